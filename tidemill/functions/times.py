"""Readings of written times: all instants that a text may name."""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta
from functools import lru_cache
from typing import NamedTuple
from zoneinfo import ZoneInfo

# ---- fixed values: month names and zone abbreviations -------------------------------------------
#: Beginnings of month names after lower-casing and dropping accents, by number; English, French, Indonesian.
MONTHS = {
    "jan": 1, "feb": 2, "fev": 2, "mar": 3, "apr": 4, "avr": 4, "may": 5, "mai": 5, "mei": 5, "jun": 6, "juin": 6, "jul": 7, "juil": 7,
    "aug": 8, "aou": 8, "agu": 8, "sep": 9, "oct": 10, "okt": 10, "nov": 11, "dec": 12, "des": 12,
}
#: Offsets in minutes that an abbreviation has at some place; which one holds depends on the source's place.
ABBREVIATIONS = {
    "UTC": [0], "GMT": [0], "Z": [0], "WET": [0], "WEST": [60], "BST": [60, 360, 660], "IST": [330, 60, 120], "CET": [60], "CEST": [120],
    "EET": [120], "EEST": [180], "MSK": [180], "ICT": [420], "WIB": [420], "WITA": [480], "WIT": [540], "SGT": [480], "HKT": [480],
    "MYT": [480], "PHT": [480], "JST": [540], "KST": [540], "CST": [-360, 480, -300], "CDT": [-300, -240], "EST": [-300, 600], "EDT": [-240, 660],
    "MST": [-420, 480], "MDT": [-360], "PST": [-480, 480], "PDT": [-420], "AST": [-240, 180], "ADT": [-180],
}
# -------------------------------------------------------------------------------------------------

#: Costs in the choice of readings: against the source's declared order or place, a switch of format, a step back in time.
AGAINST_SOURCE, SWITCH, BACKWARD = 1_000.0, 1.0, 0.5
#: Bare digits are tried as seconds, milli-, micro- and nanoseconds; instants in these years are readings.
EPOCH_YEARS = (1990, 2100)


class Reading(NamedTuple):
    """One way to read a value: `form` names format and order of the date, `at` is in seconds since 1970."""

    form: str
    at: int
    cost: float


_ACCENTS = str.maketrans("àâäáãçéèêëíìîïóòôöõúùûüý", "aaaaaceeeeiiiiooooouuuuy")
_CLOCK = r"(?P<h>\d{1,2})\s*[:h.]\s*(?P<mi>\d{2})(?:[:.](?P<s>\d{2})(?:[.,]\d+)?)?\s*(?P<ap>[ap]\.?m\.?)?"
_YMD = re.compile(r"(?P<y>\d{4})\s*(?:[-/.]|年)\s*(?P<mo>\d{1,2})\s*(?:[-/.]|月)\s*(?P<d>\d{1,2})日?")
_COMPACT = re.compile(r"(?P<y>\d{4})(?P<mo>\d{2})(?P<d>\d{2})t(?P<h>\d{2})(?P<mi>\d{2})(?P<s>\d{2})(?:[.,]\d+)?")
_NUMERIC = re.compile(r"(?<!\d)(?P<a>\d{1,2})\s*[-/.]\s*(?P<b>\d{1,2})\s*[-/.]\s*(?P<y>\d{4}|\d{2})(?!\d)")
_NAMED = re.compile(r"(?<!\d)(?P<d>\d{1,2})(?:er|st|nd|rd|th)?[\s-]+(?P<m>[a-z]{3,10})\.?[\s,-]+(?P<y>\d{4})")
_NAMED_US = re.compile(r"(?P<m>[a-z]{3,10})\.?\s+(?P<d>\d{1,2})(?:st|nd|rd|th)?,?\s+(?P<y>\d{4})")
_THANG = re.compile(r"(?<!\d)(?P<d>\d{1,2})\s+thang\s+(?P<mo>\d{1,2}),?\s+(?:nam\s+)?(?P<y>\d{4})")
_TIME = re.compile(rf"(?<![\d.]){_CLOCK}")
_OFFSET = re.compile(r"(?:utc|gmt)?\s*(?P<sign>[+-])(?P<oh>\d{1,2})(?::?(?P<om>\d{2}))?\s*\)?\s*$")
_ABBREVIATION = re.compile(r"(?:^|[\s\d(])(?P<z>[a-z]{1,4})\s*\)?\s*$")
_DIGITS = re.compile(r"(?P<n>\d+)(?:\.\d+)?")


@lru_cache(maxsize=256)
def _place(name: str | None) -> ZoneInfo | None:
    try:
        return ZoneInfo(name) if name else None
    except (KeyError, ValueError, OSError):
        return None


@lru_cache(maxsize=4096)
def _abbreviated(letters: str, zone_name: str | None, year: int) -> tuple[tuple[int, float], ...]:
    """(offset in minutes, cost) of an abbreviation; what the source's place calls so costs nothing."""
    zone, offsets = _place(zone_name), list(ABBREVIATIONS.get(letters, []))
    if zone:
        for month in (1, 7):
            there = datetime(year, month, 1, tzinfo=zone)
            own = int(there.utcoffset().total_seconds() // 60)
            if there.tzname() == letters:
                return ((own, 0.0),)
    if len(offsets) < 2 or not zone:
        return tuple((o, 0.0) for o in offsets)
    near = datetime(year, 1, 1, tzinfo=zone).utcoffset().total_seconds() / 60
    best = min(offsets, key=lambda o: (abs(o - near), o))
    return tuple((o, 0.0 if o == best else AGAINST_SOURCE) for o in offsets)


def _instants(day: datetime, text: str, zone_name: str | None) -> list[tuple[str, datetime, float]]:
    """The UTC times of a local time: by its written offset or abbreviation, else by the source's place (UTC where it has none)."""
    if text.endswith("z") and not text[-2:-1].isalpha():
        return [("z", day, 0.0)]
    if m := _OFFSET.search(text):
        hours, minutes = int(m["oh"]), int(m["om"] or 0)
        if hours <= 18 and minutes < 60:
            shift = timedelta(hours=hours, minutes=minutes) * (1 if m["sign"] == "+" else -1)
            return [("offset", day - shift, 0.0)]
    if (m := _ABBREVIATION.search(text)) and m["z"].upper() not in ("AM", "PM"):
        found = _abbreviated(m["z"].upper(), zone_name, day.year)
        if found:
            return [("abbreviated", day - timedelta(minutes=o), c) for o, c in found]
    zone = _place(zone_name)
    if zone is None:
        return [("local", day, 0.0)]
    # fold 0: of a time that occurs twice the first; a skipped time is read with the offset before the gap
    return [("local", day.replace(tzinfo=zone, fold=0).astimezone(UTC).replace(tzinfo=None), 0.0)]


def _days(text: str, order: str | None) -> list[tuple[str, int, int, int, float, str]]:
    """(form, year, month, day, cost, rest of the text) of every reading of the date."""

    def rest(m: re.Match) -> str:
        return f"{text[: m.start()]} {text[m.end() :]}"

    if m := _YMD.search(text):
        return [("ymd4", int(m["y"]), int(m["mo"]), int(m["d"]), 0.0, rest(m))]
    if m := _THANG.search(text):
        return [("words", int(m["y"]), int(m["mo"]), int(m["d"]), 0.0, rest(m))]
    if m := _NUMERIC.search(text):
        a, b, y = int(m["a"]), int(m["b"]), int(m["y"])
        ways = {"dmy": (y, b, a), "mdy": (y, a, b)}
        if len(m["y"]) == 2:
            ways = {k: (2000 + v[0], *v[1:]) for k, v in ways.items()} | {"ymd": (2000 + a, b, y)}
        # a source whose dates begin with the year writes the rest day first
        declared = order if order in ways else "dmy" if order else None
        return [(k, *v, 0.0 if declared in (k, None) else AGAINST_SOURCE, rest(m)) for k, v in ways.items()]
    for pattern in (_NAMED, _NAMED_US):
        if (m := pattern.search(text)) and (month := MONTHS.get(m["m"][:4], MONTHS.get(m["m"][:3]))):
            return [("words", int(m["y"]), month, int(m["d"]), 0.0, rest(m))]
    return []


def readings(value: str | None, zone_name: str | None, order: str | None) -> list[Reading]:
    """All valid readings of a written time, cheapest first; none for null, unusable values and impossible dates."""
    text = (value or "").strip().lower().translate(_ACCENTS)
    if not text:
        return []
    if m := _DIGITS.fullmatch(text):
        found = []
        for unit, per in (("s", 1), ("ms", 1_000), ("us", 1_000_000), ("ns", 1_000_000_000)):
            at = int(m["n"]) // per
            if datetime(EPOCH_YEARS[0], 1, 1, tzinfo=UTC).timestamp() <= at < datetime(EPOCH_YEARS[1], 1, 1, tzinfo=UTC).timestamp():
                found.append(Reading(f"epoch {unit}", at, 0.0))
        return found
    found = []
    if m := _COMPACT.match(text):
        days = [("compact", int(m["y"]), int(m["mo"]), int(m["d"]), 0.0, None)]
    else:
        days = _days(text, order)
    for form, year, month, day, cost, rest in days:
        try:
            if rest is None:
                clock, tail = (int(m["h"]), int(m["mi"]), int(m["s"])), text[m.end() :]
            elif t := _TIME.search(rest):
                hour = int(t["h"])
                if t["ap"]:
                    if not 1 <= hour <= 12:
                        continue
                    hour = hour % 12 + 12 * (t["ap"][0] == "p")
                clock, tail = (hour, int(t["mi"]), int(t["s"] or 0)), rest[: t.start()] + " " + rest[t.end() :]
            else:
                clock, tail = (0, 0, 0), rest
            extra = timedelta(days=1) if clock == (24, 0, 0) else timedelta()
            local = datetime(year, month, day, clock[0] % 24 if extra else clock[0], *clock[1:]) + extra
            for kind, utc, more in _instants(local, tail.strip(), zone_name):
                found.append(Reading(f"{form} {kind}", int(utc.replace(tzinfo=UTC).timestamp()), cost + more))
        except (ValueError, OverflowError):
            continue
    return sorted(found, key=lambda r: (r.cost, r.form, r.at))
