"""Text functions as expressions on columns."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Dollar amounts and amounts of a token.
MONEY = r"\$[0-9][0-9,]*(?:\.[0-9]+)?|[0-9][0-9,]*(?:\.[0-9]+)? USDT"

#: Amounts as the reference reads them: signs with or without a blank, thousands and millions, tokens in any case.
BLANK = r"[\s\x1c-\x1f]"
AMOUNTS = rf"(?iuU)[$€¥]{BLANK}?[\d,.]+(?:{BLANK}?[KM])?|[\d,.]+{BLANK}?(?:USDT|USDC|BTC|ETH|WXT|STABLE|EDGE)"

# ---- fixed values: stand-in for no title, words that are no terms
UNTITLED = "(无标题)"
#: Words that are no terms: grammar, and words that any announcement may have.
STOP = """
a an and are as at be by can for from has have in into is it its may more no not of on or per than that the their then
there this to up use used using via was were will with without you your users user trading trade traders trader feature
features platform service services account accounts available support supports supported new now official officially
launch launches live update updates please click also
""".split()
# -------------------------------------------------------------------------------------------------


def clean_title(title: Column) -> Column:
    """Without tags and outer blanks; UNTITLED where nothing is left."""
    text = F.regexp_replace(F.regexp_replace(F.coalesce(title, F.lit("")), "<[^>]*>", ""), r"^\s+|\s+$", "")
    return F.when(text == "", F.lit(UNTITLED)).otherwise(text)


def same_title(title: Column) -> Column:
    """The form in which titles are compared: lower case, runs of blanks as one space."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), r"[ \t\r\n]+", " ")))


def _shown(title: str | None) -> str:
    return html.unescape(re.sub(r"<[^>]+>", "", title or "")).strip() or UNTITLED


def _folded(title: str | None) -> str:
    return re.sub(r"\s+", " ", (title or "").strip()).casefold()


@F.pandas_udf(StringType())
def shown_title(titles: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """As clean_title, with entities decoded."""
    for title in titles:
        yield title.map(_shown)


@F.pandas_udf(StringType())
def folded_title(titles: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """As same_title, of all kinds of blanks and with case folded."""
    for title in titles:
        yield title.map(_folded)


def sentences(text: Column) -> Column:
    """array of the sentences: parted after . ! ? and blanks, and at line breaks; blank ones left out."""
    return F.filter(F.split(text, r"(?<=[.!?。！？])[ \t\r\n]+|\n+"), lambda s: F.trim(s) != "")


def money(text: Column) -> Column:
    """array of the distinct amounts in order of their first place."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(MONEY), F.lit(0)))


def amounts(text: Column) -> Column:
    """array of the distinct AMOUNTS in order of their first place, blanks as one space."""
    found = F.regexp_extract_all(text, F.lit(AMOUNTS), F.lit(0))
    return F.array_distinct(F.transform(found, lambda m: F.regexp_replace(m, f"(?U){BLANK}+", " ")))


def terms(text: Column) -> Column:
    """array of the distinct runs of two or more ASCII letters and digits, lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]{2,}"), F.lit(0)))


def telling_terms(text: Column) -> Column:
    """array of the distinct runs of two or more ASCII letters, digits and Chinese characters, lower case, without those in STOP."""
    found = F.transform(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9\u4e00-\u9fff]{2,}"), F.lit(0)), F.lower)
    return F.array_except(found, F.array(*[F.lit(w) for w in STOP]))


def slug(url: Column) -> Column:
    """What follows /announcements/ in a URL, without query, fragment and outer slashes; null where there is none."""
    found = F.regexp_replace(F.regexp_extract(url, "/announcements/([^?#]+)", 1), "^/+|/+$", "")
    return F.when(found != "", found)
