import random
from datetime import UTC, datetime

import pytest

from tidemill.functions.times import BACKWARD, SWITCH, readings
from tidemill.operators.timelines import resolve
from tidemill.plans.clocks import utc_times


def first(value, zone="America/New_York", order="mdy"):
    found = readings(value, zone, order)
    return datetime.fromtimestamp(found[0].at, UTC).strftime("%Y-%m-%dT%H:%M:%SZ") if found else None


@pytest.mark.parametrize(
    ("value", "zone", "order", "expected"),
    [
        ("2025-11-02 01:30:00", "America/New_York", "mdy", "2025-11-02T05:30:00Z"),  # occurs twice: the first
        ("2026-03-08 02:30:00", "America/New_York", "mdy", "2026-03-08T07:30:00Z"),  # skipped: moved on by the gap
        ("2025-10-26 02:30", "Europe/Paris", "dmy", "2025-10-26T00:30:00Z"),
        ("03/04/2026 10:00", "Europe/London", "dmy", "2026-04-03T09:00:00Z"),
        ("03/04/2026 10:00", "America/New_York", "mdy", "2026-03-04T15:00:00Z"),
        ("26/03/04 10:00", "UTC", "ymd", "2026-03-04T10:00:00Z"),
        ("2025-09-03", "Asia/Jakarta", "dmy", "2025-09-02T17:00:00Z"),
        ("1756758580808472", "Asia/Jakarta", "dmy", "2025-09-01T20:29:40Z"),
        ("1757593048.557", "Asia/Jakarta", "dmy", "2025-09-11T12:17:28Z"),
        ("20250901T082232Z", "Asia/Jakarta", "dmy", "2025-09-01T08:22:32Z"),
        ("Wed, 03 Sep 2025 05:22:11 +0700", None, None, "2025-09-02T22:22:11Z"),
        ("Sep 10, 2025, 1:13 PM (GMT+7)", None, None, "2025-09-10T06:13:00Z"),
        ("Jan 12, 2026, 12:05 AM (UTC)", None, None, "2026-01-12T00:05:00Z"),
        ("29 mars 2026 à 2h35", "Europe/Paris", "dmy", "2026-03-29T01:35:00Z"),
        ("1 août 2025 à 9h05", "Europe/Paris", "dmy", "2025-08-01T07:05:00Z"),
        ("14 September 2025 pukul 05.40", "Asia/Jakarta", "dmy", "2025-09-13T22:40:00Z"),
        ("14 tháng 9, 2025 15:27", "Asia/Ho_Chi_Minh", "dmy", "2025-09-14T08:27:00Z"),
        ("03:14 ngày 27/09/2025", "Asia/Ho_Chi_Minh", "dmy", "2025-09-26T20:14:00Z"),
        ("2026年1月26日 23:47:01", "Asia/Shanghai", "ymd", "2026-01-26T15:47:01Z"),
        ("2026-01-26 10:00:00 CST", "Asia/Shanghai", "ymd", "2026-01-26T02:00:00Z"),
        ("2026-01-26 10:00:00 CST", "America/Chicago", "mdy", "2026-01-26T16:00:00Z"),
        ("2025-09-02 07:36:35 BST", "Europe/London", "dmy", "2025-09-02T06:36:35Z"),
        ("2025-09-03 05:00:02 HKT", "Asia/Shanghai", "ymd", "2025-09-02T21:00:02Z"),
        ("2025-09-02T18:30:24.402+0530", None, None, "2025-09-02T13:00:24Z"),
        (" 2025-09-01  10:44:17 ", "UTC", "ymd", "2025-09-01T10:44:17Z"),
        ("2025-09-02T08:57:46z", "Asia/Jakarta", "dmy", "2025-09-02T08:57:46Z"),
    ],
)
def test_readings(value, zone, order, expected):
    assert first(value, zone, order) == expected


@pytest.mark.parametrize("value", [None, "", " ", "TBD", "soon", "N/A", "--:--", "null", "-", "2026-02-30 10:00:00", "2025-13-04T09:00:00Z", "0000-00-00 00:00:00", "31/02/2026", "25:61", "x" * 100_000])
def test_no_reading(value):
    assert first(value) is None


SCHEMA = "uid string, source string, locale string, fetched_at string, post_time string, update_time string, _value int"
CLOCKS = "source string, locale string, zone_name string, date_order string"


def run(spark, rows, clocks):
    found = utc_times(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA), spark.createDataFrame(clocks, CLOCKS))
    return sorted(tuple(r) for r in found.collect())


def test_announcements(spark):
    clocks = [("S", "FR", "Europe/Paris", "dmy")]
    rows = [("a", "S", "FR", "2025-09-02T00:00:00Z", "01/09/2025 10:00", None), ("b", "S", "FR", None, "2025-09-01T00:00:00Z", "TBD"), ("c", None, None, "2025-09-02T00:00:00Z", None, "2025-09-05 10:00")]
    rows += [(None, "S", "FR", "2025-09-02T00:00:00Z", "2025-09-05", None), ("a", "S", "FR", "2025-09-02T00:00:00Z", "01/09/2025 10:00", None)]
    assert run(spark, rows, clocks) == [("a", "post_time", "2025-09-01T08:00:00Z"), ("c", "update_time", "2025-09-05T10:00:00Z")]
    assert run(spark, [], clocks) == [] and len(run(spark, rows, [])) == 2


def test_order_of_records_decides_where_nothing_is_known(spark):
    values = [("2025-03-28T00:00:00Z", "28/03/2025"), ("2025-04-02T00:00:00Z", "02/04/2025"), ("2025-04-03T00:00:00Z", "03/04/2025"), ("2025-04-14T00:00:00Z", "14/04/2025")]
    rows = spark.createDataFrame([("c", t, f"u{i}", v, None, None) for i, (t, v) in enumerate(values)], "_chain string, _arrived string, _id string, _value string, _zone string, _order string")
    found = {r._value: r for r in resolve(rows).collect()}
    assert {r.form for r in found.values()} == {"dmy local"} and found["02/04/2025"].n_readings == 2


def test_chains_over_many_partitions_against_one_plain_pass(spark):
    rng = random.Random(5)
    values = [("c" if i % 3 else "d", f"{i:04}", f"u{i:04}", rng.choice(["{a:02}/{b:02}/2025", "{a:02}-{b:02}-2025 10:00", "2025-{a:02}-{b:02}"]).format(a=rng.randint(1, 12), b=rng.randint(1, 12))) for i in range(600)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.createDataFrame([(*v, None, None) for v in values], "_chain string, _arrived string, _id string, _value string, _zone string, _order string")
    got = {(r._chain, r._id): (r.at, r.form) for r in resolve(rows).collect()}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    def price(path):
        return sum(b.cost + SWITCH * (a.form != b.form) + BACKWARD * (b.at < a.at) for a, b in zip(path, path[1:])) + path[0].cost

    for chain in "cd":
        own = [(i, readings(v, None, None)) for c, _, i, v in values if c == chain]
        best = [(s.cost, [s]) for s in own[0][1]]
        for _, states in own[1:]:
            best = [min(((c + s.cost + SWITCH * (p[-1].form != s.form) + BACKWARD * (s.at < p[-1].at), [*p, s]) for c, p in best), key=lambda x: x[0]) for s in states]
        took = [next(s for s in states if (s.at, s.form) == got[chain, i]) for i, states in own]
        assert abs(price(took) - min(best, key=lambda x: x[0])[0]) < 1e-6
