"""Registered queries of the general problems, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators import history as H
from tidemill.operators.snapshots import change_counts, changes
from tidemill.plans.clocks import utc_times
from tidemill.plans.payloads import children, flat_values
from tidemill.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    found = changes(table(spark, folder, "announcement_snapshots"), "uid", "snapshot_date", "delivered_at", ["content_hash", "status"])
    return found.select(F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"), "uid", "change_kind")


def p1_counts(spark: SparkSession, folder: str) -> DataFrame:
    return change_counts(p1_found(spark, folder), "snapshot_date")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return children(table(spark, folder, "raw_payloads"))


def p2_flat(spark: SparkSession, folder: str) -> DataFrame:
    return flat_values(table(spark, folder, "raw_payloads"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return utc_times(table(spark, folder, "announcements"), table(spark, folder, "source_clocks"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return H.history(table(spark, folder, "content_history"), "uid", "captured_at", "id", ["content"])


def p4_by_order(spark: SparkSession, folder: str) -> DataFrame:
    """As p4_found, where the clocks of every other source aren't known: the order of their records decides."""
    clocks = table(spark, folder, "source_clocks").where("pmod(xxhash64(source), 2) = 0")
    return utc_times(table(spark, folder, "announcements"), clocks)


def p5_combined(spark: SparkSession, folder: str) -> DataFrame:
    """The versions of content and content_hash together: their logs split at the union of boundaries and coalesced."""
    return H.history(table(spark, folder, "content_history"), "uid", "captured_at", "id", ["content", "content_hash"])


def p5_attribute_intervals(spark: SparkSession, folder: str) -> DataFrame:
    log = H.change_log(table(spark, folder, "content_history"), "uid", "captured_at", "id", ["content", "content_hash"])
    return H.attribute_intervals(log, "uid").select("uid", "attribute", "valid_from", "valid_to")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_counts, p2_found, p2_flat, p4_found, p4_by_order, p5_found, p5_combined, p5_attribute_intervals)
}

_P1 = """
with s as (
  select uid, snapshot_date, lower(trim(coalesce(content_hash, ''))) h, lower(trim(coalesce(status, ''))) st,
    row_number() over (partition by uid, snapshot_date order by delivered_at desc) r
  from announcement_snapshots where uid is not null),
states as (select uid, snapshot_date, h, st from s where r = 1),
dates as (select snapshot_date d, lag(snapshot_date) over (order by snapshot_date) before from (select distinct snapshot_date from states)),
both_ as (
  select d, coalesce(n.uid, o.uid) uid, n.uid nu, o.uid ou, n.h nh, o.h oh, n.st ns, o.st os
  from (select d, before, uid, h, st from dates join states on snapshot_date = d where before is not null) n
  full join (select d, before, uid, h, st from dates join states on snapshot_date = before) o using (d, uid)),
found as (
  select strftime(d, '%Y-%m-%d') snapshot_date, uid,
    case when ou is null then 'added' when nu is null then 'removed' when nh <> oh or ns <> os then 'changed' end change_kind
  from both_)
"""
_P5 = """
with c as (
  select uid, date_trunc('second', try_cast(captured_at as timestamptz)) t, {value} v, id
  from content_history where uid is not null and try_cast(captured_at as timestamptz) is not null),
one as (select uid, t, v from c qualify row_number() over (partition by uid, t order by id desc) = 1),
kept as (select uid, t, v from one qualify v is distinct from lag(v) over (partition by uid order by t))
select uid, {more} strftime(t at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') valid_from,
  coalesce(strftime(lead(t) over (partition by uid order by t) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ'), '') valid_to
from kept
"""


def _p5(name: str) -> str:
    return _P5.format(value=f"coalesce({name}, '')", more=f"'{name}' attribute,")


SQL: dict[str, str] = {
    "p1_found": _P1 + "select * from found where change_kind is not null",
    "p1_counts": _P1 + "select snapshot_date, change_kind, count(*) n from found where change_kind is not null group by all",
    "p5_found": _P5.format(value="coalesce(content, '')", more=""),
    "p5_combined": _P5.format(value="(coalesce(content, ''), coalesce(content_hash, ''))", more=""),
    "p5_attribute_intervals": f"select * from ({_p5('content')}) union all select * from ({_p5('content_hash')})",
}
