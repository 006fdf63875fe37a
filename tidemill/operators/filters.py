"""Filters, lookups and rollups of announcement rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import at_hand


def among(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose value is one of those in the one column of `wanted`."""
    return rows.join(at_hand(wanted.toDF(column).distinct()), column, "left_semi")


def newer(rows: DataFrame, by: list[str], time: str, marks: DataFrame, cutoff: str, full: bool = False) -> DataFrame:
    """The rows later than the watermark (by, high_watermark) of their key, or than the cutoff where a key has none yet; all with a time, if `full`.

    Later is strict. A row without time is never taken; null keys are keys of their own.
    """
    if full:
        return rows.where(F.col(time).isNotNull())
    known = marks.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("high_watermark").alias("_mark"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return rows.join(at_hand(known), same, "left").where(F.col(time) > F.coalesce("_mark", F.lit(cutoff))).drop("_mark", *[f"_{c}" for c in by])


def fresh(rows: DataFrame, status: str, posted: str, day: str, days: int = 2) -> DataFrame:
    """Adds fresh: whether a row changed, or has no (readable) time of posting, or was posted `days` days before its `day` at the earliest."""
    posted_on = F.try_to_date(F.substring(posted, 1, 10))
    return rows.withColumn("fresh", F.coalesce((F.lower(F.trim(status)) == "changed") | posted_on.isNull() | (posted_on >= F.date_sub(F.try_to_date(day), days)), F.lit(False)))


def first_of(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Adds is_first: whether a row is the first of its key by `order`. Firsts come from an aggregate, so that no key is one task's."""
    firsts = rows.groupBy(*by).agg(F.min(F.struct(*order)).alias("_first"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    joined = rows.join(at_hand(firsts.select(*[F.col(c).alias(f"_{c}") for c in by], "_first")), same, "left")
    return joined.withColumn("is_first", F.struct(*order) == F.col("_first")).drop("_first", *[f"_{c}" for c in by])


def first_rows(rows: DataFrame, by: list[str], order: list[Column], n: int, name: str = "rank") -> DataFrame:
    """The first n rows of each key by `order`, with their rank from 1; each task hands on n of a key at most."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= n)


def rolled_up(keys: DataFrame, rows: DataFrame, by: list[str], key: str, time: str, text: str, n: int = 3) -> DataFrame:
    """(by, n_rows, newest, first_text): for every key of the list, 0 where it has no row, the newest n rows (joined by commas) and the first text that isn't null by time."""
    counts = rows.groupBy(*by).agg(F.count_distinct(key).alias("n_rows"), F.min(F.when(F.col(text).isNotNull(), F.struct(time, key, text)))[text].alias("first_text"))
    top = first_rows(rows.select(*by, key, time).distinct(), by, [F.desc(time), F.asc(key)], n).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("rank", key))).alias("_t"))  # n at most
    newest = top.select(*by, F.array_join(F.transform("_t", lambda t: t[key]), ",").alias("newest"))
    return keys.distinct().join(at_hand(counts), by, "left").join(at_hand(newest), by, "left").select(*by, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("newest", F.lit("")).alias("newest"), "first_text")


def paged(rows: DataFrame, order: list[Column], size: int = 20) -> DataFrame:
    """Adds page, from 0, of a filtered result that is small enough to be read by people."""
    return rows.withColumn("page", F.floor((F.row_number().over(Window.orderBy(*order)) - 1) / F.lit(size)))
