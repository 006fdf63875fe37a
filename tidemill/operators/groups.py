"""Copies, language groups and batches of announcements.

Groups are reduced with aggregates that combine before the shuffle. Where results are joined back, only those of groups
to which something applies are, and they are broadcast up to a checked number; beyond it the join shuffles the rows by
group, and a group that holds a large part of them is split at run time by the engine's skew join (adaptive execution).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import at_hand


def duplicates(rows: DataFrame, key: str, same: list[str], order: Column) -> DataFrame:
    """(key, duplicate_of): rows equal in `same`, all non-empty, point to the first of them by (order, key)."""
    filled = rows.where(" and ".join(f"`{c}` is not null and `{c}` <> ''" for c in same)).select(key, *same, order.alias("_o")).distinct()
    firsts = filled.groupBy(*same).agg(F.min(F.struct("_o", key)).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    return filled.join(at_hand(firsts), same).where(F.col(key) != F.col(f"_first.{key}")).select(key, F.col(f"_first.{key}").alias("duplicate_of")).distinct()


def conflicting(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, value, n): the distinct non-null values, a row each, of the keys that have more than one; n is their number."""
    pairs = rows.where(F.col(value).isNotNull()).select(*by, value).distinct()
    several = pairs.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1")
    return pairs.alias("p").join(at_hand(several).alias("s"), [F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}")) for c in by]).select(*[f"p.{c}" for c in by], f"p.{value}", "s.n")


def region_exclusive(rows: DataFrame, group: str, locale: str, common: str = "EN") -> DataFrame:
    """(group, exclusive): whether a group appears in one locale only that isn't the common one."""
    seen = rows.where(F.col(group).isNotNull()).groupBy(group).agg(F.min(locale).alias("_a"), F.max(locale).alias("_b"))
    return seen.select(group, F.coalesce((F.col("_a") == F.col("_b")) & (F.col("_a") != common), F.lit(False)).alias("exclusive"))


def variants(rows: DataFrame, by: list[str], key: str, locale: str, text: str, preferred: list[str]) -> DataFrame:
    """(by, n_rows, locales, representative): the variants of a group; the representative is of the most preferred locale, then of the longest text."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(p) for p in preferred]), F.col(locale)), F.lit(0))
    rank = F.when(rank == 0, len(preferred) + 1).otherwise(rank)
    best = F.min(F.struct(rank.alias("r"), (-F.length(F.coalesce(text, F.lit("")))).alias("l"), F.col(key).alias("k")))["k"]
    return rows.groupBy(*by).agg(F.count_distinct(key).alias("n_rows"), F.array_join(F.sort_array(F.collect_set(locale)), ",").alias("locales"), best.alias("representative"))


def counted_once(rows: DataFrame, key: str, group: str, source: str, locale: str, title: Column, order: Column) -> DataFrame:
    """Keys to count: the first of each group, unless the same source has that title earlier in another locale."""
    own = rows.select(key, F.coalesce(group, key).alias("_g"), source, locale, title.alias("_t"), order.alias("_o")).distinct()
    head = F.struct("_o", key, source, locale, "_t")
    firsts = own.groupBy("_g").agg(F.min(head).alias("_f")).select("_f.*")
    leaders = firsts.groupBy(source, "_t").agg(F.min(F.struct("_o", key, locale)).alias("_l"))
    kept = firsts.join(at_hand(leaders), [source, "_t"]).where((F.col(key) == F.col(f"_l.{key}")) | F.col(locale).eqNullSafe(F.col(f"_l.{locale}")))
    return kept.select(key)


def reusable(rows: DataFrame, batch: list[str], locale: str, group: str, base: str = "EN") -> DataFrame:
    """(batch, locale, n): batches whose set of groups is exactly that of the base locale's batch."""
    sets = rows.where(F.col(group).isNotNull()).select(*batch, locale, group).distinct().groupBy(*batch, locale).agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64(group)).alias("_x"), F.sum(F.xxhash64(F.lit(1), group).cast("decimal(38,0)")).alias("_s")
    )
    other = sets.where(F.col(locale) != base)
    en = sets.where(F.col(locale) == base).drop(locale)
    return other.join(en, [*batch, "n", "_x", "_s"]).select(*batch, locale, "n")


def daily_trend(rows: DataFrame, day: str, category: str, counted: Column) -> DataFrame:
    """(day, category, n): distinct values counted on each day seen for each category seen, 0 included."""
    seen = rows.where(F.col(day).isNotNull() & F.col(category).isNotNull())
    n = seen.groupBy(day, category).agg(F.count_distinct(counted).alias("n"))
    days, categories = n.select(day).distinct(), n.select(category).distinct()
    # a calendar and a list of kinds: days x kinds rows, not data
    grid = days.crossJoin(categories)
    return grid.join(n, [day, category], "left").select(day, category, F.coalesce("n", F.lit(0)).alias("n"))


def top_capped(rows: DataFrame, order: list[Column], per: str, most_per: int, most: int) -> DataFrame:
    """The first `most` rows by `order` with at most `most_per` of one value of `per`.

    Only each task's best rows go on: the first rows of every group are found by partial top lists.
    """
    ranked = Window.partitionBy(per).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(ranked)).where(F.col("_r") <= most_per).orderBy(*order).limit(most).drop("_r")


def round_robin(rows: DataFrame, by: list[str], order: list[Column], per: int) -> DataFrame:
    """The first `per` rows of each group by `order`, with their depth from 0: taken in order of depth they cover all groups first."""
    ranked = Window.partitionBy(*by).orderBy(*order)
    # the filter is on the rank itself, so that each task hands on `per` rows of a group only
    return rows.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= per).withColumn("depth", F.col("_rank") - 1).drop("_rank")
