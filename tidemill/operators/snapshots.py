"""What changed between full snapshots.

Method: each key's states are windowed by the index of the snapshot; the lagged state
shows changes, a gap in the indexes shows a removal and a later addition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import at_hand


def tidy(value: Column) -> Column:
    """Trimmed and lower-cased; null and empty are equal."""
    return F.coalesce(F.lower(F.regexp_replace(value.cast("string"), r"^\s+|\s+$", "")), F.lit(""))


def changes(
    snapshots: DataFrame,
    key: str,
    snapshot: str,
    delivered: str,
    compared: Sequence[str],
) -> DataFrame:
    """Rows (snapshot, key, change_kind): added, removed or changed against the snapshot before.

    The state of a key in a snapshot is its row with the latest `delivered`; of rows delivered at
    the same time the greatest compared values stand, so ties give one defined state. A null
    `delivered` counts as earliest. Rows without key or snapshot are no states. Values are compared
    after trimming and lower-casing, null as empty. The first snapshot yields nothing, nor does an
    empty table. Other columns are not read, whatever their names.

    Repeats collapse before the shuffle (partial aggregation), so no key keeps more rows than there
    are snapshots. The distinct snapshots, one row per delivery, are broadcast up to a checked number.
    """
    state = F.md5(F.to_json(F.array(*[tidy(F.col(c)) for c in compared])))
    rows = snapshots.select(
        F.col(key).alias("_key"), F.col(snapshot).alias("_at"), F.col(delivered).alias("_delivered"), F.unhex(state).alias("_state")
    ).where("_key is not null and _at is not null")
    states = rows.groupBy("_key", "_at").agg(F.max(F.struct("_delivered", "_state"))["_state"].alias("_state"))
    # one row for each delivery date of the table: a calendar, not data
    dates = (
        rows.select("_at")
        .distinct()
        .select("_at", F.row_number().over(Window.orderBy("_at")).alias("_i"), F.lead("_at").over(Window.orderBy("_at")).alias("_next"))
    )
    indexed = states.join(at_hand(dates), "_at")
    by_key = Window.partitionBy("_key").orderBy("_i")
    seen = indexed.select(
        "*",
        F.lag("_i").over(by_key).alias("_before"),
        F.lag("_state").over(by_key).alias("_was"),
        F.lead("_i").over(by_key).alias("_after"),
    )
    gap_before = F.col("_before").isNull() | (F.col("_before") < F.col("_i") - 1)
    here = (
        F.when((F.col("_i") > 1) & gap_before, F.lit("added"))
        .when(~gap_before & (F.col("_was") != F.col("_state")), F.lit("changed"))
    )
    gone = F.when(
        F.col("_next").isNotNull() & (F.col("_after").isNull() | (F.col("_after") > F.col("_i") + 1)), F.lit("removed")
    )
    found = F.filter(
        F.array(F.struct(F.col("_at").alias("at"), here.alias("kind")), F.struct(F.col("_next").alias("at"), gone.alias("kind"))),
        lambda x: x["kind"].isNotNull(),
    )
    return seen.select("_key", F.explode(found).alias("_x")).select(
        F.col("_x.at").alias(snapshot), F.col("_key").alias(key), F.col("_x.kind").alias("change_kind")
    )


def change_counts(found: DataFrame, snapshot: str) -> DataFrame:
    """Number of keys by snapshot and kind of change."""
    return found.groupBy(snapshot, "change_kind").agg(F.count("*").alias("n"))
