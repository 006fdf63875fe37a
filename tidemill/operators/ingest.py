"""Taking in deliveries: change detection, archive, watermarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.keys import content_hash


def latest(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row for each key: the greatest by `order`, then by all columns. Repeats collapse before the shuffle."""
    columns = rows.columns
    best = rows.groupBy(F.col(key).alias("_key")).agg(F.max(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*columns).alias("_row"))).alias("_best"))
    return best.where("_key is not null").select("_best._row.*")


def upsert(current: DataFrame, incoming: DataFrame, key: str = "uid") -> tuple[DataFrame, DataFrame]:
    """(new state, archived rows) of a table with (key, content, content_hash, status, fetched_at, update_time, push_status).

    `incoming` has (key, content, fetched_at), of rows of one key the latest by fetched_at counts. Unknown
    keys are inserted as new; where the content differs the old content is archived with the time from
    which it held, and the row becomes changed at the incoming fetched_at; equal content changes nothing,
    nor do keys that aren't delivered. Running it again with the same input changes nothing.
    """
    new = latest(incoming.select(key, "content", "fetched_at"), key, [F.col("fetched_at")])
    new = new.select(F.col(key).alias("_k"), F.col("content").alias("_content"), content_hash(F.col("content")).alias("_hash"), F.col("fetched_at").alias("_at"))
    both = current.join(new, F.col(key) == F.col("_k"), "full")
    fresh = F.col(key).isNull()
    changed = F.col("_k").isNotNull() & F.col(key).isNotNull() & ~F.col("content_hash").eqNullSafe(F.col("_hash"))

    def pick(insert: Column, update: Column, keep: Column) -> Column:
        return F.when(fresh, insert).when(changed, update).otherwise(keep)

    state = both.select(
        F.coalesce(F.col(key), F.col("_k")).alias(key),
        pick(F.col("_content"), F.col("_content"), F.col("content")).alias("content"),
        pick(F.col("_hash"), F.col("_hash"), F.col("content_hash")).alias("content_hash"),
        pick(F.lit("new"), F.lit("changed"), F.col("status")).alias("status"),
        pick(F.col("_at"), F.col("fetched_at"), F.col("fetched_at")).alias("fetched_at"),
        pick(F.lit(None), F.col("_at"), F.col("update_time")).alias("update_time"),
        pick(F.lit("pending"), F.lit("pending"), F.col("push_status")).alias("push_status"),
    )
    since = F.coalesce(F.nullif("update_time", F.lit("")), F.col("fetched_at"))
    archived = both.where(changed).select(key, "content_hash", "content", since.alias("captured_at"))
    return state, archived


def watermarks(rows: DataFrame, by: list[str], time: str, before: DataFrame | None = None) -> DataFrame:
    """(by, high_watermark): the greatest time seen so far for each key; null keys are keys of their own, null times don't count."""
    seen = rows.select(*by, F.col(time).alias("high_watermark"))
    if before is not None:
        seen = seen.unionByName(before.select(*by, "high_watermark"))
    return seen.groupBy(*by).agg(F.max("high_watermark").alias("high_watermark"))


def changed_versions(items: DataFrame, state: DataFrame, key: str, version: str) -> DataFrame:
    """The items whose version isn't the one of the stored state: what must be fetched again."""
    known = state.select(F.col(key).alias("_k"), F.col(version).alias("_v"))
    return items.join(known, F.col(key) == F.col("_k"), "left").where(~F.col(version).eqNullSafe(F.col("_v"))).drop("_k", "_v")


def sync_actions(desired: DataFrame, existing: DataFrame, key: str, compared: list[str]) -> DataFrame:
    """(key, action): create, update, skip or delete, by which `existing` becomes `desired`; '' equals null. Keys are unique."""
    a = desired.select(F.col(key).alias("_a"), F.struct(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in compared]).alias("_x"))
    b = existing.select(F.col(key).alias("_b"), F.struct(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in compared]).alias("_y"))
    action = F.when(F.col("_b").isNull(), "create").when(F.col("_a").isNull(), "delete").when(F.col("_x").eqNullSafe(F.col("_y")), "skip").otherwise("update")
    return a.join(b, F.col("_a") == F.col("_b"), "full").select(F.coalesce("_a", "_b").alias(key), action.alias("action"))


def merged(current: DataFrame, incoming: DataFrame, key: str, version: str, replaced: list[str], filled: list[str], kept: list[str], at: str) -> DataFrame:
    """The new state of a keyed table, with action: new, changed, unchanged, moved or absent.

    A key that isn't in the state is new; another version is a change, and status, update_time and push_status follow it, update_time being the
    incoming `at`. With an equal version nothing changes but: `replaced` columns take the incoming value (moved, if one differs), `filled` columns
    take it where it isn't null. `kept` columns never change after the first time. Keys that aren't delivered stay. Both have unique keys; running
    it again with the same input changes nothing more.
    """
    columns = [version, *replaced, *filled, *kept, at]
    both = current.alias("c").join(incoming.alias("i"), F.col(f"c.{key}") == F.col(f"i.{key}"), "full")
    old, new = F.col(f"c.{key}"), F.col(f"i.{key}")
    moved = F.lit(False)
    for c in replaced:
        moved |= ~F.col(f"c.{c}").eqNullSafe(F.col(f"i.{c}"))
    action = F.when(old.isNull(), "new").when(new.isNull(), "absent").when(~F.col(f"c.{version}").eqNullSafe(F.col(f"i.{version}")), "changed").when(moved, "moved").otherwise("unchanged")

    def value(c: str) -> Column:
        was, now = F.col(f"c.{c}"), F.col(f"i.{c}")
        if c in kept or c == at:
            return F.when(old.isNull(), now).otherwise(was)
        return F.when(new.isNull(), was).otherwise(F.coalesce(now, was) if c in filled else now)

    return both.select(F.coalesce(old, new).alias(key), *[value(c).alias(c) for c in columns], action.alias("action"), *[F.col(f"c.{c}").alias(f"_was_{c}") for c in ("status", "update_time", "push_status")], F.col(f"i.{at}").alias("_at")).select(
        key, *columns, "action",
        F.when(F.col("action") == "new", "new").when(F.col("action") == "changed", "changed").otherwise(F.col("_was_status")).alias("status"),
        F.when(F.col("action") == "changed", F.col("_at")).otherwise(F.col("_was_update_time")).alias("update_time"),
        F.when(F.col("action").isin("new", "changed"), "pending").otherwise(F.col("_was_push_status")).alias("push_status"),
    )


def run_counts(state: DataFrame) -> DataFrame:
    """(action, n) of a merged state."""
    return state.groupBy("action").agg(F.count("*").alias("n"))


def marked_again(rows: DataFrame, key: str, same: list[str], order: Column, marks: DataFrame) -> DataFrame:
    """(key, duplicate_of): the marks there are, and those of the rows that have none yet, clustered among themselves.

    So a late copy points to the canonical row, and one that comes late but is earlier becomes canonical: the former canonical then points to it, and rows marked before stay as they are.
    """
    from tidemill.operators.groups import duplicates

    open_rows = rows.join(marks.select(key), key, "left_anti")
    return marks.select(key, "duplicate_of").unionByName(duplicates(open_rows, key, same, order))


def cleaned(rows: DataFrame, history: DataFrame, key: str, captured: Column, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """(rows, history) after a clean-up: history captured between start and end is dropped, and the changed rows it belongs to are new again."""
    scope = history.where(captured.between(start, end)).select(key).distinct()
    left = history.where(~F.coalesce(captured.between(start, end), F.lit(False)))
    hit = rows.join(scope.withColumn("_hit", F.lit(True)), key, "left")
    status = F.when(F.col("_hit") & (F.lower(F.trim("status")) == "changed"), "new").otherwise(F.col("status"))
    return hit.withColumn("status", status).drop("_hit"), left
