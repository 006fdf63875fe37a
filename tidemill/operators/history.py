"""History of changing entity attributes.

Method: every attribute has its own change log with its own intervals; the logs are combined by
splitting at the union of their boundary times and coalescing neighbours of equal values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a bucket. Captures of one second collapse to one, so a key has at most so many rows in a bucket.
BUCKET_S = 30 * 86_400
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def digest(value: Column) -> Column:
    """32 bytes that stand for the value; null and empty are equal."""
    return F.unhex(F.sha2(F.coalesce(value.cast("string"), F.lit("")), 256))


def whole_seconds(value: Column) -> Column:
    """Seconds since 1970, fractions cut off, of an ISO time (UTC where no zone is written); null where it is none."""
    return F.floor(F.unix_micros(F.try_to_timestamp(value.cast("string"))) / F.lit(1_000_000)).cast("long")


def iso(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), ISO)


def neighbour(rows: DataFrame, what: Column, name: str, forward: bool = False) -> DataFrame:
    """Adds `what` of the key's row before (or after) by time as `name`; rows have _key, _bucket and _at.

    Windows run inside (key, bucket), so no key fills one task; only one row of each key and bucket
    goes through the window over the whole key.
    """
    inside = Window.partitionBy("_key", "_bucket").orderBy("_at")
    over = Window.partitionBy("_key").orderBy("_bucket")
    step, edge = (F.lead, F.min_by) if forward else (F.lag, F.max_by)
    edges = rows.groupBy("_key", "_bucket").agg(edge(what, F.col("_at")).alias("_edge"))
    edges = edges.select("_key", "_bucket", step("_edge").over(over).alias("_edge")).where("_edge is not null")
    return (
        rows.withColumn("_near", step(what).over(inside))
        .join(edges, ["_key", "_bucket"], "left")
        .withColumn(name, F.coalesce("_near", "_edge"))
        .drop("_near", "_edge")
    )


def change_log(captures: DataFrame, key: str, captured: str, order: str, attributes: Sequence[str]) -> DataFrame:
    """Rows (_key, _bucket, _attribute, _at, _value, _order): each time an attribute of a key took another value.

    Of captures in one second the highest `order` stands (at equal order the greatest digests); null
    order comes first. Captures without key or readable time are no events. Null and empty values are
    equal; _value is the digest of the value, _order names the capture that brought it.
    """
    names = [f"_d{i}" for i in range(len(attributes))]
    slim = captures.select(
        F.col(key).alias("_key"),
        whole_seconds(F.col(captured)).alias("_at"),
        F.struct(F.col(order).alias("_order"), *[digest(F.col(a)).alias(n) for a, n in zip(attributes, names)]).alias("_c"),
    ).where("_key is not null and _at is not null")
    # partial aggregation collapses repeats before the shuffle
    states = slim.groupBy("_key", F.floor(F.col("_at") / F.lit(BUCKET_S)).alias("_bucket"), "_at").agg(F.max("_c").alias("_c"))
    seen = neighbour(states, F.col("_c"), "_was")
    events = F.filter(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("attribute"),
                    F.col(f"_c.{n}").alias("value"),
                    (~F.col(f"_c.{n}").eqNullSafe(F.col(f"_was.{n}"))).alias("moved"),
                )
                for a, n in zip(attributes, names)
            ]
        ),
        lambda x: x["moved"],
    )
    return seen.select("_key", "_bucket", "_at", "_c._order", F.explode(events).alias("_e")).select(
        "_key", "_bucket", F.col("_e.attribute").alias("_attribute"), "_at", F.col("_e.value").alias("_value"), "_order"
    )


def attribute_intervals(log: DataFrame, key: str) -> DataFrame:
    """(key, attribute, value_digest, order_no, valid_from, valid_to): the intervals of each attribute on its own."""
    each = log.select(F.struct("_key", "_attribute").alias("_key"), "_bucket", "_at", "_value", "_order")
    return neighbour(each, F.col("_at"), "_to", forward=True).select(
        F.col("_key._key").alias(key),
        F.col("_key._attribute").alias("attribute"),
        F.hex("_value").alias("value_digest"),
        F.col("_order").alias("order_no"),
        iso(F.col("_at")).alias("valid_from"),
        F.coalesce(iso(F.col("_to")), F.lit("")).alias("valid_to"),
    )


def versions(log: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """(key, valid_from, valid_to): the logs of `attributes` split at the union of their boundary times, coalesced.

    valid_to is '' for the last version. An empty log gives no versions.
    """
    wanted = log.where(F.col("_attribute").isin(*attributes))
    split = wanted.groupBy("_key", "_bucket", "_at").agg(
        *[F.max(F.when(F.col("_attribute") == a, F.col("_value"))).alias(f"_v{i}") for i, a in enumerate(attributes)]
    )
    if len(attributes) > 1:  # at a boundary of one attribute the others keep the value they had
        before = Window.partitionBy("_key", "_bucket").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
        cols = [f"_v{i}" for i in range(len(attributes))]
        lasts = split.groupBy("_key", "_bucket").agg(
            *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(f"_l{c}") for c in cols]
        )
        earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        carried = lasts.select("_key", "_bucket", *[F.last(f"_l{c}", ignorenulls=True).over(earlier).alias(f"_l{c}") for c in cols])
        split = split.join(carried, ["_key", "_bucket"]).select(
            "_key", "_bucket", "_at", *[F.coalesce(F.last(c, ignorenulls=True).over(before), F.col(f"_l{c}")).alias(c) for c in cols]
        )
    state = F.struct(*[f"_v{i}" for i in range(len(attributes))])
    kept = neighbour(split, state, "_was").where(~state.eqNullSafe(F.col("_was"))).select("_key", "_bucket", "_at") if len(attributes) > 1 else split
    return neighbour(kept, F.col("_at"), "_to", forward=True).select(
        F.col("_key").alias(key), iso(F.col("_at")).alias("valid_from"), F.coalesce(iso(F.col("_to")), F.lit("")).alias("valid_to")
    )


def history(captures: DataFrame, key: str, captured: str, order: str, attributes: Sequence[str]) -> DataFrame:
    """One row (key, valid_from, valid_to) for each successive version of `attributes`; see change_log and versions."""
    return versions(change_log(captures, key, captured, order, attributes), key, attributes)
