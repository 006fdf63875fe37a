"""The written times of announcements as UTC instants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.history import iso
from tidemill.operators.timelines import resolve

FIELDS = ("post_time", "update_time")
EXACT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$"


def written_times(announcements: DataFrame, clocks: DataFrame) -> DataFrame:
    """The values of FIELDS as input of `resolve`; _chain is source, locale and field, order that of arrival."""
    values = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in FIELDS])
    own = announcements.select("uid", "source", "locale", "fetched_at", F.explode(values).alias("_x")).where("uid is not null and _x.value is not null")
    known = clocks.groupBy("source", "locale").agg(F.max(F.struct("zone_name", "date_order")).alias("_k"))
    return own.join(known, ["source", "locale"], "left").select(
        F.concat_ws("|", F.coalesce("source", F.lit("")), F.coalesce("locale", F.lit("")), F.col("_x.field")).alias("_chain"),
        F.coalesce("fetched_at", F.lit("")).alias("_arrived"),
        F.col("uid").alias("_id"),
        F.col("_x.value").alias("_value"),
        F.col("_k.zone_name").alias("_zone"),
        F.col("_k.date_order").alias("_order"),
    )


def utc_times(announcements: DataFrame, clocks: DataFrame) -> DataFrame:
    """(uid, field_name, utc_time), distinct: every value that names an instant and isn't already exactly in the one form.

    Null, unusable and impossible values give no rows, nor do rows without uid; a source without clock is
    read by the order of its records alone, times without zone as UTC. Other columns aren't read.
    """
    found = resolve(written_times(announcements, clocks))
    return (
        found.where(~F.col("_value").rlike(EXACT))
        .select(F.col("_id").alias("uid"), F.substring_index("_chain", "|", -1).alias("field_name"), iso(F.col("at")).alias("utc_time"))
        .distinct()
    )


def with_instants(announcements: DataFrame, clocks: DataFrame) -> DataFrame:
    """The announcements with post_time_utc and update_time_utc, the instants of FIELDS in the one form; null where a value names none."""
    rows = announcements.withColumn("_uid", F.coalesce("uid", F.lit("")))
    found = resolve(written_times(rows.withColumn("uid", F.col("_uid")), clocks)).groupBy("_chain", "_id", "_value").agg(F.min("at").alias("at"))
    for f in FIELDS:
        chain = F.concat_ws("|", F.coalesce("source", F.lit("")), F.coalesce("locale", F.lit("")), F.lit(f))
        own = found.select(F.col("_chain").alias("_c"), F.col("_id").alias("_i"), F.col("_value").alias("_v"), iso(F.col("at")).alias(f"{f}_utc"))
        rows = rows.join(own, (F.col("_uid") == F.col("_i")) & (F.col(f) == F.col("_v")) & (chain == F.col("_c")), "left").drop("_c", "_i", "_v")
    return rows.drop("_uid")
