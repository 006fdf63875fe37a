"""Captured bodies as files: the landing zone that deliveries are read from, and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def captured(spark: SparkSession, path: str, endpoint: str) -> DataFrame:
    """(payload_id, endpoint, captured_at, body): a row for each file under a folder, whatever its format; the id is a hash of its path."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return files.select(
        F.abs(F.xxhash64(F.col("_metadata.file_path"))).alias("payload_id"), F.lit(endpoint).alias("endpoint"),
        F.col("_metadata.file_modification_time").alias("captured_at"), F.col("value").alias("body"),
    )


def since(rows: DataFrame, updated: str, posted: str, cutoff: str) -> DataFrame:
    """Adds kept: whether the later known time of a row (updated, else posted; '' is missing) is not before the cutoff; false where none is known."""
    time = F.coalesce(F.nullif(updated, F.lit("")), F.nullif(posted, F.lit("")))
    return rows.withColumn("kept", F.coalesce(time >= cutoff, F.lit(False)))


def export_json(rows: DataFrame, path: str) -> None:
    """One JSON object a line, in as many files as the rows have partitions; null fields are written."""
    rows.write.option("ignoreNullFields", "false").json(path)


def export_csv(rows: DataFrame, path: str) -> None:
    """CSV with a header, nested columns as JSON."""
    plain = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in rows.dtypes]
    rows.select(*plain).write.option("header", "true").option("escape", '"').csv(path)
