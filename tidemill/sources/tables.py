"""Readers of the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.session import ship


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
