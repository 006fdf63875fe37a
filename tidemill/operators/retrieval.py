"""Retrieval by shared terms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.texts import terms
from tidemill.session import at_hand


def recall(queries: DataFrame, query: str, query_text: str, rows: DataFrame, key: str, text: str, most: int, of: Callable[[Column], Column] = terms) -> DataFrame:
    """(query, key, score, rank): for each query the `most` rows that share most terms with it, at least one; ties by key.

    `of` gives the distinct terms of a text. Terms are exploded and joined on equality; each pair is counted by partial aggregation.
    """
    # a set of queries is small beside the rows: broadcast, so that rows are scored where they are read, common terms too
    q = queries.select(F.col(query).alias("_q"), F.explode(of(F.col(query_text))).alias("_term"))
    r = rows.select(F.col(key).alias("_k"), F.col(text).alias("_t")).distinct().select("_k", F.explode(of(F.col("_t"))).alias("_term"))
    scored = r.join(at_hand(q), "_term").groupBy("_q", "_k").agg(F.count("*").alias("score"))
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("_q").orderBy(F.desc("score"), "_k")))
    return ranked.where(F.col("rank") <= most).select(F.col("_q").alias(query), F.col("_k").alias(key), "score", "rank")
