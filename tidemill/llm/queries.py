"""Registered queries of the problems on training texts, and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import mixing, personal, postings
from tidemill.llm.forest import repeats, taken_in
from tidemill.session import shared_folder, state
from tidemill.sources.tables import table

#: Words of a test text in a row that count as leaked.
LEAKED_WORDS = 12
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return repeats(table(spark, folder, "announcements"))


def p3_classes(spark: SparkSession, folder: str) -> DataFrame:
    return taken_in(table(spark, folder, "announcements"), 3)[0].classes()


def _index(spark: SparkSession, folder: str) -> postings.Index:
    """The index of the documents, kept beside the session's other tables: both queries, and later ones, open the same as long as the table is the same."""
    files = "".join(state(spark, f"{folder}/documents.parquet"))
    path = f"{shared_folder(spark)}/tidemill/index-{hashlib.md5(f'{folder} {files}'.encode()).hexdigest()}"
    return postings.kept(table(spark, folder, "documents"), "doc_id", "text", path)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "eval_items")
    found = postings.phrases(_index(spark, folder), docs, "doc_id", "text", items, "item_id", "text", LEAKED_WORDS)
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def p6_proximity(spark: SparkSession, folder: str) -> DataFrame:
    found = postings.proximities(_index(spark, folder), table(spark, folder, "eval_items"), "item_id", "text")
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), "n_terms")


def _mix(spark: SparkSession, folder: str) -> DataFrame:
    sized = mixing.with_tokens(table(spark, folder, "documents"), "doc_id", "text", "source", TOKENIZER)
    return mixing.mix(sized, table(spark, folder, "mix_targets"))


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    return _mix(spark, folder).withColumnRenamed("key", "doc_id")


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.shares(_mix(spark, folder), table(spark, folder, "mix_targets"))


def p7_mix_by_chars(spark: SparkSession, folder: str) -> DataFrame:
    """The mix with sizes in characters, which SQL can count."""
    docs = table(spark, folder, "documents")
    sized = docs.select(F.col("doc_id").alias("key"), mixing.tidy_source(F.col("source")).alias("source"), F.length("text").cast("long").alias("n_tokens"))
    return mixing.mix(sized, table(spark, folder, "mix_targets")).select(F.col("key").alias("doc_id"), "source", "copy", F.col("n_tokens").alias("n_chars"), "starts_at")


def _entities(spark: SparkSession, folder: str) -> DataFrame:
    return personal.entities(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "name_parts"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return _entities(spark, folder).select(F.col("doc").alias("doc_id"), "kind", "found_text").distinct()


def p8_redacted(spark: SparkSession, folder: str) -> DataFrame:
    return personal.redacted(table(spark, folder, "documents"), "doc_id", "text", _entities(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p3_found, p3_classes, p6_found, p6_proximity, p7_mix, p7_shares, p7_mix_by_chars, p8_found, p8_redacted)
}
_P7 = """
with d as (select doc_id, lower(trim(coalesce(source, ''), ' ')) source, length(text) n from documents where doc_id is not null and length(text) > 0),
t as (select lower(trim(coalesce(source, ''), ' ')) source, max((target_share, coalesce(max_repeats, 1))) tr from mix_targets where target_share > 0 and coalesce(max_repeats, 1) > 0 group by 1),
q as (select d.*, tr[1] w, tr[2] r, ('0x' || substr(md5('0:' || doc_id), 1, 15))::bigint u, sum(n) over (partition by d.source) whole from d join t on t.source = d.source),
f as (select *, sum(n) over (partition by source order by u, doc_id, n rows unbounded preceding) ahead from q),
c as (select f.*, unnest(range(r)) copy from f),
o as (select *, sum(n) over (order by (copy * whole + ahead)::double / w, source, u, doc_id, copy rows unbounded preceding) - n starts_at from c)
select doc_id, source, copy::int as copy, n n_chars, starts_at::bigint starts_at from o where starts_at + n <= (select sum(n) from d)
"""

SQL: dict[str, str] = {"p7_mix_by_chars": _P7}
