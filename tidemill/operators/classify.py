"""Classification by declarative tables of rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_word(text: Column, words: Sequence[str]) -> Column:
    """Whether a lower-case text has one of the words; words of ASCII letters as whole words, others anywhere."""
    tests = [F.concat(F.lit(" "), F.regexp_replace(text, "[^a-z0-9]+", " "), F.lit(" ")).contains(f" {w} ") if w.isascii() else text.contains(w) for w in words]
    found = tests[0]
    for t in tests[1:]:
        found = found | t
    return found


def by_words(text: Column, rules: Mapping[str, Sequence[str]]) -> Column:
    """The first rule, in order, one of whose words the text has; null where none has."""
    lower, chosen = F.lower(F.coalesce(text, F.lit(""))), None
    for name, words in rules.items():
        test = has_word(lower, words)
        chosen = F.when(test, name) if chosen is None else chosen.when(test, name)
    return chosen if chosen is not None else F.lit(None).cast("string")


def classified(rows: DataFrame, keys: Sequence[str], text: str, mapping: DataFrame, rules: Mapping[str, Sequence[str]], vague: str = "other") -> DataFrame:
    """Adds found_category and layer to rows, by a mapping (keys, category), unique in keys, and by words.

    native: mapped to another category than the vague one. keyword: mapped to the vague one or not mapped, but
    words decide. native_other: mapped to the vague one. unmapped: neither, or a key is null.
    """
    known = mapping.select(*keys, F.col("category").alias("_mapped"))
    word = by_words(F.col(text), rules)
    layer = F.when(F.col("_mapped") != vague, "native").when(word.isNotNull(), "keyword").when(F.col("_mapped") == vague, "native_other").otherwise("unmapped")
    category = F.when(F.col("_mapped") != vague, F.col("_mapped")).otherwise(F.coalesce(word, F.col("_mapped")))
    return rows.join(known, list(keys), "left").withColumn("layer", layer).withColumn("found_category", category).drop("_mapped")


def usual_mapping(rows: DataFrame, keys: Sequence[str], category: str) -> DataFrame:
    """(keys, category): the most frequent category of each key, at equal numbers the first by name."""
    counts = rows.where(" and ".join(f"`{c}` is not null" for c in [*keys, category])).groupBy(*keys, category).agg(F.count("*").alias("_n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(category).alias("c"))).alias("_b"))
    return best.select(*keys, F.col("_b.c").alias("category"))
