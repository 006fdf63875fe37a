"""Keys and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_hash(*parts: Column) -> Column:
    """SHA-256 in hex of the parts joined by underscores; null if a part is null."""
    return F.sha2(F.concat(*[x for p in parts for x in (p, F.lit("_"))][:-1]), 256)


def content_hash(content: Column) -> Column:
    """SHA-256 in hex of the text, null as empty."""
    return F.sha2(F.coalesce(content, F.lit("")), 256)


def set_fingerprint(values: Column) -> Column:
    """SHA-256 in hex of an array of texts, whatever their order."""
    return F.sha2(F.array_join(F.sort_array(values), ""), 256)
