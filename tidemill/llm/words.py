"""Plain words of texts and the hashes of their runs."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex

_TAG = re.compile(r"<(?:/?[A-Za-z][^<>]*|!--.*?--|![^<>]*|\?[^<>]*)>", re.S)
_UNSEEN = regex.compile(r"[\p{Mn}\p{Me}\p{Cf}]+")
_WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def plain_words(text: str) -> list[str]:
    """The maximal runs of letters and digits after dropping tags, decoding entities and ignoring case, accents, width and invisible characters."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if text.isascii():
        return _WORD.findall(text.lower())
    return _WORD.findall(_UNSEEN.sub("", unicodedata.normalize("NFKD", text.casefold())))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a piece take about `most` bytes at most; a longer text is a piece of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def mixed(values: np.ndarray) -> np.ndarray:
    """uint64 well spread over all bits."""
    values = (values ^ (values >> np.uint64(31))) * _MIX[0]
    values = (values ^ (values >> np.uint64(29))) * _MIX[1]
    return values ^ (values >> np.uint64(32))


def word_hashes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words of all texts in a row, number of words of each text)."""
    return hashed([plain_words(t) for t in texts])


def hashed(words: Sequence[Sequence[str]]) -> tuple[np.ndarray, np.ndarray]:
    """As word_hashes, of texts that are cut into words."""
    flat = np.array([w for own in words for w in own], dtype=object)
    counts = np.fromiter(map(len, words), np.int64, len(words))
    if not len(flat):
        return np.zeros(0, np.uint64), counts
    return pd.util.hash_array(flat, categorize=True), counts


def runs(hashes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all runs of n successive words, number of runs of each text); texts of fewer words have none."""
    total = len(hashes)
    if total < n:
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    value = np.zeros(total - n + 1, np.uint64)
    for i in range(n):
        value = mixed(value * _MIX[2] + hashes[i : total - n + 1 + i])
    keep = np.ones(total, bool)
    ends = np.cumsum(counts)
    for i in range(1, n):  # runs that would go on into the next text
        last = ends - i
        keep[last[(last >= 0) & (counts >= i)]] = False
    keep[total - n + 1 :] = False
    return value[keep[: total - n + 1]], np.maximum(counts - n + 1, 0)
