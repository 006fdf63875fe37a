"""Evaluation texts leaking into training texts.

Method: a distributed positional inverted index. The texts' token postings are stored in segments (as many
texts as a task reads at once), a row for each segment and term, laid out by how rare the term is and sorted
by term. Test texts are looked up by the rarest terms of each stretch of words: their posting lists, shifted
by the term's offset in the test text, are intersected inside each segment, the rarest first; what remains is
checked on the words themselves.

Segments are written by the tasks that read the texts, so building the index shuffles its vocabulary only. A
lookup takes the frequencies from the vocabulary and reads those layers of the lists that hold a wanted term;
whole lists are sent to the segment's task, never single postings. The index is kept: texts can be appended,
and a later query opens it. Test texts are handled in blocks of a bounded number of words.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.words import plain_words, slices, word_hashes
from tidemill.session import at_hand, listed, saved, write_note

#: Rarest terms by which a stretch of words is looked up.
RAREST = 3
#: Words of test texts that are looked up at once; their places and terms are sent to every task.
BLOCK_WORDS = 500_000

_POSTINGS = "term long, n_docs int, segment long, docs array<long>, positions array<int>, band int"
_TERMS = "term long, n_docs long, bands array<int>"
_SHIFT = np.int64(1) << np.int64(33)
_ORIGIN = np.int64(1) << np.int64(31)


class Index(NamedTuple):
    """postings: a row for each segment and term, band being the power of two of n_docs, by which the files are parted. terms: the vocabulary."""

    postings: DataFrame
    terms: DataFrame


def opened(spark: SparkSession, path: str) -> Index:
    """The index kept in a folder."""
    terms = spark.read.schema(_TERMS).parquet(f"{path}/terms")
    whole = terms.groupBy("term").agg(F.sum("n_docs").alias("n_docs"), F.array_distinct(F.flatten(F.collect_list("bands"))).alias("bands"))
    return Index(spark.read.schema(_POSTINGS).parquet(f"{path}/postings"), whole)


def append(texts: DataFrame, key: str, text: str, path: str) -> Index:
    """Writes the postings of texts as new segments of the index in a folder, made where it isn't there.

    docs and positions have one element for each posting, by text and position, from 0. Null keys and texts and texts without words have no postings.
    """

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(slices(batches, "text")):
            hashes, counts = word_hashes(batch.column("text").to_pylist())
            if not len(hashes):
                continue
            starts = np.cumsum(counts) - counts
            doc = np.repeat(np.arange(len(counts)), counts)
            place = (np.arange(len(hashes)) - np.repeat(starts, counts)).astype(np.int32)
            order = np.argsort(hashes, kind="stable")  # texts and places are in order as they are
            hashes, doc, place = hashes[order], doc[order], place[order]
            other = hashes[1:] != hashes[:-1]
            new_term = np.flatnonzero(np.r_[True, other])
            ends = np.r_[new_term, len(hashes)]
            n_docs = np.add.reduceat(np.r_[True, other | (doc[1:] != doc[:-1])].astype(np.int32), new_term).astype(np.int32)
            ids = batch.column("key").to_numpy()
            lists = (pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(v)) for v in (ids[doc], place))
            band = np.floor(np.log2(n_docs)).astype(np.int32)
            whole = pa.RecordBatch.from_arrays(
                [pa.array(hashes[new_term].view(np.int64)), pa.array(n_docs), pa.array(np.full(len(new_term), part + number)), *lists, pa.array(band)],
                names=["term", "n_docs", "segment", "docs", "positions", "band"],
            )
            yield whole

    spark = texts.sparkSession
    own = texts.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).where("key is not null and text is not null")
    before = len([n for n in listed(spark, f"{path}/terms") if n.startswith("part=")])
    rows = own.mapInArrow(segment, _POSTINGS).withColumn("segment", F.col("segment") + F.lit(before << 56))
    rows.sortWithinPartitions("band", "term").write.option("compression", "zstd").partitionBy("band").mode("append").parquet(f"{path}/postings")
    first = F.col("segment") >= F.lit(before << 56)
    new = spark.read.schema(_POSTINGS).parquet(f"{path}/postings").where(first).groupBy("term").agg(F.sum("n_docs").alias("n_docs"), F.sort_array(F.collect_set("band")).alias("bands"))
    new.write.parquet(f"{path}/terms/part={before:06}")  # the step by which the segments count
    return opened(spark, path)


def kept(texts: DataFrame, key: str, text: str, path: str) -> Index:
    """The index of texts in a folder, built if it isn't there whole."""
    spark = texts.sparkSession
    if "whole.json" not in listed(spark, path):
        append(texts, key, text, path)
        write_note(spark, f"{path}/whole.json", {"key": key, "text": text})
    return opened(spark, path)


# ---- the test texts -----------------------------------------------------------------------------


def test_words(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, place, term): every word of the test texts; repeated rows count once."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes, counts = word_hashes(batch["text"].tolist())
            if len(hashes):
                place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
                yield pd.DataFrame({"item": np.repeat(batch["item"].to_numpy(), counts), "place": place.astype(np.int32), "term": hashes.view(np.int64)})

    own = items.select(F.col(key).cast("long").alias("item"), F.col(text).alias("text")).where("item is not null and text is not null").distinct()
    return saved(own.mapInPandas(cut, "item long, place int, term long"), "items")


def with_frequencies(words: DataFrame, index: Index) -> DataFrame:
    """The test words with n_docs, the number of texts that have the term (0 where none has), and the bands of its lists. Only the vocabulary is read."""
    counted = index.terms.join(at_hand(words.select("term").distinct()), "term", "left_semi")
    return words.join(at_hand(saved(counted, "counted")), "term", "left").withColumn("n_docs", F.coalesce("n_docs", F.lit(0)))


def stretches(counted: DataFrame, length: int, rarest: int = RAREST) -> DataFrame:
    """(item, anchors), distinct: the places and terms of the rarest words of every stretch of `length` words of a test text that can occur, rarest first."""
    ahead = Window.partitionBy("item").orderBy("place").rowsBetween(0, length - 1)
    seen = counted.select("item", F.sort_array(F.collect_list(F.struct("n_docs", "place", "term")).over(ahead)).alias("_s"))
    return seen.where((F.size("_s") == length) & (F.col("_s")[0]["n_docs"] > 0)).select("item", F.transform(F.slice("_s", 1, rarest), lambda s: F.struct(s["place"], s["term"])).alias("anchors")).distinct()


def anchor_sets(counted: DataFrame, length: int, most: int) -> DataFrame:
    """(item, sets): the places of the `most` rarest terms of each stretch of `length` words of a test text, of twice, four times as many and so on up to the whole; rarest first."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, rarest in zip(batch["item"], batch["rarest"]):
                places = [r["place"] for r in rarest]
                last, size, found = max(places), length, set()
                while size < 2 * length or size < 2 * (last + 1):
                    found |= {tuple([p for p in places if start <= p < start + size][:most]) for start in range(max(0, last + 1 - size) + 1)}
                    size *= 2
                rows.append((item, [list(f) for f in sorted(found) if f]))
            yield pd.DataFrame(rows, columns=["item", "sets"])

    own = counted.where("n_docs > 0").groupBy("item").agg(F.sort_array(F.collect_set(F.struct("n_docs", "place"))).alias("rarest"))
    return own.mapInPandas(cut, "item long, sets array<array<int>>")


def _blocks(words: DataFrame) -> Iterator[DataFrame]:
    """The test words in blocks of whole test texts, of about BLOCK_WORDS words each."""
    n = -(-words.count() // BLOCK_WORDS)
    for b in range(n):
        yield words.where(F.pmod(F.xxhash64("item"), F.lit(n)) == b) if n > 1 else words


# ---- lookups ------------------------------------------------------------------------------------


class _Lists:
    """The posting lists of one segment: of each term the sorted keys text * 2^33 + position; texts are numbered in the segment."""

    def __init__(self, table: pa.Table) -> None:
        table = table.combine_chunks()
        docs, positions = (table.column(n).combine_chunks() for n in ("docs", "positions"))
        ends = docs.offsets.to_numpy()
        self.ids, code = np.unique(docs.values.to_numpy(), return_inverse=True)
        keys = code.astype(np.int64) * _SHIFT + positions.values.to_numpy() + _ORIGIN
        self.keys = {t: np.sort(keys[ends[i] : ends[i + 1]]) for i, t in enumerate(table.column("term").to_pylist())}
        self.none = np.zeros(0, np.int64)

    def at(self, term: int, place: int) -> np.ndarray:
        """The keys of the term, shifted by its place in the test text."""
        return self.keys.get(term, self.none) - place


def _rows(found: list[tuple[np.ndarray, int, np.ndarray]], value: str) -> pa.Table:
    docs, items, values = ([x[i] for x in found] for i in range(3))
    sizes = [len(d) for d in docs]
    none = np.zeros(0, np.int64)
    return pa.table({"doc": np.concatenate([none, *docs]), "item": np.repeat(np.array(items, np.int64), sizes), value: np.concatenate([none, *values])})


def _searched(index: Index, wanted: DataFrame, search: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """search, given the lists of the wanted terms (term, bands) in a segment, for every segment. Layers without a wanted term aren't read."""
    bands = [r[0] for r in wanted.select(F.explode("bands")).distinct().collect()]  # powers of two: 60 at most
    lists = index.postings.where(F.col("band").isin(bands)).join(at_hand(wanted.select("term").distinct()), "term", "left_semi")
    return lists.select("segment", "term", "docs", "positions").groupBy("segment").applyInArrow(search, schema)


def intersected(index: Index, counted: DataFrame, length: int, rarest: int) -> DataFrame:
    """(doc, item, shift): where a text has the rarest terms of a stretch of a test text at one shift of their places."""
    wanted = saved(stretches(counted, length, rarest), "stretches")
    by_item = defaultdict(list)
    for item, anchors in wanted.collect():  # of a block of test texts
        by_item[item].append([(a["term"], a["place"]) for a in anchors])

    def search(table: pa.Table) -> pa.Table:
        lists, found = _Lists(table), []
        for item, own in by_item.items():
            met = []
            for (term, place), *others in own:
                keys = lists.at(term, place)
                for term, place in others:  # noqa: PLW2901
                    if not len(keys):
                        break
                    there = lists.at(term, place)
                    at = np.searchsorted(there, keys)
                    keys = keys[(at < len(there)) & (there[np.minimum(at, len(there) - 1)] == keys)] if len(there) else lists.none
                if len(keys):
                    met.append(keys)
            if met:
                keys = np.unique(np.concatenate(met))
                found.append((lists.ids[keys // _SHIFT], item, keys % _SHIFT - _ORIGIN))
        return _rows(found, "shift")

    each = wanted.select(F.explode("anchors.term").alias("term")).distinct().join(counted.select("term", "bands").distinct(), "term")
    return _searched(index, each, search, "doc long, item long, shift long")


def phrases(index: Index, texts: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, length: int) -> DataFrame:
    """(doc, item), distinct: texts that contain at least `length` successive words of a test text, in order and with nothing between.

    `index` is that of `texts`. Test texts of fewer words are found in none; those without words,
    null keys and null texts neither; repeated rows count once.
    """
    words = saved(with_frequencies(test_words(items, item_key, item_text), index), "known")
    found = [_checked(saved(intersected(index, block, length, min(RAREST, length)), "met"), block, texts, key, text, length) for block in _blocks(words)]
    return reduce(DataFrame.unionByName, found, texts.sparkSession.createDataFrame([], "doc long, item long")).distinct()


def _checked(met: DataFrame, block: DataFrame, texts: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """(doc, item): of the places met, those where `length` successive words of the test text stand in the text."""
    tested: dict[int, list] = defaultdict(list)
    for item, place, term in block.select("item", "place", "term").collect():
        tested[item].append((place, term))
    terms = {item: np.array([t for _, t in sorted(own)], np.int64) for item, own in tested.items()}

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, counts = word_hashes(batch.column("text").to_pylist())
            ends, hashes, rows = np.cumsum(counts), hashes.view(np.int64), []
            for i, (doc, places) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("places").to_pylist())):
                own, done = hashes[ends[i] - counts[i] : ends[i]], set()
                for p in places:
                    item, shift = p["item"], p["shift"]
                    first = max(0, -shift)
                    last = min(len(terms[item]), len(own) - shift)
                    if item not in done and last - first >= length:
                        differ = np.flatnonzero(terms[item][first:last] != own[first + shift : last + shift])
                        if np.diff(np.r_[-1, differ, last - first]).max() > length:
                            done.add(item)
                rows += [(doc, item) for item in done]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], names=["doc", "item"])

    by_doc = saved(met.groupBy("doc").agg(F.collect_set(F.struct("item", "shift")).alias("places")), "places")  # of one text: its words times the test texts at most
    own = texts.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")).where("text is not null")
    return own.join(at_hand(by_doc, most=200_000), "doc").select("doc", "text", "places").mapInArrow(check, "doc long, item long")


def proximities(index: Index, items: DataFrame, item_key: str, item_text: str, terms: int = 8, least: int = 6, slack: int = 4, length: int = 12) -> DataFrame:
    """(doc, item, n_terms): texts with at least `least` of the `terms` rarest terms of a stretch of a test text at nearly the places they have there.

    Stretches are those of anchor_sets, so that a leak of any part is met by terms of its own. n_terms is that of the stretch met best.
    The shifts of the terms met lie within `slack` words of each other or a little more, up to twice as much.

    A text with `least` of `terms` lacks `terms - least` at most, so it has two of the `terms - least + 2` rarest: of the lists of
    the frequent terms only the postings of texts that have two of these go on.
    """
    words = saved(with_frequencies(test_words(items, item_key, item_text), index).where("n_docs > 0"), "known")
    found = [_near(index, block, terms, least, slack, length) for block in _blocks(words)]
    return reduce(DataFrame.unionByName, found, items.sparkSession.createDataFrame([], "doc long, item long, n_terms long"))


def _near(index: Index, block: DataFrame, most: int, least: int, slack: int, length: int) -> DataFrame:
    two = min(2, least)
    sets = saved(anchor_sets(block, length, most), "sets")
    term_at = defaultdict(dict)
    for item, place, term in block.select("item", "place", "term").collect():  # of a block of test texts
        term_at[item][place] = term
    queries = []
    for item, own in sets.collect():
        places = sorted(set(itertools.chain.from_iterable(own)))
        number = {p: i for i, p in enumerate(places)}
        has = np.zeros((len(own), len(places)), bool)
        for k, s in enumerate(own):
            has[k, [number[p] for p in s]] = True
        rare = sorted({number[p] for s in own for p in s[: most - least + two] if len(s) >= least})
        queries.append((item, [(term_at[item][p], p) for p in places], rare, has.astype(np.float32)))

    def cells(keys: np.ndarray, grid: int) -> np.ndarray:
        """The text and the cell of the shift, in one number."""
        return keys // _SHIFT * _SHIFT + (keys % _SHIFT + grid * slack) // (2 * slack)

    def search(table: pa.Table) -> pa.Table:
        lists, found = _Lists(table), []
        for item, places, rare, has in queries:
            seen = [np.unique(np.concatenate([cells(k, g) * 2 + g for g in (0, 1)])) for k in (lists.at(*places[i]) for i in rare) if len(k)]
            if not seen:
                continue
            met, n = np.unique(np.concatenate(seen), return_counts=True)
            texts = np.unique(met[n >= two] // 2 // _SHIFT)
            if not len(texts):
                continue
            wanted = np.zeros(len(lists.ids), bool)
            wanted[texts] = True
            at, place = [], []
            for i, (term, p) in enumerate(places):
                keys = lists.at(term, p)
                keys = keys[wanted[keys // _SHIFT]]
                if len(keys):
                    own = np.unique(np.concatenate([cells(keys, g) * 2 + g for g in (0, 1)]))
                    at.append(own)
                    place.append(np.full(len(own), i, np.int32))
            at, place = np.concatenate(at), np.concatenate(place)
            cell, number, n = np.unique(at, return_inverse=True, return_counts=True)
            full = n[number] >= least  # cells with so many places at all
            kept, row = np.unique(number[full], return_inverse=True)
            if not len(kept):
                continue
            best = np.zeros(len(kept), np.int64)
            for start in range(0, len(kept), 50_000):  # cells times places, as a matrix of a bounded number of rows
                own = (row >= start) & (row < start + 50_000)
                hits = np.zeros((min(50_000, len(kept) - start), len(places)), np.float32)
                hits[row[own] - start, place[full][own]] = 1
                best[start : start + len(hits)] = (hits @ has.T).max(axis=1)
            good = best >= least
            if good.any():
                doc = lists.ids[cell[kept[good]] // 2 // _SHIFT]
                top = pd.Series(best[good]).groupby(doc).max()
                found.append((top.index.to_numpy(np.int64), item, top.to_numpy(np.int64)))
        return _rows(found, "n_terms")

    places = sets.select("item", F.explode(F.array_distinct(F.flatten("sets"))).alias("place"))
    wanted = block.join(places, ["item", "place"], "left_semi").select("term", "bands").distinct()
    return _searched(index, wanted, search, "doc long, item long, n_terms long")
