"""Deduplicating new batches against all history.

Method: a prefix-tree hash forest. Each text has TREES labels, each of DEPTH min-hash values of its word
runs. A store keeps, for each accepted batch, a run: the sorted labels, the texts' plain words and the near
pairs found. Labels are searched by range: the entries of a new batch meet those whose label lies between
their own prefix's least and greatest label. Beginning with whole labels the prefix is widened value by value
until the chance to find a pair at the threshold reaches the recall target; what lies in its range is verified
on the words themselves. When there are many runs the small ones are merged.

Of history a batch reads the runs' labels and identities, and the words of candidates only, from those parts
of the runs that hold some; texts of earlier batches aren't asked for again. The store is a folder: another
session opens it by its path. Copies (the same words in the same order) are one entry of the labels, so a
text posted a million times is searched once.

With exact=True the labels are the least hashes of a text's word runs instead, so many that two texts at
the threshold must share one: every pair that shares one is verified, and none can be missed.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.words import hashed, mixed, plain_words, runs, slices
from tidemill.session import at_hand, listed, new_path, read_note, remove, saved, write_note

#: Labels of a text, min-hash values of a label, values that entries must share in any case (the branch by which runs are laid out).
TREES, DEPTH, BRANCH = 16, 4, 2
BITS = 16
#: Pairs at the threshold whose min-hash values agree, at two bits, this many standard deviations less than expected aren't
#: verified: about 2 of 10,000 pairs exactly at the threshold, far fewer above it. exact=True leaves this out.
SKETCH_DEVIATIONS = 3.5
#: Bytes of text signed at once, few enough for a core's cache.
PIECE = 1_000_000
#: Entries of a branch from which its pairs are spread over several tasks.
HOT_BRANCH = 2_000

_SIGNED = pa.schema(
    [("uid", pa.string()), ("d1", pa.int64()), ("d2", pa.int64()), ("chain", pa.int64()), ("n", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64()), ("labels", pa.list_(pa.int64())), ("words", pa.string())]
)
_SIGNED_SQL = "uid string, d1 long, d2 long, chain long, n int, s1 long, s2 long, labels array<long>, words string"
_NEAR = "a1 long, a2 long, b1 long, b2 long"
#: The bucketed parts of a run: columns, bucket column, order.
PARTS = {
    "labels": ("branch long, label long, d1 long, s1 long, s2 long, n int", "branch", ["branch", "label"]),
    "reps": ("d1 long, d2 long, row long", "d1", ["d1"]),
    "near": (_NEAR, "a1", ["a1"]),
}
#: Rows of a bucket at least, where a run has fewer buckets than there are shuffle partitions.
BUCKET_ROWS = 20_000


def _named(run: dict, part: str) -> str:
    return f"tidemill_{run['name']}_{part}"


def chance(similarity: float, depth: int) -> float:
    """The chance that a pair shares a prefix of `depth` values in one of the trees."""
    return 1 - (1 - similarity**depth) ** TREES


def sketch_agreement(threshold: float) -> int:
    """Of the TREES * DEPTH values, compared at two bits, how many must agree for a candidate pair to be verified."""
    n, same = TREES * DEPTH, threshold + (1 - threshold) / 4
    return math.floor(n * same - SKETCH_DEVIATIONS * math.sqrt(n * same * (1 - same)))


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    seeds = np.arange(1, 2 * TREES * DEPTH + 1, dtype=np.uint64)
    drawn = mixed(seeds * np.uint64(0x9E3779B97F4A7C15))
    return drawn[: TREES * DEPTH] | np.uint64(1), drawn[TREES * DEPTH :]


def _tree_labels(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(labels of each text, in the order of the trees, and two bits of each min-hash value as s1 and s2)."""
    factor, shift = _multipliers()
    least = np.empty((len(starts), TREES * DEPTH), np.uint64)
    for i in range(TREES * DEPTH):
        least[:, i] = np.minimum.reduceat(values * factor[i] + shift[i], starts)
    least = mixed(least)
    part = (least >> np.uint64(64 - BITS)).reshape(len(starts), TREES, DEPTH)
    labels = reduce(np.bitwise_or, (part[:, :, k] << np.uint64(BITS * (DEPTH - 1 - k)) for k in range(DEPTH)))
    bit = np.uint64(1) << np.arange(TREES * DEPTH, dtype=np.uint64)
    s1, s2 = (((least >> np.uint64(k)) & np.uint64(1)) @ bit for k in (0, 1))
    return labels, s1, s2


def signed(texts: DataFrame, run_words: int, exact_percent: int | None = None) -> DataFrame:
    """(uid, d1, d2, chain, n, s1, s2, labels, words) of rows (uid, chain, text) that have a run of words.

    d1 and d2 are 128 bits of chain and word sequence, n is the number of distinct runs, words the plain words. With exact_percent
    labels are the least distinct run hashes, one more than the runs that a text at that similarity may lack.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", PIECE):
            words = [plain_words(t) for t in batch.column("text").to_pylist()]
            values, counts = runs(*hashed(words), run_words)
            own = np.flatnonzero(counts)
            if not len(own):
                continue
            starts = np.concatenate([[0], np.cumsum(counts[own])[:-1]])
            place = np.arange(len(values), dtype=np.uint64) - np.repeat(starts, counts[own]).astype(np.uint64)
            chain = batch.column("chain").to_numpy().view(np.uint64)[own]
            d1 = mixed(np.add.reduceat(mixed(values + place * np.uint64(0xD6E8FEB86659FD93)), starts) + chain)
            d2 = mixed(np.add.reduceat(mixed(values ^ mixed(place + np.uint64(7))), starts) ^ mixed(chain))
            if exact_percent is None:
                each, ends = values.tolist(), np.r_[starts, len(values)]
                n = np.array([len(set(each[a:b])) for a, b in zip(ends, ends[1:])], np.int32)
                labels, s1, s2 = _tree_labels(values, starts)
                ends, flat = np.arange(0, len(own) * TREES + 1, TREES, dtype=np.int32), labels.ravel()
            else:
                distinct = [np.unique(v) for v in np.split(values, starts[1:])]
                n = np.array([len(v) for v in distinct], np.int32)
                tokens = [v[: len(v) - -(-len(v) * exact_percent // 100) + 1] for v in distinct]
                ends, flat = np.r_[0, np.cumsum([len(t) for t in tokens])].astype(np.int32), np.concatenate(tokens)
                s1 = s2 = np.zeros(len(own), np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("uid").take(pa.array(own)), *(pa.array(x.view(np.int64)) for x in (d1, d2, chain)), pa.array(n), *(pa.array(x.view(np.int64)) for x in (s1, s2)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64))), pa.array([" ".join(words[i]) for i in own], pa.string()),
                ],
                schema=_SIGNED,
            )

    return texts.select("uid", "chain", "text").mapInArrow(sign, _SIGNED_SQL)


def common_runs(pairs: DataFrame, run_words: int, percent: int) -> DataFrame:
    """The pairs (a1, a2, b1, b2) of rows with words_a and words_b of whose distinct runs of words at least `percent` of 100 occur in both."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches, "words_a"), "words_b"):
            codes, texts = pd.factorize(np.array(batch.column("words_a").to_pylist() + batch.column("words_b").to_pylist(), dtype=object))
            values, counts = runs(*hashed([t.split(" ") for t in texts]), run_words)
            sets = [np.unique(v) for v in np.split(values, np.cumsum(counts)[:-1])]
            half, keep = batch.num_rows, []
            for i in range(half):
                a, b = sets[codes[i]], sets[codes[half + i]]
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both * 100 >= (len(a) + len(b) - both) * percent)
            yield batch.select(["a1", "a2", "b1", "b2"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a1", "a2", "b1", "b2", "words_a", "words_b").mapInArrow(count, _NEAR)


class Forest:
    """A store of accepted texts. `add` takes in a batch and says what it repeats; `classes` says what belongs together.

    run_words and threshold say what is near: of all distinct runs of so many words of two texts of one chain, at
    least the threshold's share (whole percent) occurs in both. `path` is the store's folder, made where it doesn't
    exist; a store opened again must have the settings it was made with. One writer at a time: of two that add at once one fails.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, run_words: int = 5, threshold: float = 0.8, recall: float = 0.975, most_runs: int = 3, exact: bool = False) -> None:
        self.spark, self.path, self.most_runs, self.exact, self.recall = spark, path or new_path(spark, "forest"), most_runs, exact, recall
        self.run_words, self.percent, self.threshold = run_words, round(100 * threshold), threshold
        self.agree = sketch_agreement(threshold)
        if not exact and chance(threshold, BRANCH) < recall:
            raise ValueError(f"recall {recall} at similarity {threshold} needs prefixes of under {BRANCH} values, or exact=True")
        settings = {"run_words": run_words, "percent": self.percent, "exact": exact}
        notes = [n for n in listed(spark, f"{self.path}/notes") if n.endswith(".json")]
        self.note = read_note(spark, f"{self.path}/notes/{notes[-1]}") if notes else {"settings": settings, "runs": [], "batches": {}, "number": 0}
        if self.note["settings"] != settings:
            raise ValueError(f"the store was made with {self.note['settings']}")

    # ---- the store ------------------------------------------------------------------------------

    def _commit(self, runs_now: list[dict], batches: dict) -> None:
        """The step by which a batch or a merge becomes part of the store."""
        note = self.note | {"runs": runs_now, "batches": batches, "number": self.note["number"] + 1}
        write_note(self.spark, f"{self.path}/notes/{note['number']:09}.json", note)
        self.note = note

    def _laid(self, df: DataFrame, run: dict, part: str, rows: int) -> None:
        """Writes a part of a run in sorted buckets, few where it is small; joins on the bucket column read it without a shuffle."""
        _, by, order = PARTS[part]
        buckets = run["buckets"][part] = max(1, min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), rows // BUCKET_ROWS))
        laid, where = df.repartition(buckets, by), f"{self.path}/{run['name']}/{part}"
        if buckets == 1:
            laid.sortWithinPartitions(*order).write.option("compression", "zstd").parquet(where)
        else:
            laid.write.format("parquet").option("compression", "zstd").bucketBy(buckets, by).sortBy(*order).option("path", where).saveAsTable(_named(run, part))

    def _table(self, run: dict, part: str) -> DataFrame:
        """A bucketed part of a run, made known to this session's catalog where it isn't."""
        columns, by, order = PARTS[part]
        if run["buckets"][part] == 1:
            return self.spark.read.schema(columns).parquet(f"{self.path}/{run['name']}/{part}")
        if not self.spark.catalog.tableExists(_named(run, part)):
            self.spark.sql(
                f"create table {_named(run, part)} ({columns}) using parquet options (path '{self.path}/{run['name']}/{part}') "
                f"clustered by ({by}) sorted by ({', '.join(order)}) into {run['buckets'][part]} buckets"
            )
        return self.spark.table(_named(run, part))

    def _texts(self, run: dict) -> DataFrame:
        return self.spark.read.schema(f"{_SIGNED_SQL}, row long, seg int").parquet(f"{self.path}/{run['name']}/texts")

    def _everyone(self) -> DataFrame:
        return reduce(DataFrame.unionByName, (self._texts(r).select("uid", "d1", "d2") for r in self.note["runs"]))

    # ---- a batch --------------------------------------------------------------------------------

    def _write_run(self, batch: DataFrame) -> dict:
        """The batch as a run: all its texts, the entries new to the store, their sorted labels."""
        name = f"run{self.note['number'] + 1:09}_{uuid.uuid4().hex}"
        at = f"{self.path}/{name}"
        kept = batch.where("uid is not null and chain is not null and text is not null").select("uid", F.xxhash64("chain").alias("chain"), "text")
        # the row's number begins with the task's, which is also the part of the run that has its words
        sig = signed(kept, self.run_words, self.percent if self.exact else None).withColumn("row", F.monotonically_increasing_id()).withColumn("seg", F.spark_partition_id())
        sig.write.option("compression", "zstd").partitionBy("seg").parquet(f"{at}/texts")
        run = {"name": name, "buckets": {}, "entries": 0, "hot": 0, "near": False}
        texts = self._texts(run)
        run["entries"] = texts.count()  # at most: copies among them are one entry
        fresh = texts.groupBy("d1", "d2").agg(F.min("row").alias("row")).alias("n")
        for r in self.note["runs"]:  # the second half of the identity is no join key, so that the buckets serve as they are
            known = self._table(r, "reps").alias("o")
            fresh = fresh.join(known, (F.col("n.d1") == F.col("o.d1")) & (F.col("n.d2").bitwiseXOR(F.col("o.d2")) == 0), "left_anti").alias("n")
        self._laid(fresh, run, "reps", run["entries"])
        entries = texts.join(at_hand(self._table(run, "reps").select("row"), run["entries"]), "row", "left_semi")
        each = entries.select("chain", "d1", "s1", "s2", "n", F.posexplode("labels").alias("tree", "label"))
        root = F.col("label") if self.exact else F.shiftrightunsigned("label", BITS * (DEPTH - BRANCH))
        branch = F.xxhash64("chain", F.lit(0) if self.exact else F.col("tree"), root)
        self._laid(each.select(branch.alias("branch"), "label", "d1", "s1", "s2", "n"), run, "labels", run["entries"] * TREES)
        self._note_hot(run)
        return run

    def _note_hot(self, run: dict) -> None:
        """Keeps the branches with so many entries that their pairs must be spread; a run has at most labels / HOT_BRANCH of them."""
        if run["entries"] >= HOT_BRANCH:
            hot = self._table(run, "labels").groupBy("branch").agg(F.count("*").alias("n")).where(F.col("n") >= HOT_BRANCH)
            hot.write.parquet(f"{self.path}/{run['name']}/hot")
            run["hot"] = self.spark.read.schema("branch long, n long").parquet(f"{self.path}/{run['name']}/hot").count()

    def _hot(self, own: dict, other: dict) -> DataFrame | None:
        """(branch, n): the hot branches of either run."""
        there = [self.spark.read.schema("branch long, n long").parquet(f"{self.path}/{r['name']}/hot") for r in {r["name"]: r for r in (own, other)}.values() if r["hot"]]
        return reduce(DataFrame.unionByName, there).groupBy("branch").agg(F.max("n").alias("n")) if there else None

    def _in_range(self, own: dict, other: dict, depth: int) -> DataFrame:
        """(a1, b1): the entries of `own` and those of `other` whose label lies in the range of their prefix of `depth` values."""
        mine, there = at_hand(self._table(own, "labels"), own["entries"] * TREES, 100_000), self._table(other, "labels")
        rest = F.lit((1 << BITS * (DEPTH - depth)) - 1).cast("long") if not self.exact else F.lit(0).cast("long")
        low = F.col("n.label").bitwiseAND(F.bitwise_not(rest))
        high = F.col("n.label").bitwiseOR(rest)
        near = F.col("o.label").between(low, high) & (F.least("n.n", "o.n") * 100 >= F.greatest("n.n", "o.n") * self.percent)
        near &= (F.col("n.d1") < F.col("o.d1")) if own is other else (F.col("n.d1") != F.col("o.d1"))
        if not self.exact:
            apart = F.col("n.s1").bitwiseXOR(F.col("o.s1")).bitwiseOR(F.col("n.s2").bitwiseXOR(F.col("o.s2")))
            near &= F.bit_count(apart) <= TREES * DEPTH - self.agree

        def met(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
            same = reduce(Column.__and__, (F.col(f"n.{k}") == F.col(f"o.{k}") for k in keys))
            return a.alias("n").join(b.alias("o"), same & near).select(F.least("n.d1", "o.d1").alias("a1"), F.greatest("n.d1", "o.d1").alias("b1"))

        hot = self._hot(own, other)
        if hot is None:
            return met(mine, there, ["branch"])
        hot = at_hand(hot)
        # a hot branch: its entries of one side are dealt to several tasks, those of the other are sent to each of them
        shares = F.ceil(F.col("n_hot") / F.lit(HOT_BRANCH)).cast("int")
        spread = hot.withColumnRenamed("n", "n_hot")
        dealt = mine.join(spread, "branch").withColumn("share", F.pmod(F.xxhash64("d1", F.lit(5)), shares).cast("int"))
        sent = there.join(spread, "branch").withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1)))
        usual = met(mine.join(hot, "branch", "left_anti"), there.join(hot, "branch", "left_anti"), ["branch"])
        return usual.unionByName(met(dealt, sent, ["branch", "share"]))

    def _words_of(self, wanted: DataFrame) -> DataFrame:
        """(d1, d2, words) of entries by d1, from any run; only the parts of the runs that hold some are read."""
        found = []
        for r in self.note["runs"]:
            place = self._table(r, "reps").join(wanted, "d1", "left_semi").select("d1", "d2", "row", F.lit(r["name"]).alias("run"))
            found.append(place)
        places = saved(reduce(DataFrame.unionByName, found).withColumn("seg", F.shiftright("row", 33).cast("int")), "places")
        parts: dict[str, list[int]] = {}
        for run, seg in places.select("run", "seg").distinct().collect():  # numbers of parts: as many as tasks wrote them, not as texts
            parts.setdefault(run, []).append(seg)
        texts = []
        for r in (r for r in self.note["runs"] if r["name"] in parts):
            own = places.where(F.col("run") == r["name"]).select("row")
            texts.append(self._texts(r).where(F.col("seg").isin(parts[r["name"]])).join(at_hand(own), "row", "left_semi").select("d1", "d2", "words"))
        return reduce(DataFrame.unionByName, texts)

    def _widened(self) -> int:
        """Values of the prefix by which labels are searched: whole labels at first, then fewer, until the recall target is reached."""
        depth = DEPTH
        while not self.exact and chance(self.threshold, depth) < self.recall:
            depth -= 1
        return depth

    def _searched(self, own: dict) -> list[DataFrame]:
        """Tables (a1, a2, b1, b2), none where there are no candidates: the near pairs of an entry of the run `own` and any other.

        The range of a widened prefix holds those of the longer ones, so each run's labels are met once, in the widest.
        """
        depth = self._widened()
        pairs = saved(reduce(DataFrame.unionByName, (self._in_range(own, r, depth) for r in self.note["runs"])).distinct(), "candidates")
        if pairs.isEmpty():
            return []
        wanted = pairs.select(F.explode(F.array("a1", "b1")).alias("d1")).distinct()
        words = saved(self._words_of(wanted), "words")
        a, b = (words.select(F.col("d1").alias(f"{s}1"), F.col("d2").alias(f"{s}2"), F.col("words").alias(f"words_{s}")) for s in "ab")
        return [common_runs(pairs.join(a, "a1").join(b, "b1"), self.run_words, self.percent)]

    def add(self, batch: DataFrame, name: str | None = None) -> DataFrame:
        """(uid_a, uid_b), uid_a < uid_b: the batch's texts that repeat one another or one accepted before.

        The batch has (uid, chain, text). Null uid, chain or text and texts without a run of words repeat nothing. Rows
        of one uid are versions of it; they are never a pair. A batch whose `name` the store has already is not taken
        again; what was found then is returned. Until the last step, the note, the store is as it was before.
        """
        name = name or uuid.uuid4().hex
        if name in self.note["batches"]:
            return self._found(name)
        before = self.note
        run = self._write_run(batch)
        self.note = before | {"runs": [*before["runs"], run]}  # as it is to be; committed below
        try:
            if near := self._searched(run):
                near = reduce(DataFrame.unionByName, near)
                turned = F.struct(F.col("b1").alias("a1"), F.col("b2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2"))
                both = near.select(F.explode(F.array(F.struct("a1", "a2", "b1", "b2"), turned)).alias("_p")).select("_p.*")
                self._laid(both, run, "near", run["entries"])
                run["near"] = True
            self._pairs(run).write.parquet(f"{self.path}/{run['name']}_pairs")
            runs_now = self.note["runs"]
        finally:
            self.note = before
        self._commit(runs_now, before["batches"] | {name: f"{run['name']}_pairs"})
        self._merge_runs()
        return self._found(name)

    def _found(self, name: str) -> DataFrame:
        return self.spark.read.schema("uid_a string, uid_b string").parquet(f"{self.path}/{self.note['batches'][name]}")

    def _pairs(self, own: dict) -> DataFrame:
        """Pairs of a row of the run and any row, of the same entry or of entries near each other."""
        mine = self._texts(own).select(F.col("uid").alias("_u"), "d1", "d2").distinct()
        entries = at_hand(mine.select("d1", "d2").distinct(), own["entries"])
        links = []
        for r in (r for r in self.note["runs"] if r["near"]):
            near = self._table(r, "near").alias("o")
            met = near.join(entries.alias("n"), (F.col("n.d1") == F.col("o.a1")) & (F.col("n.d2").bitwiseXOR(F.col("o.a2")) == 0))
            links.append(met.select("o.a1", "o.a2", F.col("o.b1").alias("d1"), F.col("o.b2").alias("d2")))
        # of the members, only those of the batch's entries and of entries near them go on
        theirs = self._everyone().withColumnRenamed("uid", "_v")
        found = mine.join(theirs.join(entries, ["d1", "d2"], "left_semi").distinct(), ["d1", "d2"]).select("_u", "_v")
        if links:
            near = at_hand(saved(reduce(DataFrame.unionByName, links).distinct(), "links"))
            others = theirs.join(near, ["d1", "d2"]).select("_v", F.col("a1").alias("d1"), F.col("a2").alias("d2")).distinct()
            found = found.unionByName(others.join(mine, ["d1", "d2"]).select("_u", "_v"))
        return (
            found.where("_u <> _v")
            .select(F.least("_u", "_v").alias("uid_a"), F.greatest("_u", "_v").alias("uid_b")).distinct()
        )

    def _merge_runs(self) -> None:
        """Where there are more than most_runs, the smallest half becomes one run: each text is written again about log(batches) times."""
        if len(self.note["runs"]) <= self.most_runs:
            return
        by_size = sorted(self.note["runs"], key=lambda r: r["entries"])
        small, rest = by_size[: len(by_size) - self.most_runs // 2], by_size[len(by_size) - self.most_runs // 2 :]
        run = {"name": f"run{self.note['number'] + 1:09}_{uuid.uuid4().hex}", "buckets": {}, "entries": sum(r["entries"] for r in small), "hot": 0, "near": any(r["near"] for r in small)}
        at = f"{self.path}/{run['name']}"
        # the texts are numbered anew, as few parts as tasks; an entry's row is the first of its copies
        united = reduce(DataFrame.unionByName, (self._texts(r).drop("row", "seg") for r in small))
        united.withColumn("row", F.monotonically_increasing_id()).withColumn("seg", F.spark_partition_id()).write.option("compression", "zstd").partitionBy("seg").parquet(f"{at}/texts")
        fresh = reduce(DataFrame.unionByName, (self._table(r, "reps").select("d1", "d2") for r in small))
        rows = self._texts(run).groupBy("d1", "d2").agg(F.min("row").alias("row"))
        self._laid(rows.join(fresh, ["d1", "d2"], "left_semi"), run, "reps", run["entries"])
        self._laid(reduce(DataFrame.unionByName, (self._table(r, "labels") for r in small)), run, "labels", run["entries"] * TREES)
        if run["near"]:
            self._laid(reduce(DataFrame.unionByName, (self._table(r, "near") for r in small if r["near"])), run, "near", run["entries"])
        self._note_hot(run)
        self._commit([*rest, run], self.note["batches"])
        for r in small:  # what was found in them is kept beside them
            for part in (p for p, n in r["buckets"].items() if n > 1):
                self.spark.sql(f"drop table if exists {_named(r, part)}")
            remove(self.spark, f"{self.path}/{r['name']}")

    # ---- what belongs together ------------------------------------------------------------------

    def classes(self) -> DataFrame:
        """(uid, class_id, n_links): a row for each accepted uid and text of it; class_id is the least entry of all that near pairs and copies connect with it.

        n_links counts the other rows that are copies of the text or near it; copies aren't expanded into pairs. Classes are found in rounds over the near pairs between
        entries: each takes the least class among its neighbours', then that class's own.
        """
        near = reduce(DataFrame.unionByName, (self._table(r, "near") for r in self.note["runs"] if r["near"]), self.spark.createDataFrame([], _NEAR)).distinct()
        entry = lambda s: F.struct(F.col(f"{s}1").alias("d1"), F.col(f"{s}2").alias("d2")).alias(s)
        edges = saved(near.select(entry("a"), entry("b")), "edges")
        found = saved(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("c")), "classes")
        settled = edges.isEmpty()
        while not settled:
            least = edges.join(found.select(F.col("a").alias("b"), "c"), "b").groupBy("a").agg(F.min("c").alias("_near"))
            step = found.join(least, "a").select("a", F.least("c", "_near").alias("c"))
            jump = step.select(F.col("a").alias("c"), F.col("c").alias("_next"))
            after = saved(step.join(jump, "c", "left").select("a", F.coalesce("_next", "c").alias("c")), "classes")
            settled = after.exceptAll(found).isEmpty()
            found = after
        everyone = (self._everyone() if self.note["runs"] else self.spark.createDataFrame([], "uid string, d1 long, d2 long")).distinct().select("uid", F.struct("d1", "d2").alias("a"))
        sizes = everyone.groupBy("a").agg(F.count("*").alias("_n"))
        around = edges.join(sizes.select(F.col("a").alias("b"), "_n"), "b").groupBy("a").agg(F.sum("_n").alias("_around"))
        entries = sizes.join(found, "a", "left").join(around, "a", "left")
        named = entries.select("a", F.coalesce("c", "a").alias("c"), (F.col("_n") - 1 + F.coalesce("_around", F.lit(0))).alias("n_links"))
        return everyone.join(named, "a").select("uid", F.format_string("%016x%016x", "c.d1", "c.d2").alias("class_id"), "n_links")


def not_blank(text: Column) -> Column:
    return text.isNotNull() & text.rlike(r"[^\s ​﻿]")


def announcement_texts(announcements: DataFrame) -> DataFrame:
    """(uid, chain, text) of announcements with non-blank content: title, space, content; chain is source and locale."""
    return announcements.where(not_blank(F.col("content"))).select(
        "uid", F.to_json(F.array("source", "locale")).alias("chain"), F.concat(F.coalesce("title", F.lit("")), F.lit(" "), "content").alias("text")
    )


def taken_in(announcements: DataFrame, days: int = 10) -> tuple[Forest, list[DataFrame]]:
    """The store of all announcements, and what each batch repeated: the backlog, then each of the last `days` days as it arrived.

    Near is: of three words to a run, at least 60 % in common. Rows without a day belong to the backlog.
    """
    forest = Forest(announcements.sparkSession, run_words=3, threshold=0.6)
    last = [r[0] for r in announcements.select(F.substring("fetched_at", 1, 10).alias("d")).where("d is not null").distinct().orderBy(F.desc("d")).limit(days).collect()]
    first = min(last, default="")
    found = [forest.add(announcement_texts(announcements.where(f"fetched_at is null or fetched_at < '{first}'")), "backlog")]
    for day in sorted(last):  # compared as text, so that the file's statistics serve
        found.append(forest.add(announcement_texts(announcements.where((F.col("fetched_at") >= day) & (F.col("fetched_at") < f"{day}~"))), day))
    return forest, found


def repeats(announcements: DataFrame, days: int = 10) -> DataFrame:
    """(uid_a, uid_b): near-equal announcements of one source and locale, as taken_in finds them. An empty table gives no rows."""
    return reduce(DataFrame.unionByName, taken_in(announcements, days)[1]).distinct()
