"""Mixing sources to target weights.

Method: weighted fair queueing. Every source's records are shuffled; each gets a virtual finish time, the
tokens of its source up to and with it divided by the source's target weight. All records are range-sorted
by that time and cut where the budget is full. A source is gone through again, up to its cap, before it
falls silent; its share then goes to the others in proportion to their weights. The sort is by ranges of
finish times that hold about equally many records, whatever the weights; only a sum for each range is added up.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.words import slices
from tidemill.operators.ranges import running_sum
from tidemill.session import at_hand, saved

#: Records that one window sorts, about.
CELL_RECORDS = 50_000
#: Values of the hash that shuffles the records.
HASHES = 16**15
#: Fixed value: the split pattern of the byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def with_tokens(texts: DataFrame, key: str, text: str, source: str, tokenizer: str) -> DataFrame:
    """(key, source, n_tokens): sizes in tokens of the vocabulary file `tokenizer`; null text has none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(tokenizer).encode_ordinary
        for batch in slices(batches, "text"):
            sizes = [len(encode(t)) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("source"), pa.array(sizes, pa.int64())], names=["key", "source", "n_tokens"])

    own = texts.select(F.col(key).cast("long").alias("key"), tidy_source(F.col(source)).alias("source"), F.col(text).alias("text"))
    return own.mapInArrow(count, "key long, source string, n_tokens long")


def tidy_source(source: Column) -> Column:
    return F.lower(F.trim(F.coalesce(source, F.lit(""))))


def queued(records: DataFrame, cells: int) -> DataFrame:
    """Adds _queued, the tokens of the source's shuffled records before each record.

    The shuffle's cells are equally wide parts of a hash, so they hold about equally many records; windows run inside
    (source, cell), and only one sum for each of them goes through a window over the source.
    """
    dealt = records.withColumn("_cell", F.floor(F.col("_u") / F.lit(float(HASHES)) * cells))
    sums = dealt.groupBy("source", "_cell").agg(F.sum("n_tokens").alias("_sum"))
    earlier = Window.partitionBy("source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("source", "_cell", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("source", "_cell").orderBy("_u", "key", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.join(before, ["source", "_cell"]).withColumn("_queued", F.col("_before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))


def _full_at(wholes: DataFrame, budget: int) -> float:
    """The virtual time by which the queues have surely given `budget` tokens; infinite where they never do.

    At time t a source has given weight * t tokens, all its repeats at most, less the record it is at. `wholes` has one row
    for each source of the targets: (_w, _r, _whole, _most), _most being its largest record.
    """
    own = wholes.select((F.col("_r") * F.col("_whole")).alias("_all"), "_w", "_most").withColumn("_end", F.col("_all") / F.col("_w"))
    so_far = Window.orderBy("_end")
    given = own.select("_end", "_w", F.sum("_all").over(so_far).alias("_ended"), F.sum("_w").over(so_far).alias("_left"), F.sum("_most").over(Window.partitionBy()).alias("_slack"), F.sum("_w").over(Window.partitionBy()).alias("_weights"))
    # what all have given when a source ends: those ended whole, the others by weight
    at_end = F.col("_ended") + F.col("_end") * (F.col("_weights") - F.col("_left"))
    wanted = F.lit(budget) + F.col("_slack")
    steps = given.select("_end", at_end.alias("_given"), (F.col("_weights") - F.col("_left")).alias("_rate"), wanted.alias("_wanted"), "_weights").agg(
        F.max(F.when(F.col("_given") < F.col("_wanted"), F.struct("_end", "_given", "_rate"))).alias("last"), F.max("_wanted").alias("wanted"), F.max("_weights").alias("weights")
    ).first()  # one row
    if steps is None or steps["wanted"] is None:
        return math.inf
    end, given_then, rate = tuple(steps["last"]) if steps["last"] else (0.0, 0.0, steps["weights"])
    return (end + (steps["wanted"] - given_then) / rate) * 1.001 if rate > 1e-12 else math.inf


def mix(sized: DataFrame, targets: DataFrame, seed: int = 0, budget: int | None = None) -> DataFrame:
    """(key, source, copy, n_tokens, starts_at): the records drawn, in the order of starts_at, their first token's place in the mix.

    `sized` has (key, source, n_tokens), `targets` (source, target_share, max_repeats); its sources are tidied
    and of rows of one source the greatest counts. The budget is the tokens of all records unless given. A
    record is drawn at most max_repeats times (copy 0 on; null counts as 1); sources without a positive share
    or absent from `targets` give nothing, nor do records without tokens or key. The mix is cut before the
    first record that would pass the budget. Records of equal keys are told apart by size alone: equal rows
    follow one another.

    Copies whose turn comes after the budget is surely full aren't made, so what is sorted is little more than the budget.
    """
    sized = saved(sized.where("key is not null and n_tokens > 0"), "sized")
    totals = sized.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count("*")).first()
    budget, n = totals[0] if budget is None else budget, totals[1]
    own = targets.where("target_share > 0 and coalesce(max_repeats, 1) > 0").groupBy(tidy_source(F.col("source")).alias("source")).agg(
        F.max(F.struct(F.col("target_share").alias("w"), F.coalesce("max_repeats", F.lit(1)).alias("r"))).alias("_t")
    )
    sums = sized.groupBy("source").agg(F.sum("n_tokens").alias("_whole"), F.max("n_tokens").alias("_most"))
    # as many rows as the targets have sources
    wholes = saved(own.join(sums, "source").select("source", F.col("_t.w").alias("_w"), F.col("_t.r").alias("_r"), "_whole", "_most"), "wholes")
    full = _full_at(wholes, budget)
    hashed = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string"))), 1, 15), 16, 10).cast("long")
    drawn = queued(sized.join(at_hand(wholes), "source").withColumn("_u", hashed), max(1, n // CELL_RECORDS))
    last = F.least(F.col("_r") - 1, F.floor(F.lit(min(full, 1e300)) * F.col("_w") / F.col("_whole")))
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    finish = (F.col("copy") * F.col("_whole") + F.col("_queued") + F.col("n_tokens")) / F.col("_w")
    timed = copies.select("key", "source", "copy", "n_tokens", "_u", finish.alias("_finish")).where(F.col("_finish") <= full)
    placed = running_sum(timed, ["_finish", "source", "_u", "key", "copy"], "n_tokens", "starts_at")
    return placed.where(F.col("starts_at") + F.col("n_tokens") <= budget).select("key", "source", "copy", "n_tokens", "starts_at")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, n_records, n_tokens, share, most_repeats): what each source was to give and gave."""
    drawn = mixed.groupBy("source").agg(F.count("*").alias("n_records"), F.sum("n_tokens").alias("n_tokens"), (F.max("copy") + 1).alias("most_repeats"))
    own = targets.groupBy(tidy_source(F.col("source")).alias("source")).agg(F.max("target_share").alias("target_share"))
    both = own.join(drawn, "source", "left")
    whole = Window.partitionBy()  # as many rows as targets has
    tokens = F.coalesce("n_tokens", F.lit(0))
    return both.select(
        "source", "target_share", F.coalesce("n_records", F.lit(0)).alias("n_records"), tokens.alias("n_tokens"),
        F.coalesce(tokens / F.nullif(F.sum(tokens).over(whole), F.lit(0)), F.lit(0.0)).alias("share"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
    )
