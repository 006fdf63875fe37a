"""Mixed time formats and zones as one unambiguous form.

Method: all valid readings of every value are generated as arrays; a Viterbi pass over each source's
record order chooses among them, with costs for readings against what is known of the source, for
switches of format and for steps back in time.

The order is laid out by a range sort. A chain (one source's order) may span many partitions: each
partition hands on the cost matrix, first to last record, of the chains at its two ends only, these at
most two rows per partition are joined into the cheapest path, and each partition then decodes its part.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemill.functions.times import BACKWARD, SWITCH, Reading, readings
from tidemill.session import shared_folder

READ_SCHEMA = "_chain string, _arrived string, _id string, _value string, _form string, _at long, _others string"
READ_ARROW = pa.schema([("_chain", pa.string()), ("_arrived", pa.string()), ("_id", pa.string()), ("_value", pa.string()), ("_form", pa.string()), ("_at", pa.int64()), ("_others", pa.string())])
OUT_ARROW = pa.schema([("_chain", pa.string()), ("_id", pa.string()), ("_value", pa.string()), ("at", pa.int64()), ("form", pa.string()), ("n_readings", pa.int32())])


def with_readings(values: DataFrame) -> DataFrame:
    """Rows of (_chain, _arrived, _id, _value, _zone, _order) that have a reading, with all of them.

    The cheapest reading is in _form and _at, others with their costs in _others, null where there are none.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {n: batch.column(n).to_pylist() for n in ("_chain", "_arrived", "_id", "_value", "_zone", "_order")}
            out = []
            for chain, arrived, rid, value, zone, order in zip(*cols.values()):
                if found := readings(value, zone, order):
                    first = found[0]
                    more = json.dumps([first.cost, *found[1:]]) if len(found) > 1 or first.cost else None
                    out.append((chain, arrived, rid, value, first.form, first.at, more))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), READ_ARROW)], schema=READ_ARROW)

    return values.select("_chain", "_arrived", "_id", "_value", "_zone", "_order").mapInArrow(read, READ_SCHEMA)


def _states(form: str, at: int, others: str | None) -> list[Reading]:
    if others is None:
        return [Reading(form, at, 0.0)]
    cost, *more = json.loads(others)
    return [Reading(form, at, cost), *(Reading(*m) for m in more)]


def _step(before: Reading, after: Reading) -> float:
    return after.cost + SWITCH * (before.form != after.form) + BACKWARD * (after.at < before.at)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(chain, id, value, states) in order; repeats of a record in a row are left out."""
    last = None
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in ("_chain", "_arrived", "_id", "_value", "_form", "_at", "_others"))):
            if row[:4] != last:
                last = row[:4]
                yield row[0], row[2], row[3], _states(*row[4:])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cost matrices of the first and the last chain of a partition."""
    done: list[tuple] = []
    chain, first, last, matrix = None, [], [], []

    def close() -> None:
        if chain is not None:
            done[1:] = [(chain, json.dumps([first, last, matrix]))] if done else []
            if not done:
                done.append((chain, json.dumps([first, last, matrix])))

    for name, _, _, states in _records(batches):
        if name != chain:
            close()
            chain, first, last = name, states, states
            matrix = [[s.cost if i == j else 1e18 for j, s in enumerate(states)] for i in range(len(states))]
            continue
        if len(states) == 1 and len(last) == 1:
            step = _step(last[0], states[0])
            matrix = [[row[0] + step] for row in matrix]
        else:
            steps = [[_step(a, b) for b in states] for a in last]
            matrix = [[min(row[k] + steps[k][j] for k in range(len(last))) for j in range(len(states))] for row in matrix]
        last = states
    close()
    part = TaskContext.get().partitionId()
    if done:
        yield pa.RecordBatch.from_pydict({"part": pa.array([part] * len(done), pa.int32()), "chain": [d[0] for d in done], "ends": [d[1] for d in done]})


def _joined(pieces: list[tuple[int, str, str]]) -> dict[tuple[int, str], tuple[int, int]]:
    """For each piece of a chain that spans partitions: which of its first and last record's readings the cheapest path takes."""
    chains: dict[str, list] = {}
    for part, chain, ends in sorted(pieces):
        first, last, matrix = json.loads(ends)
        chains.setdefault(chain, []).append((part, [Reading(*x) for x in first], [Reading(*x) for x in last], matrix))
    chosen = {}
    for chain, own in chains.items():
        if len(own) == 1:
            continue
        back, cost = [], [0.0]
        before: list[Reading] = []
        for _, first, last, matrix in own:
            enter = [
                min((cost[k] + _step(b, s) - s.cost, k) for k, b in enumerate(before)) if before else (0.0, 0) for s in first
            ]
            through = [min((enter[i][0] + matrix[i][j], i) for i in range(len(first))) for j in range(len(last))]
            back.append((enter, through))
            cost, before = [c for c, _ in through], last
        end = min(range(len(cost)), key=cost.__getitem__)
        for (part, *_), (enter, through) in zip(reversed(own), reversed(back)):
            start = through[end][1]
            chosen[part, chain] = (start, end)
            end = enter[start][1]
    return chosen


def resolve(values: DataFrame) -> DataFrame:
    """(_chain, _id, _value, at, form, n_readings): the reading chosen for each value, `at` in seconds since 1970.

    `values` has _chain (the source whose order counts), _arrived, _id, _value, _zone (time zone of values
    without one; UTC where null) and _order (dmy, mdy, ymd or null). Values without a valid reading give no
    row. Records of equal arrival are ordered by id and value; repeats count once.
    """
    spark = values.sparkSession
    shared_folder(spark)
    keys = ["_chain", "_arrived", "_id", "_value"]
    # laid out first and read then: the sample for the ranges needs no readings
    ordered = with_readings(values.repartitionByRange(*keys)).sortWithinPartitions(*keys).checkpoint()
    # at most two rows for each partition, whatever the number of records
    pieces = ordered.mapInArrow(_ends, "part int, chain string, ends string").collect()
    chosen = _joined([tuple(p) for p in pieces])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        chain, held = None, []  # held: (id, value, states, best predecessor of each state)
        cost: list[float] = []

        def flush(end: int) -> None:
            for rid, value, states, back in reversed(held):
                out.append((chain, rid, value, states[end].at, states[end].form, len(states)))
                end = back[end]
            held.clear()

        def close() -> None:
            if held:
                fixed = chosen.get((part, chain))
                flush(fixed[1] if fixed else min(range(len(cost)), key=cost.__getitem__))

        last: list[Reading] = []
        for name, rid, value, states in _records(batches):
            if name != chain:
                close()
                chain = name
                fixed = chosen.get((part, chain))
                cost = [s.cost if not fixed or i == fixed[0] else 1e18 for i, s in enumerate(states)]
                held.append((rid, value, states, [0] * len(states)))
            else:
                if len(last) == 1 and held:  # every path goes through a record with one reading
                    flush(0)
                    cost = [0.0]
                best = [min((cost[k] + _step(b, s), k) for k, b in enumerate(last)) for s in states]
                cost = [c for c, _ in best]
                held.append((rid, value, states, [k for _, k in best]))
            last = states
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), OUT_ARROW)], schema=OUT_ARROW)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), OUT_ARROW)], schema=OUT_ARROW)

    return ordered.mapInArrow(decode, "_chain string, _id string, _value string, at long, form string, n_readings int")
