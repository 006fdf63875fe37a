"""Polled deliveries as a stream."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemill.operators.ingest import upsert
from tidemill.session import listed, new_path, read_note, write_note

#: Parts of the state by key; a delivery rewrites those that it has keys of.
BUCKETS = 64


class Store:
    """State and archive of deliveries in a folder. Another session goes on with it by its path.

    A note says which files are the state and which batch was the last; it is written in one step at the end of a batch. What a batch that failed
    or was cut short has written is in no note, and is written again when the batch is taken again; so each batch counts once.
    """

    def __init__(self, spark: SparkSession, start: DataFrame | None = None, path: str | None = None) -> None:
        self.spark, self.path = spark, path or new_path(spark, "store")
        notes = [n for n in listed(spark, f"{self.path}/notes") if n.endswith(".json")]
        if notes:
            self.note = read_note(spark, f"{self.path}/notes/{notes[-1]}")
        elif start is None:
            raise ValueError(f"{self.path} has no store, and there is no state to begin with")
        else:
            self.note = {"schema": start.schema.json(), "done": -1, "parts": self._written(start, "start"), "archive": []}
            write_note(spark, f"{self.path}/notes/{0:012}.json", self.note)

    @property
    def done(self) -> int:
        return self.note["done"]

    def _written(self, rows: DataFrame, version: str) -> dict[str, str]:
        """The rows written by key; bucket: folder."""
        where = f"{self.path}/state/{version}"
        rows.withColumn("bucket", _bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(where)
        return {n.split("=")[1]: f"{where}/{n}" for n in listed(self.spark, where) if n.startswith("bucket=")}

    def _read(self, folders: list[str]) -> DataFrame:
        schema = StructType.fromJson(json.loads(self.note["schema"]))
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def state(self) -> DataFrame:
        return self._read(sorted(self.note["parts"].values()))

    def archive(self) -> DataFrame:
        schema = "uid string, content_hash string, content string, captured_at string"
        return self.spark.read.schema(schema).parquet(*self.note["archive"]) if self.note["archive"] else self.spark.createDataFrame([], schema)

    def take(self, batch: DataFrame, number: int) -> None:
        """One delivery; a batch number that was taken already is left out."""
        if number <= self.done:
            return
        batch = batch.where("uid is not null")
        touched = [str(r[0]) for r in batch.select(_bucket().alias("b")).distinct().collect()]  # BUCKETS at most
        parts = self.note["parts"]
        state, archived = upsert(self._read([parts[b] for b in touched if b in parts]), batch)
        where = f"{self.path}/archive/batch={number:012}"
        archived.write.mode("overwrite").parquet(where)
        note = self.note | {"done": number, "parts": parts | self._written(state, f"batch{number:012}"), "archive": [*self.note["archive"], where]}
        write_note(self.spark, f"{self.path}/notes/{number + 1:012}.json", note)
        self.note = note


def _bucket():
    return F.pmod(F.xxhash64("uid"), F.lit(BUCKETS))


def run(deliveries: DataFrame, store: Store, on_batch: Callable[[int], None] | None = None) -> StreamingQuery:
    """Starts the stream of deliveries (uid, content, fetched_at) into the store; takes all that is there, then stops.

    The stream's own checkpoint is kept in the store's folder, so that its batch numbers and the store's belong together.
    """

    def each(batch: DataFrame, number: int) -> None:
        store.take(batch, number)
        if on_batch:
            on_batch(number)

    return deliveries.writeStream.foreachBatch(each).option("checkpointLocation", f"{store.path}/stream").trigger(availableNow=True).start()
