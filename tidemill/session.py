"""Session settings and tables that cut lineage."""

from __future__ import annotations

import json
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a few numbers up to which a table is broadcast.
BROADCAST_ROWS = 500_000


def local_session(cpus: int | str = 8, partitions: int = 8, app: str = "tidemill", memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the bench. Clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python once per application, wherever the driver imported it from."""
    context = spark.sparkContext
    if getattr(context, "_has_tidemill", False):
        return
    home = Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='spark-')}/tidemill", "zip", home.parent, home.name)
    context.addPyFile(archive)  # served by the driver
    context._has_tidemill = True


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or the checkpoint folder the caller set.

    Where neither is set, a session on this machine alone (tests, the bench) gets one of its own; on a cluster that is an error.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if found is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-tidemill-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/tidemill/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """df written to the shared folder and read again: cuts lineage and survives the loss of executors. `by` partitions the files."""
    path = new_path(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_hand(df: DataFrame, rows: int | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """df to be broadcast if it has at most `most` rows (counted unless given), else as it is: the join shuffles then."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= most else df


# ---- small files of a store: what it consists of ------------------------------------------------


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def listed(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, in order; none where it doesn't exist."""
    fs, where = _files(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def state(spark: SparkSession, path: str) -> list[str]:
    """Names, lengths and times of the files of a table: another list once it was written again."""
    fs, where = _files(spark, path)
    files = fs.listFiles(where, True)
    found = []
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()};")
    return sorted(found)


def read_note(spark: SparkSession, path: str) -> dict:
    fs, where = _files(spark, path)
    stream = fs.open(where)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, note: dict) -> None:
    """Writes a small JSON file in one step: it is there whole or not at all. An existing file is an error, so of two writers one wins."""
    fs, where = _files(spark, path)
    _, draft = _files(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    stream.write(bytearray(json.dumps(note).encode()))
    stream.close()
    if fs.exists(where) or not fs.rename(draft, where):
        fs.delete(draft, False)
        raise RuntimeError(f"{path} was written by another")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that a store wrote and nothing refers to any more."""
    fs, where = _files(spark, path)
    fs.delete(where, True)
