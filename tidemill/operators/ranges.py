"""Global numbering and running sums without a single task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemill.session import saved


def laid_out(rows: DataFrame, order: list[str], size: str, label: str = "ranges") -> DataFrame:
    """The rows in ranges of the global order, with _part, the number of their range, and _inside, the sum of `size` (null as 0) over the rows before in it.

    Summed up where the range sort puts the rows, so they are shuffled once; written, so that the ranges stay as they are.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, so_far = TaskContext.get().partitionId(), 0
        for batch in batches:
            own = pc.fill_null(batch.column(size), 0).to_numpy(zero_copy_only=False)
            upto = so_far + np.cumsum(own)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(own), part, np.int32)), pa.array((upto - own).astype(np.int64))], names=[*batch.schema.names, "_part", "_inside"]
            )
            so_far = int(upto[-1]) if len(own) else so_far

    ranged = rows.withColumn(size, F.col(size).cast("long")).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = StructType([*ranged.schema.fields, StructField("_part", IntegerType()), StructField("_inside", LongType())])
    return saved(ranged.mapInArrow(sums, schema), label)


def running_sum(rows: DataFrame, order: list[str], size: str, name: str) -> DataFrame:
    """Adds `name`, the sum of `size` over all rows before a row in the global order; rows equal in all order columns stand in any order.

    The ranges hold about equally many rows whatever the values; only one sum for each range is summed up over the ranges.
    """
    laid = laid_out(rows, order, size)
    sums = laid.groupBy("_part").agg(F.sum(size).alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    before = sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    return laid.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_inside")).drop("_part", "_before", "_inside")


def numbered(rows: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """Adds the row's number from 0 in the global order; see running_sum."""
    return running_sum(rows.withColumn("_one", F.lit(1).cast("long")), order, "_one", name).drop("_one")


def chunked(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """Adds chunk, the number of the chunk of `size` rows in the global order."""
    return numbered(rows, order, "_row").withColumn("chunk", F.floor(F.col("_row") / F.lit(size))).drop("_row")
