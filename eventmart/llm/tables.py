"""Helpers the operators share: stored intermediate tables, joins with a measured side, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side of a join is broadcast only if it was counted and is no larger than this.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 * 2**20

# Rows that one Arrow batch holds, so that a Python worker's memory is bounded by a few texts.
BATCH_ROWS = 512


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it in spark.checkpoint.dir.

    Where it is unset, a local session gets a temporary folder; any other master
    is an error, because executors would write to disks others cannot see.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="eventmart-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(frame: DataFrame, name: str, partition_by: str | None = None, narrow: bool = False) -> DataFrame:
    """Write a frame to the shared folder and read it back: computed once, safe from lost executors.

    ``narrow`` is for short rows made from a scan of long ones: they are brought
    together in files of the size Spark aims at, not a small file for each task.
    The files go when the session ends.
    """
    spark = frame.sparkSession
    target = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = (frame.hint("rebalance", *filter(None, [partition_by])) if narrow else frame).write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(target)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(frame.schema).parquet(target)


def join_measured(
    left: DataFrame, right: DataFrame, on, how: str = "inner", row_bytes: int = 32, rows: int | None = None
) -> DataFrame:
    """Join with a stored right side: broadcast if its counted rows fit the bound, else by shuffle.

    ``row_bytes`` is the width of a row of ``right``. Beyond the bound adaptive
    execution splits skewed keys of the left side.
    """
    rows = right.count() if rows is None else rows
    small = rows <= BROADCAST_ROWS and rows * row_bytes <= BROADCAST_BYTES
    return left.join(F.broadcast(right) if small else right, on, how)


def by_batch(frame: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply a function to each Arrow batch of bounded size; no shuffle."""
    return by_partition(frame, lambda batches: map(function, batches), schema)


def by_partition(
    frame: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Apply a function to the Arrow batches, of bounded size, of each partition; no shuffle."""
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return frame.mapInArrow(function, schema)


def free_name(name: str, frame: DataFrame) -> str:
    """A name that no column of the frame has, in whichever case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: pa.Array) -> list:
    """The texts of a column as bytes, None for null."""
    return column.cast(pa.large_binary()).to_pylist()
