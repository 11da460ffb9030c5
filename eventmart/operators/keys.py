"""Dense surrogate keys without a global window.

``row_number() over ()`` would move all rows into one task. Instead, rows are
written once together with a *slot* (task number and position within the task).
From then on slots are facts on disk, whatever is recomputed later. The rows per
task are counted into a table, and their running sum turns every slot into a dense
position. The sum is taken on two levels, within blocks of BLOCK tasks and over
the blocks, so that it is spread out where there are many tasks. One row of
totals is all that reaches the driver.

Rows that lie on disk with numbers already need not be written again to number some of them:
a bit for each row says which are kept, and the bits before a row are its position.
"""

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.operators.dedup import BLOCK_BYTES, WORDS, marks_of, only_marked, with_ranks

SLOT = "_slot"
BLOCK = 1024
# Up to this many tasks' first keys, 16 bytes each, are broadcast; beyond it the join shuffles.
BROADCAST_TASKS = 1_000_000
_TASK_BITS = 33  # layout of monotonically_increasing_id
# Marks and ranks of a block, and what else its row holds.
PLACE_BYTES = BLOCK_BYTES + 4 * WORDS + 64


def _task() -> Column:
    return F.shiftright(SLOT, _TASK_BITS)


def _position() -> Column:
    return F.col(SLOT).bitwiseAND(F.lit((1 << _TASK_BITS) - 1))


def next_key(table: DataFrame, key: str) -> DataFrame:
    """The largest key of a table, 0 where it is empty."""
    return table.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("max_key"))


def running_sums(counts: DataFrame) -> DataFrame:
    """``task, wanted`` to ``task, before``: how many are wanted of all tasks before."""
    block = F.floor(F.col("task") / BLOCK)
    counts = counts.select("task", "wanted", block.alias("block"))
    inside = F.sum("wanted").over(Window.partitionBy("block").orderBy("task")) - F.col("wanted")
    blocks = counts.groupBy("block").agg(F.sum("wanted").alias("all"))
    # One row for BLOCK tasks each.
    earlier = F.sum("all").over(Window.orderBy("block")) - F.col("all")
    joined = counts.withColumn("inside", inside).join(blocks.select("block", earlier.alias("earlier")), "block")
    return joined.select("task", (F.col("inside") + F.col("earlier")).alias("before"))


@dataclass
class Slotted:
    """Rows on disk with slots; ``counts`` on disk holds one row per task that wrote any."""

    rows: DataFrame
    counts: DataFrame
    tasks: int
    count: int
    to_number: int
    only: str | None
    totals: dict[str, int]

    def numbered(self, column: str, base: int, type_name: str = "bigint") -> DataFrame:
        """Replace slots by keys from ``base + 1`` up, without gaps.

        Rows that ``only`` leaves out keep the key they have.
        """
        per_task = running_sums(self.counts).select(F.col("task").alias("_task"), "before")
        if self.tasks <= BROADCAST_TASKS:
            per_task = F.broadcast(per_task)
        key = (F.col("before") + base + 1 + _position()).cast(type_name)
        if self.only:
            key = F.when(F.col(self.only), key).otherwise(F.col(column))
        return self.rows.withColumn("_task", _task()).join(per_task, "_task").withColumn(column, key).drop(SLOT, "_task", "before")


def write_slotted(
    frame: DataFrame, path: str, only: str | None = None, totals: Mapping[str, Column] | None = None
) -> Slotted:
    """Write ``frame`` with slots below ``path`` and count the rows per task.

    Rows get slots in the order the tasks produce them. ``only`` names a boolean
    column; where it is given, only its rows are to be numbered, and they must
    come first in every partition (see :func:`order_for_keys`). ``totals`` are
    further whole numbers to sum, or sets of bits to unite (names that end in
    ``_set``), in the pass that counts.
    """
    spark, totals = frame.sparkSession, dict(totals or {})
    slotted = frame.withColumn(SLOT, F.monotonically_increasing_id())
    slotted.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/rows")
    rows = spark.read.schema(slotted.schema).parquet(f"{path}/rows")

    def united(name: str, column: Column) -> Column:
        return (F.bit_or(column) if name.endswith("_set") else F.sum(column)).cast("bigint").alias(name)

    wanted = F.count_if(only) if only else F.count("*")
    per_task = rows.groupBy(_task().alias("task")).agg(
        F.count("*").alias("rows"), wanted.alias("wanted"), *[united(name, column) for name, column in totals.items()]
    )
    per_task.write.mode("overwrite").parquet(f"{path}/counts")
    counts = spark.read.schema(per_task.schema).parquet(f"{path}/counts")
    sums = [united(name, F.col(name)) for name in ("rows", "wanted", *totals)]
    all_ = counts.agg(F.count("*").alias("tasks"), *sums).first()
    found = {name: all_[name] or 0 for name in totals}
    return Slotted(rows, counts, all_["tasks"], all_["rows"] or 0, all_["wanted"] or 0, only, found)


@dataclass
class Placed:
    """Rows on disk with numbers, of which some are kept; ``places`` on disk says which."""

    rows: DataFrame
    places: DataFrame
    blocks: int
    count: int
    small: bool

    def numbered(self, column: str, base: int) -> DataFrame:
        """The kept rows with keys from ``base + 1`` up, in the order of their numbers, without gaps."""
        before = running_sums(self.places.select(F.col("block").alias("task"), F.col("held").alias("wanted")))
        places = self.places.join(before.withColumnRenamed("task", "block"), "block")
        kept = only_marked(self.rows, places, SLOT, self.small)
        return kept.withColumn(column, F.col("_rank") + F.lit(base + 1).cast("bigint")).drop(SLOT, "_rank")


def write_places(rows: DataFrame, kept: DataFrame, path: str, most_rows: int, most_bytes: int) -> Placed:
    """Write which of ``rows``, that lie on disk with their numbers in ``SLOT``, are among ``kept``.

    Numbers are those of ``monotonically_increasing_id``. Places within both limits count as small.
    """
    spark, places = rows.sparkSession, with_ranks(marks_of(kept.select(SLOT), SLOT))
    places.write.mode("overwrite").parquet(path)
    places = spark.read.schema(places.schema).parquet(path)
    blocks, count = places.agg(F.count("*"), F.coalesce(F.sum("held"), F.lit(0))).first()
    small = blocks <= most_rows and blocks * PLACE_BYTES <= most_bytes
    return Placed(rows, places, blocks, count, small)


def order_for_keys(frame: DataFrame, key: str, first: str | None = None, small: bool = False) -> DataFrame:
    """Range-partition and sort by a unique key, so slots follow its order.

    Range partitioning samples its input first; where the caller has measured that there
    are no more than a task sorts at ease, they go through one exchange instead, which
    leaves what is below it parallel.
    """
    parts = frame.repartition(1) if small else frame.repartitionByRange(F.col(key))
    sort = [F.desc(first), F.asc(key)] if first else [F.asc(key)]
    return parts.sortWithinPartitions(*sort)
