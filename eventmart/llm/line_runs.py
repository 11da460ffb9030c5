"""Levelled sorted runs of line hashes, which can outlive a call.

A run is a Parquet table of (h1, h2, n_docs, keeper), one row for each line hash, cut into
buckets by the hash and sorted within. All runs of a folder have the same number of
buckets, so a batch that has been dealt out by hash once is merge-joined with one run after
the other: neither side is shuffled or sorted again. Where a level has ``fan_in`` runs, they
are merged into one on the next level, by full outer merge joins of two at a time.

A batch's hashes are anti-joined with all runs. The unknown ones bring their keeper, the
known ones only their count. So the first batch that has a line names its keeper, for good.

Runs in a folder of their own choice stay there. ``publish`` makes the runs added
since the folder was opened its contents, in one step; until then a later reader finds the
earlier ones, so a job that failed is simply run again. Of two that add to the same
folder at the same time, the second to publish gets an error.

Cases: a batch may be empty. Documents must come once: one that is added again counts again.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.tables import shared_folder
from eventmart.mart import Files

FAN_IN = 2
KEY = ["h1", "h2"]
# A folder gets at least as many buckets as the session has shuffle partitions, and so many that
# the first call's lines leave no more than this in one.
BUCKET_ROWS = 4_000_000
MAX_BUCKETS = 65_536

# Buckets are read as they lie: dealt out by hash, and sorted where one file holds a bucket.
AS_THEY_LIE = {
    "spark.sql.sources.bucketing.enabled": "true",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


@contextmanager
def as_they_lie(spark: SparkSession) -> Iterator[None]:
    """Settings for plans over buckets; the session's own come back, also after an error."""
    before = {name: spark.conf.get(name, None) for name in AS_THEY_LIE}
    try:
        for name, value in AS_THEY_LIE.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class LineRuns:
    """The runs of a folder; without one, of a temporary folder that goes with the session."""

    def __init__(self, spark: SparkSession, folder: str | None = None, fan_in: int = FAN_IN):
        self.spark, self.fan_in = spark, fan_in
        self.folder = folder.rstrip("/") if folder else f"{shared_folder(spark)}/line-runs-{uuid.uuid4().hex}"
        self._files = Files(spark, self.folder)
        if not folder:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
            files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            files.mkdirs(path)
            files.deleteOnExit(path)
        numbers = [int(n[:-5]) for n in self._files.names(self.folder) if n.endswith(".json") and n[:-5].isdigit()]
        self.number = max(numbers, default=0)
        found = json.loads(self._files.read(self._contents(self.number))) if numbers else {}
        self.buckets: int | None = found.get("buckets")
        self.levels: list[list[str]] = found.get("levels", [[]])
        self._tables: set[str] = set()

    def _contents(self, number: int) -> str:
        return f"{self.folder}/{number:08d}.json"

    @property
    def names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def table(self, name: str) -> DataFrame:
        """A run as a bucketed table; the session's catalog learns where it lies when it is first asked for."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS line_run_{name} (h1 BIGINT, h2 BIGINT, n_docs BIGINT, keeper BIGINT) USING parquet "
            f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{name}'"
        )
        self._tables.add(name)
        return self.spark.table(f"line_run_{name}")

    def forget_tables(self) -> None:
        """Take the runs out of the session's catalog; their files stay."""
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS line_run_{name}")
        self._tables.clear()

    def _write(self, run: DataFrame) -> str:
        name = uuid.uuid4().hex
        writer = run.select(*KEY, "n_docs", "keeper").write.format("parquet").option("path", f"{self.folder}/{name}")
        writer.bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(f"line_run_{name}")
        self._tables.add(name)
        return name

    def unknown(self, own: DataFrame) -> DataFrame:
        """Hashes of a batch that no run holds."""
        for name in self.names:
            own = own.join(self.table(name).select(*KEY).hint("merge"), KEY, "left_anti")
        return own

    def with_keepers(self, own: DataFrame) -> DataFrame:
        """A batch's hashes, with the keeper of those that no run holds, null for the others."""
        fresh = self.unknown(own).select(*KEY, "keeper")
        return own.drop("keeper").join(fresh.hint("merge"), KEY, "left")

    def _both(self, one: str, two: str) -> DataFrame:
        """Two runs as one: counts added up; of the keepers, which are null but for the first sighting, that one."""
        other = self.table(two).toDF(*KEY, "n_docs2", "keeper2").hint("merge")
        count = F.coalesce("n_docs", F.lit(0)) + F.coalesce("n_docs2", F.lit(0))
        keeper = F.greatest("keeper", "keeper2")
        return self.table(one).join(other, KEY, "full_outer").select(*KEY, count.alias("n_docs"), keeper.alias("keeper"))

    def merged(self, names: list[str] | None = None) -> DataFrame:
        """Runs as one, all if none are named. Of more than two, the first ones are merged into files."""
        names = list(self.names if names is None else names)
        while len(names) > 2:
            names = [self._write(self._both(*names[:2])), *names[2:]]
        return self._both(*names) if len(names) == 2 else self.table(names[0])

    def add(self, lines: DataFrame, expected: int) -> None:
        """Add a batch (doc, h1, h2), in which the largest doc keeps a line that no run holds.

        ``expected`` lines set the number of buckets, once for a folder.
        """
        if self.buckets is None:
            shuffled = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self.buckets = min(MAX_BUCKETS, max(shuffled, math.ceil(expected / BUCKET_ROWS)))
        own = (
            lines.groupBy(*KEY, "doc").agg(F.lit(1).alias("one"))
            .groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper"))
            .repartition(self.buckets, *KEY)
        )
        with as_they_lie(self.spark):
            name = self._write(own)
            if self.names:
                name = self._write(self.with_keepers(self.table(name)))
            self.levels[0].append(name)
            for depth, level in enumerate(self.levels):
                if len(level) >= self.fan_in:
                    if depth + 1 == len(self.levels):
                        self.levels.append([])
                    self.levels[depth + 1].append(self._write(self.merged(level)))
                    self.levels[depth] = []

    def publish(self) -> None:
        """Make these runs the folder's; call it once results made with them are safe."""
        text = json.dumps({"buckets": self.buckets, "levels": self.levels})
        if not self._files.put_new(self._contents(self.number + 1), text, f"{self.folder}/_{uuid.uuid4().hex}"):
            raise RuntimeError(f"{self.folder} has got other runs since it was opened")
        self.number += 1

    def sweep(self) -> None:
        """Delete runs that the published contents don't name, such as merged ones; nobody else may use the folder."""
        self.forget_tables()
        named = json.loads(self._files.read(self._contents(self.number)))["levels"] if self.number else []
        keep = {name for level in named for name in level}
        for name in self._files.names(self.folder):
            if not name.endswith(".json") and name not in keep:
                self._files.remove(f"{self.folder}/{name}")
