"""Event ids that earlier loads hold, as an index of sorted, bucketed runs.

A run is a Parquet table of ids alone, cut into buckets by the hash of the id and
sorted within. Because the buckets are Spark's own, a batch that is shuffled by id once
can be anti-joined with one run after the other, and no run is ever shuffled. A short
batch doesn't even read the runs whole: its few ids are given as values, so Spark opens only the
buckets they fall into, and within those only row groups whose range and Bloom
filter admit one of them. Ids are compared as they are, not by a hash.

A load of RUN_ROWS ids or more becomes a run of its own. Smaller loads stay *loose*, which
means that their ids are read from their facts, until there are RUN_ROWS of those or
LOOSE_LOADS loads. Runs have levels by size, FAN times larger each; once FAN runs are on a
level, they are merged into one. So an id is rewritten once for each level, and the
number of runs grows with the logarithm of the ids.
"""

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.mart import KNOWN_IDS, Commit, Mart
from eventmart.operators.dedup import restrict_to

RUN_ROWS = 200_000
LOOSE_LOADS = 32
FAN = 8
# A run has the least of these many buckets that leaves no bucket more than BUCKET_ROWS
# ids. Few steps, because a batch is shuffled again for each of them.
BUCKETS = (16, 256, 4096, 65536)
BUCKET_ROWS = 1_000_000
# Up to this many ids are looked up by value.
FEW = 1_000


@dataclass(frozen=True)
class Index:
    """What a commit says of the index."""

    runs: list[list[int]]
    loose: list[list[int]] | None


def buckets_for(rows: int) -> int:
    return next((n for n in BUCKETS if rows <= n * BUCKET_ROWS), BUCKETS[-1])


def level_of(rows: int, run_rows: int) -> int:
    level = 0
    while rows >= run_rows * FAN ** (level + 1):
        level += 1
    return level


def plan_runs(index: Index, run_rows: int) -> tuple[list[int], list[list[int]]]:
    """Which loose loads become a run now, and which runs it takes in."""
    loose = index.loose or []
    rows = sum(n for _, n in loose)
    if rows < run_rows and len(loose) < LOOSE_LOADS:
        return [], []
    merged: list[list[int]] = []
    while True:
        level = level_of(rows, run_rows)
        peers = [run for run in index.runs if run not in merged and level_of(run[1], run_rows) <= level]
        if len(peers) < FAN - 1:
            return [load for load, _ in loose], merged
        merged += peers
        rows += sum(run[1] for run in peers)


class KnownIds:
    """The index of a mart as of a commit."""

    def __init__(self, mart: Mart, at: Commit, run_rows: int = RUN_ROWS):
        self.mart, self.at, self.spark, self.run_rows = mart, at, mart.spark, run_rows

    def _name(self, load: int) -> str:
        return f"known_ids_{hashlib.md5(self.mart.root.encode()).hexdigest()[:12]}_{load}"

    def run(self, load: int, buckets: int) -> DataFrame:
        """A run as a bucketed table; the session's catalog learns where it lies when it is first asked for."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name(load)} (event_id STRING) USING parquet "
            f"CLUSTERED BY (event_id) SORTED BY (event_id) INTO {buckets} BUCKETS LOCATION '{self.mart.path(KNOWN_IDS, load)}'"
        )
        return self.spark.table(self._name(load))

    def forget(self, load: int) -> None:
        """Drop a run that another has taken in, table and files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(load)}")
        self.mart.clear_run(load)

    def unseen(self, events: DataFrame, small: bool, few: list[str] | None = None) -> DataFrame:
        """Events whose id no earlier load holds.

        ``few`` are the batch's ids where they are few. ``small`` says that they were
        measured and may be broadcast, which only matters for loose loads.
        """
        mart, at = self.mart, self.at
        for load, _, buckets in sorted(at.runs, key=lambda run: run[2]):
            known = self.run(load, buckets)
            if few is not None:
                known = F.broadcast(known.filter(F.col("event_id").isin(few)))
            events = events.join(known, "event_id", "left_anti")
        if not at.snapshots["fact_sales"] or at.loose == []:
            return events
        loads = None if at.loose is None else [load for load, _ in at.loose]
        loose = mart.table("fact_sales", at, loads).select("event_id")
        return events.join(restrict_to(loose, events, "event_id", small), "event_id", "left_anti")

    def seen(self, ids: DataFrame) -> DataFrame | None:
        """Those of a long batch's rows whose ``event_id`` an earlier load holds; None where no load does."""
        mart, at, parts = self.mart, self.at, []
        for load, _, buckets in at.runs:
            parts.append(ids.join(self.run(load, buckets), "event_id", "left_semi"))
        if at.snapshots["fact_sales"] and at.loose != []:
            loads = None if at.loose is None else [load for load, _ in at.loose]
            parts.append(ids.join(mart.table("fact_sales", at, loads).select("event_id"), "event_id", "left_semi"))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def extended(self, load: int, rows: int, facts: DataFrame) -> tuple[Index, list[int]]:
        """The index after ``load`` has added ``rows`` facts, and the runs that are no longer needed.

        Writes a run below ``load`` where it is time for one.
        """
        at = self.at
        if not rows:
            return Index(at.runs, at.loose), []
        ids, merged = facts.select("event_id"), []
        if at.loose is None:  # facts from before there was an index
            if at.snapshots["fact_sales"]:
                ids = ids.unionByName(self.mart.table("fact_sales", at).select("event_id"))
            total = ids.count()
        else:
            index = Index(at.runs, [*at.loose, [load, rows]])
            loads, merged = plan_runs(index, self.run_rows)
            if not loads:
                return index, []
            earlier = [n for n in loads if n != load]
            if earlier:
                ids = ids.unionByName(self.mart.table("fact_sales", at, earlier).select("event_id"))
            for number, _, buckets in merged:
                ids = ids.unionByName(self.run(number, buckets))
            total = sum(n for _, n in index.loose) + sum(run[1] for run in merged)
        self.write(ids, load, total)
        kept = [run for run in at.runs if run not in merged]
        return Index([*kept, [load, total, buckets_for(total)]], []), [run[0] for run in merged]

    def write(self, ids: DataFrame, load: int, rows: int) -> None:
        buckets = buckets_for(rows)
        writer = ids.repartition(buckets, "event_id").write.format("parquet").mode("overwrite")
        writer = writer.option("path", self.mart.path(KNOWN_IDS, load)).bucketBy(buckets, "event_id").sortBy("event_id")
        writer = writer.option("compression", "zstd").option("parquet.bloom.filter.enabled#event_id", "true")
        writer.option("parquet.bloom.filter.expected.ndv#event_id", str(max(1_000, rows // buckets))).saveAsTable(self._name(load))
