"""Load a batch of events into the star schema, all or nothing."""

import logging
import re
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from eventmart.domain import DISCOUNT, DOMAIN, PRICE, TABLE_DDL, Domain
from eventmart.functions.cleaning import normalize
from eventmart.functions.enrichment import date_key, enrich, one_per_day
from eventmart.functions.rules import Rule, event_rules, validate
from eventmart.mart import Commit, Mart
from eventmart.operators import keys, merge
from eventmart.operators.constraints import duplicate_keys, row_rules
from eventmart.operators.dedup import (
    BLOCK_BYTES, bitmap_bits, hash_bitmap, key_hash, last_per_key, later_copies, marks_of, without_marked,
)
from eventmart.operators.known_ids import FEW, RUN_ROWS, KnownIds
from eventmart.operators.resolve import lacks_member, resolve_keys, sized

log = logging.getLogger(__name__)

# A batch up to this size counts as small: its ids are broadcast to filter the
# stored tables in place. Both are measured before they are used.
SMALL_ROWS = 1_000_000
SMALL_BYTES = 64 * 1024 * 1024

# Members of a batch beyond this size are looked up without a sort of the events.
LOOKUP_ROWS = 200_000

# Members of a batch up to this size are put in order by one task.
SORT_ROWS = 50_000

# A batch with fewer new facts writes few files instead of one for each task and event type.
SHORT_ROWS = 50_000

# Columns no stored table takes anything from.
UNUSED = ("kafka_key", "ingestion_timestamp", "event_timestamp", "device_type", "browser")
DERIVED_ONLY = ("event_timestamp_ts", "event_date", "kafka_timestamp")

FACT_FIELDS = [c.split()[0] for c in re.split(r",\s+", TABLE_DDL["fact_sales"].strip())]


class ConstraintError(ValueError):
    """A batch breaks constraints of a stored table."""


@dataclass(frozen=True)
class LoadOptions:
    on_violation: str = "fail"  # or "quarantine": the rows become dead letters
    always_update: bool = False  # rewrite every matched dimension row
    keep_known: bool = False  # a default text never replaces a known one
    check_lengths: bool = False
    domain: Domain = DOMAIN  # values that rules and constraints allow
    rules: tuple[Rule, ...] | None = None  # instead of the standard ones
    run_rows: int = RUN_ROWS  # facts whose ids make a run of the index
    attempts: int = 3
    wait_seconds: float = 5.0


@dataclass(frozen=True)
class LoadResult:
    """What a load did. ``load`` is None where there was nothing to do."""

    load: int | None
    valid: int = 0
    rejected: int = 0
    inserted: int = 0
    skipped: int = 0
    missing_key: int = 0
    replayed: bool = False


def dead_letters(rejects: DataFrame, batch_id: int, now: datetime, keep: tuple[str, ...] = ()) -> DataFrame:
    """Quarantine rows, without their key; with other columns to ``keep``."""
    payload = [c for c in ("raw_json", "raw_payload") if c in rejects.columns]
    texts = [F.nullif(F.col(c), F.lit("")) for c in payload]
    reason = F.nullif(F.col("reject_reason"), F.lit(""))
    return rejects.select(
        "event_id",
        F.coalesce(*texts, F.lit("")).alias("raw_payload"),
        F.coalesce(reason, F.lit("schema parse failure")).alias("reject_reason"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.lit(now).alias("created_at"),
        *keep,
    )


def incoming_members(events: DataFrame, dim: merge.Dimension, keep_known: bool = False) -> DataFrame:
    """One row per member in a batch, with the attributes of its latest event."""
    renamed = events.withColumnsRenamed(dict(dim.renamed))
    defaults = merge.TEXT_DEFAULTS if keep_known and dim.tracked else None
    return last_per_key(renamed, dim.id, dim.attributes, defaults=defaults)


def fact_rows(resolved: DataFrame, now: datetime) -> DataFrame:
    """Fact columns of events whose keys are resolved, except ``sales_key``."""
    typed = {
        "quantity": F.col("quantity").cast("int"),
        "price": F.col("price").cast(PRICE),
        "discount": F.col("discount").cast(DISCOUNT),
        "loaded_at": F.lit(now),
    }
    return resolved.withColumns(typed).select(*[c for c in FACT_FIELDS if c in typed or c in resolved.columns])


@dataclass(frozen=True)
class Batch:
    """Valid events without copies, where they were staged, and what was measured of them."""

    rows: DataFrame  # with their number in keys.SLOT
    placed: keys.Placed
    totals: dict[str, int]

    @property
    def count(self) -> int:
        return self.placed.count


class _Load:
    """One attempt to load one batch."""

    def __init__(self, mart: Mart, previous: Commit, batch_id: int, source: str, options: LoadOptions, now: datetime):
        self.mart, self.previous, self.options, self.now = mart, previous, options, now
        self.batch_id, self.source = batch_id, source
        self.load = mart.claim(previous)
        self.snapshots = dict(previous.snapshots)
        self.buckets = dict(previous.buckets)
        self.runs, self.loose, self.replaced = previous.runs, previous.loose, []
        self.max_keys = dict(previous.max_keys)

    def run(self, events: DataFrame) -> LoadResult:
        try:
            return self._run(events)
        except BaseException:
            self.mart.clear_load(self.load)
            raise

    def _run(self, events: DataFrame) -> LoadResult:
        mart = self.mart
        staged = self._stage(events)
        sizes = staged.groupBy("is_valid").agg(F.count("*").alias("n")).collect()
        counts = {row["is_valid"]: row["n"] for row in sizes}
        valid, rejected = counts.get(True, 0), counts.get(False, 0)
        if not valid and not rejected:
            mart.clear_staging(self.load)
            return LoadResult(None)
        result = LoadResult(self.load, valid, rejected)
        with ThreadPoolExecutor(1) as side:
            quarantined = side.submit(self._append_dead_letters, staged.filter(~F.col("is_valid"))) if rejected else None
            if valid:
                result = self._load_valid(staged.filter("is_valid"), result)
            if quarantined:
                quarantined.result()
        previous = self.previous
        brought = {"fact_sales": result.inserted, "dead_letter_events": rejected}
        recent = {table: previous.with_recent(table, self.load, rows) for table, rows in brought.items()}
        mart.publish(
            Commit(
                previous.number + 1, self.load, self.snapshots, self.max_keys,
                {**previous.applied, self.source: self.batch_id},
                {k: v for k, v in vars(result).items() if k not in ("load", "replayed")},
                [*previous.dead, *range(previous.load + 1, self.load)],
                recent, self.buckets, self.runs, self.loose,
            )
        )
        for number in self.replaced:
            KnownIds(mart, previous).forget(number)
        mart.clear_staging(self.load)
        return result

    def _stage(self, events: DataFrame) -> DataFrame:
        """Normalise and validate, once, into a table split by validity.

        Everything after reads this table, each step only its columns. It also
        leaves the stream's own session, where adaptive execution is off. Rows get a number
        and a hash of their content, by which copies are told apart.
        """
        normal, options = normalize(events), self.options
        stored = self._row_rules(normal) if options.on_violation == "quarantine" else ()
        checked = validate(normal, options.rules or event_rules(options.domain), stored)
        checked = checked.withColumn("raw_json", F.when(~F.col("is_valid"), F.col("raw_json"))).drop(*UNUSED)
        content = [c for c in checked.columns if c not in ("event_id", "raw_json", "reject_reason", "is_valid")]
        checked = checked.withColumns({"hash": F.xxhash64(*content), "row": F.monotonically_increasing_id()})
        path = self.mart.staging(self.load, "events")
        checked.write.mode("overwrite").option("compression", "zstd").partitionBy("is_valid").parquet(path)
        return self.mart.spark.read.schema(checked.schema).parquet(path)

    def _append_dead_letters(self, rejects: DataFrame) -> None:
        table = "dead_letter_events"
        rows = dead_letters(rejects.withColumnRenamed("row", keys.SLOT), self.batch_id, self.now, (keys.SLOT,))
        placed = keys.write_places(rows, rows, self.mart.staging(self.load, table), SMALL_ROWS, SMALL_BYTES)
        base = self.max_keys[table]
        numbered = placed.numbered("dead_letter_key", base).write.mode("overwrite").option("compression", "zstd")
        numbered.parquet(self.mart.path(table, self.load))
        self.max_keys[table] = base + placed.count
        self.snapshots[table] = self.load

    def _load_valid(self, events: DataFrame, result: LoadResult) -> LoadResult:
        events = events.drop("raw_json", "reject_reason", "is_valid")
        batch = self._measured(events, self._unique(events))
        dimensions = self._merge_dimensions(batch)
        inserted, missing_key = self._append_facts(batch, dimensions)
        skipped = batch.count - inserted - missing_key
        return replace(result, inserted=inserted, skipped=skipped, missing_key=missing_key)

    def _measured(self, events: DataFrame, unique: DataFrame) -> Batch:
        """Check the constraints of a batch, and find the places of its rows among the staged ones.

        Events are not written again: what follows reads the staged ones, each step only its
        columns, leaves out the copies by their marks and derives what it needs itself.
        """
        enriched = enrich(unique).drop(*DERIVED_ONLY, "hash", "row")
        rules = self._row_rules(enriched)
        totals = {name: F.when(bad, 1) for name, bad in rules}
        for column in ("event_id", *(dim.id for dim in merge.DIMENSIONS)):
            totals[f"{column}_bytes"] = F.octet_length(F.col(column).cast("string"))
        found = enriched.agg(*[F.sum(value).alias(name) for name, value in totals.items()]).first()
        sums = {name: found[name] or 0 for name in totals}
        broken = [f"{name}: {sums[name]} rows" for name, _ in rules if sums[name]]
        if broken:
            raise ConstraintError("; ".join(broken))
        rows, staged = (frame.withColumnRenamed("row", keys.SLOT).drop("hash") for frame in (unique, events))
        path = self.mart.staging(self.load, "kept")
        return Batch(rows, keys.write_places(staged, rows, path, SMALL_ROWS, SMALL_BYTES), sums)

    def _small(self, batch: Batch, column: str) -> bool:
        """Whether the batch's values of an id column were measured to be few enough to broadcast."""
        return batch.count <= SMALL_ROWS and batch.totals[f"{column}_bytes"] <= SMALL_BYTES

    def _unique(self, events: DataFrame) -> DataFrame:
        """One row per event id.

        Hashes of ids that repeat are found first, from the id column alone. Where they are too many to
        broadcast, a bitmap of them is: most rows that are no copies are told by it. The numbers of the rows
        to leave out are then broadcast, as a bit for each row of the batch, so whole events
        stay where they are.
        """
        spark, path = self.mart.spark, self.mart.staging(self.load, "repeated")
        hashes = events.filter(F.col("event_id").isNotNull()).select(key_hash("event_id"))
        duplicate_keys(hashes, "key_hash").write.mode("overwrite").parquet(path)
        repeated = spark.read.schema("key_hash BIGINT, copies BIGINT").parquet(path)
        size = repeated.count()
        if not size:
            return events
        small = size <= 2 * SMALL_ROWS and 8 * size <= SMALL_BYTES  # half as large as ids of as many rows
        bits = None if small else bitmap_bits(size, SMALL_BYTES)
        bitmap = hash_bitmap(repeated, bits) if bits else None
        repeated = F.broadcast(repeated) if small else repeated.hint("shuffle_hash")
        return self._without(events, later_copies(events, repeated, hashed=True, bitmap=bitmap), "row", "left_out")

    def _without(self, rows: DataFrame, numbers: DataFrame, row: str, name: str) -> DataFrame:
        """Rows whose number is not among ``numbers``, which are written as marks first."""
        path = self.mart.staging(self.load, name)
        marks = marks_of(numbers, row)
        marks.write.mode("overwrite").parquet(path)
        marks = self.mart.spark.read.schema(marks.schema).parquet(path)
        blocks = marks.count()
        if not blocks:
            return rows
        return without_marked(rows, marks, row, blocks <= SMALL_ROWS and blocks * BLOCK_BYTES <= SMALL_BYTES)

    def _row_rules(self, events: DataFrame) -> list[Rule]:
        """Constraints the stored tables put on the events of a batch."""
        tables = ("fact_sales", "dim_customer", "dim_product", "dim_store", "dim_channel")
        rules = [r for table in tables for r in row_rules(table, self.options.check_lengths, events.columns, self.options.domain)]
        return list(dict(rules).items())

    def _merge_dimensions(self, batch: Batch) -> dict[str, DataFrame]:
        """Merge the dimensions side by side, each a few small jobs; returns the batch's own members with their keys."""
        with ThreadPoolExecutor(len(merge.DIMENSIONS)) as pool:
            merged = list(pool.map(lambda dim: self._merge(batch, dim), merge.DIMENSIONS))
        return {dim.table: table for dim, table in zip(merge.DIMENSIONS, merged)}

    def _merge(self, batch: Batch, dim: merge.Dimension) -> DataFrame:
        mart, options = self.mart, self.options
        current = mart.table(dim.table, self.previous)
        events = one_per_day(batch.rows) if dim is merge.DATE else enrich(batch.rows)
        incoming = incoming_members(events, dim, options.keep_known)
        # Reading the batch once more to filter a snapshot only pays where the snapshot is large.
        restrict = self._small(batch, dim.id) and self.max_keys[dim.table] > SMALL_ROWS
        classified = merge.classify(incoming, current, dim, options.always_update, options.keep_known, restrict)
        members = merge.resolved_rows(classified, dim, self.now, options.keep_known)
        few = batch.count <= SORT_ROWS
        if not few:  # members of a long batch are counted before they are put in order
            path = mart.staging(self.load, f"{dim.table}/members")
            members.write.mode("overwrite").parquet(path)
            members = mart.spark.read.schema(members.schema).parquet(path)
            few = members.count() <= SORT_ROWS
        ordered = keys.order_for_keys(members, dim.id, first="is_new", small=few)
        touched = F.col("is_new") | F.col("is_changed")
        totals = {
            "touched_set": F.when(touched, F.call_function("shiftleft", F.lit(1).cast("bigint"), dim.bucket())),
            "id_bytes": F.octet_length(F.col(dim.id).cast("string")),
        }
        written = keys.write_slotted(ordered, mart.staging(self.load, dim.table), only="is_new", totals=totals)
        base = self.max_keys[dim.table]
        numbered = written.numbered(dim.key, base, dim.key_type) if dim.key else written.rows.drop(keys.SLOT)
        hit = [b for b in range(dim.buckets) if written.totals["touched_set"] >> b & 1]
        if hit:
            self._rewrite(dim, current, numbered.filter(touched), hit)
            if dim.key:
                self.max_keys[dim.table] = base + written.to_number
        if written.count <= SMALL_ROWS and written.totals["id_bytes"] <= SMALL_BYTES:
            return F.broadcast(numbered)  # Spark's estimate would often shuffle and sort whole events; an id and a key are taken of it
        return sized(numbered, written.count, LOOKUP_ROWS)

    def _rewrite(self, dim: merge.Dimension, current: DataFrame, changes: DataFrame, hit: list[int]) -> None:
        """Write the buckets that changes fall into; the others stay as earlier loads left them."""
        mart, table, previous = self.mart, dim.table, self.previous
        loads = previous.buckets.get(table)
        if loads and len(loads) == dim.buckets:
            current = mart.members(table, previous, hit)
        else:  # a snapshot from before there were buckets, or with others: all are written
            loads, hit = [0] * dim.buckets, range(dim.buckets)
        state = merge.apply_changes(current, changes, dim).withColumn("bucket", dim.bucket())
        state.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(mart.path(table, self.load))
        present = set(mart.buckets_written(table, self.load))
        self.buckets[table] = [(self.load if b in present else 0) if b in hit else loads[b] for b in range(dim.buckets)]
        self.snapshots[table] = self.load

    def _append_facts(self, batch: Batch, dimensions: dict[str, DataFrame]) -> tuple[int, int]:
        """Append events the fact does not hold yet; returns rows inserted and rows without a key.

        ``sales_key`` counts all events of the batch, so skipped ones leave gaps.
        """
        mart, table = self.mart, "fact_sales"
        base = self.max_keys[table]
        known = KnownIds(mart, self.previous, self.options.run_rows)
        placed, few = batch.placed, None
        if self.previous.runs and batch.count <= FEW and batch.totals["event_id_bytes"] <= 100 * FEW:
            few = [row[0] for row in batch.rows.select("event_id").collect()]  # at most FEW
        if batch.count > SMALL_ROWS:  # only ids and slots are shuffled, whole events stay where they are
            seen = known.seen(batch.rows.select("event_id", keys.SLOT))
            if seen is not None:
                placed = replace(placed, rows=self._without(placed.rows, seen, keys.SLOT, "seen"))
            events = placed.numbered("sales_key", base)
        else:
            events = known.unseen(placed.numbered("sales_key", base), self._small(batch, "event_id"), few)
        # Prices and the calendar are derived after the lookups, so they are not shuffled where events are.
        resolved = resolve_keys(events.withColumn("date_key", date_key("event_timestamp_ts")), dimensions)
        seen = Observation()
        watched = resolved.withColumn("_no_key", lacks_member()).observe(seen, F.count_if("_no_key").alias("missing"))
        rows = fact_rows(enrich(watched.filter(~F.col("_no_key"))), self.now)
        if batch.count <= SHORT_ROWS:  # few files; tasks of longer batches write large ones anyway
            rows = rows.hint("rebalance", "event_type")
        rows.write.mode("overwrite").option("compression", "zstd").partitionBy("event_type").parquet(mart.path(table, self.load))
        # Counted from the files' footers.
        facts = mart.spark.read.schema(TABLE_DDL[table]).parquet(mart.path(table, self.load))
        inserted = facts.count()
        try:
            missing = seen.get["missing"]
        except Py4JJavaError:  # no event was left to look up, and Spark dropped the step that counts
            missing = 0
        if missing:
            log.warning("load %s: %s events without a dimension member", self.load, missing)
        if inserted:
            self.max_keys[table] = base + batch.count
            self.snapshots[table] = self.load
        index, self.replaced = known.extended(self.load, inserted, facts)
        self.runs, self.loose = index.runs, index.loose
        return inserted, missing


def with_retries(action: Callable[[], LoadResult], attempts: int = 3, wait_seconds: float = 5.0) -> LoadResult:
    """Run ``action``; on failure wait a little longer each time, then give up."""
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception:
            log.exception("attempt %s of %s failed", attempt, attempts)
            if attempt == attempts:
                raise
            time.sleep(wait_seconds * attempt)


def load_batch(
    mart: Mart, events: DataFrame, batch_id: int, source: str = "batch", options: LoadOptions = LoadOptions()
) -> LoadResult:
    """Load parsed events; readers see all of the batch or nothing.

    ``source`` and ``batch_id`` name the batch. A source's ids grow; one that is
    not above the last applied id was loaded before, and nothing happens.
    """

    def attempt() -> LoadResult:
        with mart.lock():
            previous = mart.bootstrap()
            if previous.applied.get(source, -1) >= batch_id:
                return LoadResult(None, replayed=True)
            now = datetime.now(timezone.utc)
            return _Load(mart, previous, batch_id, source, options, now).run(events)

    return with_retries(attempt, options.attempts, options.wait_seconds)
