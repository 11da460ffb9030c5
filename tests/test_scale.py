"""Loads leave whole events where they are, or move no more of them than is asked for."""

import re

import pytest
from pyspark.sql import functions as F

from eventmart.functions.enrichment import enrich, one_per_day
from eventmart.operators import dedup, keys
from eventmart.operators.constraints import duplicate_keys
from eventmart.operators.dedup import first_per_key, marks_of, without_marked
from eventmart.operators.merge import DIMENSIONS
from eventmart.operators.resolve import resolve_keys, sized
from eventmart.plans import load as load_module
from eventmart.plans.load import LoadOptions, load_batch
from eventmart.mart import Mart
from tests.conftest import payload


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("small", [True, False])
def test_marked_rows_are_left_out_where_they_lie(spark, tmp_path, small):
    rows = spark.range(0, 30_000, 1, 3).withColumn("row", F.monotonically_increasing_id())
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    gone = rows.filter("id % 7 = 3 OR id % 64 = 63 OR id = 0 OR id BETWEEN 5000 AND 9999")
    kept = without_marked(rows, marks_of(gone.select("row")), small=small)
    assert kept.columns == ["id", "row"]
    assert sorted(r.id for r in kept.collect()) == [
        i for i in range(30_000) if not (i % 7 == 3 or i % 64 == 63 or i == 0 or 5000 <= i <= 9999)
    ]
    assert "SortMergeJoin" not in plan_of(kept)
    none = without_marked(rows, marks_of(rows.filter("id < 0")), small=small)
    assert none.count() == 30_000


def test_a_long_batch_is_not_shuffled_to_leave_out_copies_and_known_ids(events, spark, tmp_path, monkeypatch):
    """Whole events meet only marks; what was seen before is found from ids."""
    monkeypatch.setattr(load_module, "SMALL_ROWS", 20)
    marked = []

    def watched(rows, marks, row, small):
        marked.append((row, small))
        return without_marked(rows, marks, row, small)

    monkeypatch.setattr(load_module, "without_marked", watched)
    mart, options = Mart(spark, str(tmp_path / "mart")), LoadOptions(attempts=1, run_rows=10)
    first = [payload(event_id=f"E{i}") for i in range(60)] + [payload(event_id=f"E{i}", quantity=9) for i in range(30)]
    load_batch(mart, events(*first), 0, options=options)
    result = load_batch(mart, events(*[payload(event_id=f"E{i}") for i in range(50, 90)]), 1, options=options)
    assert (result.inserted, result.skipped) == (30, 10)
    assert marked == [("row", True), ("_slot", True)]
    facts = mart.table("fact_sales")
    assert facts.count() == 90 and facts.filter("quantity = 9").count() == 0


@pytest.mark.parametrize("small", [True, False])
def test_copies_are_found_by_hashes_and_judged_by_ids(spark, small, monkeypatch):
    """Here every third id shares its hash with others; nulls are no copies of each other."""
    monkeypatch.setattr(dedup, "key_hash", lambda key: (F.length(key) % 2).cast("bigint").alias("key_hash"))
    rows = [(f"E{i}" if i % 5 else None, i % 3, i % 2, i) for i in range(40)] + [(f"E{i}", 1, 7, 100 + i) for i in range(1, 12)]
    frame = spark.createDataFrame(rows, "event_id string, kafka_timestamp int, hash bigint, row bigint")
    repeated = frame.filter("event_id IS NOT NULL").select(dedup.key_hash("event_id")).distinct()
    assert repeated.count() == 2
    found = dedup.later_copies(frame, F.broadcast(repeated) if small else repeated.hint("shuffle_hash"), hashed=True)
    first, late = {}, set()
    for id, at, tie, row in sorted((r for r in rows if r[0]), key=lambda r: r[1:]):
        late |= {row} if id in first else set()
        first.setdefault(id, row)
    assert {r.row for r in found.collect()} == late and len(late) == 9


def test_ids_are_not_shuffled_as_texts_to_find_copies(events, spark, tmp_path, monkeypatch):
    grouped = []

    def watched(frame, key):
        grouped.append((frame.columns, dict(frame.dtypes)[key]))
        return duplicate_keys(frame, key)

    monkeypatch.setattr(load_module, "duplicate_keys", watched)
    mart = Mart(spark, str(tmp_path / "mart"))
    sent = [payload(event_id=f"E{i % 7}", quantity=1 + i) for i in range(9)]
    result = load_batch(mart, events(*sent), 0, options=LoadOptions(attempts=1))
    assert (result.valid, result.inserted) == (9, 7)
    assert grouped == [(["key_hash"], "bigint")]
    assert {r.quantity for r in mart.table("fact_sales").collect()} == set(range(1, 8))


@pytest.mark.parametrize("limit", [100, 3])
def test_kept_rows_are_numbered_where_they_lie(spark, tmp_path, limit):
    """Every bit of a word and several blocks and tasks; some tasks keep nothing."""
    rows = spark.range(0, 40_000, 1, 4).withColumn(keys.SLOT, F.monotonically_increasing_id())
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    kept = rows.filter("id % 7 <> 3 AND NOT id BETWEEN 8000 AND 21000 AND id <> 63")
    placed = keys.write_places(rows, kept, str(tmp_path / "places"), limit, 1 << 20)
    assert placed.small == (limit == 100)
    ids = [r.id for r in kept.orderBy("id").collect()]
    assert placed.count == len(ids)
    numbered = placed.numbered("key", 10)
    assert numbered.columns == ["id", "key"]
    assert sorted((r.id, r.key) for r in numbered.collect()) == [(i, 11 + n) for n, i in enumerate(ids)]
    none = keys.write_places(rows, rows.filter("id < 0"), str(tmp_path / "none"), limit, 1 << 20)
    assert none.count == 0 and none.numbered("key", 10).count() == 0


def test_events_are_staged_once_and_priced_after_the_lookups(events, spark, tmp_path, monkeypatch):
    written, looked_up = [], []

    def slotted(frame, path, *args, **settings):
        written.append((path.rsplit("/", 1)[-1], "payment_method" in frame.columns))
        return keys_write(frame, path, *args, **settings)

    def watched(rows, dimensions):
        looked_up.extend(rows.columns)
        return resolve_keys(rows, dimensions)

    keys_write = keys.write_slotted
    monkeypatch.setattr(keys, "write_slotted", slotted)
    monkeypatch.setattr(load_module, "resolve_keys", watched)
    mart = Mart(spark, str(tmp_path / "mart"))
    sent = [payload(event_id=f"E{i}") for i in range(9)] + [payload(event_id="E4", quantity=9), payload(event_id="X", price=0)]
    assert load_batch(mart, events(*sent), 0, options=LoadOptions(attempts=1)).inserted == 9
    assert written and not any(whole for _, whole in written)
    assert "date_key" in looked_up and not {"final_price", "revenue", "day_name"} & set(looked_up)
    facts = mart.table("fact_sales")
    assert sorted(r.sales_key for r in facts.collect()) == list(range(1, 10))
    assert facts.filter("date_key = 20250308 AND final_price = 16.99 AND event_hour = 23").count() == 9


def test_a_calendar_of_days_is_that_of_the_events(spark):
    times = [f"2024-{month:02d}-{day:02d} {hour:02d}:30:00" for month in (1, 2, 12) for day in (1, 29, 30) for hour in (0, 23) if (month, day) != (2, 30)]
    frame = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("event_timestamp_ts"))
    money = {c: F.lit(1).cast("decimal(8,6)") for c in ("price", "discount", "quantity")}
    whole = enrich(frame.withColumns({**money, "event_type": F.lit("purchase")}))
    columns = ["date_key", *DIMENSIONS[-1].attributes[:2], "event_year", "event_month", "week_number", "day_name", "is_weekend", "month_name"]
    columns = [c for c in columns if c in whole.columns]
    days = one_per_day(frame)
    assert days.count() == 8
    assert sorted(days.select(columns).collect()) == sorted(whole.select(columns).distinct().collect())


def test_first_per_key_moves_only_what_is_kept(spark, tmp_path):
    rows = [(f"k{i % 9}", i % 2, f"a{i % 5}", f"b{i % 3}", i) for i in range(200)]
    frame = spark.createDataFrame(rows, "event_id string, kafka_timestamp int, a string, b string, n int")
    frame.write.parquet(str(tmp_path / "rows"))
    frame = spark.read.parquet(str(tmp_path / "rows"))
    whole, narrow = first_per_key(frame), first_per_key(frame, keep=["b"])
    assert sorted(narrow.collect()) == sorted(whole.select("event_id", "b").collect())
    sorted_by = re.search(r"partial_min_by.*?\n.*?Sort.*?\n.*?Project \[([^\n]*)\]\n", plan_of(narrow), re.S)
    moved = re.findall(r"(\w+)#\d+", re.sub(r"xxhash64\(.*?\)", "", sorted_by.group(1)))
    assert {"event_id", "kafka_timestamp", "b"} <= set(moved) and not {"a", "n"} & set(moved)


def test_a_large_lookup_is_hashed(spark):
    events = spark.range(100).selectExpr(
        "cast(id % 7 AS string) AS customer_id", "'p' AS product_id", "'s' AS store_id", "'c' AS marketing_channel", "1 AS date_key"
    )
    tables = {d.table: events.select(d.id, *([F.lit(1).alias(d.key)] if d.key else [])).distinct() for d in DIMENSIONS}
    tables["dim_customer"] = sized(tables["dim_customer"], 7, 6)
    plan = plan_of(resolve_keys(events, tables))
    assert plan.count("ShuffledHashJoin") == 1
    assert sized(events, 6, 6) is events


@pytest.mark.parametrize("limit, value", [("SMALL_ROWS", None), ("SMALL_ROWS", 3), ("SMALL_BYTES", 3)])
def test_lookups_measured_to_be_small_leave_events_where_they_are(events, spark, tmp_path, monkeypatch, limit, value):
    """Whatever Spark estimates: here it would broadcast nothing by itself."""
    plans = []

    def watched(rows, dimensions):
        resolved = resolve_keys(rows, dimensions)
        plans.append(plan_of(resolved))
        return resolved

    monkeypatch.setattr(load_module, "resolve_keys", watched)
    if value:
        monkeypatch.setattr(load_module, limit, value)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = Mart(spark, str(tmp_path / "mart"))
        load_batch(mart, events(*[payload(event_id=f"E{i}", customer_id=f"C{i}") for i in range(9)]), 0, options=LoadOptions(attempts=1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert bool(re.search(r"SortMergeJoin [^\n]*LeftOuter", plans[0])) == bool(value)
    facts = mart.table("fact_sales")
    assert facts.select("customer_key").distinct().count() == facts.count() == 9


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum("shuffle_" in str(f) for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles()))


def test_shuffle_files_go_with_the_action_that_wrote_them(events, spark, tmp_path):
    before = shuffle_files(spark)
    grouped = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()
    assert len(grouped.collect()) == 7 and len(grouped.collect()) == 7
    mart = Mart(spark, str(tmp_path / "mart"))
    assert load_batch(mart, events(*[payload(event_id=f"E{i % 20}") for i in range(30)]), 0).inserted == 20
    assert shuffle_files(spark) <= before


def test_a_bitmap_keeps_all_rows_that_may_be_copies(spark):
    rows = spark.range(200_000).select(F.concat(F.lit("E"), "id").alias("event_id"), dedup.key_hash("id"))
    some = rows.filter("event_id LIKE '%77'")
    size = some.count()
    bits = dedup.bitmap_bits(size, 1 << 20)
    marks, _ = dedup.hash_bitmap(some, bits)
    passed = dedup.in_bitmap(rows, marks, bits)
    assert passed.columns == rows.columns
    held = {r.event_id for r in passed.collect()}
    assert {r.event_id for r in some.collect()} <= held and len(held) < 18_000
    assert dedup.bitmap_bits(0, 1 << 20) == 12 and dedup.bitmap_bits(1 << 20, 1 << 23) == 24
    assert dedup.bitmap_bits(1 << 22, 1 << 20) is None and dedup.bitmap_bits(9, 3) is None


@pytest.mark.parametrize("copies", [40, 0])
def test_only_rows_that_may_be_copies_are_shuffled(events, spark, tmp_path, monkeypatch, copies):
    """Repeated hashes that are too many to broadcast: a bitmap of them leaves the other rows where they are."""
    monkeypatch.setattr(load_module, "SMALL_ROWS", 10)
    found = []
    later = load_module.later_copies

    def watched(rows, repeated, **settings):
        found.append((settings.get("bitmap"), rows, later(rows, repeated, **settings)))
        return found[0][2]

    monkeypatch.setattr(load_module, "later_copies", watched)
    monkeypatch.setattr(Mart, "clear_staging", lambda *args: None)
    mart = Mart(spark, str(tmp_path / "mart"))
    sent = [payload(event_id=f"E{i}", quantity=1) for i in range(300)] + [payload(event_id=f"E{i}", quantity=9) for i in range(copies)]
    result = load_batch(mart, events(*sent), 0, options=LoadOptions(attempts=1))
    assert (result.valid, result.inserted) == (300 + copies, 300)
    assert mart.table("fact_sales").filter("quantity = 9").count() == 0
    assert sorted(r.sales_key for r in mart.table("fact_sales").select("sales_key").collect()) == list(range(1, 301))
    if copies:
        bitmap, rows, gone = found[0]
        assert bitmap and gone.count() == copies
        assert 2 * copies <= dedup.in_bitmap(rows.select(dedup.key_hash("event_id")), *bitmap).count() < 150
        assert "LeftSemi" not in plan_of(gone)


def test_rejected_events_are_numbered_where_they_were_staged(events, spark, tmp_path, monkeypatch):
    written = []
    slotted = keys.write_slotted
    monkeypatch.setattr(keys, "write_slotted", lambda frame, path, *args, **settings: (written.append(path), slotted(frame, path, *args, **settings))[1])
    mart = Mart(spark, str(tmp_path / "mart"))
    for batch in range(2):
        sent = [payload(event_id=f"X{batch}{i}", price=0) for i in range(12)] + [payload(event_id=f"E{batch}")]
        assert load_batch(mart, events(*sent), batch, options=LoadOptions(attempts=1)).rejected == 12
    letters = mart.table("dead_letter_events")
    assert sorted(r.dead_letter_key for r in letters.collect()) == list(range(1, 25))
    assert letters.filter("reject_reason = 'invalid price' AND raw_payload LIKE concat('%', event_id, '%')").count() == 24
    assert not [path for path in written if "dead_letter" in path]
