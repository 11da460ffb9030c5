from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventmart.functions.rounding import percentage, ratio
from eventmart.operators import constraints, keys, merge
from eventmart.operators.dedup import first_per_key, last_per_key, not_seen
from eventmart.operators.resolve import resolve_keys


# --- de-duplication


def test_first_per_key_ignores_row_order(spark):
    rows = [("a", 3, "late"), ("a", 1, "x"), ("a", 1, "y"), ("b", None, "only"), ("c", 2, "z")]
    schema = "event_id string, kafka_timestamp int, text string"
    results = {
        tuple(sorted(tuple(r) for r in first_per_key(spark.createDataFrame(r, schema).repartition(n)).collect()))
        for r in (rows, rows[::-1]) for n in (1, 3)
    }
    assert len(results) == 1
    kept = {r[0]: r[1] for r in results.pop()}
    assert kept == {"a": 1, "b": None, "c": 2}


def test_hot_key_collapses_before_the_shuffle(spark):
    frame = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END AS event_id", "id AS kafka_timestamp"
    )
    unique = first_per_key(frame)
    assert unique.count() == 20_001
    assert unique.filter("event_id = 'hot'").first()["kafka_timestamp"] == 0
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_last_per_key_ties(spark):
    frame = spark.createDataFrame([("c", 1, "a", None), ("c", 1, "b", 2), ("c", 1, "b", 3)], "id string, ts int, name string, age int")
    last = last_per_key(frame, "id", ["name", "age"], "ts")
    assert [tuple(r) for r in last.collect()] == [("c", "b", 3)]
    assert "HashAggregate(keys=[id" in last._jdf.queryExecution().executedPlan().toString()


def test_last_per_key(spark):
    rows = [("c", 1, "a", "Old"), ("c", 2, "b", None), ("d", 1, "z", "Zed")]
    frame = spark.createDataFrame(rows, "id string, ts int, event_id string, name string")
    assert {tuple(r) for r in last_per_key(frame, "id", ["name"], "ts").collect()} == {("c", None), ("d", "Zed")}
    assert {r[0] for r in last_per_key(frame, "id", [], "ts").collect()} == {"c", "d"}


def test_last_per_key_keeps_known_texts(spark):
    rows = [("c", 1, "Ann", 1), ("c", 2, "Unknown Customer", 2), ("d", 1, "Unknown Customer", 3)]
    frame = spark.createDataFrame(rows, "id string, ts int, customer_name string, age int")
    last = last_per_key(frame, "id", ["customer_name", "age"], "ts", {"customer_name": "Unknown Customer"})
    assert {tuple(r) for r in last.collect()} == {("c", "Ann", 2), ("d", "Unknown Customer", 3)}


@pytest.mark.parametrize("small", [True, False])
def test_not_seen(spark, small):
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "event_id string, n int")
    seen = spark.createDataFrame([("b", "x"), ("b", "y"), ("z", "z")], "event_id string, other string")
    left = not_seen(batch, seen, small=small)
    assert {r["event_id"] for r in left.collect()} == {"a", "c"}
    assert "LeftAnti" in left._jdf.queryExecution().executedPlan().toString()


# --- keys


@pytest.mark.parametrize("small", [True, False])
def test_keys_are_dense_and_ordered(spark, tmp_path, small):
    frame = spark.range(5_000).selectExpr("'id-' || lpad(cast((id * 7919) % 5000 AS string), 4, '0') AS id", "id % 4 = 0 AS is_new")
    ordered = keys.order_for_keys(frame.repartition(7), "id", first="is_new", small=small)
    slotted = keys.write_slotted(ordered.withColumn("key", F.lit(None).cast("bigint")), str(tmp_path / "s"), only="is_new")
    assert (slotted.count, slotted.to_number) == (5_000, 1_250)
    rows = slotted.numbered("key", 100).collect()
    numbered = sorted((r["key"], r["id"]) for r in rows if r["is_new"])
    assert [k for k, _ in numbered] == list(range(101, 1_351))
    assert [i for _, i in numbered] == sorted(i for _, i in numbered)
    assert all(r["key"] is None for r in rows if not r["is_new"])


def test_keys_of_all_rows(spark, tmp_path):
    slotted = keys.write_slotted(spark.range(1_000).repartition(6).toDF("n"), str(tmp_path / "s"))
    found = sorted(r["key"] for r in slotted.numbered("key", 0, "int").collect())
    assert found == list(range(1, 1_001))
    assert keys.write_slotted(spark.range(0).toDF("n"), str(tmp_path / "e")).numbered("key", 5).count() == 0


def test_next_key(spark):
    frame = spark.createDataFrame([(3,), (9,)], "k bigint")
    assert keys.next_key(frame, "k").first()[0] == 9
    assert keys.next_key(frame.filter("k > 10"), "k").first()[0] == 0


# --- merge

OLD, NOW = datetime(2025, 1, 1), datetime(2025, 6, 1)
STORED = [
    (1, "s1", "Hub", "Egypt", "Giza", OLD, OLD),
    (2, "s2", "Mall", "Egypt", None, OLD, OLD),
    (3, "s3", "Shop", "Egypt", "Cairo", OLD, OLD),
]
INCOMING = [("s1", "Hub", "Egypt", "Giza"), ("s2", "Mall", "Egypt", "Giza"), ("s4", "New", None, None)]
STORE_DDL = "store_key bigint, store_id string, store_name string, store_country string, store_city string, created_at timestamp, updated_at timestamp"


def merged(spark, tmp_path, small=True, incoming=INCOMING, **settings):
    current = spark.createDataFrame(STORED, STORE_DDL)
    batch = spark.createDataFrame(incoming, "store_id string, store_name string, store_country string, store_city string")
    always = settings.pop("always_update", False)
    classified = merge.classify(batch, current, merge.STORE, always, small=small, **settings)
    touched = merge.resolved_rows(classified, merge.STORE, NOW, settings.get("keep_known", False))
    slotted = keys.write_slotted(keys.order_for_keys(touched, "store_id", "is_new"), str(tmp_path / "c"), only="is_new")
    snapshot = merge.apply_changes(current, slotted.numbered("store_key", 3), merge.STORE)
    return {r["store_id"]: r for r in snapshot.collect()}


@pytest.mark.parametrize("small", [True, False])
def test_merge_changes_only_what_differs(spark, tmp_path, small):
    rows = merged(spark, tmp_path, small)
    assert {k: r["store_key"] for k, r in rows.items()} == {"s1": 1, "s2": 2, "s3": 3, "s4": 4}
    assert rows["s2"]["store_city"] == "Giza"
    assert {k for k, r in rows.items() if r["updated_at"] == NOW} == {"s2", "s4"}
    assert {k for k, r in rows.items() if r["created_at"] == NOW} == {"s4"}


def test_merge_always(spark, tmp_path):
    rows = merged(spark, tmp_path, always_update=True)
    assert {k for k, r in rows.items() if r["updated_at"] == NOW} == {"s1", "s2", "s4"}
    assert {k for k, r in rows.items() if r["created_at"] == NOW} == {"s4"}


def test_merge_keep_known(spark):
    stored = spark.createDataFrame([(1, "p1", "Pen", "Toys", "B", None, OLD, OLD)], (
        "product_key bigint, product_id string, product_name string, product_category string, brand string,"
        " supplier string, created_at timestamp, updated_at timestamp"
    ))
    batch = spark.createDataFrame(
        [("p1", "Unknown Product", "Books", "B", "Unknown Supplier")],
        "product_id string, product_name string, product_category string, brand string, supplier string",
    )
    for keep, name in ((True, "Pen"), (False, "Unknown Product")):
        classified = merge.classify(batch, stored, merge.PRODUCT, keep_known=keep)
        row = merge.resolved_rows(classified, merge.PRODUCT, NOW, keep).first()
        assert (row["product_name"], row["product_category"]) == (name, "Books")


# --- key lookup


def test_resolve_keys_marks_missing_members(spark):
    events = spark.createDataFrame(
        [("e1", "c1", "p1", "s1", "email", 20250101), ("e2", "c9", "p1", "s1", "email", 20250102)],
        "event_id string, customer_id string, product_id string, store_id string, marketing_channel string, date_key int",
    )
    tables = {
        "dim_customer": spark.createDataFrame([("c1", 1)], "customer_id string, customer_key bigint"),
        "dim_product": spark.createDataFrame([("p1", 2)], "product_id string, product_key bigint"),
        "dim_store": spark.createDataFrame([("s1", 3)], "store_id string, store_key bigint"),
        "dim_channel": spark.createDataFrame([("email", 4)], "marketing_channel string, channel_key int"),
        "dim_date": spark.createDataFrame([(20250101,)], "date_key int"),
    }
    rows = {r["event_id"]: r for r in resolve_keys(events, tables).collect()}
    assert [rows["e1"][k] for k in ("customer_key", "product_key", "store_key", "channel_key", "date_key")] == [1, 2, 3, 4, 20250101]
    assert rows["e2"]["customer_key"] is None and rows["e2"]["date_key"] is None


# --- constraints


def test_row_constraints(spark):
    frame = spark.createDataFrame(
        [(1, "c1", "A", 30), (2, None, "B", 12), (3, "c3", "x" * 151, 101)],
        "customer_key bigint, customer_id string, customer_name string, customer_age int",
    )
    columns = frame.columns
    found = {r["rule"]: r["violations"] for r in constraints.check_constraints(frame, constraints.row_rules("dim_customer", columns=columns)).collect()}
    assert found["customer_id not null"] == 1 and found["customer_age between 13 and 100"] == 2
    assert not any("long" in rule for rule in found)
    rules = constraints.row_rules("dim_customer", lengths=True, columns=columns)
    broken = {r["customer_key"]: r["broken"] for r in constraints.violating_rows(frame, rules).collect()}
    assert broken == {
        2: ["customer_id not null", "customer_age between 13 and 100"],
        3: ["customer_age between 13 and 100", "customer_name at most 150 long"],
    }


def test_fact_constraints(spark):
    good = "1 AS quantity, 1.0 AS price, 0.0 AS discount, 1.0 AS final_price, 'review' AS event_type, 5 AS rating, 23 AS event_hour"
    bad = "0 AS quantity, 0.0 AS price, 1.0 AS discount, -1.0 AS final_price, 'other' AS event_type, 6 AS rating, 24 AS event_hour"
    frame = spark.range(1).selectExpr(*good.split(", ")).unionByName(spark.range(1).selectExpr(*bad.split(", ")))
    found = {r["rule"]: r["violations"] for r in constraints.check_constraints(frame, constraints.row_rules("fact_sales", columns=frame.columns)).collect()}
    broken = {rule for rule, n in found.items() if n == 1}
    assert broken == {
        "event_type allowed", "event_hour between 0 and 23", "rating between 1 and 5", "quantity > 0", "price > 0",
        "discount < 1", "final_price >= 0",
    }


def test_duplicates_and_orphans(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "customer_key bigint")
    assert [tuple(r) for r in constraints.duplicate_keys(fact, "customer_key").collect()] == [(1, 2)]
    dim = spark.createDataFrame([(2,)], "customer_key bigint")
    assert {tuple(r) for r in constraints.orphans(fact, dim, "customer_key").collect()} == {(1, 2), (None, 1)}


# --- rounding


def test_half_up_ratios(spark):
    frame = spark.createDataFrame([(1, 3), (1, 8), (1, 200), (0, 5), (5, 0), (10**15, 3)], "n bigint, d bigint")
    got = [tuple(r) for r in frame.select(ratio(F.col("n"), F.col("d")), percentage(F.col("n"), F.col("d"))).collect()]
    assert got[:5] == [(0.33, 33.33), (0.13, 12.5), (0.01, 0.5), (0.0, 0.0), (None, None)]
    money = spark.sql("SELECT cast('10.05' AS decimal(28,2)) AS n, 2L AS d")
    assert money.select(ratio(F.col("n"), F.col("d"))).first()[0] == 5.03
