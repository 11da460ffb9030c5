"""Checks of a stored mart that begin where the last clean one ended."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks.marts import publish_unchecked
from eventmart.domain import Domain
from eventmart.plans.audit import check_mart
from eventmart.plans.load import LoadOptions, load_batch
from tests.conftest import payload

ONCE = LoadOptions(attempts=1, run_rows=10)


def broken(mart, **options):
    return {(r.table_name, r.rule): r.violations for r in check_mart(mart, **options).collect() if r.violations}


def sent(ids):
    return [payload(event_id=f"E{i}", customer_id=f"C{i % 7}", product_id=f"P{i % 5}") for i in ids]


@pytest.fixture
def clean(events, mart):
    """Two loads, one in a run of the index and one not, found clean, and a load after that."""
    load_batch(mart, events(*sent(range(20))), 0, options=ONCE)
    load_batch(mart, events(*sent(range(20, 24))), 1, options=ONCE)
    assert broken(mart) == {}
    load_batch(mart, events(*sent(range(22, 28)), payload(event_id="X", customer_id="C99"), ""), 2, options=ONCE)
    return mart


def test_only_what_was_written_since_is_read(spark, clean):
    path = clean.path("fact_sales", 1)
    stored = spark.read.parquet(path)
    spark.createDataFrame(stored.collect(), stored.schema).withColumn("quantity", F.lit(-1)).write.mode("overwrite").partitionBy("event_type").parquet(path)
    found = check_mart(clean)
    assert found.filter("violations > 0").count() == 0 and found.filter("table_name = 'fact_sales'").count() > 20
    assert found.filter("table_name = 'dim_channel'").count() == 0  # nothing was written to it
    assert check_mart(clean).count() == 0  # marked, and nothing is new
    assert broken(clean, whole=True) == {("fact_sales", "quantity > 0"): 20}
    # Other constraints were not checked before, so all rows are read.
    assert broken(clean, domain=Domain(years=(2024,)))[("fact_sales", "quantity > 0")] == 20


def test_new_facts_that_clash_with_old_ones(clean):
    facts, base = clean.table("fact_sales"), clean.commit_record().max_keys["fact_sales"]
    again = facts.filter("event_id IN ('E1', 'E2', 'E21', 'E25')").withColumn("sales_key", F.col("sales_key") + base)
    same_key = facts.filter("event_id = 'E5'").withColumns({"event_id": F.lit("new"), "customer_key": F.lit(-1).cast("long")})
    publish_unchecked(clean, again.unionByName(same_key))
    expected = {
        ("fact_sales", "event_id unique"): 4, ("fact_sales", "sales_key unique"): 1, ("fact_sales", "customer_key in dim_customer"): 1,
    }
    assert broken(clean) == broken(clean, whole=True) == expected
    assert broken(clean) == expected  # a commit that breaks something is not marked


def test_old_facts_whose_member_is_gone(spark, clean):
    assert broken(clean) == {}
    at = clean.commit_record()
    load, buckets = clean.claim(at), list(at.buckets["dim_customer"])
    member = clean.table("dim_customer").filter("customer_id = 'C3'").first()
    bucket = next(b for b, n in enumerate(buckets) if n and clean.members("dim_customer", at, [b]).filter("customer_id = 'C3'").count())
    left = clean.members("dim_customer", at, [bucket]).filter("customer_id <> 'C3'")
    other = clean.table("dim_customer").filter("customer_id = 'C4'").withColumn("customer_name", F.lit(None).cast("string"))
    left.unionByName(other).write.parquet(f"{clean.path('dim_customer', load)}/bucket={bucket}")
    buckets[bucket] = load
    clean.publish(
        replace(at, number=at.number + 1, load=load, snapshots={**at.snapshots, "dim_customer": load}, buckets={**at.buckets, "dim_customer": buckets})
    )
    lost = clean.table("fact_sales").filter(F.col("customer_key") == member.customer_key).count()
    found = broken(clean)
    assert lost > 0 and found == broken(clean, whole=True)
    assert found[("fact_sales", "customer_key in dim_customer")] == lost
    assert found[("dim_customer", "customer_key unique")] == found[("dim_customer", "customer_id unique")] == 1
    assert found[("dim_customer", "customer_name not null")] == 1


def test_a_root_without_tables(mart):
    with pytest.raises(LookupError):
        check_mart(mart)
