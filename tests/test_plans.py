"""What the plans must and must not contain."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventmart.functions.cleaning import normalize
from eventmart.functions.rules import valid, validate
from eventmart.mart import Mart
from eventmart.plans import reports
from eventmart.plans.load import LoadOptions, load_batch
from eventmart.sources.envelope import parse_events
from tests.conftest import payload

PACKAGE = Path(__file__).parent.parent / "eventmart"
# Text operators have tests of their own.
SOURCES = [p for p in PACKAGE.rglob("*.py") if "llm" not in p.parts]


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    mart = Mart(spark, str(tmp_path_factory.mktemp("plans") / "mart"))
    texts = [("k", payload()), ("k", payload(event_id="E2", event_type="review", rating=3))]
    frame = spark.createDataFrame(texts, "key string, value string").withColumn("timestamp", F.current_timestamp())
    load_batch(mart, parse_events(frame), 0, options=LoadOptions(attempts=1))
    return mart


def test_rows_never_reach_the_driver():
    """Only counts per validity are collected, and the ids of a batch that has few."""
    used = {}
    for path in SOURCES:
        found = re.findall(r"\.(toPandas|collect|take|toLocalIterator|localCheckpoint|crossJoin|udf)\(", path.read_text())
        if found:
            used[path.name] = found
    assert used == {"load.py": ["collect", "collect"]}


def test_no_window_over_data():
    """Only counts of rows, one for each task, are summed by windows."""
    assert [p.name for p in SOURCES if "Window" in p.read_text()] == ["keys.py"]


def test_filters_stay_above_the_parser(events):
    plan = plan_of(valid(validate(normalize(events(payload())))))
    assert plan.count("from_json") == 1


@pytest.mark.parametrize("name", ["q02", "q03", "q07", "q08", "q13"])
def test_reports_read_only_the_event_types_they_need(loaded, name):
    plan = reports.REPORTS[name](loaded)._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any("event_type" in f and "purchase" in f for f in filters), plan


def test_reports_read_only_the_columns_they_need(loaded):
    plan = plan_of(reports.revenue_by_category(loaded))
    assert "ReadSchema: struct<product_key:bigint,revenue:decimal(33,2)>" in plan
    assert "ReadSchema: struct<product_key:bigint,product_category:string>" in plan


def test_counts_by_type_read_no_columns(loaded):
    for report in (reports.return_rate, reports.conversion_funnel):
        assert "ReadSchema: struct<>" in plan_of(report(loaded))


@pytest.mark.parametrize("report", [reports.newest_facts, reports.newest_dead_letters])
def test_newest_rows_read_only_the_newest_loads(spark, tmp_path, report):
    mart = Mart(spark, str(tmp_path / "mart"))
    for batch in range(4):
        texts = [("k", payload(event_id=f"E{batch}{i}", price=i % 2 * 5)) for i in range(12)]
        frame = spark.createDataFrame(texts, "key string, value string").withColumn("timestamp", F.current_timestamp())
        load_batch(mart, parse_events(frame), batch, options=LoadOptions(attempts=1))
    found = report(mart)
    assert {r.event_id[:2] for r in found.collect()} == {"E2", "E3"}
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan_of(found))
    assert any("load" in f and "IN (4,3)" in f.replace("load#", "load") or "IN (3,4)" in f for f in filters), filters


@pytest.mark.parametrize("report,good", [(reports.newest_facts, True), (reports.newest_dead_letters, False)])
def test_more_newest_rows_than_a_commit_remembers(spark, tmp_path, report, good):
    mart = Mart(spark, str(tmp_path / "mart"))
    for batch in range(3):
        texts = [("k", payload(event_id=f"E{batch}{i:02}", price=5 * good)) for i in range(60)]
        frame = spark.createDataFrame(texts, "key string, value string").withColumn("timestamp", F.current_timestamp())
        load_batch(mart, parse_events(frame), batch, options=LoadOptions(attempts=1))
    whole = [f"E{batch}{i:02}" for batch in (2, 1, 0) for i in range(60)]
    for limit in (100, 130, 150, 500):
        assert [r.event_id for r in report(mart, limit).collect()] == whole[:limit]


def test_key_lookup_reads_the_batch_and_no_dimension(spark, tmp_path, monkeypatch):
    """Known and new members alike come out of the merge with their keys."""
    from eventmart.plans import load as load_module

    plans = []
    resolve = load_module.resolve_keys

    def watched(events, dimensions):
        plans.extend(frame.inputFiles() for frame in dimensions.values())
        return resolve(events, dimensions)

    monkeypatch.setattr(load_module, "resolve_keys", watched)
    mart = Mart(spark, str(tmp_path / "mart"))
    for batch, ids in enumerate((range(50), range(49, 52))):
        texts = [("k", payload(event_id=f"E{batch}-{i}", customer_id=f"C{i}")) for i in ids]
        frame = spark.createDataFrame(texts, "key string, value string").withColumn("timestamp", F.current_timestamp())
        load_batch(mart, parse_events(frame), batch, options=LoadOptions(attempts=1))
    assert len(plans) == 10
    assert all("/staging/" in file for files in plans for file in files)
    assert mart.table("fact_sales").groupBy("customer_key").count().count() == 52


def test_facts_are_aggregated_before_the_join(loaded):
    plan = plan_of(reports.top_customers(loaded))
    join, partial = plan.index("Join"), plan.index("partial_sum(revenue")
    assert join < partial  # plans are printed from the top, the scan comes last
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("name", list(reports.REPORTS))
def test_no_cartesian_products(loaded, name):
    plan = plan_of(reports.REPORTS[name](loaded))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_enriched_events_are_made_unique_without_columns_nobody_asks_for(spark, sf):
    from checks import registry

    plan = registry.enrich_events(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    moved = re.search(r"min_by\(struct\((.*?)\), struct\(", plan).group(1)
    assert {"price", "event_timestamp_ts"} <= set(re.findall(r"[a-z_]+", moved))
    assert "product_name" not in moved and "session_id" not in moved and "_tie" not in moved
