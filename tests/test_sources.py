"""The line-item adapter and the message round trip."""

import re

import pytest

from eventmart.domain import RAW_EVENT_FIELDS
from eventmart.functions.cleaning import normalize
from eventmart.functions.rules import event_rules, validate
from eventmart.sources import line_items
from eventmart.sources.envelope import parse_events, to_messages


def test_message_keys(spark):
    rows = [("c", "s", "e"), ("", "s", "e"), (None, None, "e"), (None, "", "")]
    frame = spark.createDataFrame(rows, "customer_id string, session_id string, event_id string")
    sent = to_messages(frame, ("event_id", "customer_id"))
    assert [r["key"] for r in sent.collect()] == ["c", "s", "e", None]
    assert [r["value"] for r in sent.collect()][2] == '{"event_id":"e","customer_id":null}'


def test_an_event_without_values_is_an_empty_message(spark):
    fields = ("event_id", "customer_id", "session_id")
    frame = spark.createDataFrame([(None, None, None)], ", ".join(f"{name} string" for name in fields))
    assert [tuple(r) for r in to_messages(frame, fields).collect()] == [(None, "")]


def test_every_rule_and_repair_has_something_to_do(spark, sf):
    raw = line_items.raw_events(spark, sf)
    reasons = {r[0] for r in validate(normalize(raw)).select("reject_reason").distinct().collect()} - {""}
    single = {text for reason in reasons for text in reason.split("; ")}
    assert single == {text for text, _ in event_rules()}
    assert any("; " in reason for reason in reasons)
    for damage in ("event_type <> trim(event_type)", "product_category <> trim(product_category)", "price < 0", "discount IS NULL",
                   "brand IS NULL", "supplier IS NULL", "customer_name IS NULL", "product_name IS NULL", "rating = 9"):
        assert raw.filter(damage).count() > 0, damage


def test_round_trip_changes_nothing(spark, sf):
    raw = line_items.raw_events(spark, sf).select(*RAW_EVENT_FIELDS)
    parsed = parse_events(line_items.messages(spark, sf)).select(*RAW_EVENT_FIELDS)
    assert raw.exceptAll(parsed).count() == 0 and parsed.exceptAll(raw).count() == 0


def test_one_event_per_line_item_and_copies(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert line_items.raw_events(spark, sf).count() == lines
    copies = line_items.raw_events(spark, sf, copies=True)
    assert copies.filter("copy = 1").count() == copies.filter("copy = 0 AND h % 50 IN (0, 25)").count() > 0


def shop(spark, folder, customers):
    """Tables of a few orders of three lines each."""
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "EUROPE")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(1, "FRANCE", 0)]),
        "customer": ("c_custkey bigint, c_name string, c_nationkey int", [(n, f"C{n}", 1) for n in range(customers)]),
        "part": ("p_partkey bigint, p_name string, p_brand string, p_retailprice double", [(n, f"P{n}", "B", 9.5) for n in range(20)]),
        "supplier": ("s_suppkey bigint, s_name string, s_nationkey int", [(n, f"S{n}", 1) for n in range(10)]),
        "orders": ("o_orderkey bigint, o_custkey bigint", [(n, n % customers) for n in range(100)]),
        "lineitem": (
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, l_returnflag string",
            [(n, (3 * n + line) % 20, n % 10, line, 5.0, 0.1, "RN"[n % 2]) for n in range(100) for line in (1, 2, 3)],
        ),
    }
    for name, (ddl, rows) in tables.items():
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("copies", [True, False])
def test_the_step_that_makes_messages_is_compiled(spark, tmp_path, copies):
    """Beyond the limit Spark runs joins and columns one by one, each copying whole rows."""
    sent = line_items.messages(spark, shop(spark, str(tmp_path), 7), copies)
    limit = int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code = sent._sc._jvm.PythonSQLUtils.explainString(sent._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert 1_000 < max(sizes) <= limit


def test_copies_differ_from_their_rows_in_three_columns(spark, tmp_path):
    sent = line_items.raw_events(spark, shop(spark, str(tmp_path), 7), copies=True)
    assert sent.columns == ["h", "copy", *RAW_EVENT_FIELDS, "arrival"]
    key = ("h", "event_id")
    rows, again = ({tuple(r[k] for k in key): r for r in sent.filter(f"copy = {n}").collect()} for n in (0, 1))
    assert again and {r["h"] % 50 for r in again.values()} <= {0, 25}
    for at, copy in again.items():
        differ = {c for c in RAW_EVENT_FIELDS if copy[c] != rows[at][c]}
        assert differ <= ({"product_name", "quantity"} if copy["h"] % 50 else set())
        assert (copy["arrival"] - rows[at]["arrival"]).total_seconds() == 3600
