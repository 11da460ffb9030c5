"""Reports on small hand-made facts."""

from datetime import date
from decimal import Decimal

import pytest

from eventmart.plans import reports
from eventmart.plans.load import LoadOptions, load_batch
from eventmart.mart import Mart
from eventmart.sources.envelope import parse_events
from tests.conftest import payload

ONCE = LoadOptions(attempts=1)


def sale(n, **changes):
    return payload(**{"event_id": f"E{n}", "discount": 0, "price": 10.0, "quantity": 1, **changes})


EVENTS = [
    sale(1, customer_id="C1", product_id="P1"),
    sale(2, customer_id="C2", product_id="P2", product_category="Toys", store_id="S2", store_country="Peru"),
    sale(3, customer_id="C2", product_id="P2", product_category="Toys", store_id="S2", store_country="Peru",
         event_type="return", price=4.0),
    sale(4, customer_id="C3", product_id="P1", quantity=3, event_timestamp="2024-01-31T10:00:00+00:00",
         payment_method="wallet", marketing_channel="social"),
    sale(5, event_type="product_view"), sale(6, event_type="product_view"), sale(7, event_type="product_view"),
    sale(8, event_type="checkout", payment_method="cash"),
    sale(9, event_type="review", rating=5, product_id="P1"), sale(10, event_type="review", rating=4, product_id="P1"),
    sale(11, event_type="review", rating=4, product_id="P1"), sale(12, event_type="review", rating=None, product_id="P2",
                                                                  product_category="Toys"),
    sale(13, event_type="review", rating=5, product_id="P3"),
    sale(14, quantity=0), sale(15, quantity=0), sale(16, price=0),
]


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    mart = Mart(spark, str(tmp_path_factory.mktemp("reports") / "mart"))
    rows = [("k", text, i) for i, text in enumerate(EVENTS)]
    frame = spark.createDataFrame(rows, "key string, value string, n bigint")
    load_batch(mart, parse_events(frame.selectExpr("key", "value", "timestamp_seconds(n) AS timestamp")), 0, options=ONCE)
    return mart


EXPECTED = {
    "q01": [("dead_letter_events", 3), ("dim_channel", 2), ("dim_customer", 3), ("dim_date", 2), ("dim_product", 3),
            ("dim_store", 2), ("fact_sales", 13)],
    "q02": [(46.0,)],
    "q03": [("Books", 40.0), ("Toys", 6.0)],
    "q04": [("Egypt", 40.0), ("Peru", 6.0)],
    "q05": [(2024, 1, "January", 30.0), (2025, 3, "March", 16.0)],
    "q06": [(2024, 30.0), (2025, 16.0)],
    "q07": [("C3", "Ann", "Egypt", 1, 30.0), ("C1", "Ann", "Egypt", 1, 10.0), ("C2", "Ann", "Egypt", 1, 6.0)],
    "q08": [("P1", "X", "Books", 4, 40.0), ("P2", "X", "Toys", 1, 6.0)],
    "q09": [(1, 3, 33.33)],
    "q10": [(3, 1, 3, 100.0, 300.0)],
    "q11": [("C3", "Ann", 30.0), ("C1", "Ann", 10.0), ("C2", "Ann", 6.0)],
    "q12": [("P3", "X", "Books", 5.0, 1), ("P1", "X", "Books", 4.33, 3)],
    "q13": [("social", 1, 30.0), ("email", 2, 16.0)],
    "q14": [("invalid quantity", 2), ("invalid price", 1)],
    "q15": [("wallet", 1, 30.0, 10.0), ("cash", 2, 20.0, 10.0)],
    "q16": [("invalid quantity", 2), ("invalid price", 1)],
    "q17": [("dim_customer", True, 3, False), ("dim_product", True, 3, False), ("dim_store", True, 2, False),
            ("dim_date", True, 2, False), ("dim_channel", True, 2, False), ("fact_sales", True, 13, False),
            ("dead_letter_events", True, 3, False)],
    "q18": [("S1", "Hub", 40.0), ("S2", "Hub", 6.0)],
    "q19": [(Decimal("46.00"),)],
    "q21": [(13, 3, 3, 3, 2, 2, 2)],
}


@pytest.mark.parametrize("name", EXPECTED)
def test_report(mart, name):
    assert [tuple(r) for r in reports.REPORTS[name](mart).collect()] == EXPECTED[name]


def test_newest(mart):
    assert [r["event_id"] for r in reports.newest_facts(mart, 3).collect()] == ["E1", "E10", "E11"]
    assert [r["event_id"] for r in reports.newest_dead_letters(mart).collect()] == ["E14", "E15", "E16"]
    assert len(reports.newest_facts(mart).columns) == 21


def test_single_counts(mart):
    assert {n: reports.count_of(mart, n).first()[n] for n in reports.COUNT_NAMES} == {
        "fact_rows": 13, "rejected_rows": 3, "customers": 3, "products": 3, "stores": 2, "dates": 2, "channels": 2,
    }


def test_ties_go_by_business_id(mart):
    assert [r["customer_id"] for r in reports.top_customers(mart, 2).collect()] == ["C3", "C1"]


def test_stored_dates(mart):
    row = mart.table("dim_date").orderBy("date_key").first()
    assert row.asDict() == {
        "date_key": 20240131, "full_date": date(2024, 1, 31), "year": 2024, "quarter": 1, "month": 1,
        "month_name": "January", "week_number": 5, "day_of_month": 31, "day_name": "Wednesday", "is_weekend": False,
    }


def test_empty_mart(spark, tmp_path):
    mart = Mart(spark, str(tmp_path / "mart"))
    assert [tuple(r) for r in reports.warehouse_health(mart).collect()][0] == ("dim_customer", False, None, False)
    mart.bootstrap()
    assert reports.total_revenue(mart).first()[0] is None
    assert tuple(reports.return_rate(mart).first()) == (0, 0, None)
    assert tuple(reports.conversion_funnel(mart).first()) == (0, 0, 0, None, None)
    assert reports.revenue_by_category(mart).count() == 0
    assert {r["table_name"] for r in reports.warehouse_health(mart).filter("empty_fact").collect()} == {"fact_sales"}
