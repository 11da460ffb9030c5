import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventmart.mart import Mart  # noqa: E402
from eventmart.session import build_session  # noqa: E402
from eventmart.sources.envelope import parse_events  # noqa: E402

BASE_EVENT = {
    "event_id": "E1", "event_timestamp": "2025-03-08T23:30:00+00:00",
    "customer_id": "C1", "customer_name": "Ann", "customer_age": 30, "customer_gender": "Female",
    "customer_country": "Egypt", "customer_city": "Cairo",
    "product_id": "P1", "product_name": "X", "product_category": "Books", "brand": "B", "supplier": "S",
    "store_id": "S1", "store_name": "Hub", "store_country": "Egypt", "store_city": "Giza",
    "price": 19.99, "discount": 0.15, "quantity": 3, "payment_method": "cash", "event_type": "purchase",
    "marketing_channel": "email", "session_id": "SES-1",
}


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", 4,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def payload(**changes) -> str:
    """The base event as JSON; a change to ``...`` leaves the field out."""
    event = {**BASE_EVENT, **changes}
    return json.dumps({k: v for k, v in event.items() if v is not ...})


@pytest.fixture
def messages(spark):
    """Payloads to messages; each arrives a second after the one before."""

    def make(*payloads, start=0):
        rows = [("k", text, start + i) for i, text in enumerate(payloads)]
        frame = spark.createDataFrame(rows, "key string, value string, n bigint")
        return frame.selectExpr("key", "value", "timestamp_seconds(1800000000 + n) AS timestamp")

    return make


@pytest.fixture
def events(messages):
    return lambda *payloads, **settings: parse_events(messages(*payloads, **settings))


@pytest.fixture
def mart(spark, tmp_path):
    return Mart(spark, str(tmp_path / "mart"))


@pytest.fixture(scope="session")
def sf():
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test data not found")
    return folder
