"""Declared schemas and fixed values of the shop-event domain."""

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: must equal what event producers and readers agree on ------

VALID_YEARS = (2023, 2024, 2025, 2026)

EVENT_TYPES = ("product_view", "add_to_cart", "checkout", "purchase", "return", "review")

CATEGORIES = ("Electronics", "Fashion", "Home", "Beauty", "Sports", "Books", "Toys", "Grocery")

CHANNELS = ("organic", "paid_search", "social", "email", "affiliate", "direct")

# Event types that move revenue.
NET_TYPES = ("purchase", "return")

PROFIT_MARGIN = "0.28"

# Defaults put in place of a missing text.
TEXT_DEFAULTS = {
    "customer_name": "Unknown Customer",
    "product_name": "Unknown Product",
    "brand": "Unknown Brand",
    "supplier": "Unknown Supplier",
    "payment_method": "not_applicable",
}

@dataclass(frozen=True)
class Domain:
    """Values an event may have; rules and table constraints follow from it."""

    years: tuple[int, ...] = VALID_YEARS
    event_types: tuple[str, ...] = EVENT_TYPES
    categories: tuple[str, ...] = CATEGORIES
    channels: tuple[str, ...] = CHANNELS


DOMAIN = Domain()

# --- money -------------------------------------------------------------------
# Money is exact inside. A price keeps eight decimals and has twenty digits before
# them, a discount keeps six decimals; neither is rounded before it is used, and
# their product still fits 38 digits. Results are rounded to cents.

PRICE = T.DecimalType(28, 8)
DISCOUNT = T.DecimalType(8, 6)
FINAL_PRICE = T.DecimalType(22, 2)
AMOUNT = T.DecimalType(33, 2)

# --- schemas -----------------------------------------------------------------

RAW_EVENT_DDL = """
    event_id STRING, event_timestamp STRING,
    customer_id STRING, customer_name STRING, customer_age INT,
    customer_gender STRING, customer_country STRING, customer_city STRING,
    product_id STRING, product_name STRING, product_category STRING,
    brand STRING, supplier STRING,
    store_id STRING, store_name STRING, store_country STRING, store_city STRING,
    price DOUBLE, discount DOUBLE, quantity INT,
    payment_method STRING, event_type STRING, rating INT, review_text STRING,
    device_type STRING, browser STRING, session_id STRING, marketing_channel STRING
"""

RAW_EVENT_FIELDS = tuple(part.split()[0] for part in RAW_EVENT_DDL.split(","))

ENVELOPE_DDL = "key STRING, value STRING, timestamp TIMESTAMP"

TABLE_DDL = {
    "dim_customer": """
        customer_key BIGINT, customer_id STRING, customer_name STRING, customer_age INT,
        customer_gender STRING, customer_country STRING, customer_city STRING,
        created_at TIMESTAMP, updated_at TIMESTAMP
    """,
    "dim_product": """
        product_key BIGINT, product_id STRING, product_name STRING, product_category STRING,
        brand STRING, supplier STRING, created_at TIMESTAMP, updated_at TIMESTAMP
    """,
    "dim_store": """
        store_key BIGINT, store_id STRING, store_name STRING, store_country STRING,
        store_city STRING, created_at TIMESTAMP, updated_at TIMESTAMP
    """,
    "dim_date": """
        date_key INT, full_date DATE, year INT, quarter INT, month INT, month_name STRING,
        week_number INT, day_of_month INT, day_name STRING, is_weekend BOOLEAN
    """,
    "dim_channel": "channel_key INT, marketing_channel STRING",
    "fact_sales": f"""
        sales_key BIGINT, event_id STRING, customer_key BIGINT, product_key BIGINT,
        store_key BIGINT, date_key INT, channel_key INT, event_type STRING, quantity INT,
        price {PRICE.simpleString()}, discount {DISCOUNT.simpleString()},
        final_price {FINAL_PRICE.simpleString()}, revenue {AMOUNT.simpleString()},
        profit_estimate {AMOUNT.simpleString()}, event_timestamp TIMESTAMP, event_hour INT,
        rating INT, review_text STRING, session_id STRING, payment_method STRING,
        loaded_at TIMESTAMP
    """,
    "dead_letter_events": """
        dead_letter_key BIGINT, event_id STRING, raw_payload STRING, reject_reason STRING,
        batch_id BIGINT, created_at TIMESTAMP
    """,
}

TABLES = tuple(TABLE_DDL)
