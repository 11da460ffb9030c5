"""Table constraints, checked as data.

A row constraint is a name and a predicate that is true for a bad row. All row
constraints of a table are counted in one pass over it. Uniqueness is a grouped
count, referential integrity an anti-join.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.domain import DOMAIN, Domain
from eventmart.functions.rules import Rule

# --- fixed values ------------------------------------------------------------

NOT_NULL = {
    "dim_customer": ("customer_key", "customer_id", "customer_name", "customer_age", "created_at", "updated_at"),
    "dim_product": ("product_key", "product_id", "product_name", "product_category", "created_at", "updated_at"),
    "dim_store": ("store_key", "store_id", "store_name", "store_country", "store_city", "created_at", "updated_at"),
    "dim_date": (
        "date_key", "full_date", "year", "quarter", "month", "month_name", "week_number", "day_of_month", "day_name",
        "is_weekend",
    ),
    "dim_channel": ("channel_key", "marketing_channel"),
    "fact_sales": (
        "sales_key", "event_id", "customer_key", "product_key", "store_key", "date_key", "channel_key", "event_type",
        "quantity", "price", "discount", "final_price", "revenue", "profit_estimate", "event_timestamp", "event_hour",
        "loaded_at",
    ),
    "dead_letter_events": ("dead_letter_key", "reject_reason", "batch_id", "created_at"),
}

UNIQUE = {
    "dim_customer": ("customer_key", "customer_id"),
    "dim_product": ("product_key", "product_id"),
    "dim_store": ("store_key", "store_id"),
    "dim_date": ("date_key", "full_date"),
    "dim_channel": ("channel_key", "marketing_channel"),
    "fact_sales": ("sales_key", "event_id"),
    "dead_letter_events": ("dead_letter_key",),
}

FOREIGN_KEYS = (
    ("customer_key", "dim_customer"),
    ("product_key", "dim_product"),
    ("store_key", "dim_store"),
    ("date_key", "dim_date"),
    ("channel_key", "dim_channel"),
)

BETWEEN = {
    "dim_customer": {"customer_age": (13, 100)},
    "dim_date": {"quarter": (1, 4), "month": (1, 12), "week_number": (1, 53), "day_of_month": (1, 31)},
    "fact_sales": {"event_hour": (0, 23), "rating": (1, 5)},
}

BOUNDS = {  # SQL a good row meets
    "fact_sales": ("quantity > 0", "price > 0", "discount >= 0", "discount < 1", "final_price >= 0"),
}

MAX_LENGTH = {
    "dim_customer": {
        "customer_id": 30, "customer_name": 150, "customer_gender": 30, "customer_country": 80, "customer_city": 80,
    },
    "dim_product": {"product_id": 30, "product_name": 200, "product_category": 80, "brand": 100, "supplier": 150},
    "dim_store": {"store_id": 30, "store_name": 150, "store_country": 80, "store_city": 80},
    "dim_date": {"month_name": 20, "day_name": 20},
    "dim_channel": {"marketing_channel": 60},
    "fact_sales": {"event_id": 80, "event_type": 30, "review_text": 1000, "session_id": 80, "payment_method": 40},
    "dead_letter_events": {"event_id": 80, "reject_reason": 1000},
}

# --- row constraints ---------------------------------------------------------


def allowed_values(domain: Domain) -> dict[str, dict[str, tuple[str, ...]]]:
    """Columns that hold one of a list of texts."""
    return {
        "dim_product": {"product_category": domain.categories},
        "dim_channel": {"marketing_channel": domain.channels},
        "fact_sales": {"event_type": domain.event_types},
    }


def ranges(domain: Domain) -> dict[str, dict[str, tuple[int, int]]]:
    """Columns between two values; those of dates follow from the years."""
    first, last = min(domain.years), max(domain.years)
    dates = {"date_key": (first * 10_000 + 101, last * 10_000 + 1231), "year": (first, last)}
    return {**BETWEEN, "dim_date": {**dates, **BETWEEN["dim_date"]}}


def row_rules(
    table: str, lengths: bool = False, columns: Sequence[str] | None = None, domain: Domain = DOMAIN
) -> list[Rule]:
    """Row constraints of a table; a null only breaks the not-null ones.

    Text lengths are checked on request. With ``columns``, only the constraints
    of these columns are returned.
    """
    rules = [(c, f"{c} not null", F.col(c).isNull()) for c in NOT_NULL[table]]
    rules += [(c, f"{c} allowed", ~F.col(c).isin(*values)) for c, values in allowed_values(domain).get(table, {}).items()]
    rules += [
        (c, f"{c} between {low} and {high}", ~F.col(c).between(low, high))
        for c, (low, high) in ranges(domain).get(table, {}).items()
    ]
    rules += [(sql.split()[0], sql, ~F.expr(sql)) for sql in BOUNDS.get(table, ())]
    if lengths:
        rules += [(c, f"{c} at most {n} long", F.length(c) > n) for c, n in MAX_LENGTH[table].items()]
    return [(name, bad) for c, name, bad in rules if columns is None or c in columns]


def check_constraints(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rule, violations``: rows of ``frame`` that break each rule, counted in one pass."""
    counted = frame.agg(*[F.count_if(bad).alias(f"r{i}") for i, (_, bad) in enumerate(rules)])
    pairs = [
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations")) for i, (name, _) in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*pairs)))


def violating_rows(frame: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break a rule, with the names of the rules in ``broken``."""
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules]))
    return frame.withColumn("broken", broken).filter(F.size("broken") > 0)


# --- constraints over rows and tables ----------------------------------------


def duplicate_keys(frame: DataFrame, key: str) -> DataFrame:
    """Non-null values of ``key`` that occur more than once, with their count."""
    present = frame.filter(F.col(key).isNotNull())
    return present.groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Key values of ``fact`` without a row in ``dimension``, with the facts that carry them.

    Facts are counted per key first, so the join sees every key once.
    """
    per_key = fact.groupBy(key).agg(F.count("*").alias("facts"))
    return per_key.join(dimension.select(key), key, "left_anti")


def check_tables(tables: dict[str, DataFrame], lengths: bool = False, domain: Domain = DOMAIN) -> DataFrame:
    """``table_name, rule, violations`` for every constraint of every table given."""
    parts = []
    for name, frame in tables.items():
        parts.append((name, check_constraints(frame, row_rules(name, lengths, domain=domain))))
        for key in UNIQUE[name]:
            copies = duplicate_keys(frame, key).agg(F.count("*").alias("violations"))
            parts.append((name, copies.select(F.lit(f"{key} unique").alias("rule"), "violations")))
    for key, dimension in FOREIGN_KEYS if "fact_sales" in tables else ():
        lost = orphans(tables["fact_sales"], tables[dimension], key)
        lost = lost.agg(F.coalesce(F.sum("facts"), F.lit(0)).alias("violations"))
        parts.append(("fact_sales", lost.select(F.lit(f"{key} in {dimension}").alias("rule"), "violations")))
    named = [part.select(F.lit(name).alias("table_name"), "rule", "violations") for name, part in parts]
    return reduce(DataFrame.unionByName, named)
