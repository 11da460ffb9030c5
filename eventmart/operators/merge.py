"""Dimension merge: overwrite changed attributes, add new members.

Parquet has no update in place, so a merge finds the members that are new or
changed and writes the buckets they lie in anew. Members of other buckets are neither
rewritten nor moved.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.domain import TEXT_DEFAULTS
from eventmart.operators.dedup import restrict_to


@dataclass(frozen=True)
class Dimension:
    """What the loads need to know of a dimension table."""

    table: str
    id: str
    key: str | None = None  # surrogate key; None where the id is the key
    key_type: str = "bigint"
    attributes: tuple[str, ...] = ()
    renamed: tuple[tuple[str, str], ...] = ()  # (event column, dimension column)
    tracked: bool = False  # has created_at and updated_at, and attributes may change
    buckets: int = 1  # by the hash of the id; at most 62, so that a set of them is a whole number

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.id).cast("string")), F.lit(self.buckets)).cast("int")

    @property
    def columns(self) -> list[str]:
        audit = ["created_at", "updated_at"] if self.tracked else []
        return [*([self.key] if self.key else []), self.id, *self.attributes, *audit]


CUSTOMER = Dimension(
    "dim_customer", "customer_id", "customer_key", tracked=True, buckets=32,
    attributes=("customer_name", "customer_age", "customer_gender", "customer_country", "customer_city"),
)
PRODUCT = Dimension(
    "dim_product", "product_id", "product_key", tracked=True, buckets=32,
    attributes=("product_name", "product_category", "brand", "supplier"),
)
STORE = Dimension(
    "dim_store", "store_id", "store_key", tracked=True, buckets=8,
    attributes=("store_name", "store_country", "store_city"),
)
CHANNEL = Dimension("dim_channel", "marketing_channel", "channel_key", "int")
DATE = Dimension(
    "dim_date", "date_key",
    attributes=(
        "full_date", "year", "quarter", "month", "month_name",
        "week_number", "day_of_month", "day_name", "is_weekend",
    ),
    renamed=(("event_year", "year"), ("event_month", "month")),
)
DIMENSIONS = (CUSTOMER, PRODUCT, STORE, CHANNEL, DATE)


def attribute_changed(attribute: str, keep_known: bool) -> Column:
    """True where the incoming value (``new_``) differs from the stored one."""
    differs = ~F.col(f"new_{attribute}").eqNullSafe(F.col(attribute))
    if keep_known and attribute in TEXT_DEFAULTS:
        differs &= F.col(f"new_{attribute}") != TEXT_DEFAULTS[attribute]
    return differs


def classify(
    incoming: DataFrame, current: DataFrame, dim: Dimension, always_update: bool = False,
    keep_known: bool = False, small: bool = False,
) -> DataFrame:
    """Join one incoming row per id to the stored rows and mark what to do.

    Adds ``is_new`` and ``is_changed``. Comparison is null-safe. With
    ``always_update`` every match counts as changed; with ``keep_known`` a
    default text does not overwrite a known value.
    """
    stored = restrict_to(current, incoming, dim.id, small).withColumn("_stored", F.lit(True))
    fresh = incoming.withColumnsRenamed({a: f"new_{a}" for a in dim.attributes})
    joined = fresh.join(stored, dim.id, "left")
    matched = F.col("_stored").isNotNull()
    if not dim.tracked:
        changed = F.lit(False)
    elif always_update:
        changed = matched
    else:
        changed = matched & reduce(Column.__or__, [attribute_changed(a, keep_known) for a in dim.attributes])
    return joined.withColumns({"is_new": ~matched, "is_changed": changed}).drop("_stored")


def resolved_rows(classified: DataFrame, dim: Dimension, now: datetime, keep_known: bool = False) -> DataFrame:
    """The incoming members as they will be stored, with ``is_new`` and ``is_changed``; new ones have no key yet."""
    touched = F.col("is_new") | F.col("is_changed")
    values = {}
    for a in dim.attributes:
        value = F.col(f"new_{a}")
        if keep_known and dim.tracked and a in TEXT_DEFAULTS:
            value = F.when(F.col("is_new") | (value != TEXT_DEFAULTS[a]), value).otherwise(F.col(a))
        values[a] = value
    if dim.tracked:
        values["created_at"] = F.coalesce("created_at", F.lit(now))
        values["updated_at"] = F.when(touched, F.lit(now)).otherwise(F.col("updated_at"))
    return classified.withColumns(values).select(*dim.columns, "is_new", "is_changed")


def apply_changes(current: DataFrame, changes: DataFrame, dim: Dimension) -> DataFrame:
    """The next state of the buckets that ``current`` holds: untouched rows as they are, and the changes."""
    untouched = current.join(changes.filter(~F.col("is_new")).select(dim.id), dim.id, "left_anti")
    return untouched.select(*dim.columns).unionByName(changes.select(*dim.columns))
