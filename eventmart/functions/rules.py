"""Validation rules.

A rule is a text and a predicate that is true for a bad row. Predicates that
come out null do not fire. The texts of all rules that fire, in rule order,
become ``reject_reason``; a row without any is valid.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.domain import DOMAIN, Domain

Rule = tuple[str, Column]


def missing(column: str) -> Column:
    return F.col(column).isNull()


def outside(column: str, allowed: Sequence) -> Column:
    """True where the value is null or not one of ``allowed``."""
    return missing(column) | ~F.col(column).isin(*allowed)


def event_rules(domain: Domain = DOMAIN) -> list[Rule]:
    """The rules every event must pass, in the order their texts are joined."""
    age, rating = F.col("customer_age"), F.col("rating")
    return [
        ("missing event_id", missing("event_id")),
        ("bad timestamp", missing("event_timestamp_ts")),
        ("event year outside supported range", ~F.year("event_timestamp_ts").isin(*domain.years)),
        ("missing customer_id", missing("customer_id")),
        ("missing product_id", missing("product_id")),
        ("missing store_id", missing("store_id")),
        ("invalid event_type", outside("event_type", domain.event_types)),
        ("invalid product_category", outside("product_category", domain.categories)),
        ("invalid customer_age", missing("customer_age") | ~age.between(13, 100)),
        ("invalid price", missing("price") | (F.col("price") <= 0)),
        ("invalid quantity", missing("quantity") | (F.col("quantity") <= 0)),
        ("invalid discount", missing("discount") | (F.col("discount") < 0) | (F.col("discount") >= 1)),
        ("invalid review rating", (F.col("event_type") == "review") & ~rating.between(1, 5)),
    ]


def reject_reason(rules: Sequence[Rule]) -> Column:
    """Texts of the rules that fire, joined; empty where none does."""
    return F.concat_ws("; ", *[F.when(bad, F.lit(text)) for text, bad in rules])


def validate(events: DataFrame, rules: Sequence[Rule] | None = None, stored: Sequence[Rule] = ()) -> DataFrame:
    """Add ``reject_reason`` and ``is_valid`` to normalised events.

    ``stored`` are constraints of the stored tables; they give the reason where
    no other rule fires.
    """
    reason = reject_reason(event_rules() if rules is None else rules)
    if stored:
        reason = F.coalesce(F.nullif(reason, F.lit("")), reject_reason(stored))
    return events.withColumn("reject_reason", reason).withColumn("is_valid", F.col("reject_reason") == "")


def valid(events: DataFrame) -> DataFrame:
    return events.filter("is_valid")


def rejected(events: DataFrame) -> DataFrame:
    return events.filter(~F.col("is_valid"))
