"""Normalisation: scalar repair of raw event fields."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.domain import DISCOUNT, PRICE, TEXT_DEFAULTS


def nan_to_null(frame: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating column."""
    floating = [f.name for f in frame.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floating:
        return frame
    return frame.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating})


def text_or_default(column: str, default: str) -> Column:
    """Trimmed text, or ``default`` where it is null. A blank text stays blank."""
    return F.coalesce(F.trim(column), F.lit(default))


def exact(column: str, to: T.DecimalType) -> Column:
    """The exact decimal of a number, null where it does not fit."""
    return F.col(column).try_cast(to)


def unsigned(column: Column) -> Column:
    """Repair the sign of an amount that cannot be negative."""
    return F.when(column < 0, F.abs(column)).otherwise(column)


def as_date(column: str) -> Column:
    """Date of a date, a timestamp or an ISO text; null where there is none."""
    return F.col(column).try_cast("date")


def as_timestamp(column: str) -> Column:
    """Timestamp of a timestamp or an ISO text; null where there is none."""
    return F.col(column).try_cast("timestamp")


def normalize(events: DataFrame) -> DataFrame:
    """Repair what is safe to repair.

    Price and discount become exact decimals. A price that is NaN, infinite or
    of more digits than any money becomes null, and validation rejects it. The discount
    default is filled in first, so a discount that is NaN is rejected as well
    and not mistaken for a missing one.
    """
    defaulted = events.withColumn("discount", F.coalesce("discount", F.lit(0.0)))
    return nan_to_null(defaulted).withColumns(
        {
            "event_timestamp_ts": F.try_to_timestamp("event_timestamp"),
            "event_type": F.lower(F.trim("event_type")),
            "product_category": F.trim("product_category"),
            **{column: text_or_default(column, text) for column, text in TEXT_DEFAULTS.items()},
            "discount": exact("discount", DISCOUNT),
            "price": unsigned(exact("price", PRICE)),
        }
    )
