"""Derived columns of valid events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.domain import AMOUNT, FINAL_PRICE, PROFIT_MARGIN


def final_price() -> Column:
    """Price after discount, rounded half up to cents."""
    return F.round(F.col("price") * (F.lit(1) - F.col("discount")), 2).cast(FINAL_PRICE)


def signed_revenue(price: Column) -> Column:
    """What an event adds to revenue: sales count up, returns down, the rest nothing."""
    gross = price * F.col("quantity")
    return (
        F.when(F.col("event_type") == "purchase", gross)
        .when(F.col("event_type") == "return", -gross)
        .otherwise(F.lit(0))
    )


def profit(signed: Column) -> Column:
    return F.round(signed * F.lit(PROFIT_MARGIN).cast("decimal(2,2)"), 2)


def date_key(moment: str) -> Column:
    """The day of a timestamp as a whole number, year first."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def calendar(moment: str) -> dict[str, Column]:
    """Calendar columns of a timestamp, in the session's zone."""
    ts, day = F.col(moment), F.to_date(moment)
    year, month, day_of_month = F.year(ts), F.month(ts), F.dayofmonth(ts)
    return {
        "event_date": day,
        "event_month": month,
        "event_year": year,
        "event_hour": F.hour(ts),
        "week_number": F.weekofyear(ts),
        "is_weekend": F.dayofweek(ts).isin(1, 7),
        "date_key": date_key(moment),
        "full_date": day,
        "quarter": F.quarter(ts),
        "month_name": F.date_format(ts, "MMMM"),
        "day_of_month": day_of_month,
        "day_name": F.date_format(ts, "EEEE"),
    }


def one_per_day(valid_events: DataFrame) -> DataFrame:
    """The latest time of each day, which is all that a calendar takes from events."""
    latest = valid_events.groupBy(F.to_date("event_timestamp_ts").alias("_day")).agg(F.max("event_timestamp_ts").alias("event_timestamp_ts"))
    days = latest.select("event_timestamp_ts", F.col("event_timestamp_ts").alias("event_timestamp"))
    return days.withColumns(calendar("event_timestamp"))


def enrich(valid_events: DataFrame) -> DataFrame:
    """Add prices, revenue, profit and the calendar to valid, de-duplicated events."""
    priced = valid_events.withColumns(
        {"event_timestamp": F.col("event_timestamp_ts"), "final_price": final_price()}
    )
    signed = signed_revenue(F.col("final_price"))
    return priced.withColumns(
        {
            "revenue": F.round(signed, 2).try_cast(AMOUNT),
            "profit_estimate": profit(signed).try_cast(AMOUNT),
            **calendar("event_timestamp"),
        }
    )
