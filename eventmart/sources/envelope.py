"""Message envelope: key, JSON value, timestamp."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.domain import RAW_EVENT_DDL, RAW_EVENT_FIELDS


def read_envelope(messages: DataFrame) -> DataFrame:
    """Name and cast the three message columns; works on a stream and on a table."""
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_json"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def parse_events(messages: DataFrame) -> DataFrame:
    """Parse the JSON of every message against the declared schema.

    Permissive: a text that is no JSON gives nulls, unknown fields are left out.
    """
    # A generator, so that no later filter can be pushed below the parser: pushed
    # down, a filter on many fields would parse the same text once per field.
    parsed = F.inline(F.array(F.from_json("raw_json", RAW_EVENT_DDL)))
    return read_envelope(messages).select("kafka_key", "raw_json", "kafka_timestamp", parsed).withColumn(
        "ingestion_timestamp", F.current_timestamp()
    )


def message_key() -> Column:
    """The first of customer, session and event id that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("customer_id", "session_id", "event_id")])


def to_messages(events: DataFrame, fields: Sequence[str] = RAW_EVENT_FIELDS, timestamp: str | None = None) -> DataFrame:
    """Serialise raw events to ``key, value[, timestamp]``.

    Nulls are written out; an event without any value is an empty message.
    """
    text = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    some = F.coalesce(*[F.col(c).cast("string") for c in fields]).isNotNull()
    columns = [message_key().alias("key"), F.when(some, text).otherwise("").alias("value")]
    if timestamp:
        columns.append(F.col(timestamp).alias("timestamp"))
    return events.select(*columns)
