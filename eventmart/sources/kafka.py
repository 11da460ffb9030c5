"""Kafka, through Spark's own connector.

The connector is a separate package (``spark-sql-kafka-0-10``) the cluster must
provide. Anything with the columns ``key, value, timestamp`` can stand in for it.
"""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

DEFAULT_TOPIC = "retail_events"


def source_options(
    servers: str,
    topic: str = DEFAULT_TOPIC,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
    more: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """``min_partitions`` splits a topic with few partitions over more tasks.

    ``max_offsets_per_trigger`` bounds a batch, so that a backlog is worked off in
    pieces. ``more`` are further options of the connector, such as those of
    security (``kafka.security.protocol``); they override the others.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return {**options, **(more or {})}


def sink_options(servers: str, topic: str = DEFAULT_TOPIC, more: Mapping[str, str] | None = None) -> dict[str, str]:
    """Acknowledged by all replicas, retried, and in order; ``more`` overrides."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "10",
        "kafka.retry.backoff.ms": "500",
        "kafka.linger.ms": "25",
        "kafka.request.timeout.ms": "30000",
        "kafka.max.in.flight.requests.per.connection": "1",
        **(more or {}),
    }


def read_stream(spark: SparkSession, servers: str, topic: str = DEFAULT_TOPIC, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**source_options(servers, topic, **options)).load()


def write_messages(
    messages: DataFrame, servers: str, topic: str = DEFAULT_TOPIC, more: Mapping[str, str] | None = None
) -> None:
    """Publish the output of :func:`eventmart.sources.envelope.to_messages`."""
    messages.select("key", "value").write.format("kafka").options(**sink_options(servers, topic, more)).save()
