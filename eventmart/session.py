"""Session settings the engine relies on."""

from pyspark.sql import SparkSession

REQUIRED = {
    # Years, hours and date keys are those of UTC.
    "spark.sql.session.timeZone": "UTC",
    # Sizes partitions, picks broadcast joins and splits skewed ones at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partitioned writes keep this many files open instead of sorting all rows by
    # partition; loads split by validity (2) and by event type (6).
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # The JVM does not compile methods beyond this size; Spark then runs the stage
    # in smaller pieces instead of one long method that is interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Shuffle files go when the action that wrote them has ended, not when the driver happens to collect
    # its garbage: a load is many actions, and no later one reads a shuffle of an earlier one.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Stored timestamps are readable by other engines.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(
    app_name: str = "eventmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Get a session with the required settings.

    ``shuffle_partitions`` sets the shuffle width where adaptive coalescing
    should start from another number than the cluster's default.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**REQUIRED, **extra}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required settings to a session somebody else made."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
