"""Star schemas loaded from the given tables, for the registered queries."""

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.mart import Files, Mart
from eventmart.plans.audit import check_mart
from eventmart.plans.load import LoadOptions, load_batch
from eventmart.session import configure
from eventmart.sources import line_items
from eventmart.sources.envelope import parse_events, to_messages
from eventmart.streaming import ingest

# Pieces in which the stream's input is written, by time of arrival; the stream loads one at a time.
STREAM_SLICES = 4
# Messages a file of a piece has at least, where a piece has more than one.
FILE_ROWS = 1_000

_loaded: dict[tuple, Mart] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the one the cluster shares, as spark.checkpoint.dir names it.

    Only a local session may do without: all its tasks see the machine's own
    temporary folder.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not shared and not context.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{shared or context._jvm.System.getProperty('java.io.tmpdir')}/{name}-{uuid.uuid4().hex}"


def _once(kind: str, spark: SparkSession, folder: str, load: Callable[[Mart], None]) -> Mart:
    """Load a mart once per session and input folder."""
    configure(spark)
    key = (kind, spark.sparkContext.applicationId, folder)
    if key not in _loaded:
        mart = Mart(spark, scratch(spark, kind))
        load(mart)
        _loaded[key] = mart
    return _loaded[key]


def events(spark: SparkSession, folder: str) -> DataFrame:
    """All line items as parsed messages, some sent twice."""
    return parse_events(line_items.messages(configure(spark), folder, copies=True))


def single(spark: SparkSession, folder: str) -> Mart:
    """Everything in one batch."""
    return _once("single", spark, folder, lambda mart: load_batch(mart, events(spark, folder), 0))


def first_half(spark: SparkSession, folder: str) -> DataFrame:
    raw = line_items.raw_events(configure(spark), folder).filter("h % 2 = 0")
    return parse_events(to_messages(raw, timestamp="arrival"))


def second_half(spark: SparkSession, folder: str) -> DataFrame:
    """The other half, and a tenth of the first half again; some customers, brands and stores have changed."""
    raw = line_items.raw_events(configure(spark), folder).filter("h % 2 = 1 OR h % 20 = 0")
    renamed = F.when(F.col("customer_id").endswith("7"), F.concat("customer_name", F.lit(" II")))
    raw = raw.withColumns(
        {
            "customer_name": F.coalesce(renamed, "customer_name"),
            "customer_gender": F.when(~F.col("customer_id").endswith("3"), F.col("customer_gender")),
            "brand": F.when(F.col("product_id").endswith("5"), "Rebranded").otherwise(F.col("brand")),
            "store_name": F.when(F.col("store_id").endswith("2"), F.concat("store_name", F.lit(" Annex"))).otherwise(
                F.col("store_name")
            ),
        }
    )
    return parse_events(to_messages(raw, timestamp="arrival"))


def halves(spark: SparkSession, folder: str) -> Mart:
    """Two batches that overlap."""

    def load(mart: Mart) -> None:
        # Ids of the first make a run of the index already.
        options = LoadOptions(run_rows=1_000)
        load_batch(mart, first_half(spark, folder), 0, options=options)
        load_batch(mart, second_half(spark, folder), 1, options=options)

    return _once("halves", spark, folder, load)


def halves_always(spark: SparkSession, folder: str) -> Mart:
    """The same two batches, every match counting as a change."""

    def load(mart: Mart) -> None:
        options = LoadOptions(always_update=True)
        load_batch(mart, first_half(spark, folder), 0, options=options)
        load_batch(mart, second_half(spark, folder), 1, options=options)

    return _once("halves_always", spark, folder, load)


def publish_unchecked(mart: Mart, facts: DataFrame) -> None:
    """Append facts as a load of their own, past all rules."""
    at = mart.commit_record()
    load = mart.claim(at)
    facts.write.partitionBy("event_type").parquet(mart.path("fact_sales", load))
    written = mart.spark.read.schema(facts.schema).parquet(mart.path("fact_sales", load))
    rows, largest = written.agg(F.count("*"), F.max("sales_key")).first()
    mart.publish(
        replace(
            at, number=at.number + 1, load=load, snapshots={**at.snapshots, "fact_sales": load},
            max_keys={**at.max_keys, "fact_sales": max(largest or 0, at.max_keys["fact_sales"])},
            dead=[*at.dead, *range(at.load + 1, load)], loose=[*at.loose, [load, rows]],
            recent={**at.recent, "fact_sales": at.with_recent("fact_sales", load, rows)},
        )
    )


def damaged(spark: SparkSession, folder: str) -> Mart:
    """Everything in one batch, found clean; then its returns again, less than none of unknown products."""

    def load(mart: Mart) -> None:
        load_batch(mart, events(spark, folder), 0, options=LoadOptions(run_rows=1_000))
        check_mart(mart)
        base = mart.commit_record().max_keys["fact_sales"]
        changes = {"sales_key": F.col("sales_key") + base, "product_key": -F.col("product_key"), "quantity": -F.col("quantity")}
        publish_unchecked(mart, mart.table("fact_sales").filter("event_type = 'return'").withColumns(changes))

    return _once("damaged", spark, folder, load)


def two_sources(spark: SparkSession, folder: str) -> Mart:
    """Two sources that load at the same time, one of them twice."""

    def load(mart: Mart) -> None:
        jobs = (("a", first_half, 0), ("b", second_half, 0), ("a", first_half, 0))
        with ThreadPoolExecutor(len(jobs)) as pool:
            for done in [pool.submit(load_batch, mart, half(spark, folder), n, name) for name, half, n in jobs]:
                done.result()

    return _once("two_sources", spark, folder, load)


def _inbox(spark: SparkSession, folder: str) -> DataFrame:
    """All messages as a stream of files.

    Files are written in the order messages arrive, and the stream takes them in
    the order they were written; so an original is loaded before its copies. Every piece has
    the same number of files, and a trigger takes that many: the number of loads does
    not depend on how many files the messages fill, and a piece is loaded as a whole.
    Messages are not shuffled for that, unless some file of a piece would get none of them.
    """
    sent, inbox = scratch(spark, "sent"), scratch(spark, "inbox")
    line_items.messages(spark, folder, copies=True).write.option("compression", "zstd").parquet(sent)
    messages = spark.read.parquet(sent)
    second = F.unix_seconds("timestamp") - line_items.FIRST_ARRIVAL
    step = line_items.ARRIVAL_SECONDS // STREAM_SLICES
    part = F.least(F.floor(second / step), F.lit(STREAM_SLICES - 1))
    sizes = messages.agg(*[F.count_if(part == number) for number in range(STREAM_SLICES)]).first()
    files = max(1, min(spark.sparkContext.defaultParallelism, min(sizes) // FILE_ROWS))
    stored, held = Files(spark, inbox), set()
    for number in range(STREAM_SLICES):
        piece = messages.filter(part == number)
        for deal in (piece.coalesce, piece.repartition):
            deal(files).write.mode("append").option("compression", "zstd").parquet(inbox)
            added = {name for name in stored.names(inbox) if name.startswith("part-")} - held
            if len(added) == files or deal == piece.repartition:
                break
            for name in added:
                stored.remove(f"{inbox}/{name}")
        held |= added
    stored.remove(sent)
    return spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", files).parquet(inbox)


def streamed(spark: SparkSession, folder: str) -> Mart:
    """Everything, as a stream of files."""

    def load(mart: Mart) -> None:
        ingest.run(_inbox(spark, folder), mart, scratch(spark, "checkpoint"), trigger=None)

    return _once("streamed", spark, folder, load)


class Lost(RuntimeError):
    """The failure that a restarted stream meets."""


class FailingMart(Mart):
    """Loses its second load once everything is written and before it is published."""

    def publish(self, commit) -> None:
        if commit.number == 2:
            raise Lost("before publishing")
        super().publish(commit)


def restarted(spark: SparkSession, folder: str) -> Mart:
    """The same stream, stopped by a failure in its second load and started again from its checkpoint."""

    def load(mart: Mart) -> None:
        stream, checkpoint = _inbox(spark, folder), scratch(spark, "checkpoint")
        failing = FailingMart(spark, mart.root)
        try:
            ingest.run(stream, failing, checkpoint, trigger=None, options=LoadOptions(attempts=1))
        except StreamingQueryException as error:
            if "before publishing" not in str(error):
                raise
        else:
            raise RuntimeError("the stream was meant to stop")
        ingest.run(stream, mart, checkpoint, trigger=None)

    return _once("restarted", spark, folder, load)
