"""The stream gives what one batch gives, also after a restart."""

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventmart.mart import Mart
from eventmart.plans.load import LoadOptions, load_batch
from eventmart.sources import kafka
from eventmart.streaming import ingest
from tests.conftest import payload

ONCE = LoadOptions(attempts=1)


@pytest.fixture
def inbox(spark, tmp_path, messages):
    folder = tmp_path / "inbox"

    def put(name, *payloads, start=0):
        messages(*payloads, start=start).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.02)

    put.stream = lambda: (
        spark.readStream.schema("key string, value string, timestamp timestamp").option("maxFilesPerTrigger", 1).parquet(str(folder))
    )
    return put


def facts(mart):
    columns = ("event_id", "customer_key", "quantity", "revenue", "event_timestamp")
    return sorted(tuple(r) for r in mart.table("fact_sales").select(*columns).collect())


def test_stream_equals_batch_and_restarts(spark, tmp_path, inbox, events):
    first = [payload(event_id=f"E{i}", customer_id=f"C{i % 3}") for i in range(6)]
    second = [payload(event_id=f"E{i}", customer_id=f"C{i % 3}") for i in range(4, 9)] + ["junk"]
    checkpoint, mart = str(tmp_path / "checkpoint"), Mart(spark, str(tmp_path / "streamed"))
    results = []
    note = lambda batch_id, result: results.append((batch_id, result))

    inbox("a", *first)
    assert ingest.run(inbox.stream(), mart, checkpoint, trigger=None, options=ONCE, on_result=note)
    inbox("b", *second, start=100)
    assert ingest.run(inbox.stream(), mart, checkpoint, trigger=None, options=ONCE, on_result=note)
    assert [b for b, _ in results] == [0, 1]
    assert [(r.inserted, r.skipped, r.rejected) for _, r in results] == [(6, 0, 0), (3, 2, 1)]

    whole = Mart(spark, str(tmp_path / "batch"))
    load_batch(whole, events(*first, *second), 0, options=ONCE)
    assert facts(mart) == facts(whole)

    # A stream that lost its offsets after a commit offers the batch again under the same number.
    last = Path(checkpoint) / "commits" / "1"
    last.unlink()
    (last.parent / ".1.crc").unlink(missing_ok=True)
    before = mart.commit_record()
    assert ingest.run(inbox.stream(), mart, checkpoint, trigger=None, options=ONCE, on_result=note)
    assert results[-1][1].replayed
    assert mart.commit_record() == before

    # A new checkpoint starts over: facts are recognised by their id.
    assert ingest.run(inbox.stream(), mart, str(tmp_path / "other"), trigger=None, options=ONCE)
    assert facts(mart) == facts(whole)


def test_interval_trigger_runs_until_stopped(spark, tmp_path, inbox):
    mart = Mart(spark, str(tmp_path / "mart"))
    inbox("a", payload())
    query = ingest.start(inbox.stream(), mart, str(tmp_path / "checkpoint"), trigger="1 second", options=ONCE)
    try:
        query.processAllAvailable()
        assert query.isActive
        inbox("b", payload(event_id="E2"), start=9)
        query.processAllAvailable()
        assert mart.table("fact_sales").count() == 2
    finally:
        query.stop()
    assert ingest.TRIGGER == "10 seconds"
    assert ingest.run(inbox.stream(), mart, str(tmp_path / "checkpoint"), timeout=1, trigger="1 second") is False


def test_failed_batch_stops_the_stream(spark, tmp_path, inbox):
    mart = Mart(spark, str(tmp_path / "mart"))
    inbox("a", payload(marketing_channel=None))
    with pytest.raises(Exception, match="marketing_channel"):
        ingest.run(inbox.stream(), mart, str(tmp_path / "checkpoint"), trigger=None, options=ONCE)
    assert mart.table("fact_sales").count() == 0


def test_kafka_options(spark):
    assert kafka.source_options("h:9092") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "retail_events", "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    assert kafka.source_options("h", "t", "earliest", True, 64)["minPartitions"] == "64"
    more = kafka.source_options("h", max_offsets_per_trigger=500, more={"kafka.security.protocol": "SSL"})
    assert (more["maxOffsetsPerTrigger"], more["kafka.security.protocol"]) == ("500", "SSL")
    assert kafka.sink_options("h", more={"kafka.acks": "1"})["kafka.acks"] == "1"
    sink = kafka.sink_options("h:9092", "t")
    assert sink["topic"] == "t" and sink["kafka.acks"] == "all"
    assert json.dumps(sink)


@pytest.mark.parametrize("sorted_by_time", [False, True])
def test_input_of_a_stream_lies_once_in_even_pieces(spark, tmp_path, monkeypatch, sorted_by_time):
    """Each piece fills as many files as a trigger takes, shuffled only where its messages lie too close together for that."""
    from checks import marts

    step, shuffles = marts.line_items.ARRIVAL_SECONDS // marts.STREAM_SLICES, []
    second = F.lit(marts.line_items.FIRST_ARRIVAL) + F.col("id") % 4 * step + F.col("id") % step
    sent = spark.range(0, 8_000, 1, 8).select(F.lit("k").alias("key"), F.col("id").cast("string").alias("value"), F.timestamp_seconds(second).alias("timestamp"))
    sent = sent.repartitionByRange(4, "timestamp") if sorted_by_time else sent
    dealt = type(sent).repartition
    monkeypatch.setattr(type(sent), "repartition", lambda frame, n: (shuffles.append(n), dealt(frame, n))[1])
    monkeypatch.setattr(marts.line_items, "messages", lambda *args, **settings: sent)
    monkeypatch.setattr(marts, "scratch", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(marts, "FILE_ROWS", 500)
    stream = marts._inbox(spark, "")
    assert stream.isStreaming and not (tmp_path / "sent").exists()
    written = sorted((tmp_path / "inbox").glob("part-*"), key=lambda f: f.stat().st_mtime_ns)
    assert len(written) == 16
    pieces = [spark.read.parquet(*map(str, written[n : n + 4])) for n in range(0, 16, 4)]
    assert [frame.count() for frame in pieces] == [2_000] * 4
    assert {row.value for frame in pieces for row in frame.collect()} == {str(n) for n in range(8_000)}
    times = [frame.agg(F.min("timestamp"), F.max("timestamp")).first() for frame in pieces]
    assert all(a[1] < b[0] for a, b in zip(times, times[1:]))
    assert shuffles == ([4] * 4 if sorted_by_time else [])
