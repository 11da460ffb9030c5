"""Benchmark: prints one JSON line.

Messages are written once from the given tables (not timed); timed are the
steps a user waits for: parse and validate, one full star load, a second load in
which every event is already known, a batch of 300 messages, and every report.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.marts import scratch  # noqa: E402
from eventmart.functions.cleaning import normalize  # noqa: E402
from eventmart.functions.enrichment import enrich  # noqa: E402
from eventmart.functions.rules import valid, validate  # noqa: E402
from eventmart.mart import Mart  # noqa: E402
from eventmart.operators.dedup import first_per_key  # noqa: E402
from eventmart.plans.load import load_batch  # noqa: E402
from eventmart.plans.reports import REPORTS  # noqa: E402
from eventmart.session import build_session  # noqa: E402
from eventmart.sources import line_items  # noqa: E402
from eventmart.sources.envelope import parse_events  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus),
        **{"spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch(spark, "bench")
    messages = f"{root}/messages"
    line_items.messages(spark, folder, copies=True).write.parquet(messages)
    events = parse_events(spark.read.parquet(messages))
    count = spark.read.parquet(messages).count()
    mart = Mart(spark, f"{root}/mart")
    timings: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        action()
        timings[name] = round(time.perf_counter() - start, 3)

    def discard(frame):
        frame.write.format("noop").mode("overwrite").save()

    checked = validate(normalize(events))
    timed("validate_events", lambda: discard(checked))
    timed("enrich_events", lambda: discard(enrich(first_per_key(valid(checked).drop("raw_json")))))
    timed("star_load", lambda: load_batch(mart, events, 0))
    timed("second_load_all_known", lambda: load_batch(mart, events, 1))
    short = f"{root}/short"
    spark.read.parquet(messages).limit(300).write.parquet(short)  # as a stream's trigger would bring them
    timed("batch_of_300", lambda: load_batch(mart, parse_events(spark.read.parquet(short)), 2))
    for name, report in REPORTS.items():
        timed(name, lambda: discard(report(mart)))

    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "events": count,
        "rows_per_sec": {
            "validate_events": round(count / timings["validate_events"]),
            "enrich_events": round(count / timings["enrich_events"]),
            "star_load": round(count / timings["star_load"]),
        },
    }))
    spark.stop()


if __name__ == "__main__":
    main()
