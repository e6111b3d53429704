"""Prints one JSON line with the time of the headline queries.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Every query runs once to warm up and then twice; the better time counts. Results go to
Spark's ``noop`` sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

from riskloom.operators.rules import Rule
from riskloom.operators.signals import risk_signals
from riskloom.operators.timeline import Evaluation
from riskloom.plans.queries import QUERIES
from riskloom.session import local_session, settings
from riskloom.sources import generated, records
from riskloom.streaming import pipeline
from riskloom.streaming.sinks import HistoryTable, HotStateTable, QuarantineTable

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "rule_signals",
    "multi_rule_signals",
    "capacity_signals",
    "cross_topic_signal",
    "decode_outcomes",
    "quarantine_records",
    "dedup_first_arrival",
    "dedup_ttl",
    "history_final",
    "actor_history_topk",
    "hot_state_latest",
    "store_reconciliation",
    "pipeline_metrics",
    "latency_percentiles",
    "summary_stats",
)
# The published single-node figure is for 50 000 events of 500 actors and one rule.
LOAD_EVENTS, LOAD_ACTORS = 50_000, 500
# Published stream figures are for 10 000 and 60 000 records into both stores.
STREAMED = {"stream_start_up": 10, "stream_10000_records": 10_000, "stream_60000_records": 60_000}


def timed(frame_of) -> float:
    best = None
    for attempt in range(3):
        start = time.perf_counter()
        frame_of().write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        if attempt and (best is None or took < best):
            best = took
    return best


def evaluator(spark, events: int, actors: int):
    rule = Rule("benchmark", 3_600_000, 1, 0, 10)
    return lambda: risk_signals(generated.load(spark, events, actors), Evaluation((rule,)))


def streamed(spark, folder: str, events: int) -> float:
    """Seconds for a stream over a backlog of raw records, with both stores written."""
    root = f"{folder}/{uuid.uuid4()}"
    generated.load_records(spark, events, max(1, events // 10)).write.parquet(f"{root}/records")
    stores = pipeline.Stores(
        HotStateTable(spark, f"{root}/hot"),
        HistoryTable(spark, f"{root}/history"),
        QuarantineTable(spark, f"{root}/quarantine"),
    )
    spec = Evaluation((Rule("benchmark", 3_600_000, 1, 0, 10),))
    start = time.perf_counter()
    raw = records.file_stream(spark, f"{root}/records")
    with settings(spark, {"spark.sql.shuffle.partitions": CPUS}):
        query = pipeline.start_sliced_signals(
            raw, spec, stores, f"{root}/checkpoint", bounded=True
        )
    query.awaitTermination()
    took = time.perf_counter() - start
    stored = stores.history.final().count()
    if stored != events:
        raise RuntimeError(f"{events} records gave {stored} signals")
    return took


def main() -> None:
    spark = local_session("bench", cores=CPUS)
    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(timed(lambda n=name: QUERIES[n](spark, SF_DIR)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    for factor in (1, 20):
        name = f"evaluator_{LOAD_EVENTS * factor}_events"
        run = evaluator(spark, LOAD_EVENTS * factor, LOAD_ACTORS * factor)
        seconds[name] = round(timed(run), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    with tempfile.TemporaryDirectory(prefix="bench-stream-") as folder:
        # The first, small run also starts Python workers; its time is start-up.
        for name, events in STREAMED.items():
            seconds[name] = round(streamed(spark, folder, events), 3)
            print(name, seconds[name], file=sys.stderr, flush=True)
    rate = LOAD_EVENTS / seconds[f"evaluator_{LOAD_EVENTS}_events"]
    big = LOAD_EVENTS * 20 / seconds[f"evaluator_{LOAD_EVENTS * 20}_events"]
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "evaluator_events_per_second": round(rate),
                "evaluator_events_per_second_1m": round(big),
                "stream_records_per_second": {
                    str(n): round(n / seconds[name]) for name, n in STREAMED.items() if n > 10
                },
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
