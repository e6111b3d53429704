import datetime as dt
import math
import random
import statistics as py
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from riskloom.operators import dedup, metrics, reconcile, statistics
from riskloom.operators.rules import Rule
from riskloom.operators.signals import risk_signals
from riskloom.operators.timeline import Evaluation
from riskloom.streaming.pipeline import pending_records


def test_order_statistics(spark):
    rng = random.Random(3)
    rows = [("a", rng.randrange(-30, 60)) for _ in range(500)] + [("b", 7)] * 300
    rows += [("c", 1), ("c", None), ("d", None)]
    frame = spark.createDataFrame(rows, "g string, v bigint")
    known = {g: sorted(v for h, v in rows if h == g and v is not None) for g in "abc"}
    ranks = statistics.nearest_rank(frame, "g", "v", {"p50": 0.5, "p99": 0.99}).collect()
    assert {r.g for r in ranks} == set(known)
    for r in ranks:
        values = known[r.g]
        assert r.n == len(values)
        assert r.p50 == values[max(0, math.ceil(0.5 * len(values)) - 1)]
        assert r.p99 == values[max(0, math.ceil(0.99 * len(values)) - 1)]
        assert r["max"] == values[-1]
    for r in statistics.summary(frame, "g", "v").collect():
        values = known[r.g]
        assert r.median == py.median(values)
        assert r.mean == pytest.approx(py.mean(values))
        deviation = py.stdev(values) if len(values) > 1 else 0
        assert r.sample_standard_deviation == pytest.approx(deviation)


def test_missing_values_are_none(spark):
    values = [None, None, 10.0, 20.0, 30.0, float("nan")]
    frame = spark.createDataFrame([("a", v) for v in values], "g string, v double")
    row = statistics.summary(frame, "g", "v").first()
    assert (row.n, row.median, row["max"]) == (3, 20.0, 30.0)
    assert statistics.nearest_rank(frame, "g", "v", {"p50": 0.5}).first().n == 3


def test_summary_without_a_usable_mean(spark):
    row = statistics.summary(
        spark.createDataFrame([("a", -1.0), ("a", 1.0)], "g string, v double"), "g", "v"
    ).first()
    assert not row.coefficient_of_variation_applicable
    assert row.coefficient_of_variation_percent is None


def test_drift(spark):
    frame = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([10, 20, 20, 40, 60])] + [("b", 0, 1.0)], "g string, i int, v double")
    rows = {r.g: r for r in statistics.drift(frame, "g", ["i"], "v").collect()}
    a = rows["a"]
    assert (a.n, a.first_half_mean, a.second_half_mean) == (5, 15.0, 40.0)
    assert a.second_half_vs_first_half_percent == pytest.approx(500 / 3)
    assert a.linear_slope == pytest.approx(12.0)
    assert rows["b"].first_half_mean is None


def test_latency_and_lag(spark):
    rows = [(1, 1000, 800, 900), (2, 1000, 900, 950), (0, 1000, 2000, 3000)]
    frame = spark.createDataFrame(rows, "i int, at bigint, ingested bigint, occurred bigint")
    latency = metrics.processing_latency_ms(F.col("at"), F.col("ingested"))
    assert [r[0] for r in frame.orderBy("i").select(latency).collect()] == [0, 200, 100]
    assert metrics.event_time_lag(frame, "at", "occurred", "i").first()[0] == 50


def test_consumer_lag(spark):
    frame = spark.createDataFrame([("t", 0, i) for i in range(5)], "topic string, partition int, offset bigint")
    for consumed, pending in ((F.col("offset") < 1, 4), (F.lit(True), 0), (F.lit(False), 5)):
        assert metrics.consumer_lag(frame, consumed).first().pending_records == pending


def test_duplicates_are_forgotten_after_the_time_to_live(spark):
    rng = random.Random(11)
    rows = sorted({(rng.choice("ab"), rng.choice("xyz"), rng.randrange(2000)) for _ in range(300)}, key=lambda r: r[2])
    frame = spark.createDataFrame(rows, "actor_id string, event_id string, at bigint")
    expected, last = set(), {}
    for actor, event, at in rows:
        if (actor, event) not in last or at >= last[actor, event] + 150:
            last[actor, event] = at
            expected.add((actor, event, at))
    accepted = dedup.accepted_arrivals(frame, ["at"], "at", 150)
    assert sorted(map(tuple, accepted.collect())) == sorted(expected)


def test_forgotten_events_count_again(spark):
    rows = [("a", "e1", 0, 0), ("a", "e1", 0, 50), ("a", "e1", 0, 200), ("a", "e2", 1, 300)]
    frame = spark.createDataFrame(rows, "actor_id string, event_id string, ms bigint, at bigint")
    events = dedup.accepted_arrivals(frame, ["at"], "at", 150).select(
        "*",
        F.timestamp_millis("ms").alias("occurred_at"),
        F.lit("POLICY_MATCH").alias("event_type"),
        F.lit(5).alias("severity"),
        F.create_map().cast("map<string,string>").alias("attributes"),
    )
    for options in ({}, {"actor_rows": 1}):
        spec = Evaluation((Rule("r", 1000, 1, 0, 5),), ("at",), dedup=False, **options)
        found = [r.observed_event_count for r in risk_signals(events, spec).orderBy("at").collect()]
        assert found == [1, 2, 3]


def test_pending_records():
    sources = [
        SimpleNamespace(latestOffset='{"t":{"0":5,"1":2}}', endOffset='{"t":{"0":1}}'),
        SimpleNamespace(latestOffset="not kafka", endOffset=None),
    ]
    assert pending_records(SimpleNamespace(sources=sources)) == 6


def test_reconciliation(spark):
    schema = "signal_id string, actor_id string, triggering_event_id string, rule_id string, risk_score int, observed_event_count bigint, observed_severity_sum bigint"
    rows = [(f"s{i}", f"a{i % 2}", f"e{i}", "r", 80, i, i) for i in range(6)]
    changed = [(*rows[1][:5], 99, 1)] + rows[2:] + [("new", "a9", "e", "r", 1, 1, 1)]
    left, right = spark.createDataFrame(rows, schema), spark.createDataFrame(changed, schema)
    report = {r.outcome: r for r in reconcile.report(left, right).collect()}
    assert {k: r.records for k, r in report.items()} == {
        "missing": 1, "different": 1, "equal": 4, "unexpected": 1,
        "side:expected": 6, "side:observed": 6,
    }
    assert report["side:expected"].checksum != report["side:observed"].checksum
    outcomes = {r.outcome: r["count"] for r in reconcile.compare(left, right).groupBy("outcome").count().collect()}
    assert outcomes == {"missing": 1, "different": 1, "equal": 4, "unexpected": 1}
    shuffled = spark.createDataFrame(rows[::-1], schema).repartition(3)
    same = {r.outcome: r for r in reconcile.report(left, shuffled).collect()}
    assert set(same) == {"equal", "side:expected", "side:observed"}
    assert same["side:expected"].checksum == same["side:observed"].checksum


def test_throughput(spark):
    start = dt.datetime(2031, 4, 9, 12)
    rows = [(start + dt.timedelta(seconds=s),) for s in (0, 1, 59, 60, 61)]
    frame = spark.createDataFrame(rows, "at timestamp")
    found = [(r.events, r.events_per_second) for r in metrics.throughput(frame, "at").orderBy("interval_start_ms").collect()]
    assert found == [(3, 3 / 60), (2, 2 / 60)]
