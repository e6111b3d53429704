import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators.rules import Rule
from riskloom.operators.timeline import Evaluation
from riskloom.sources import generated, records
from riskloom.streaming import pipeline
from riskloom.streaming.sinks import HistoryTable, HotStateTable, QuarantineTable
from tests import brute

START = dt.datetime(2031, 4, 9, 12)


@pytest.fixture
def stores(spark, tmp_path):
    return pipeline.Stores(
        HotStateTable(spark, str(tmp_path / "hot"), snapshot_every=2),
        HistoryTable(spark, str(tmp_path / "history")),
        QuarantineTable(spark, str(tmp_path / "quarantine")),
    )


def payload(event_id, ms, severity, actor="actor", event_type="CONTENT_REPORT", **attributes):
    at = (START + dt.timedelta(milliseconds=ms)).isoformat(timespec="milliseconds") + "Z"
    return json.dumps(
        {
            "schema_version": 1,
            "event_id": event_id,
            "occurred_at": at,
            "ingested_at": at,
            "actor_id": actor,
            "event_type": event_type,
            "severity": severity,
            "attributes": attributes,
        }
    )


def deliver(spark, path, payloads, first_offset=0, topic="events"):
    """One file with one record per payload, in order."""
    rows = [
        (None, bytearray(p.encode()), topic, 0, first_offset + i,
         START + dt.timedelta(milliseconds=first_offset + i))
        for i, p in enumerate(payloads)
    ]
    frame = spark.createDataFrame(rows, schemas.RAW_RECORD)
    frame.coalesce(1).write.mode("append").parquet(path)


def run(spark, path, rules, stores, tmp_path, cap=100_000, **options):
    raw = records.file_stream(spark, path)
    spec = Evaluation(tuple(rules), history_cap=cap)
    query = pipeline.start_signals(
        raw, spec, stores, str(tmp_path / "checkpoint"), bounded=True, **options
    )
    query.awaitTermination()
    return query


def found(stores):
    return [
        (r.actor_id, r.triggering_event_id, r.rule_id, r.observed_event_count, r.observed_severity_sum)
        for r in stores.history.final().collect()
    ]


def test_mixed_poison(spark, stores, tmp_path):
    path = str(tmp_path / "raw")
    base = json.loads(payload("e4", 0, 40))
    deliver(
        spark,
        path,
        [
            payload("e1", 0, 40),
            "not-json",
            payload("e1", 0, 40),
            '{"schema_version":99}',
            payload("e2", 1000, 40),
            json.dumps({**base, "surprise": 1}),
            payload("e3", 2000, 40),
        ],
    )
    run(spark, path, [Rule("r", 60_000, 3, 120, 90)], stores, tmp_path)
    assert [(r[1], r[3], r[4]) for r in found(stores)] == [("e3", 3, 120)]
    raw = records.file_stream(spark, path)
    pipeline.start_quarantine(raw, stores, str(tmp_path / "c"), bounded=True).awaitTermination()
    reasons = {r.source_offset: r.failure_reason for r in stores.quarantine.read().collect()}
    assert reasons == {
        1: "MALFORMED_JSON",
        3: "UNSUPPORTED_SCHEMA_VERSION",
        5: "CONTRACT_VIOLATION",
    }


def test_restart_keeps_state_and_late_events_count(spark, stores, tmp_path):
    path = str(tmp_path / "raw")
    rules = [Rule("r", 60_000, 3, 0, 90)]
    deliver(spark, path, [payload("e1", 50_000, 10), payload("e2", 51_000, 10)])
    run(spark, path, rules, stores, tmp_path)
    # 31 s behind the largest event time, and the watermark delay is 10 s.
    deliver(spark, path, [payload("e1", 50_000, 10), payload("late", 20_000, 10)], 2)
    run(spark, path, rules, stores, tmp_path)
    rows = stores.history.final().collect()
    assert [(r.triggering_event_id, r.observed_event_count) for r in rows] == [("late", 3)]
    assert rows[0].emitted_at == START + dt.timedelta(milliseconds=51_000)
    hot = stores.hot_state.read(0).collect()
    assert [r.key for r in hot] == ["safety:risk:actor:actor"]
    assert json.loads(hot[0].payload)["triggering_event_id"] == "late"
    assert json.loads(hot[0].payload)["emitted_at"] == "2031-04-09T12:00:51Z"


@pytest.mark.parametrize("cap", [100_000, 6])
def test_stream_equals_brute_force_over_several_batches(spark, stores, tmp_path, cap):
    rng = random.Random(cap)
    rules = [
        Rule("short", 400, 2, 60, 10, ("CONTENT_REPORT",)),
        Rule("long", 2000, 3, 0, 20),
        Rule("tagged", 900, 1, 30, 30, (), {"k": "1"}),
    ]
    events, payloads = [], []
    for i in range(300):
        ms = 5000 + i * 20 - rng.choice([0, 0, 0, 50, 700, 2500])
        event = {
            "actor_id": f"a{rng.randrange(4)}",
            "event_id": f"e{i}",
            "us": ms * 1000,
            "event_type": rng.choice(["CONTENT_REPORT", "USER_BLOCK"]),
            "severity": rng.randrange(101),
            "attributes": {"k": str(rng.randrange(3))},
        }
        for _ in range(2 if rng.random() < 0.1 else 1):
            events.append(event)
            payloads.append(
                payload(event["event_id"], ms, event["severity"], event["actor_id"],
                        event["event_type"], **event["attributes"])
            )
    path = str(tmp_path / "raw")
    for start in range(0, len(payloads), 120):
        deliver(spark, path, payloads[start : start + 120], start)
        run(spark, path, rules, stores, tmp_path, cap)
    expected = [row[:5] for row in brute.signals(events, rules, cap)]
    assert len(expected) > 100
    assert sorted(found(stores)) == sorted(expected)
    # The hot state holds the last emitted signal of every actor.
    last = {row[0]: row[1:3] for row in expected}
    hot = {
        r.actor_id: (json.loads(r.payload)["triggering_event_id"], json.loads(r.payload)["rule_id"])
        for r in stores.hot_state.read(0).collect()
    }
    assert hot == last


def test_no_valid_instant_stops_the_stream(spark, stores, tmp_path):
    path = str(tmp_path / "raw")
    rules = [Rule("r", 60_000, 1, 0, 90)]
    texts = []
    for i, year in enumerate(("0001", "1600", "2031", "3000", "9999")):
        text = json.loads(payload(f"e{i}", 0, 10, f"actor-{year}"))
        texts.append(json.dumps({**text, "occurred_at": f"{year}-06-01T00:00:00Z"}))
    deliver(spark, path, texts)
    before = spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled")
    run(spark, path, rules, stores, tmp_path)
    deliver(spark, path, [payload("after", 0, 10, "later")], len(texts))
    run(spark, path, rules, stores, tmp_path)
    assert len({row[0] for row in found(stores)}) == len(texts) + 1
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == before
    assert pipeline.completed_batches(spark, str(tmp_path / "checkpoint" / "signals")) == 2


def test_recovery_stream(spark, stores, tmp_path):
    path = str(tmp_path / "raw")
    generated.with_poison(spark).write.parquet(path)
    run(spark, path, [Rule("r", 60_000, 2, 80, 95)], stores, tmp_path)
    assert [(r[0], r[3], r[4]) for r in found(stores)] == [("actor-recovery", 2, 80)]
    raw = records.file_stream(spark, path)
    for _ in range(2):  # a second delivery of the same batch replaces the first
        query = pipeline.start_quarantine(raw, stores, str(tmp_path / "c"), bounded=True)
        query.awaitTermination()
    rows = stores.quarantine.read()
    assert rows.count() == 6
    assert rows.select("failure_reason").distinct().first()[0] == "MALFORMED_JSON"


def test_quiet_actors_give_back_their_history(spark, stores, tmp_path):
    """A heartbeat long after moves the watermark; the timer then drops the history."""
    path = str(tmp_path / "raw")
    rules = [Rule("r", 1000, 2, 0, 50)]
    options = {"cleanup_ms": 1}
    deliver(spark, path, [payload("e1", 0, 10, "quiet")])
    run(spark, path, rules, stores, tmp_path, **options)
    state = str(tmp_path / "checkpoint" / "signals")

    def held():
        reader = spark.read.format("statestore").option("stateVarName", "history")
        return {
            r.key.actor_id: r.n
            for r in reader.load(state).groupBy("key").agg(F.count("*").alias("n")).collect()
        }

    assert held() == {"quiet": 1}
    for i in range(3):  # actors in every partition bring the watermark
        beats = [payload(f"beat-{i}-{n}", 60_000 + i, 10, f"busy-{n}") for n in range(40)]
        deliver(spark, path, beats, 1 + 40 * i)
        run(spark, path, rules, stores, tmp_path, **options)
    assert "quiet" not in held()


def test_hot_state_rejects_older_writes(spark, tmp_path):
    def signals(*rows):
        schema = schemas.RISK_SIGNAL.simpleString()[7:-1].replace(":", " ")
        return spark.createDataFrame(
            [("s", a, e, "r", 80, "x", 3, 120, START + dt.timedelta(milliseconds=ms), i, 0)
             for i, (a, e, ms) in enumerate(rows)],
            schema + ", arrival bigint, rule_pos int",
        )

    table = HotStateTable(spark, str(tmp_path / "hot"), ttl_ms=1000, snapshot_every=3)
    order = pipeline.EMISSION_ORDER

    def state(now):
        return {
            r.actor_id: json.loads(r.payload)["triggering_event_id"]
            for r in table.read(now).collect()
        }

    table.merge(signals(("a", "newer", 2000), ("a", "stale", 1000), ("b", "b1", 5)), 0, 100, order)
    assert state(100) == {"a": "newer", "b": "b1"}
    table.merge(signals(("a", "older", 1500)), 1, 900, order)
    assert state(900) == {"a": "newer", "b": "b1"}
    assert state(1100) == {}  # the rejected write did not renew the time to live
    table.merge(signals(("a", "equal", 2000)), 2, 950, order)
    table.merge(signals(("a", "equal", 2000)), 2, 950, order)  # delivered twice
    assert state(1500) == {"a": "equal"}
    table.merge(signals(("a", "old-again", 10)), 3, 2000, order)
    assert state(2000) == {"a": "old-again"}  # after expiry anything is accepted
