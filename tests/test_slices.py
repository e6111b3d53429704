"""The stream with state in slices, against brute force and its own restarts."""

import datetime as dt
import random

import pytest

from riskloom import schemas
from riskloom.operators import decode
from riskloom.operators.rules import Rule
from riskloom.operators.timeline import Evaluation
from riskloom.sources import records
from riskloom.streaming import pipeline, slices
from tests import brute
from tests.test_streaming import START, deliver, found, payload, stores  # noqa: F401

RULES = [
    Rule("short", 400, 2, 60, 10, ("CONTENT_REPORT",)),
    Rule("long", 2000, 3, 0, 20),
    Rule("tagged", 900, 1, 30, 30, (), {"k": "1"}),
]


def run(spark, path, rules, stores, tmp_path, cap=100_000, **options):
    raw = records.file_stream(spark, path)
    spec = Evaluation(tuple(rules), history_cap=cap)
    query = pipeline.start_sliced_signals(
        raw, spec, stores, str(tmp_path / "checkpoint"), bounded=True, **options
    )
    query.awaitTermination()
    return pipeline.sliced_state(spark, str(tmp_path / "checkpoint"), spec, **options)


def stream(seed, n=300):
    rng = random.Random(seed)
    events, payloads = [], []
    for i in range(n):
        ms = 5000 + i * 20 - rng.choice([0, 0, 0, 50, 700, 2500])
        event = {
            "actor_id": f"a{rng.randrange(4)}",
            "event_id": f"e{i}",
            "us": ms * 1000,
            "event_type": rng.choice(["CONTENT_REPORT", "USER_BLOCK"]),
            "severity": rng.randrange(101),
            "attributes": {"k": str(rng.randrange(3)), "other": "x"},
        }
        for _ in range(2 if rng.random() < 0.1 else 1):
            events.append(event)
            payloads.append(
                payload(event["event_id"], ms, event["severity"], event["actor_id"],
                        event["event_type"], **event["attributes"])
            )
    return events, payloads


@pytest.mark.parametrize("cap", [100_000, 6])
def test_equals_brute_force_over_several_batches(spark, stores, tmp_path, cap):  # noqa: F811
    events, payloads = stream(cap)
    path = str(tmp_path / "raw")
    # A watermark far behind gives nothing back, so the batches are one long evaluation.
    options = {"merge_every": 2, "delay_ms": 1_000_000}
    for start in range(0, len(payloads), 100):
        deliver(spark, path, payloads[start : start + 100] + ["poison"], start + start // 100)
        state = run(spark, path, RULES, stores, tmp_path, cap, **options)
    expected = [row[:5] for row in brute.signals(events, RULES, cap)]
    assert len(expected) > 100
    assert sorted(found(stores)) == sorted(expected)
    last = {row[0]: row[1:3] for row in expected}
    assert {r.actor_id for r in stores.hot_state.read(0).collect()} == set(last)

    totals = state.totals().first()
    unique = {(e["actor_id"], e["event_id"]): e for e in events}
    assert totals.events_total == totals.accepted_records_total == len(events)
    assert totals.quarantined_records_total == -(-len(payloads) // 100)
    assert totals.duplicates_total == len(events) - len(unique)
    assert totals.risk_signals_total == len(expected)
    full = sum(row[2] == schemas.CAPACITY_RULE_ID for row in expected)
    assert totals.state_capacity_evictions_total == totals.state_capacity_breaches_total == full
    held = {}
    for event in unique.values():
        held.setdefault(event["actor_id"], []).append(event["us"] // 1000)
    kept = {a: len([t for t in ts if t >= max(ts) - 2000][:cap]) for a, ts in held.items()}
    got = {r.actor_id: r["count"] for r in state.held().groupBy("actor_id").count().collect()}
    assert got == kept
    late = totals.late_events_beyond_history_total
    assert late > 0
    assert totals.history_expired_events_total == len(unique) - late - full - sum(kept.values())


def decoded(spark, *rows):
    """(event id, ms, actor, topic, partition) per record, in order."""
    raw = [
        (None, bytearray(payload(e, ms, 10, actor).encode()), topic, part, i,
         START + dt.timedelta(milliseconds=i))
        for i, (e, ms, actor, topic, part) in enumerate(rows)
    ]
    return decode.decode_records(spark.createDataFrame(raw, schemas.RAW_RECORD))


class Clock:
    def __init__(self):
        self.now = 1_000_000

    def __call__(self):
        return self.now


def state_of(spark, tmp_path, clock, **options):
    spec = Evaluation((Rule("r", 1000, 1, 0, 50),))
    return slices.SlicedState(spark, str(tmp_path / "s"), spec, clock=clock, **options)


def taken(state, frame, batch_id):
    with state.advanced(frame, batch_id) as signals:
        return sorted((r.triggering_event_id, r.observed_event_count) for r in signals.collect())


def holders(state):
    return {r.actor_id: r["count"] for r in state.held().groupBy("actor_id").count().collect()}


def test_a_silent_actor_gives_back_what_the_watermark_has_passed(spark, tmp_path):
    state = state_of(spark, tmp_path, Clock(), delay_ms=100, merge_every=2)
    taken(state, decoded(spark, ("e1", 0, "quiet", "t", 0), ("e2", 500, "quiet", "t", 0)), 0)
    assert holders(state) == {"quiet": 2}
    # The watermark is 1101 - 100 - 1 = 1000: e1 goes at 0 + 1000 + 1 only.
    taken(state, decoded(spark, ("b1", 1101, "busy", "t", 0)), 1)
    assert holders(state) == {"quiet": 2, "busy": 1}
    taken(state, decoded(spark, ("b2", 1102, "busy", "t", 0)), 2)
    assert holders(state) == {"quiet": 1, "busy": 2}
    taken(state, decoded(spark, ("b3", 9000, "busy", "t", 0)), 3)
    assert holders(state) == {"busy": 1}
    # Its largest event time stays: what is behind the longest window is late for ever.
    assert taken(state, decoded(spark, ("old", -501, "quiet", "t", 0)), 4) == []
    assert taken(state, decoded(spark, ("new", -500, "quiet", "t", 0)), 5) == [("new", 1)]
    assert state.totals().first().late_events_beyond_history_total == 1


def test_a_silent_partition_holds_the_watermark_back_for_a_minute(spark, tmp_path):
    clock = Clock()
    state = state_of(spark, tmp_path, clock, delay_ms=100)
    taken(state, decoded(spark, ("e1", 0, "a", "t", 0), ("e2", 5, "b", "t", 1)), 0)
    assert state.watermark_ms() == START_MS - 101
    clock.now += 30_000
    taken(state, decoded(spark, ("e3", 50_000, "b", "t", 1)), 1)
    assert state.watermark_ms() == START_MS - 101 and holders(state) == {"a": 1, "b": 1}
    clock.now += 30_000  # partition 0 has been silent for a minute
    taken(state, decoded(spark, ("e4", 50_001, "b", "t", 1)), 2)
    assert state.watermark_ms() == START_MS + 50_001 - 101 and holders(state) == {"b": 2}
    # It comes back far behind; the watermark does not fall and the event is evaluated.
    assert taken(state, decoded(spark, ("e5", 700, "a", "t", 0)), 3) == [("e5", 1)]
    assert state.watermark_ms() == START_MS + 50_001 - 101


START_MS = int(START.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_ids_are_forgotten_after_their_time_to_live(spark, tmp_path):
    clock = Clock()
    state = state_of(spark, tmp_path, clock, dedup_ttl_ms=1000, merge_every=1)
    one = decoded(spark, ("e", 0, "a", "t", 0))
    assert taken(state, one, 0) == [("e", 1)]
    clock.now += 999  # a copy does not renew it
    assert taken(state, one, 1) == []
    clock.now += 1
    assert taken(state, one, 2) == [("e", 2)]


def test_a_batch_delivered_again_changes_nothing(spark, tmp_path):
    state = state_of(spark, tmp_path, Clock(), merge_every=2)
    batches = [
        decoded(spark, *[(f"e{b}-{i}", 10 * i, f"a{i % 3}", "t", 0) for i in range(12)])
        for b in range(4)
    ]
    first = [taken(state, batch, i) for i, batch in enumerate(batches[:3])]
    with pytest.raises(ZeroDivisionError):  # a store fails: the batch did not happen
        with state.advanced(batches[3], 3):
            1 / 0
    assert state.totals().first().events_total == 36
    assert taken(state, batches[2], 2) == first[2]
    taken(state, batches[3], 3)
    again = state.totals().first()
    assert taken(state, batches[3], 3) and state.totals().first() == again
    assert again.events_total == 48 and again.duplicates_total == 0
    assert sorted(state._ids("slice")) == [2, 3] and sorted(state._ids("merged")) == [1, 3]


def test_more_rules_than_one_pass_takes(spark, tmp_path):
    rules = tuple(Rule(f"r{i}", 1000 + i, 1, 0, 50) for i in range(40))
    state = slices.SlicedState(spark, str(tmp_path / "s"), Evaluation(rules))
    for batch in range(2):
        with state.advanced(decoded(spark, (f"e{batch}", batch, "a", "t", 0)), batch) as signals:
            assert {r.observed_event_count for r in signals.collect()} == {batch + 1}
    assert state.totals().first().risk_signals_total == 80


def test_nothing_taken_in(spark, tmp_path):
    state = state_of(spark, tmp_path, Clock())
    assert state.held().count() == 0 and state.totals().first().events_total == 0
    with pytest.raises(ValueError):
        state_of(spark, tmp_path, Clock(), dedup_ttl_ms=0)
