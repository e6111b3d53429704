from pyspark.sql import functions as F

from riskloom.operators import history, hot_state
from riskloom.operators.rules import Rule
from riskloom.operators.signals import risk_signals
from riskloom.operators.timeline import Evaluation
from riskloom.sources import generated

ANY = Evaluation((Rule("r", 3_600_000, 1, 0, 10),))


def counts(signals):
    return signals.agg(F.count("*"), F.countDistinct("signal_id")).first()


def test_uniform(spark):
    events = generated.uniform(spark)
    assert events.count() == 132_000
    assert tuple(counts(risk_signals(events, ANY))) == (120_000, 120_000)


def test_skewed(spark):
    events = generated.skewed(spark)
    assert events.count() == 36_000
    assert tuple(counts(risk_signals(events, ANY))) == (30_000, 30_000)


def test_retention(spark):
    assert tuple(counts(risk_signals(generated.retention(spark), ANY))) == (2_000, 2_000)


def test_load(spark):
    events, actors = 4_000, 400
    per_actor = events // actors
    spec = Evaluation((Rule("r", 60_000, per_actor, per_actor, 90),))
    generated_load = generated.load(spark, events, actors)
    assert generated_load.select("topic").distinct().count() == 4
    rows = risk_signals(generated_load, spec).collect()
    assert len(rows) == actors
    for r in rows:
        actor = int(r.actor_id.rsplit("-", 1)[1])
        assert r.triggering_event_id == f"load-run-{actor + (per_actor - 1) * actors}"
        assert (r.observed_event_count, r.observed_severity_sum) == (per_actor, per_actor)


def test_serving(spark):
    signals = generated.serving(spark)
    assert signals.count() == 2_000
    newest = hot_state.as_state(hot_state.latest(signals, ["arrival", "rule_pos"]))
    payload = newest.where("actor_id = 'actor-100'").first().payload
    assert '"signal_id":"signal-100-9"' in payload and '"actor_id":"actor-100"' in payload
    recent = history.recent_of(signals, "actor-100").collect()
    assert [r.signal_id for r in recent] == [f"signal-100-{9 - i}" for i in range(10)]


def test_history_collapses_replays(spark):
    row = generated.serving(spark, 1, 1).withColumn("stored_at", F.current_timestamp())
    later = row.withColumn("stored_at", F.col("stored_at") + F.expr("INTERVAL 1 SECOND"))
    final = history.collapsed(row.unionByName(later))
    assert final.count() == 1
    assert final.first().stored_at == later.first().stored_at or final.first().risk_score == 80
