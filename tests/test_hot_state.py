"""Writes of the hot state out of order, against a loop and against the state table."""

import random

import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators import hot_state
from riskloom.streaming.sinks import HotStateTable

TTL = 100
ORDER = ("written", "n")


def brute(rows):
    held, accepted = {}, []
    for actor, written, emitted, n in sorted(rows, key=lambda r: (r[1], r[3])):
        live = actor in held and written < held[actor][0] + TTL
        if not live or emitted >= held[actor][1]:
            held[actor] = written, emitted, n
            accepted.append((actor, n))
    return sorted(accepted), {actor: n for actor, (_, _, n) in held.items()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "actor_id string, written bigint, emitted bigint, n bigint")


def rows_of(rng):
    rows = []
    for actor, count, span in (("hot", 700, 6000), ("slow", 60, 9000), ("quick", 200, 90)):
        for _ in range(count):
            written = rng.randrange(span)
            rows.append((actor, written, written - rng.choice([0, 0, 1, 30, 400]), len(rows)))
    # Falling for long, so that followers are far away; then ties of both times.
    rows += [("falls", i // 4, 1000 - i, 5000 + i) for i in range(390)]
    rows += [("ties", i // 3, 7, 6000 + i) for i in range(20)]
    rows += [("once", 3, 4, 7000), ("edge", 0, 9, 7001), ("edge", TTL - 1, 8, 7002)]
    rows += [("edge", TTL, 1, 7003)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("partitions", [1, 7])
def test_equals_a_loop(spark, partitions):
    rows = rows_of(random.Random(partitions))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        writes = frame(spark, rows + [(None, 1, 1, 1), ("x", None, 1, 2), ("x", 1, None, 3)])
        accepted = hot_state.accepted_writes(writes, "written", "emitted", TTL, ORDER).collect()
        state = hot_state.upserted(writes, "written", "emitted", TTL, ORDER).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    chain, last = brute(rows)
    assert sorted((r.actor_id, r.n) for r in accepted) == chain
    assert {r.actor_id: r.n for r in state} == last
    assert sum(r.accepted_writes for r in state) == len(chain)


def test_no_writes_and_no_time_to_live(spark):
    empty = frame(spark, [])
    assert hot_state.upserted(empty, "written", "emitted", TTL, ORDER).count() == 0
    with pytest.raises(ValueError, match="positive"):
        hot_state.accepted_writes(empty, "written", "emitted", 0, ORDER)


def test_equals_the_state_table(spark, tmp_path):
    """One write per actor and batch, batches at the times of writing."""
    rng = random.Random(3)
    rows = []
    for batch in range(10):
        for actor in rng.sample(["a", "b", "c", "d"], 3):
            rows.append((actor, batch * 40, batch * 40 - rng.choice([0, 50, 90]), len(rows)))
    table = HotStateTable(spark, str(tmp_path), ttl_ms=TTL, snapshot_every=4)
    signals = frame(spark, rows)
    for field in schemas.RISK_SIGNAL:
        if field.name not in ("actor_id", "emitted_at"):
            value = F.col("n").cast("string") if field.name == "signal_id" else F.lit(None)
            signals = signals.withColumn(field.name, value.cast(field.dataType))
    signals = signals.withColumn("emitted_at", F.timestamp_millis("emitted")).cache()
    for batch in range(10):
        table.merge(signals.where(F.col("written") == batch * 40), batch, batch * 40, ["n"])
    held = table.read(9 * 40).select("actor_id", F.get_json_object("payload", "$.signal_id"))
    state = hot_state.upserted(frame(spark, rows), "written", "emitted", TTL, ORDER)
    live = state.where(F.col("written") + TTL > 9 * 40).select("actor_id", F.col("n").cast("string"))
    assert sorted(map(tuple, held.collect())) == sorted(map(tuple, live.collect()))
