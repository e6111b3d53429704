"""Generated event sets for tests and benchmarks, as Spark range expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- Fixed values: start times of the generated sets, epoch milliseconds ----
UNIFORM_START_MS = 1_700_000_000_000
RETENTION_START_MS = 1_700_010_800_000
LOAD_START_MS = 1_787_054_400_000
# ---- End of fixed values ----

_HOUR_MS = 3_600_000


def _events(
    rows: DataFrame, event_id: Column, actor_id: Column, ms: Column, severity: Column
) -> DataFrame:
    return rows.select(
        event_id.alias("event_id"),
        actor_id.alias("actor_id"),
        F.timestamp_millis(ms).alias("occurred_at"),
        F.lit("CONTENT_REPORT").alias("event_type"),
        severity.cast("int").alias("severity"),
        F.create_map(F.lit("source"), F.lit("test")).alias("attributes"),
        "arrival",
    )


def _numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _resent(rows: DataFrame, again: Column) -> DataFrame:
    """Arrival numbers with the events marked ``again`` sent twice in a row."""
    copies = F.when(again, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("id", F.explode(copies).alias("copy")).withColumn(
        "arrival", F.col("id") * 2 + F.col("copy")
    )


def _slightly_late_ms(i: Column) -> Column:
    return F.lit(UNIFORM_START_MS) + i * 10 - F.when(i % 17 == 0, 250).otherwise(0)


def uniform(spark: SparkSession, events: int = 120_000, actors: int = 100) -> DataFrame:
    """Even load; every 10th event twice, every 17th 250 ms late."""
    i = F.col("id")
    rows = _resent(spark.range(events), i % 10 == 0)
    actor = _numbered("actor-", i % actors)
    return _events(rows, _numbered("event-", i), actor, _slightly_late_ms(i), i % 100)


def skewed(spark: SparkSession, events: int = 30_000, hot: int = 10) -> DataFrame:
    """Nine tenths on a few hot actors; 0, 10 and 50 % copies by thirds."""
    i = F.col("id")
    third = events // 3
    again = F.when(i < third, False).when(i < 2 * third, i % 10 == 0).otherwise(i % 2 == 0)
    rows = _resent(spark.range(events), again)
    actor = F.when(i < events * 9 // 10, _numbered("hot-", i % hot)).otherwise(
        _numbered("cold-", i % 1000)
    )
    return _events(rows, _numbered("event-", i), actor, _slightly_late_ms(i), i % 100)


def retention(
    spark: SparkSession, actors: int = 100, recent: int = 20, stale: int = 10
) -> DataFrame:
    """Per actor some recent events, then events three hours older."""
    per_actor = recent + stale
    rows = spark.range(actors * per_actor).withColumn("arrival", F.col("id"))
    actor = F.floor(F.col("id") / per_actor)
    n = F.col("id") % per_actor
    ms = F.lit(RETENTION_START_MS) + F.when(n < recent, n).otherwise(
        n - recent - 3 * _HOUR_MS
    )
    event_id = F.concat_ws("-", F.lit("retention"), actor.cast("string"), n.cast("string"))
    return _events(rows, event_id, _numbered("actor-", actor), ms, F.lit(1))


def load(spark: SparkSession, events: int, actors: int, run: str = "run") -> DataFrame:
    """Round-robin over actors, one millisecond apart, with a ``topic`` number."""
    i = F.col("id")
    rows = spark.range(events).withColumn("arrival", i)
    generated = _events(
        rows,
        _numbered(f"load-{run}-", i),
        _numbered(f"load-{run}-", i % actors),
        F.lit(LOAD_START_MS) + i,
        F.lit(1),
    )
    return generated.withColumn("topic", F.concat(F.lit("topic-"), F.col("arrival") % 4))


def load_records(spark: SparkSession, events: int, actors: int) -> DataFrame:
    """``load`` as raw records of its four topics."""
    at = F.date_format("occurred_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    text = F.to_json(
        F.struct(
            F.lit(1).alias("schema_version"),
            "event_id",
            at.alias("occurred_at"),
            at.alias("ingested_at"),
            "actor_id",
            "event_type",
            "severity",
            "attributes",
        )
    )
    return load(spark, events, actors).select(
        F.lit(None).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        "topic",
        F.lit(0).alias("partition"),
        F.floor(F.col("arrival") / 4).alias("offset"),
        F.col("occurred_at").alias("timestamp"),
    )


def serving(spark: SparkSession, actors: int = 200, per_actor: int = 10) -> DataFrame:
    """Signals with growing counts per actor, for the read side of the stores."""
    actor, seq = F.floor(F.col("id") / per_actor), F.col("id") % per_actor
    actor_text, seq_text = actor.cast("string"), seq.cast("string")
    return spark.range(actors * per_actor).select(
        F.concat_ws("-", F.lit("signal"), actor_text, seq_text).alias("signal_id"),
        F.concat(F.lit("actor-"), actor_text).alias("actor_id"),
        F.concat_ws("-", F.lit("event"), actor_text, seq_text).alias("triggering_event_id"),
        F.lit("benchmark-rule").alias("rule_id"),
        F.lit(80).alias("risk_score"),
        F.lit("benchmark").alias("reason"),
        (seq + 1).alias("observed_event_count"),
        (10 * (seq + 1)).alias("observed_severity_sum"),
        F.timestamp_millis(F.lit(UNIFORM_START_MS) + seq).alias("emitted_at"),
        F.col("id").alias("arrival"),
        F.lit(0).alias("rule_pos"),
    )


def with_poison(spark: SparkSession, fillers: int = 3000, every: int = 500) -> DataFrame:
    """Raw records: one valid event per filler actor, a poison record before every
    ``every``-th, and two events of one actor at the end."""
    i = F.col("id")
    total = fillers + 2
    ends = i >= fillers
    actor = F.when(ends, F.lit("actor-recovery")).otherwise(_numbered("actor-", i))
    event = F.when(ends, _numbered("recovery-", i - fillers + 1)).otherwise(_numbered("filler-", i))
    severity = F.when(ends, 40).otherwise(1)
    ms = F.lit(LOAD_START_MS) + F.when(ends, i + 1).otherwise(i)
    at = F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    valid = F.to_json(
        F.struct(
            F.lit(1).alias("schema_version"),
            event.alias("event_id"),
            at.alias("occurred_at"),
            at.alias("ingested_at"),
            actor.alias("actor_id"),
            F.lit("CONTENT_REPORT").alias("event_type"),
            severity.alias("severity"),
        )
    )
    poisoned = (i % every == 0) & ~ends
    values = F.when(poisoned, F.array(_numbered("not-json-", i), valid)).otherwise(F.array(valid))
    return (
        spark.range(total)
        .select(i, F.posexplode(values).alias("n", "text"))
        .select(
            F.lit(None).cast("binary").alias("key"),
            F.col("text").cast("binary").alias("value"),
            F.lit("recovery-events").alias("topic"),
            F.lit(0).alias("partition"),
            (i * 2 + F.col("n")).alias("offset"),
            F.timestamp_millis(F.lit(LOAD_START_MS) + i * 2 + F.col("n")).alias("timestamp"),
        )
    )
