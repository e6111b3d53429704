"""Pipeline metrics as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.timeline import Evaluation


def route_counts(decoded: DataFrame) -> DataFrame:
    """Accepted and quarantined records per topic."""
    return decoded.groupBy("topic").agg(
        F.count_if(F.col("failure_reason").isNull()).alias("accepted_records_total"),
        F.count_if(F.col("failure_reason").isNotNull()).alias("quarantined_records_total"),
    )


def signals_of(spec: Evaluation) -> Column:
    """Number of signals of a timeline row."""
    fires = [F.when(F.col("evicted") > 0, 1).otherwise(0)]
    for bit, rule in enumerate(spec.rules):
        fired = (
            F.col(f"match_{bit}")
            & ~F.col("late")
            & (F.col(f"n_{bit}") >= rule.minimum_events)
            & (F.col(f"sum_{bit}") >= rule.minimum_severity_sum)
        )
        fires.append(F.when(fired, 1).otherwise(0))
    return reduce(Column.__add__, fires)


def pipeline_totals(events: DataFrame, rows: DataFrame, spec: Evaluation) -> DataFrame:
    """Counters over a whole evaluation; ``rows`` is ``timeline(events, spec)``.

    What has entered a history and was neither evicted nor is still held after the
    last arrival of its actor has expired.
    """
    per_actor = rows.groupBy("actor_id").agg(
        F.count("*").alias("accepted"),
        F.count_if("late").alias("late"),
        F.sum("evicted").alias("evictions"),
        F.count_if(F.col("evicted") > 0).alias("breaches"),
        F.sum(signals_of(spec)).alias("signals"),
        F.max_by("history_n", F.struct(*spec.arrival)).alias("held"),
    )
    totals = per_actor.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("accepted", "late", "evictions", "breaches", "signals", "held")
        ]
    )
    # Two one-row aggregates side by side, as one grouped aggregate over both.
    received = events.agg(F.count("*").alias("received"))
    both = received.unionByName(totals, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("received", *totals.columns)]
    )
    return both.select(
        F.col("received").alias("events_total"),
        (F.col("received") - F.col("accepted")).alias("duplicates_total"),
        F.col("signals").alias("risk_signals_total"),
        (F.col("accepted") - F.col("late") - F.col("evictions") - F.col("held")).alias(
            "history_expired_events_total"
        ),
        F.col("late").alias("late_events_beyond_history_total"),
        F.col("breaches").alias("state_capacity_breaches_total"),
        F.col("evictions").alias("state_capacity_evictions_total"),
    )


def throughput(events: DataFrame, processed_at: str, seconds: int = 60) -> DataFrame:
    """Events and events per second in every full interval."""
    interval = F.window(processed_at, f"{seconds} seconds")
    return (
        events.groupBy(interval.alias("w"))
        .agg(F.count("*").alias("events"))
        .select(
            F.unix_millis("w.start").alias("interval_start_ms"),
            "events",
            (F.col("events") / seconds).alias("events_per_second"),
        )
    )


def processing_latency_ms(processed_ms: Column, ingested_ms: Column) -> Column:
    return F.greatest(F.lit(0), processed_ms - ingested_ms)


def event_time_lag(
    events: DataFrame, processed_ms: str, occurred_ms: str, *order: str
) -> DataFrame:
    """Lag of the last processed event, never below zero."""
    lag = F.greatest(F.lit(0), F.col(processed_ms) - F.col(occurred_ms))
    return events.agg(F.max_by(lag, F.struct(*order)).alias("event_time_lag_ms"))


def consumer_lag(records: DataFrame, consumed: Column) -> DataFrame:
    """Records after the consumed position, per partition.

    ``records`` are the raw records, ``consumed`` tells which were read already. The
    positions are taken as in Kafka: one past the largest offset.
    """
    position = F.coalesce(F.max(F.when(consumed, F.col("offset"))) + 1, F.min("offset"))
    return records.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("end_offset"),
        position.alias("consumed_offset"),
        (F.max("offset") + 1 - position).alias("pending_records"),
    )
