"""Signal history with replay collapse."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SORT_KEY = ("actor_id", "emitted_at", "signal_id")


def _newest_per(history: DataFrame, keys: tuple[str, ...], *order: str) -> DataFrame:
    # Also limits each group before the shuffle, so replays do not travel.
    window = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return (
        history.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")
    )


def collapsed(history: DataFrame) -> DataFrame:
    """One row per sort key: the one stored last."""
    return _newest_per(history, SORT_KEY, "stored_at")


def latest_by_signal(history: DataFrame) -> DataFrame:
    """One row per signal, also when a replay gave it another ``emitted_at``."""
    return _newest_per(history, ("signal_id",), "stored_at", "emitted_at")


def recent_per_actor(history: DataFrame, limit: int = 10) -> DataFrame:
    """The newest signals of every actor, with their rank.

    The reading is of the rows as stored, so replays not yet collapsed may show.
    """
    order = [F.desc("emitted_at"), F.desc("signal_id")]
    window = Window.partitionBy("actor_id").orderBy(*order)
    ranked = history.withColumn("recency", F.row_number().over(window))
    return ranked.where(F.col("recency") <= limit)


def recent_of(history: DataFrame, actor_id: str, limit: int = 10) -> DataFrame:
    """The newest signals of one actor; the filter reaches the Parquet scan."""
    return history.where(F.col("actor_id") == actor_id).orderBy(F.desc("emitted_at")).limit(limit)


def rule_statistics(final: DataFrame) -> DataFrame:
    """Per rule over collapsed history: signals, actors, range of observed counts."""
    return final.groupBy("rule_id").agg(
        F.count("*").alias("signals"),
        F.min("observed_event_count").alias("least_events"),
        F.max("observed_event_count").alias("most_events"),
        F.max("observed_severity_sum").alias("most_severity"),
    )


def by_rule(signals: DataFrame, rule_id: str) -> DataFrame:
    """The signals of one rule; the filter reaches the scan of a stored history."""
    return signals.where(F.col("rule_id") == rule_id)
