"""Risk signals from rolling windows."""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions.identity import signal_id
from riskloom.operators.timeline import RULES_PER_PASS, Evaluation, timeline

CAPACITY_POS = -1


def risk_signals(events: DataFrame, spec: Evaluation) -> DataFrame:
    """Signals of a batch of events: the signal columns, the arrival columns, rule_pos.

    Emission order is (arrival, rule_pos); a capacity signal has rule_pos -1 and comes
    before the rules of the same event.
    """
    rules = spec.rules
    if len(rules) <= RULES_PER_PASS:
        return from_timeline(timeline(events, spec), spec)
    return reduce(
        DataFrame.unionByName,
        [_pass(events, spec, start) for start in range(0, len(rules), RULES_PER_PASS)],
    )


def _pass(events: DataFrame, spec: Evaluation, start: int) -> DataFrame:
    """A slice of a long policy. The longest rule rides along to keep the retention."""
    longest = max(spec.rules, key=lambda rule: rule.window_ms)
    chosen = list(spec.rules[start : start + RULES_PER_PASS])
    guest = longest not in chosen
    part = dataclasses.replace(spec, rules=tuple(chosen + [longest] * guest))
    found = from_timeline(timeline(events, part), part)
    if guest:
        found = found.where(F.col("rule_pos") < len(chosen))
    if start > 0:  # the capacity signal belongs to the first pass
        found = found.where(F.col("rule_pos") != CAPACITY_POS)
    shifted = F.when(F.col("rule_pos") >= 0, F.col("rule_pos") + start)
    return found.withColumn("rule_pos", F.coalesce(shifted, F.col("rule_pos")))


def from_timeline(rows: DataFrame, spec: Evaluation) -> DataFrame:
    def candidate(fires: Column, pos: int, rule_id: str, score: int, reason, n, total):
        return F.when(
            fires,
            F.struct(
                F.lit(pos).alias("rule_pos"),
                F.lit(rule_id).alias("rule_id"),
                F.lit(score).alias("risk_score"),
                reason.alias("reason"),
                F.col(n).alias("observed_event_count"),
                F.col(total).alias("observed_severity_sum"),
            ),
        )

    capacity_reason = F.concat(
        F.lit(f"history_capacity={spec.history_cap}, evicted="),
        F.col("evicted").cast("string"),
        F.lit(", operator_action_required=true"),
    )
    candidates = [
        candidate(
            F.col("evicted") > 0,
            CAPACITY_POS,
            schemas.CAPACITY_RULE_ID,
            schemas.CAPACITY_SCORE,
            capacity_reason,
            "history_n",
            "history_sum",
        )
    ]
    for bit, rule in enumerate(spec.rules):
        n, total = f"n_{bit}", f"sum_{bit}"
        fires = (
            F.col(f"match_{bit}")
            & ~F.col("late")
            & (F.col(n) >= rule.minimum_events)
            & (F.col(total) >= rule.minimum_severity_sum)
        )
        reason = F.concat(
            F.lit("events="),
            F.col(n).cast("string"),
            F.lit(", severity_sum="),
            F.col(total).cast("string"),
        )
        candidates.append(
            candidate(fires, bit, rule.rule_id, rule.risk_score, reason, n, total)
        )
    fired = (
        rows.select(
            "actor_id",
            F.col("event_id").alias("triggering_event_id"),
            "max_ms",
            *spec.carried,
            F.explode(F.array(*candidates)).alias("_signal"),
        )
        .where("_signal IS NOT NULL")
        .select("*", "_signal.*")
    )
    return fired.select(
        signal_id(F.col("triggering_event_id"), F.col("rule_id")).alias("signal_id"),
        "actor_id",
        "triggering_event_id",
        "rule_id",
        "risk_score",
        "reason",
        "observed_event_count",
        "observed_severity_sum",
        F.timestamp_millis("max_ms").alias("emitted_at"),
        *spec.carried,
        "rule_pos",
    )
