"""Duplicate removal by arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir

ACTOR_EVENT = ("actor_id", "event_id")


def first_arrivals(
    events: DataFrame, arrival: Sequence[str], keys: Sequence[str] = ACTOR_EVENT
) -> DataFrame:
    """The first arrival of every key.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle as
    well, so any number of copies of one event leaves a map task as one row.
    """
    order = Window.partitionBy(*keys).orderBy(*arrival)
    return (
        events.withColumn("_copy", F.row_number().over(order))
        .where("_copy = 1")
        .drop("_copy")
    )


def accepted_arrivals(
    events: DataFrame,
    arrival: Sequence[str],
    at_ms: str,
    ttl_ms: int,
    keys: Sequence[str] = ACTOR_EVENT,
) -> DataFrame:
    """Arrivals that pass a duplicate filter that forgets a key after ``ttl_ms``.

    A key is remembered from its accepted arrival on; copies do not refresh it. An
    arrival is accepted again once ``at_ms`` is at least the last accepted time plus
    the time to live. ``arrival`` must start in ``at_ms`` order.

    Only keys whose arrivals span the time to live need more than their first arrival, and
    of them only the first arrival of every millisecond. Each of these points to the first
    one that is a time to live later; what the key's first arrival reaches is accepted. The
    pointers are doubled, so a chain of n accepted arrivals takes log2(n) rounds.
    """
    keys = list(keys)
    spanning = (
        events.groupBy(*keys)
        .agg(F.min(at_ms).alias("_begin"), F.max(at_ms).alias("_end"))
        .where(F.col("_end") - F.col("_begin") >= ttl_ms)
        .select(*keys)
    )
    ensure_checkpoint_dir(events.sparkSession)
    candidates = first_arrivals(events.join(spanning, keys), arrival, [*keys, at_ms])
    order = Window.partitionBy(*keys).orderBy(*arrival)
    candidates = candidates.select(*events.columns, F.row_number().over(order).alias("_pos"))
    candidates = candidates.checkpoint()
    reached = chain(candidates.where("_pos = 1"), _next_after(candidates, keys, at_ms, ttl_ms), keys)
    again = candidates.join(reached.where("_pos > 1"), [*keys, "_pos"])
    return first_arrivals(events, arrival, keys).unionByName(again.select(*events.columns))


def chain(starts: DataFrame, steps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Positions ``_pos`` that pointers lead to from the starts, which are among them.

    ``steps`` has ``_pos`` and ``_to``, at most one pointer a position, all forward. They are
    doubled: after a round, positions are reached in less than 2 ** rounds steps.
    """
    reached, steps = starts.select(*keys, "_pos"), steps.checkpoint()
    while not steps.isEmpty():
        further = reached.join(steps, [*keys, "_pos"]).select(*keys, F.col("_to").alias("_pos"))
        reached = reached.unionByName(further).checkpoint()
        second = steps.select(*keys, F.col("_pos").alias("_to"), F.col("_to").alias("_then"))
        steps = steps.join(second, [*keys, "_to"])
        steps = steps.select(*keys, "_pos", F.col("_then").alias("_to")).checkpoint()
    return reached


def _next_after(candidates: DataFrame, keys: list[str], at_ms: str, after_ms: int) -> DataFrame:
    """``_pos`` and ``_to``, the first position of the key at least ``after_ms`` later.

    From the latest time to the earliest, every candidate asks at its time plus ``after_ms``
    which was the last, that is the earliest, position passed.
    """
    at = candidates.select(*keys, "_pos", F.col(at_ms).alias("_at"), F.lit(0).alias("_asks"))
    asks = at.select(*keys, "_pos", (F.col("_at") + after_ms).alias("_at"), F.lit(1).alias("_asks"))
    backwards = (
        Window.partitionBy(*keys)
        .orderBy(F.desc("_at"), "_asks", F.desc("_pos"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    passed = F.min(F.when(F.col("_asks") == 0, F.col("_pos"))).over(backwards)
    found = at.unionByName(asks).withColumn("_to", passed)
    return found.where("_asks = 1 AND _to IS NOT NULL").select(*keys, "_pos", "_to")
