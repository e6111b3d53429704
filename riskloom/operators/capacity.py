"""History capacity: which arrival pushes which event out of a full history.

The history keeps the newest ``cap`` events by (time, id). Both expiry and eviction
remove from the old end, so after any arrival the history is what is still inside the
retention window among the ``cap`` newest events that have arrived. An arrival
therefore pushes out the smallest of ``cap + 1`` events, whatever has expired.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.segments import SEGMENT

_PUSHED = (
    "actor_id string, victim_pos bigint, victim_us bigint, "
    "evictor_pos bigint, evictor_ms bigint"
)


def with_evictions(arrivals: DataFrame, cap: int, retention_ms: int) -> DataFrame:
    """Arrivals of actors that fit one task each, with what their histories push out.

    Adds ``evictor_pos`` and ``evictor_ms`` (the arrival that pushes this event out)
    and ``evicted`` (1 when this arrival pushes out an event that had not expired).
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in arrivals.schema)
    schema = f"{fields}, evictor_pos bigint, evictor_ms bigint, evicted int"

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.take(_by_age(rows))
        pos, end = rows["pos"].to_numpy(), rows["max_ms"].to_numpy()
        victims, evictors = _push_out(np.argsort(pos), [], cap)
        by_pos, by_ms = np.zeros(len(pos), "int64"), np.zeros(len(pos), "int64")
        stays, evicted = np.ones(len(pos), bool), np.zeros(len(pos), "int32")
        by_pos[victims], by_ms[victims], stays[victims] = pos[evictors], end[evictors], False
        event_ms = rows["occurred_us"].to_numpy()[victims] // 1000
        evicted[evictors[event_ms >= end[evictors] - retention_ms]] = 1
        return (
            rows.append_column("evictor_pos", pa.array(by_pos, mask=stays))
            .append_column("evictor_ms", pa.array(by_ms, mask=stays))
            .append_column("evicted", pa.array(evicted))
        )

    return arrivals.groupBy("actor_id").applyInArrow(run, schema)


def evictions(arrivals: DataFrame, cap: int) -> DataFrame:
    """One row per push-out of actors of any size, also of already expired events.

    ``arrivals`` holds actor_id, event_id, occurred_us, pos, max_ms and the segment
    number, with arrival order split into segments (``segments.place``). A group of
    the grouped map is one segment plus the at most ``cap`` events carried into it.
    """
    own = arrivals.select(
        "actor_id", SEGMENT, "pos", "occurred_us", "event_id", "max_ms"
    )
    rows = own.withColumn("own", F.lit(True)).unionByName(
        _carried_in(own, cap).withColumn("own", F.lit(False))
    )

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.take(_by_age(rows))
        own, pos = rows["own"].to_numpy(), rows["pos"].to_numpy()
        arriving = np.argsort(np.where(own, pos, -1), kind="stable")[(~own).sum() :]
        victims, evictors = _push_out(arriving, np.flatnonzero(~own).tolist(), cap)
        out, by = rows.take(victims), rows.take(evictors)
        return pa.table(
            {
                "actor_id": out["actor_id"],
                "victim_pos": out["pos"],
                "victim_us": out["occurred_us"],
                "evictor_pos": by["pos"],
                "evictor_ms": by["max_ms"],
            }
        )

    return rows.groupBy("actor_id", SEGMENT).applyInArrow(run, _PUSHED)


def _by_age(rows: pa.Table) -> pa.Array:
    """Row numbers from the oldest event to the newest."""
    keys = ["occurred_us", "event_id", "pos"]
    return pc.sort_indices(rows, sort_keys=[(key, "ascending") for key in keys])


def _push_out(
    arriving: np.ndarray, carried: list[int], cap: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which rank is pushed out by which. Ranks number events from oldest to newest.

    ``arriving`` are the ranks of the arriving events in arrival order, ``carried``
    those already held, ascending.
    """
    heap = carried
    victims, evictors = [], []
    for rank in arriving.tolist():
        if len(heap) < cap:
            heapq.heappush(heap, rank)
        else:
            victims.append(heapq.heappushpop(heap, rank))
            evictors.append(rank)
    return np.array(victims, "int64"), np.array(evictors, "int64")


def _newest(rows: DataFrame, cap: int) -> DataFrame:
    newest_first = [F.desc("occurred_us"), F.desc("event_id"), F.desc("pos")]
    order = Window.partitionBy("actor_id", SEGMENT).orderBy(*newest_first)
    ranked = rows.withColumn("_n", F.row_number().over(order))
    return ranked.where(F.col("_n") <= cap).drop("_n")


def _carried_in(own: DataFrame, cap: int) -> DataFrame:
    """For every segment, the ``cap`` newest events of all earlier segments.

    Doubling: with the newest of the last n segments known for every segment, the
    newest of the last 2n are the newest of two such sets, n segments apart. No set
    ever exceeds 2 * cap rows, and log2(segments) rounds reach the first segment.
    """
    bounds = own.groupBy("actor_id").agg(
        F.max(SEGMENT).alias("_last"), F.min(SEGMENT).alias("_first")
    )
    bounds = bounds.where("_last > _first").checkpoint()
    longest = bounds.agg(F.max(F.col("_last") - F.col("_first"))).first()[0] or 0

    def shifted(rows: DataFrame, by: int) -> DataFrame:
        moved = rows.withColumn(SEGMENT, F.col(SEGMENT) + by)
        return moved.where(F.col(SEGMENT) <= F.col("_last"))

    newest = _newest(own.join(bounds, "actor_id"), cap)
    carried = shifted(newest, 1).checkpoint()
    reach = 1
    while reach < longest:
        carried = _newest(carried.unionByName(shifted(carried, reach)), cap).checkpoint()
        reach *= 2
    return carried.select(own.columns)
