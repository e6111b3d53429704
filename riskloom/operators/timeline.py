"""Rolling rule windows in arrival order.

For every accepted event, in arrival order per actor:

* ``max_ms`` is the largest event time seen so far by the actor, over all events;
* the history is what arrived so far and is not older than ``max_ms`` minus the longest
  window, bounded by the history cap;
* a rule counts the matching history that is not older than ``max_ms`` minus its window.

``max_ms`` never falls, so an event leaves a window at one point of the arrival order
and never returns. Every event therefore contributes +1 where it arrives and -1 at the
point where ``max_ms`` first passes its time plus the window, and a running sum over
both kinds of points gives all counts in a single sort. No self join is needed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions.instants import micros_to_millis
from riskloom.operators import segments
from riskloom.operators.capacity import evictions, with_evictions
from riskloom.operators.dedup import first_arrivals
from riskloom.operators.rules import Rule, validate_rules
from riskloom.session import ensure_checkpoint_dir

# Beyond the whole range of timestamps, so a longer window changes nothing and sums
# with an event time stay inside 64 bits.
_LONGEST_WINDOW_MS = 10**15
# Rules per pass: each takes one bit of the match mask and two running sums.
RULES_PER_PASS = 32
# Rows that one task of the windows over whole actors is given, about.
_TASK_ROWS = 200_000
# A shuffle cannot have any number of partitions; beyond this, segments grow instead.
_MOST_SEGMENTS = 50_000
_FLOOR = "_floor_ms"
_CAPPED_ORDER = ["point_ms", "is_arrival", "point_pos", "is_reading"]
# Up to this many large actors the list is small enough to send to every executor.
_BROADCAST_ACTORS = 200_000


@dataclass(frozen=True)
class Evaluation:
    """What to evaluate and where one task stops being enough for one actor.

    ``arrival`` names the columns whose order is the arrival order; they must be unique
    per row, and may end in event_id. An actor with more than ``actor_rows`` rows is
    split into segments. ``stage_input`` writes the few columns that are needed to the
    checkpoint folder first: right when the events are expensive to produce, such as
    decoded records, because they are read twice (actors are counted first).
    ``dedup=False`` is for events that ``dedup.accepted_arrivals`` has already passed.
    ``floor`` names a column with the largest event time (ms, or NULL) that the actor had
    reached before these events, the same in all its rows. ``at_most`` is a number of rows
    that no actor can exceed, where one is known: actors are not counted if it is small.
    """

    rules: tuple[Rule, ...]
    arrival: tuple[str, ...] = ("arrival",)
    history_cap: int = schemas.DEFAULT_HISTORY_CAP
    actor_rows: int = 500_000
    dedup: bool = True
    stage_input: bool = False
    floor: str | None = None
    at_most: int | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "rules", validate_rules(self.rules, self.history_cap))

    @property
    def carried(self) -> tuple[str, ...]:
        """Arrival columns besides the event id, which every row has anyway."""
        return tuple(c for c in self.arrival if c != "event_id")

    @property
    def retention_ms(self) -> int:
        return max(_window(rule) for rule in self.rules)


def _window(rule: Rule) -> int:
    return min(rule.window_ms, _LONGEST_WINDOW_MS)


def timeline(events: DataFrame, spec: Evaluation) -> DataFrame:
    """One row per accepted event with its window end and rolling history.

    Columns: actor_id, event_id, the arrival columns, occurred_us, severity, max_ms,
    late, evicted, history_n, history_sum, and for rule i: match_i, n_i, sum_i.
    ``signals.risk_signals`` takes policies of any length; this is one pass of it.
    """
    if len(spec.rules) > RULES_PER_PASS + 1:
        raise ValueError(f"more than {RULES_PER_PASS} rules in one pass")
    slim = events.select(
        "actor_id",
        "event_id",
        *spec.carried,
        F.unix_micros("occurred_at").alias("occurred_us"),
        "severity",
        _match_mask(spec.rules).alias("mask"),
        *([F.col(spec.floor).alias(_FLOOR)] if spec.floor else []),
    )
    if spec.stage_input:
        ensure_checkpoint_dir(slim.sparkSession)
        slim = events = slim.checkpoint()
    parts = _by_size(slim, events, spec)
    done = [_one_task_per_actor(parts.plain, spec, False, parts.tasks)]
    if parts.capped is not None:
        done.append(_one_task_per_actor(parts.capped, spec, True, parts.tasks))
    if parts.large is not None:
        done.append(_many_tasks_per_actor(parts, spec))
    return reduce(DataFrame.unionByName, done)


def _match_mask(rules: Sequence[Rule]) -> Column:
    """Matching rules as bits, so that no event column but the mask is shuffled."""
    event_type, attributes = F.col("event_type"), F.col("attributes")
    mask = F.lit(0).cast("bigint")
    for bit, rule in enumerate(rules):
        mask += F.when(rule.matches(event_type, attributes), F.lit(1 << bit)).otherwise(0)
    return mask


@dataclass(frozen=True)
class _Parts:
    """Rows by what their actor needs. Absent parts are None."""

    plain: DataFrame  # fits one task and can never fill its history
    capped: DataFrame | None  # fits one task
    large: DataFrame | None  # does not fit one task
    large_rows: int = 0
    large_can_fill: bool = False
    tasks: int | None = None  # of the plain and the capped part; None: few rows


def _by_size(slim: DataFrame, events: DataFrame, spec: Evaluation) -> _Parts:
    """One count per actor decides; only unusually large actors leave the plain part."""
    cap, limit = spec.history_cap, spec.actor_rows
    if spec.at_most is not None and spec.at_most <= min(cap, limit):
        return _Parts(slim, None, None)
    rows = F.col("_rows")
    counts = events.groupBy("actor_id").agg(F.count("*").alias("_rows"))
    unusual = rows > min(cap, limit)
    found = counts.agg(
        F.count_if(unusual).alias("actors"),
        F.count_if(rows > limit).alias("large"),
        F.sum(F.when(rows > limit, rows)).alias("large_rows"),
        F.max(rows).alias("most"),
        F.coalesce(F.sum(rows), F.lit(0)).alias("all_rows"),
    ).first()
    cores = slim.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, math.ceil(found.all_rows / _TASK_ROWS))
    if found.actors == 0:
        return _Parts(slim, None, None, tasks=tasks)
    listed = counts.where(unusual).select("actor_id", (rows > limit).alias("_large"))
    if found.actors <= _BROADCAST_ACTORS:
        schema = "actor_id string, _large boolean"
        listed = F.broadcast(slim.sparkSession.createDataFrame(listed.collect(), schema))
    else:  # too many to send around; the joins shuffle instead
        ensure_checkpoint_dir(slim.sparkSession)
        listed = listed.checkpoint()
    plain = slim.join(listed, "actor_id", "left_anti")

    def of(large: bool) -> DataFrame:
        wanted = listed.where(F.col("_large") if large else ~F.col("_large"))
        return slim.join(wanted, "actor_id", "left_semi")

    return _Parts(
        plain,
        of(False) if found.actors > found.large else None,
        of(True) if found.large else None,
        found.large_rows or 0,
        found.most > cap,
        tasks,
    )


def _one_task_per_actor(
    slim: DataFrame, spec: Evaluation, capped: bool, tasks: int | None
) -> DataFrame:
    """Duplicate removal, running maximum and window sums after a single shuffle.

    All window steps are partitioned by actor (or finer), so the one exchange on
    actor_id serves them all; explode keeps the partitioning. Only actors that may
    fill their history pass through Python, and are shuffled once more after it.

    The tasks are as many as the rows ask for: a row needs many times its shuffled bytes
    in the windows, so a number that follows the bytes would let tasks grow.
    """
    rows = slim.repartition(*([] if tasks is None else [tasks]), "actor_id")
    if spec.dedup:
        rows = first_arrivals(rows, spec.arrival)
    arrival_order = Window.partitionBy("actor_id").orderBy(*spec.arrival)
    so_far = arrival_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("max_ms", F.max(_reached(spec)).over(so_far)).drop(_FLOOR)
    if capped:
        rows = rows.withColumn("pos", F.row_number().over(arrival_order).cast("bigint"))
        rows = with_evictions(rows, spec.history_cap, spec.retention_ms)
        order = _CAPPED_ORDER
    else:
        rows = rows.withColumn("evicted", F.lit(0))
        order = ["point_ms", "is_arrival", *spec.arrival]
    sums = _running(_deltas(spec, capped), "actor_id", order)
    return _arrivals_only(_points(rows, spec, capped).selectExpr("*", *sums), spec)


def _many_tasks_per_actor(parts: _Parts, spec: Evaluation) -> DataFrame:
    """The same over segments; see ``segments``. Arrival order is split first, for the
    running maximum, then the order of the points, for the running sums."""
    capped = parts.large_can_fill
    pieces = min(math.ceil(parts.large_rows / spec.actor_rows), _MOST_SEGMENTS)
    rows = first_arrivals(parts.large, spec.arrival) if spec.dedup else parts.large
    placed = segments.place(rows, pieces, "actor_id", spec.arrival)
    placed = segments.with_carry(placed, "actor_id", {"max_before": F.max(_reached(spec))})
    order = segments.within("actor_id", spec.arrival)
    number = F.row_number().over(order).cast("bigint")
    arrivals = placed.select(
        *rows.columns,
        segments.SEGMENT,
        (F.shiftleft(F.col(segments.SEGMENT).cast("bigint"), 40) + number).alias("pos"),
        F.greatest("max_before", F.max(_reached(spec)).over(order)).alias("max_ms"),
    ).drop(_FLOOR)
    if capped:
        arrivals = _pushed_out(arrivals.checkpoint(), spec)
    else:
        arrivals = arrivals.withColumn("evicted", F.lit(0))

    points = _points(arrivals.drop(segments.SEGMENT), spec, capped, segmented=True)
    order_columns = _CAPPED_ORDER if capped else ["point_ms", "is_arrival", *spec.arrival]
    deltas = _deltas(spec, capped)
    points = segments.place(points, 2 * pieces, "actor_id", order_columns)
    points = segments.with_carry(
        points, "actor_id", {f"before_{n}": F.expr(f"sum({d})") for n, d in deltas.items()}
    )
    sums = _running(deltas, f"actor_id, {segments.SEGMENT}", order_columns)
    kept = [_quoted(c) for c in points.columns if not c.startswith("before_")]
    totals = [f"{n} + coalesce(before_{n}, 0) AS {n}" for n in deltas]
    return _arrivals_only(points.selectExpr("*", *sums).selectExpr(*kept, *totals), spec)


def _pushed_out(arrivals: DataFrame, spec: Evaluation) -> DataFrame:
    """Adds evictor_pos, evictor_ms and evicted, as ``capacity.with_evictions`` does."""
    pushed = evictions(arrivals, spec.history_cap).checkpoint()
    victims = pushed.select(
        "actor_id", F.col("victim_pos").alias("pos"), "evictor_pos", "evictor_ms"
    )
    held = micros_to_millis(F.col("victim_us")) >= F.col("evictor_ms") - spec.retention_ms
    evicting = pushed.where(held).select(
        "actor_id", F.col("evictor_pos").alias("pos"), F.lit(1).alias("evicted")
    )
    return (
        arrivals.join(victims, ["actor_id", "pos"], "left")
        .join(evicting, ["actor_id", "pos"], "left")
        .withColumn("evicted", F.coalesce("evicted", F.lit(0)))
    )


# ---- Points and running sums, shared by both ----------------------------------------


def _event_ms() -> Column:
    return micros_to_millis(F.col("occurred_us"))


def _reached(spec: Evaluation) -> Column:
    return F.greatest(_event_ms(), _FLOOR) if spec.floor else _event_ms()


def _bit(index: int) -> str:
    return f"(mask & {1 << index}L) <> 0"


def _points(
    rows: DataFrame, spec: Evaluation, capped: bool, segmented: bool = False
) -> DataFrame:
    """One arrival point per event and one leaving point per event and window length.

    With a capacity, an event that is pushed out before it expires leaves at the
    arrival that pushed it out, just before that arrival is read; an event pushed out
    by its own arrival never enters.
    """
    event_ms, max_ms = F.col("event_ms"), F.col("max_ms")
    enters = F.lit(True)
    if capped:
        enters = F.coalesce(F.col("evictor_pos") != F.col("pos"), F.lit(True))
    rows = rows.withColumn("event_ms", _event_ms()).withColumn("enters", enters)
    # Leaving points carry nothing that is only read at an arrival. In segments they
    # keep their place in arrival order, so that equal times can be split as well.
    payload = ["event_id", "occurred_us", "evicted", *spec.carried]
    placing = spec.arrival if segmented and not capped else ()
    empty = [
        F.col(c) if c in placing else F.lit(None).cast(rows.schema[c].dataType).alias(c)
        for c in payload
    ]

    def point(ms: Column, is_arrival: Column, window: int, columns: list, pos, reading):
        place = [ms.alias("point_ms"), is_arrival.alias("is_arrival")]
        if capped:
            place += [pos.alias("point_pos"), F.lit(reading).alias("is_reading")]
        return F.struct(*place, F.lit(window).alias("window_ms"), *columns)

    own_pos = F.col("pos") if capped else None
    arriving = point(
        max_ms, F.lit(1), 0, [F.col(c) for c in payload], own_pos, 1
    )
    leaving = []
    for window, rule_bits in _windows(spec).items():
        expires = event_ms + F.lit(window + 1)
        used = (event_ms >= max_ms - window) & F.col("enters")
        if window != spec.retention_ms:
            used &= F.col("mask").bitwiseAND(rule_bits) != 0
        if capped:
            pushed = F.coalesce(F.col("evictor_ms") < expires, F.lit(False))
            left = point(
                F.when(pushed, F.col("evictor_ms")).otherwise(expires),
                F.when(pushed, 1).otherwise(0),
                window,
                empty,
                F.when(pushed, F.col("evictor_pos")).otherwise(own_pos),
                0,
            )
        else:
            left = point(expires, F.lit(0), window, empty, None, 0)
        leaving.append(F.when(used, left))
    kept = ["actor_id", "severity", "mask", "event_ms", "max_ms", "enters"]
    return rows.select(
        *kept, F.explode(F.array(arriving, *leaving)).alias("_point")
    ).where("_point IS NOT NULL").select(*kept, "_point.*")


def _windows(spec: Evaluation) -> dict[int, int]:
    """Window lengths with the bits of the rules that use them."""
    windows: dict[int, int] = {}
    for bit, rule in enumerate(spec.rules):
        windows[_window(rule)] = windows.get(_window(rule), 0) | (1 << bit)
    return windows


def _deltas(spec: Evaluation, capped: bool) -> dict[str, str]:
    """Change of every running value at a point, as SQL text."""
    arrival = "is_reading = 1" if capped else "is_arrival = 1"

    def change(window: int, counted: str, amount: str) -> str:
        inside = f"enters AND event_ms >= max_ms - {window}"
        return (
            f"CASE WHEN NOT ({counted}) THEN 0 "
            f"WHEN {arrival} THEN CASE WHEN {inside} THEN {amount} ELSE 0 END "
            f"WHEN window_ms = {window} THEN -{amount} ELSE 0 END"
        )

    one, severity = "1L", "CAST(severity AS BIGINT)"
    deltas = {
        "history_n": change(spec.retention_ms, "true", one),
        "history_sum": change(spec.retention_ms, "true", severity),
    }
    for bit, rule in enumerate(spec.rules):
        deltas[f"n_{bit}"] = change(_window(rule), _bit(bit), one)
        deltas[f"sum_{bit}"] = change(_window(rule), _bit(bit), severity)
    return deltas


def _quoted(column: str) -> str:
    return f"`{column}`"


def _running(deltas: dict[str, str], group: str, order: Sequence[str]) -> list[str]:
    """Sums of the deltas from the first point up to each point, as SQL text."""
    window = (
        f"PARTITION BY {group} ORDER BY {', '.join(map(_quoted, order))} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    )
    return [f"sum({delta}) OVER ({window}) AS {name}" for name, delta in deltas.items()]


def _arrivals_only(points: DataFrame, spec: Evaluation) -> DataFrame:
    reading = "is_reading" if "is_reading" in points.columns else "is_arrival"
    per_rule = []
    for bit in range(len(spec.rules)):
        per_rule += [f"{_bit(bit)} AS match_{bit}", f"n_{bit}", f"sum_{bit}"]
    return points.where(f"{reading} = 1").selectExpr(
        "actor_id",
        "event_id",
        *map(_quoted, spec.carried),
        "occurred_us",
        "severity",
        "max_ms",
        f"event_ms < max_ms - {spec.retention_ms} AS late",
        "evicted",
        "history_n",
        "history_sum",
        *per_rule,
    )
