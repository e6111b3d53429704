"""Stream state as slices: tables of what the batches brought, merged now and then.

A micro-batch is evaluated by the same plan as a batch of events (``operators.timeline``):
the events its actors still hold come first, then the new ones. No state is asked for single
ids or actors and no row goes through Python; the price is that a batch reads the live state
of its columns, so this is for streams whose batches are large, while ``processor`` looks up
single keys of a state store.

What a batch accepted is one slice, written once: its ids are the seen ids of that moment, its
events the histories. Every ``merge_every`` batches the live rest of all slices is written as
one table each of seen ids, held events and largest event times, sorted by actor; slices and
merged tables before the last but one are removed. State before batch n is the newest merged
table before n and the slices between, so a batch that is delivered again finds the state it
found before and replaces its own slice.

*Seen ids* expire ``dedup_ttl_ms`` after the processing time of their batch, and are not
renewed by copies. *Held events* are the ``history_cap`` newest of an actor that its largest
event time has not passed by the longest window, and that the watermark has not: an event at t
is given back when the watermark reaches t + window + 1, whether its actor is heard of or not.
The largest event time of an actor stays.

*Watermark*: per topic and partition the largest event time less ``delay_ms`` and 1, and of
these the least. A partition without records for ``idle_ms`` does not hold it back; it never
falls. Late events are evaluated like others, however far they are behind it.
"""

from __future__ import annotations

import dataclasses
import json
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators.dedup import ACTOR_EVENT, first_arrivals
from riskloom.operators.metrics import signals_of
from riskloom.operators.signals import from_timeline, risk_signals
from riskloom.operators.timeline import RULES_PER_PASS, Evaluation, timeline
from riskloom.sources.records import SOURCE_ORDER

EMISSION_ORDER = [*SOURCE_ORDER, "rule_pos"]
COUNTERS = (
    "accepted_records",
    "quarantined_records",
    "new_events",
    "risk_signals",
    "late_events",
    "capacity_breaches",
    "capacity_evictions",
)

_EVENT = "event_id string, occurred_at timestamp, event_type string, severity int"
_HELD = (
    f"actor_id string, {_EVENT}, attributes map<string,string>, timestamp timestamp, "
    "topic string, partition int, offset bigint"
)
_SLICE = f"{_HELD}, at_ms bigint"
_SEEN = "actor_id string, event_id string, at_ms bigint"
_TOPS = "actor_id string, floor_ms bigint"


class _Known(NamedTuple):
    """State before a batch: a merged table, or none, and the slices after it."""

    merged: int | None
    slices: list[int]
    progress: dict


def _now_ms() -> int:
    return int(time.time() * 1000)


class SlicedState:
    """State of one query in one folder that all machines share."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        spec: Evaluation,
        *,
        dedup_ttl_ms: int = schemas.DEFAULT_TTL_MS,
        merge_every: int = 20,
        delay_ms: int = 10_000,
        idle_ms: int = 60_000,
        clock: Callable[[], int] = _now_ms,
    ) -> None:
        if dedup_ttl_ms <= 0 or merge_every <= 0:
            raise ValueError("dedup TTL and merge interval must be positive")
        self.spark, self.path = spark, path
        self.spec = dataclasses.replace(
            spec, arrival=("phase", *SOURCE_ORDER), dedup=False, floor="floor_ms"
        )
        self.dedup_ttl_ms, self.merge_every = dedup_ttl_ms, merge_every
        self.delay_ms, self.idle_ms, self.clock = delay_ms, idle_ms, clock

    # ---- One batch ------------------------------------------------------------------

    @contextmanager
    def advanced(self, decoded: DataFrame, batch_id: int) -> Iterator[DataFrame]:
        """Take in a batch of decoded records; gives its signals while the block runs.

        The batch counts as taken in when the block ends without an error.
        """
        now, known = self.clock(), self._known(batch_id)
        progress = self._accept(decoded, batch_id, known, now)
        rows, signals = self._evaluated(known, batch_id, progress)
        rows = rows.persist()
        try:
            progress["counters"] |= self._counted(rows, signals)
            signals = from_timeline(rows, self.spec) if signals is None else signals
            yield signals.drop("phase")
            totals = known.progress.get("totals", {})
            progress["totals"] = {
                name: totals.get(name, 0) + progress["counters"][name] for name in COUNTERS
            }
            self._write_progress(batch_id, progress)
            if (batch_id + 1) % self.merge_every == 0:
                self._merge(batch_id, now)
        finally:
            rows.unpersist()

    def _accept(self, decoded: DataFrame, batch_id: int, known: _Known, now: int) -> dict:
        """Write the batch's new events; its partitions, counters and watermark."""
        wanted = sorted({key for rule in self.spec.rules for key in rule.required_attributes})
        event = [F.col(f"event.{c}").alias(c) for c in ("actor_id", "event_id", "occurred_at")]
        held = F.map_filter("event.attributes", lambda k, _: k.isin(wanted))
        incoming = decoded.select(
            *event,
            F.col("event.event_type").alias("event_type"),
            F.col("event.severity").cast("int").alias("severity"),
            (held if wanted else F.create_map().cast("map<string,string>")).alias("attributes"),
            *SOURCE_ORDER,
            F.col("failure_reason").isNull().alias("valid"),
        ).persist()
        try:
            partitions = (
                incoming.groupBy("topic", "partition")
                .agg(
                    F.count_if("valid").alias("accepted"),
                    F.count_if(~F.col("valid")).alias("quarantined"),
                    F.max(F.unix_millis("occurred_at")).alias("reached"),
                )
                .collect()  # one row per partition of the source
            )
            fresh = first_arrivals(incoming.where("valid").drop("valid"), SOURCE_ORDER)
            if known.merged is not None or known.slices:
                fresh = fresh.join(self._seen(known, now), list(ACTOR_EVENT), "left_anti")
            fresh = fresh.withColumn("at_ms", F.lit(now).cast("bigint"))
            fresh.write.mode("overwrite").parquet(self._slice(batch_id))
        finally:
            incoming.unpersist()
        heard = {(p["topic"], p["partition"]): p for p in known.progress.get("partitions", [])}
        for row in partitions:
            before = heard.get((row.topic, row.partition), {})
            reached = [x for x in (row.reached, before.get("reached_ms")) if x is not None]
            heard[row.topic, row.partition] = {
                "topic": row.topic,
                "partition": row.partition,
                "reached_ms": max(reached, default=None),
                "heard_ms": now,
            }
        counters = {
            "accepted_records": sum(p.accepted for p in partitions),
            "quarantined_records": sum(p.quarantined for p in partitions),
        }
        return {
            "partitions": list(heard.values()),
            "watermark_ms": self._watermark(known.progress.get("watermark_ms"), heard, now),
            "counters": counters,
        }

    def _watermark(self, before: int | None, heard: dict, now: int) -> int | None:
        awake = [p["reached_ms"] for p in heard.values() if now - p["heard_ms"] < self.idle_ms]
        if not awake or None in awake:
            return before
        reached = min(awake) - self.delay_ms - 1
        return reached if before is None else max(before, reached)

    def _evaluated(
        self, known: _Known, batch_id: int, progress: dict
    ) -> tuple[DataFrame, DataFrame | None]:
        """Timeline rows of the new events, and the signals where one pass is not enough."""
        # No actor has more rows than have ever been taken in; see ``Evaluation.at_most``.
        ever = known.progress.get("totals", {}).get("new_events", 0)
        ever += progress["counters"]["accepted_records"]
        spec = dataclasses.replace(self.spec, at_most=ever)
        new = self._read(_SLICE, [self._slice(batch_id)]).drop("at_ms")
        if known.merged is None and not known.slices:
            events = new.withColumn("phase", F.lit(1)).withColumn(
                "floor_ms", F.lit(None).cast("bigint")
            )
        else:
            actors = new.select("actor_id").distinct()
            tops = self._tops(known).join(actors, "actor_id", "left_semi")
            held = self._live(known, tops).withColumn("phase", F.lit(0))
            new = new.join(tops, "actor_id", "left").withColumn("phase", F.lit(1))
            events = held.unionByName(new)
        if len(spec.rules) <= RULES_PER_PASS:
            return timeline(events, spec).where("phase = 1"), None
        longest = max(spec.rules, key=lambda rule: rule.window_ms)
        rows = timeline(events, dataclasses.replace(spec, rules=(longest,)))
        return rows.where("phase = 1"), risk_signals(events, spec).where("phase = 1")

    def _counted(self, rows: DataFrame, signals: DataFrame | None) -> dict:
        number = F.sum(signals_of(self.spec)) if signals is None else F.lit(signals.count())
        seen = rows.agg(
            F.count("*").alias("new_events"),
            F.count_if("late").alias("late_events"),
            F.count_if(F.col("evicted") > 0).alias("capacity_breaches"),
            F.coalesce(F.sum("evicted"), F.lit(0)).cast("bigint").alias("capacity_evictions"),
            F.coalesce(number, F.lit(0)).cast("bigint").alias("risk_signals"),
        )
        return seen.first().asDict()

    # ---- State ----------------------------------------------------------------------

    def held(self) -> DataFrame:
        """Events that actors hold now: the columns of a slice without its time."""
        known = self._known(None)
        return self._live(known, self._tops(known)).drop("floor_ms")

    def totals(self) -> DataFrame:
        """The counters of all batches, one row.

        What was new, not late and neither evicted nor is still held has expired.
        """
        totals = self._known(None).progress.get("totals", dict.fromkeys(COUNTERS, 0))
        told = [F.lit(totals[name]).cast("bigint").alias(name) for name in COUNTERS]
        row = self.held().agg(F.count("*").alias("held")).select("held", *told)
        return row.select(
            F.col("accepted_records").alias("accepted_records_total"),
            F.col("quarantined_records").alias("quarantined_records_total"),
            F.col("accepted_records").alias("events_total"),
            (F.col("accepted_records") - F.col("new_events")).alias("duplicates_total"),
            F.col("risk_signals").alias("risk_signals_total"),
            F.expr("new_events - late_events - capacity_evictions - held").alias(
                "history_expired_events_total"
            ),
            F.col("late_events").alias("late_events_beyond_history_total"),
            F.col("capacity_breaches").alias("state_capacity_breaches_total"),
            F.col("capacity_evictions").alias("state_capacity_evictions_total"),
        )

    def watermark_ms(self) -> int | None:
        return self._known(None).progress.get("watermark_ms")

    def _seen(self, known: _Known, now: int) -> DataFrame:
        rows = self._read(_SLICE, map(self._slice, known.slices)).select(*ACTOR_EVENT, "at_ms")
        if known.merged is not None:
            rows = rows.unionByName(self._read(_SEEN, [self._merged("seen", known.merged)]))
        return rows.where(F.col("at_ms") > now - self.dedup_ttl_ms)

    def _tops(self, known: _Known) -> DataFrame:
        """Largest event time of every actor there has been."""
        rows = self._read(_SLICE, map(self._slice, known.slices)).select(
            "actor_id", _event_ms().alias("floor_ms")
        )
        if known.merged is not None:
            rows = rows.unionByName(self._read(_TOPS, [self._merged("tops", known.merged)]))
        return rows.groupBy("actor_id").agg(F.max("floor_ms").alias("floor_ms"))

    def _live(self, known: _Known, tops: DataFrame) -> DataFrame:
        """Held events, with ``floor_ms``, of the actors in ``tops``."""
        rows = self._read(_SLICE, map(self._slice, known.slices)).drop("at_ms")
        if known.merged is not None:
            rows = rows.unionByName(self._read(_HELD, [self._merged("held", known.merged)]))
        end = F.col("floor_ms")
        if (watermark := known.progress.get("watermark_ms")) is not None:
            end = F.greatest(end, F.lit(watermark).cast("bigint"))
        rows = rows.join(tops, "actor_id").where(_event_ms() >= end - self.spec.retention_ms)
        newest = Window.partitionBy("actor_id").orderBy(F.desc("occurred_at"), F.desc("event_id"))
        rows = rows.withColumn("_n", F.row_number().over(newest))
        return rows.where(F.col("_n") <= self.spec.history_cap).drop("_n")

    def _merge(self, batch_id: int, now: int) -> None:
        """Write the live rest of all slices, then remove what no repeat can need."""
        known = self._known(batch_id + 1)
        older = self._ids("merged")
        for kind, rows in (
            ("seen", self._seen(known, now)),
            ("held", self._live(known, self._tops(known)).drop("floor_ms")),
            ("tops", self._tops(known)),  # the last one makes the merge count
        ):
            sorted_ = rows.repartition("actor_id").sortWithinPartitions("actor_id")
            sorted_.write.mode("overwrite").parquet(self._merged(kind, batch_id))
        keep = max((i for i in older if i < batch_id), default=None)
        if keep is not None:
            for kind in ("slice", "merged"):
                for old in (i for i in self._ids(kind) if i <= keep - (kind == "merged")):
                    self._remove(f"{self.path}/{kind}/{old}")

    # ---- Files ----------------------------------------------------------------------

    def _slice(self, batch_id: int) -> str:
        return f"{self.path}/slice/{batch_id}"

    def _merged(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/merged/{batch_id}/{kind}"

    def _read(self, schema: str, paths) -> DataFrame:
        paths = list(paths)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _known(self, before: int | None) -> _Known:
        """State before a batch, or after all of them."""

        def earlier(kind: str) -> list[int]:
            return [i for i in self._ids(kind) if before is None or i < before]

        told = earlier("progress")
        last = max(told, default=None)
        progress = {} if last is None else json.loads(self._text(f"{self.path}/progress/{last}"))
        # A batch whose progress was not written did not happen.
        done = [i for i in earlier("merged") if self._exists(f"{self._merged('tops', i)}/_SUCCESS")]
        merged = max((i for i in done if last is not None and i <= last), default=None)
        slices = [
            i
            for i in earlier("slice")
            if last is not None and i <= last and (merged is None or i > merged)
        ]
        return _Known(merged, sorted(slices), progress)

    def _write_progress(self, batch_id: int, progress: dict) -> None:
        out = self._files().create(self._hadoop(f"{self.path}/progress/{batch_id}"), True)
        out.write(bytearray(json.dumps(progress).encode()))
        out.close()

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._hadoop(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._files().exists(self._hadoop(path))

    def _remove(self, path: str) -> None:
        self._files().delete(self._hadoop(path), True)

    def _text(self, path: str) -> str:
        stream = self._files().open(self._hadoop(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _ids(self, kind: str) -> list[int]:
        folder = f"{self.path}/{kind}"
        if not self._exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files().listStatus(self._hadoop(folder))]
        return [int(name) for name in names if name.isdigit()]


def _event_ms() -> Column:
    return F.unix_millis("occurred_at")
