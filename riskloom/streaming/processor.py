"""Stateful rule evaluation of a stream.

Runs in processing-time mode on purpose: event-time mode would drop events behind the
watermark, which must still be evaluated, and state may only expire by processing time.
The watermark is only read for cleaning up actors that have gone quiet.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskloom import schemas
from riskloom.functions.identity import signal_id
from riskloom.operators.rules import Rule
from riskloom.operators.timeline import Evaluation
from riskloom.sources.records import SOURCE_ORDER
from riskloom.streaming.windows import ActorWindows, Held, signal_row

WATERMARK_DELAY = "10 seconds"

_EMITTED = T.StructType(
    [
        T.StructField("actor_id", T.StringType()),
        T.StructField("triggering_event_id", T.StringType()),
        T.StructField("rule_id", T.StringType()),
        T.StructField("risk_score", T.IntegerType()),
        T.StructField("reason", T.StringType()),
        T.StructField("observed_event_count", T.LongType()),
        T.StructField("observed_severity_sum", T.LongType()),
        T.StructField("emitted_ms", T.LongType()),
        T.StructField("arrival", T.LongType()),
        T.StructField("rule_pos", T.IntegerType()),
    ]
)
_HELD = "occurred_us long, event_id string, severity int, matched string"


_ROW = T.StructType(
    [
        T.StructField("actor_id", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("occurred_us", T.LongType()),
        T.StructField("severity", T.IntegerType()),
        T.StructField("matched", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("watermark_ms", T.LongType()),
    ]
)


class DuplicateFilter(StatefulProcessor):
    """Passes the first arrival of an actor's event id; forgets it after a time to live.

    Keyed by a hash of actor and event id: asking the state for every single id is the
    expensive part, and this way the ids of a busy actor are spread over all tasks.
    Rows are stamped with the watermark, which a second stateful operator cannot ask
    for.
    """

    def __init__(self, ttl_ms: int) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        identity = "actor_id string, event_id string"
        self.seen = handle.getMapState("seen", identity, "at long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(rows).sort_values(list(SOURCE_ORDER), kind="stable")
        batch = batch.drop_duplicates(["actor_id", "event_id"])
        now = (timerValues.getCurrentProcessingTimeInMs(),)
        fresh = []
        for identity in zip(batch["actor_id"], batch["event_id"]):
            fresh.append(not self.seen.containsKey(identity))
            if fresh[-1]:
                self.seen.updateValue(identity, now)
        passed = batch.loc[fresh]
        watermark_ms = timerValues.getCurrentWatermarkInMs()
        yield passed.assign(watermark_ms=watermark_ms)[_ROW.fieldNames()]

    def close(self) -> None:
        pass


class RuleProcessor(StatefulProcessor):
    """Per actor: rolling history and largest event time.

    The history state is read once and appended to once per micro-batch. What has
    expired or was pushed out by the cap is recognised when it is read, and the state
    is rewritten only when most of it is dead.

    Quiet actors are cleaned up by a timer, up to the watermark on the rows that other
    actors of the same task bring into the micro-batch; without any, it tries later.
    """

    def __init__(
        self, rules: Sequence[Rule], cap: int, cleanup_ms: int, slack_ms: int
    ) -> None:
        self.rules, self.cap = tuple(rules), cap
        self.cleanup_ms, self.slack_ms = cleanup_ms, slack_ms
        self.retention_ms = max(rule.window_ms for rule in rules)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.watermark_ms = handle, None
        self.history = handle.getListState("history", _HELD)
        # Largest event time, rows in the history state, whether a timer is set.
        self.progress = handle.getValueState("progress", "max_ms long, stored long, timer boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        actor = key[0]
        max_ms, stored, timer = self._progress()
        batch = pd.concat(rows).sort_values(list(SOURCE_ORDER), kind="stable")
        self.watermark_ms = max(self.watermark_ms or 0, int(batch["watermark_ms"].max()))
        held = (Held(*entry) for entry in self.history.get()) if stored else ()
        windows = ActorWindows(self.rules, self.cap, max_ms, held)
        events = [
            Held(*row) for row in batch[list(Held._fields)].itertuples(index=False, name=None)
        ]
        emitted = []
        for arrival, event in enumerate(events):
            for pos, count, total, evicted in windows.arrive(event):
                what = signal_row(self.rules, self.cap, pos, count, total, evicted)
                emitted.append(
                    (actor, event.event_id, *what, count, total, windows.max_ms, arrival, pos)
                )
        live = windows.history.events
        if stored + len(events) > 2 * len(live) + 64:
            self._store(live)
            stored = len(live)
        else:
            self.history.appendList([tuple(e) for e in events])
            stored += len(events)
        if live and not timer:
            self._set_timer(timerValues)
            timer = True
        self.progress.update((windows.max_ms, stored, timer))
        yield pd.DataFrame(emitted, columns=_EMITTED.fieldNames())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Reclaim history the watermark has passed; the largest event time stays."""
        max_ms, _, _ = self._progress()
        cutoff_ms = max_ms - self.retention_ms
        if self.watermark_ms is not None:
            cutoff_ms = max(cutoff_ms, self.watermark_ms - self.retention_ms - self.slack_ms)
        held = [Held(*entry) for entry in self.history.get()]
        live = [e for e in held if e.occurred_us >= cutoff_ms * 1000]
        if len(live) < len(held):
            self._store(live)
        if live:
            self._set_timer(timerValues)
        self.progress.update((max_ms, len(live), bool(live)))
        yield pd.DataFrame([], columns=_EMITTED.fieldNames())

    def close(self) -> None:
        pass

    def _progress(self) -> tuple[int | None, int, bool]:
        return self.progress.get() if self.progress.exists() else (None, 0, False)

    def _set_timer(self, timerValues) -> None:
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.cleanup_ms)

    def _store(self, events: Sequence[Held]) -> None:
        if events:
            self.history.put([tuple(e) for e in events])
        else:
            self.history.clear()


def stream_signals(
    events: DataFrame,
    spec: Evaluation,
    dedup_ttl_ms: int = schemas.DEFAULT_TTL_MS,
    cleanup_ms: int = 60_000,
    slack_ms: int = 0,
    seen_buckets: int = 64,
) -> DataFrame:
    """Signals of a stream of accepted events that kept their source coordinates.

    Records of one actor within a micro-batch are taken in source order: record time,
    topic, partition, offset. ``slack_ms`` delays the clean-up of quiet actors for
    sources whose partitions run far apart, as Spark's watermark follows the fastest.
    ``seen_buckets`` bounds how many tasks share the duplicate filter; give several per
    core, and keep it for the life of a checkpoint.
    """
    if dedup_ttl_ms <= 0:
        raise ValueError("dedup TTL must be positive")
    matched = [
        F.when(rule.matches(F.col("event_type"), F.col("attributes")), "1").otherwise("0")
        for rule in spec.rules
    ]
    bucket = F.pmod(F.xxhash64("actor_id", "event_id"), F.lit(seen_buckets))
    # Only numbers and texts go to Python: pandas cannot hold every instant Spark can.
    order = [F.unix_micros(c).alias(c) if c == "timestamp" else F.col(c) for c in SOURCE_ORDER]
    slim = events.withWatermark("occurred_at", WATERMARK_DELAY).select(
        "actor_id",
        "event_id",
        F.unix_micros("occurred_at").alias("occurred_us"),
        F.col("severity").cast("int").alias("severity"),
        F.concat(*matched).alias("matched"),
        *order,
        bucket.alias("bucket"),
    )
    fresh = slim.groupBy("bucket").transformWithStateInPandas(
        DuplicateFilter(dedup_ttl_ms),
        outputStructType=_ROW,
        outputMode="append",
        timeMode="ProcessingTime",
    )
    emitted = fresh.groupBy("actor_id").transformWithStateInPandas(
        RuleProcessor(spec.rules, spec.history_cap, cleanup_ms, slack_ms),
        outputStructType=_EMITTED,
        outputMode="append",
        timeMode="ProcessingTime",
    )
    return emitted.select(
        signal_id(F.col("triggering_event_id"), F.col("rule_id")).alias("signal_id"),
        *[c for c in _EMITTED.fieldNames() if c not in ("emitted_ms", "arrival", "rule_pos")],
        F.timestamp_millis("emitted_ms").alias("emitted_at"),
        "arrival",
        "rule_pos",
    )
