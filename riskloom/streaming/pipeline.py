"""The whole stream: raw records to hot state, history and quarantine."""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators import decode, quarantine
from riskloom.operators.timeline import Evaluation
from riskloom.session import settings
from riskloom.sources.records import SOURCE_ORDER
from riskloom.streaming import slices
from riskloom.streaming.processor import stream_signals
from riskloom.streaming.sinks import HistoryTable, HotStateTable, QuarantineTable, to_stores

EMISSION_ORDER = ["arrival", "rule_pos"]


@dataclass(frozen=True)
class Stores:
    hot_state: HotStateTable
    history: HistoryTable
    quarantine: QuarantineTable


def accepted_stream(raw: DataFrame) -> DataFrame:
    return decode.accepted_events(decode.decode_records(raw), *SOURCE_ORDER)


def start_signals(
    raw: DataFrame,
    spec: Evaluation,
    stores: Stores,
    checkpoint: str,
    bounded: bool = False,
    **options: int,
) -> StreamingQuery:
    """Evaluate rules; every micro-batch goes to the hot state and the history.

    ``bounded`` reads what is there now and stops. ``options`` go to
    ``processor.stream_signals``.
    """

    def to_hot_state(batch: DataFrame, batch_id: int) -> None:
        stores.hot_state.merge(batch, batch_id, int(time.time() * 1000), EMISSION_ORDER)

    signals = stream_signals(accepted_stream(raw), spec, **options)
    writer = (
        signals.writeStream.queryName(f"signals-{stores.history.writer}")
        .option("checkpointLocation", f"{checkpoint}/signals")
        .foreachBatch(to_stores(to_hot_state, stores.history.append))
    )
    return _start(raw.sparkSession, writer, bounded)


def start_sliced_signals(
    raw: DataFrame,
    spec: Evaluation,
    stores: Stores,
    checkpoint: str,
    bounded: bool = False,
    **options,
) -> StreamingQuery:
    """As ``start_signals``, with state in slices and every batch evaluated as a batch.

    For streams whose batches are large. ``options`` go to ``slices.SlicedState``.
    """
    state = sliced_state(raw.sparkSession, checkpoint, spec, **options)

    def take_in(batch: DataFrame, batch_id: int) -> None:
        with state.advanced(batch, batch_id) as signals:
            now = int(time.time() * 1000)
            stores.hot_state.merge(signals, batch_id, now, slices.EMISSION_ORDER)
            stores.history.append(signals, batch_id)

    writer = (
        decode.decode_records(raw)
        .writeStream.queryName(f"sliced-signals-{stores.history.writer}")
        .option("checkpointLocation", f"{checkpoint}/sliced")
        .foreachBatch(take_in)
    )
    return _start(raw.sparkSession, writer, bounded)


def sliced_state(
    spark: SparkSession, checkpoint: str, spec: Evaluation, **options
) -> slices.SlicedState:
    """The state of a query that ``start_sliced_signals`` runs or ran."""
    return slices.SlicedState(spark, f"{checkpoint}/slices", spec, **options)


def start_quarantine(
    raw: DataFrame, stores: Stores, checkpoint: str, bounded: bool = False
) -> StreamingQuery:
    """Evidence of poison records. A query of its own, so that neither path waits."""
    evidence = quarantine.evidence(decode.rejected_records(decode.decode_records(raw)))
    writer = (
        evidence.writeStream.queryName(f"quarantine-{stores.quarantine.writer}")
        .option("checkpointLocation", f"{checkpoint}/quarantine")
        .foreachBatch(stores.quarantine.append)
    )
    return _start(raw.sparkSession, writer, bounded)


def quarantine_to_kafka(
    raw: DataFrame, servers: str, topics: list[str], checkpoint: str, topic: str | None = None
) -> StreamingQuery:
    """Evidence to a Kafka topic, by default the first input topic plus a suffix.

    The key is the source coordinate, so consumers can recognise repeated delivery.
    """
    evidence = quarantine.evidence(decode.rejected_records(decode.decode_records(raw)))
    return (
        quarantine.encode(evidence)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic or quarantine.default_topic(topics))
        .option("checkpointLocation", f"{checkpoint}/quarantine")
        .start()
    )


# A processing-time stateful query asks for another empty batch for ever, since a timer
# may be due, and a bounded run would not end. Without empty batches timers fire in
# batches that carry data.
_BOUNDED = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}


def _start(spark: SparkSession, writer, bounded: bool) -> StreamingQuery:
    if not bounded:
        return writer.start()
    with settings(spark, _BOUNDED):
        return writer.trigger(availableNow=True).start()


def pending_records(progress) -> int:
    """Records behind, over all sources of a streaming progress report."""
    behind = 0
    for source in progress.sources:
        done = _offsets(source.endOffset)
        for topic, partitions in _offsets(source.latestOffset).items():
            for partition, offset in partitions.items():
                behind += offset - done.get(topic, {}).get(partition, 0)
    return behind


def _offsets(reported: str | None) -> dict:
    """Kafka's ``{topic: {partition: offset}}``; empty for any other source."""
    try:
        offsets = json.loads(reported or "{}")
    except json.JSONDecodeError:
        return {}
    kafka = isinstance(offsets, dict) and all(isinstance(v, dict) for v in offsets.values())
    return offsets if kafka else {}


def completed_batches(spark: SparkSession, checkpoint: str) -> int:
    """Micro-batches a query has committed, over all its runs.

    Read from the commit log in its checkpoint folder: progress reports are kept for the
    last few batches only. Batch numbers start at 0 and old log files may have been
    removed, so the highest number counts.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return 0
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return max((int(name) + 1 for name in names if name.isdigit()), default=0)
