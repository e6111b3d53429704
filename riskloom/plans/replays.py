"""Queries that run the stream itself over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom import schemas
from riskloom.operators.decode import accepted_events, decode_records
from riskloom.operators.timeline import Evaluation
from riskloom.plans import tables
from riskloom.plans.tables import POLICY
from riskloom.session import ensure_checkpoint_dir, prepare_streaming, settings
from riskloom.sources import records
from riskloom.streaming import pipeline
from riskloom.streaming.sinks import HistoryTable, HotStateTable, QuarantineTable
from riskloom.streaming.slices import SlicedState

_RAW = [f.name for f in schemas.RAW_RECORD]


class Replay:
    """The raw records of the tables, streamed into fresh stores in the shared folder.

    With several slices the records arrive slice by slice in arrival order, and the
    query is stopped and resumed from its checkpoint in between. ``sliced_state`` keeps the
    state in slices instead of a state store.
    """

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        slices: int = 1,
        cap: int = schemas.DEFAULT_HISTORY_CAP,
        sliced_state: bool = False,
        **options: int,
    ) -> None:
        prepare_streaming(spark)
        ensure_checkpoint_dir(spark)
        root = f"{spark.sparkContext.getCheckpointDir()}/replay-{uuid.uuid4()}"
        self.checkpoint, self.records = f"{root}/checkpoint", f"{root}/records"
        self.spark = spark
        self.stores = pipeline.Stores(
            HotStateTable(spark, f"{root}/hot-state"),
            HistoryTable(spark, f"{root}/history"),
            QuarantineTable(spark, f"{root}/quarantine"),
        )
        raw = tables.raw_records(spark, sf_dir)
        first, last = raw.agg(F.min("arrived_us"), F.max("arrived_us")).first()
        step = (last - first) // slices + 1
        self.spec, self.sliced_state = Evaluation(POLICY, history_cap=cap), sliced_state
        self.options = options
        for i in range(slices):
            arrived = F.col("arrived_us").between(first + i * step, first + (i + 1) * step - 1)
            raw.where(arrived).select(_RAW).write.mode("append").parquet(self.records)
            self._start().awaitTermination()

    def _start(self) -> StreamingQuery:
        """Starts the query with a state partition per core; a query keeps the settings
        it was started with."""
        per_core = {"spark.sql.shuffle.partitions": str(self.spark.sparkContext.defaultParallelism)}
        with settings(self.spark, per_core):
            stream = records.file_stream(self.spark, self.records)
            start = pipeline.start_signals
            if self.sliced_state:
                start = pipeline.start_sliced_signals
            return start(
                stream, self.spec, self.stores, self.checkpoint, bounded=True, **self.options
            )

    def events(self) -> DataFrame:
        raw = records.file_batch(self.spark, self.records)
        return accepted_events(decode_records(raw))

    def state(self) -> SlicedState:
        """What the query has kept, of a query with sliced state."""
        return pipeline.sliced_state(self.spark, self.checkpoint, self.spec, **self.options)
