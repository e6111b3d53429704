"""Tables a stream writes to, safe to repeat batch by batch.

``foreachBatch`` may deliver a batch again after a failure. Every batch writes its own
folder and replaces it when repeated, so a repeat leaves the table unchanged. A stream
that starts over with a new checkpoint counts batches from zero again and needs a new
``writer`` name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators import history, hot_state

_HISTORY = schemas.RISK_SIGNAL.simpleString()[7:-1].replace(":", " ").replace(",", ", ")


class HistoryTable:
    """Append-only signal history, one folder per writer and batch."""

    SCHEMA = f"{_HISTORY}, stored_at timestamp, writer string, batch_id bigint"

    def __init__(self, spark: SparkSession, path: str, writer: str = "main") -> None:
        self.spark, self.path, self.writer = spark, path, writer

    def append(self, signals: DataFrame, batch_id: int) -> None:
        """Sorted by actor first: the row-group statistics then serve actor lookups."""
        rows = signals.select(
            *schemas.RISK_SIGNAL.fieldNames(), F.current_timestamp().alias("stored_at")
        )
        rows.sortWithinPartitions(*history.SORT_KEY).write.mode("overwrite").parquet(
            f"{self.path}/writer={self.writer}/batch_id={batch_id}"
        )

    def read(self) -> DataFrame:
        """All stored rows, replays included."""
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def final(self) -> DataFrame:
        return history.collapsed(self.read())


class HotStateTable:
    """Newest signal per actor with a time to live.

    A batch adds the writes it accepted; the state of an actor is its last accepted
    write. Every ``snapshot_every`` batches the whole live state is written as well, so
    a read takes one snapshot and the batches after it.
    """

    SCHEMA = (
        "key string, actor_id string, emitted_at_ms bigint, payload string, "
        "written_ms bigint, kind string, batch_id bigint"
    )

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        ttl_ms: int = schemas.DEFAULT_TTL_MS,
        snapshot_every: int = 50,
    ) -> None:
        if ttl_ms <= 0:
            raise ValueError("hot state TTL must be positive")
        self.spark, self.path = spark, path
        self.ttl_ms, self.snapshot_every = ttl_ms, snapshot_every
        empty = spark.createDataFrame([], self.SCHEMA).drop("kind", "batch_id")
        empty.write.mode("ignore").parquet(self._folder("snapshot", -1))

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.path}/kind={kind}/batch_id={batch_id}"

    def merge(
        self, signals: DataFrame, batch_id: int, now_ms: int, write_order: list[str]
    ) -> None:
        """Apply one batch of writes at ``now_ms``.

        A write older than the live state of its actor is rejected and renews nothing;
        an equally old one replaces it.
        """
        accepted = hot_state.as_state(hot_state.latest(signals, write_order))
        if self._numbers("batch", batch_id):
            # Only the actors of the batch are ranked; the others' state stays as it is.
            touched = signals.select("actor_id").distinct()
            before = self._live(batch_id, now_ms, touched).select(
                "actor_id", F.col("emitted_at_ms").alias("_held_ms")
            )
            accepted = accepted.join(before, "actor_id", "left").where(
                F.col("_held_ms").isNull() | (F.col("_held_ms") <= F.col("emitted_at_ms"))
            )
        accepted = accepted.select("key", "actor_id", "emitted_at_ms", "payload").withColumn(
            "written_ms", F.lit(now_ms).cast("bigint")
        )
        accepted.write.mode("overwrite").parquet(self._folder("batch", batch_id))
        if (batch_id + 1) % self.snapshot_every == 0:
            live = self._live(batch_id + 1, now_ms).drop("kind", "batch_id")
            live.write.mode("overwrite").parquet(self._folder("snapshot", batch_id))

    def read(self, now_ms: int) -> DataFrame:
        """Live state: key, actor_id, emitted_at_ms, payload, expires_at."""
        return self._live(None, now_ms).select(
            "key",
            "actor_id",
            "emitted_at_ms",
            "payload",
            F.timestamp_millis(F.col("written_ms") + self.ttl_ms).alias("expires_at"),
        )

    def _live(
        self, before_batch: int | None, now_ms: int, actors: DataFrame | None = None
    ) -> DataFrame:
        """The last accepted write of every actor: one snapshot and the batches after it."""
        snapshots = self._numbers("snapshot", before_batch)
        last = max(snapshots, default=-1)
        folders = [self._folder("snapshot", last)] if snapshots else []
        folders += [
            self._folder("batch", i) for i in self._numbers("batch", before_batch) if i > last
        ]
        since = self.spark.read.schema(self.SCHEMA).option("basePath", self.path).parquet(*folders)
        if actors is not None:
            since = since.join(actors, "actor_id", "left_semi")
        order = Window.partitionBy("actor_id").orderBy(F.desc("batch_id"))
        newest = since.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")
        return newest.where(F.col("written_ms") + self.ttl_ms > now_ms)

    def _numbers(self, kind: str, before_batch: int | None) -> list[int]:
        """Batch numbers of the folders of a kind, from their names."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/kind={kind}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path)]
        found = [int(n.split("=", 1)[1]) for n in names if n.startswith("batch_id=")]
        return [i for i in found if before_batch is None or i < before_batch]


class QuarantineTable:
    """Poison evidence, one folder per writer and batch; identities survive repeats."""

    def __init__(self, spark: SparkSession, path: str, writer: str = "main") -> None:
        self.spark, self.path, self.writer = spark, path, writer

    def append(self, evidence: DataFrame, batch_id: int) -> None:
        evidence.write.mode("overwrite").parquet(
            f"{self.path}/writer={self.writer}/batch_id={batch_id}"
        )

    def read(self) -> DataFrame:
        return self.spark.read.schema(schemas.QUARANTINE_EVENT).parquet(self.path)


SignalStore = Callable[[DataFrame, int], None]


def to_stores(*stores: SignalStore) -> Callable[[DataFrame, int], None]:
    """One ``foreachBatch`` function that evaluates a batch once and writes it to all.

    A store is any function of a batch and its number. It must tolerate repeats.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for store in stores:
                try:
                    store(kept, batch_id)
                except Exception as error:
                    raise RuntimeError("risk signal write failed") from error
        finally:
            kept.unpersist()

    return write
