"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results. They are runtime settings, so they can also be
# applied to a session somebody else created.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # The wire contract keeps the last of two equal JSON keys.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Needed by the stateful stream. Uploading only changes makes commits cheap.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to an existing session."""
    for key, value in REQUIRED_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def prepare_streaming(spark: SparkSession) -> SparkSession:
    """Settings for stateful streams, on top of ``prepare``."""
    for key, value in STREAM_SETTINGS.items():
        spark.conf.set(key, value)
    return prepare(spark)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Runtime settings for a while. A stream keeps those it was started with."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def local_session(
    app_name: str = "riskloom", cores: int | str = "*", **extra: str
) -> SparkSession:
    """A single-machine session for tests and bench.py.

    On a cluster, create the session with spark-submit and call ``prepare``.
    """
    cpus = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**REQUIRED_SETTINGS, **STREAM_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable.

    A cluster names its shared folder in ``spark.checkpoint.dir``, and Spark picks
    that up by itself. Only a local session without it gets a temporary folder,
    because no other machine has to read it back.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = context.getConf().get("spark.checkpoint.dir")
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all nodes share")
        configured = tempfile.mkdtemp(prefix="riskloom-checkpoint-")
    context.setCheckpointDir(configured)
