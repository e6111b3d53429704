"""Tables between two jobs, in the folder that all machines of the cluster share.

They cut lineage like ``DataFrame.checkpoint``, but as Parquet. ``spark.checkpoint.dir``
names the folder; the tables of an application lie in one sub-folder, which ``clear``
removes when their readers are done.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskloom.session import ensure_checkpoint_dir

_SETTING = "spark.checkpoint.dir"


def folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    shared = context.getConf().get(_SETTING)
    if shared is None:  # tests and single machines only: ensure_checkpoint_dir says so
        ensure_checkpoint_dir(spark)
        shared = context.getCheckpointDir()
    return f"{shared.rstrip('/')}/tables-{context.applicationId}"


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write the frame and return the written table."""
    spark = frame.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files and broadcasts of frames nobody holds any more.

    Its cleaner acts when the driver collects garbage, which a driver with little to do
    may not do for long; a loop over written tables calls this once a round.
    """
    gc.collect()
    spark._jvm.System.gc()


def remove(table: DataFrame) -> None:
    """Remove a staged table once everything made of it is written itself."""
    spark = table.sparkSession
    files = table.inputFiles()
    if files:
        path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Remove all tables this application has staged."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
