"""Tasks are as many as the rows ask for, whatever the files and the shuffled bytes are."""

from pyspark.sql import functions as F

from riskloom.operators import timeline as timelines
from riskloom.operators.rules import Rule
from riskloom.operators.timeline import Evaluation, timeline
from riskloom.plans import tables


def _rows_per_task(frame):
    return [r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect()]


def test_rows_of_one_row_group_are_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "TASK_ROWS", 100)
    rows = spark.range(3000).select(
        F.col("id").alias("event_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.lit(5.0).alias("value"),
        F.lit('{"k": 1}').alias("props"),
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")  # many tasks, one with rows
    try:
        table = tables.events_table(spark, str(tmp_path))
        assert table.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert max(_rows_per_task(table)) == 3000
        raw = tables.raw_records(spark, str(tmp_path))
        found = _rows_per_task(raw)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(found) == 3300  # every tenth record comes twice
    assert max(found) < 250


def test_windows_over_actors_take_more_tasks_for_more_rows(spark, monkeypatch):
    monkeypatch.setattr(timelines, "_TASK_ROWS", 50)
    events = spark.range(2000).select(
        (F.col("id") % 200).cast("string").alias("actor_id"),
        F.col("id").cast("string").alias("event_id"),
        F.timestamp_seconds("id").alias("occurred_at"),
        F.lit("view").alias("event_type"),
        F.lit(5).alias("severity"),
        F.create_map().cast("map<string,string>").alias("attributes"),
        F.col("id").alias("arrival"),
    )
    rows = timeline(events, Evaluation((Rule("r", 3_600_000, 1, 0, 10),)))
    found = _rows_per_task(rows)
    assert sum(found) == 2000
    assert max(found) < 300
