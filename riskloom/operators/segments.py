"""Running values over groups too large for one task.

A window function puts a whole group into one task. For groups that may hold a large
share of all rows, the rows are range-partitioned by (group, order) instead. Every
partition then holds one consecutive stretch, a *segment*, of its groups. A running
value is the running value inside the segment combined with the total of the earlier
segments of the same group, and there are only as many totals as (group, segment)
pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir

SEGMENT = "_segment"


def place(rows: DataFrame, segments: int, group: str, order: Sequence[str]) -> DataFrame:
    """Range-partition by (group, order) and number the partitions.

    The range limits come from a sample, so the result is written out once: everything
    that is computed from the numbering reads the same rows, also after a lost task.
    A single segment needs neither.
    """
    if segments == 1:
        return rows.withColumn(SEGMENT, F.lit(0))
    ensure_checkpoint_dir(rows.sparkSession)
    return (
        rows.repartitionByRange(segments, group, *order)
        .withColumn(SEGMENT, F.spark_partition_id())
        .checkpoint()
    )


def with_carry(placed: DataFrame, group: str, totals: dict[str, Column]) -> DataFrame:
    """Add, per row, each total over the earlier segments of its group.

    ``totals`` maps an output name to an aggregate that can be combined with itself:
    a ``sum`` (missing means 0) or a ``max`` (missing means NULL).
    """
    per_segment = placed.groupBy(group, SEGMENT).agg(
        *[total.alias(name) for name, total in totals.items()]
    )
    earlier = (
        Window.partitionBy(group)
        .orderBy(SEGMENT)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    combine = {name: F.max if name.startswith("max") else F.sum for name in totals}
    carried = per_segment.select(
        group,
        SEGMENT,
        *[combine[name](name).over(earlier).alias(name) for name in totals],
    )
    # No broadcast hint: the optimizer sees the size of the totals and decides.
    return placed.join(carried, [group, SEGMENT])


def within(group: str, order: Sequence[str]) -> Window:
    return (
        Window.partitionBy(group, SEGMENT)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
