"""Comparison of what a store holds with what it should hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPARED = (
    "signal_id",
    "actor_id",
    "triggering_event_id",
    "rule_id",
    "risk_score",
    "observed_event_count",
    "observed_severity_sum",
)


def canonical_row() -> Column:
    return F.concat_ws("|", *COMPARED)


_LANES = 4


def _tagged(rows: DataFrame, side: str) -> DataFrame:
    """Rows with their SHA-256 cut into 60-bit lanes."""
    digested = rows.select("signal_id", "actor_id", F.sha2(canonical_row(), 256).alias("_d"))
    lanes = [
        F.conv(F.substring("_d", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)").alias(f"_{i}")
        for i in range(_LANES)
    ]
    return digested.select("signal_id", "actor_id", *lanes, F.lit(side).alias("_side"))


def _lane_sums(sides: tuple[str, ...]) -> list[Column]:
    return [
        F.coalesce(F.sum(F.when(F.col("_side") == side, F.col(f"_{i}"))), F.lit(0)).alias(
            f"_{side}_{i}"
        )
        for side in sides
        for i in range(_LANES)
    ]


def compare(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Every signal of either side with its ``outcome``."""
    left = expected.select(F.struct(*COMPARED).alias("expected"), "signal_id")
    right = observed.select(F.struct(*COMPARED).alias("observed"), "signal_id")
    both = left.join(right, "signal_id", "full_outer")
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"expected.{c}").eqNullSafe(F.col(f"observed.{c}")) for c in COMPARED],
    )
    outcome = (
        F.when(F.col("observed").isNull(), "missing")
        .when(F.col("expected").isNull(), "unexpected")
        .when(same, "equal")
        .otherwise("different")
    )
    return both.withColumn("outcome", outcome)


def report(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Signals and actors per outcome, and a checksum per side.

    The checksum of a side adds up the digests of its rows, so it does not depend on
    their order and combines map-side; the reading of a store that sorts its rows is
    not needed. Each side is read once: a signal is equal when both sides hold the
    same number of rows with the same sum of digests.
    """
    sides = ("expected", "observed")
    tagged = [_tagged(rows, side) for side, rows in zip(sides, (expected, observed))]
    counts = [
        F.count_if(F.col("_side") == side).alias(f"_{side}_rows") for side in sides
    ]
    actor = F.max_by("actor_id", "_side").alias("actor_id")  # the observed one, if any
    signals = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("signal_id")
        .agg(*counts, *_lane_sums(sides), actor)
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(f"_expected_{x}") == F.col(f"_observed_{x}") for x in ("rows", *range(_LANES))],
    )
    outcome = (
        F.when(F.col("_observed_rows") == 0, "missing")
        .when(F.col("_expected_rows") == 0, "unexpected")
        .when(same, "equal")
        .otherwise("different")
    )
    summed = [f"_{side}_{x}" for side in sides for x in ("rows", *range(_LANES))]
    outcomes = signals.groupBy(outcome.alias("outcome")).agg(
        F.count("*").alias("records"),
        F.countDistinct("actor_id").alias("actors"),
        *[F.sum(c).cast("decimal(38,0)").alias(c) for c in summed],
    )
    # At most four rows from here on; the rolled-up row has the totals of both sides.
    totals = outcomes.rollup("outcome").agg(
        F.grouping("outcome").alias("_total"),
        F.sum("records").alias("records"),
        F.sum("actors").alias("actors"),
        *[F.sum(c).alias(c) for c in summed],
    )

    def row(name: Column, records: Column, actors: Column, checksum: Column) -> Column:
        return F.struct(
            name.alias("outcome"),
            records.cast("bigint").alias("records"),
            actors.cast("bigint").alias("actors"),
            checksum.cast("string").alias("checksum"),
        )

    def side_row(side: str) -> Column:
        lanes = [F.col(f"_{side}_{i}").cast("string") for i in range(_LANES)]
        records = F.coalesce(F.col(f"_{side}_rows"), F.lit(0))
        return row(F.lit(f"side:{side}"), records, F.lit(None), F.concat_ws("-", *lanes))

    own = F.array(row(F.col("outcome"), F.col("records"), F.col("actors"), F.lit(None)))
    by_side = F.array(*[side_row(side) for side in sides])
    return totals.select(F.inline(F.when(F.col("_total") == 1, by_side).otherwise(own)))
