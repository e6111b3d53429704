"""Exact order statistics, summaries and trends at any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per doubling of the absolute value.
_BUCKETS_PER_DOUBLING = 4096


def _known(rows: DataFrame, value: str) -> DataFrame:
    """Rows with a value: neither NULL nor NaN is one."""
    return rows.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))


def _bucket(value: str) -> Column:
    """A number that never falls as the value grows, of bounded range: its logarithm."""
    number = F.col(value).cast("double")
    height = F.floor(F.log2(F.abs(number) + 1) * _BUCKETS_PER_DOUBLING)
    return F.signum(number) * height


def _ranked_values(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Distinct values per group with the ranks they cover: ``rank_from``..``rank_to``.

    Equal values are counted before anything is ordered, so one value may hold any share
    of the rows. Distinct values are ordered within buckets of their logarithm, and the
    buckets' totals, of which a group has a bounded number, are cumulated.
    """
    counts = _known(rows, value).groupBy(group, value).agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_bucket", _bucket(value))
    totals = counts.groupBy(group, "_bucket").agg(F.sum("_n").alias("_in_bucket"))
    earlier = (
        Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = totals.select(
        group, "_bucket", F.coalesce(F.sum("_in_bucket").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy(group, "_bucket").orderBy(value)
    up_to = F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        counts.join(before, [group, "_bucket"])
        .select(group, value, "_n", (up_to + F.col("_before")).alias("rank_to"))
        .withColumn("rank_from", F.col("rank_to") - F.col("_n") + 1)
    )


def _value_at(value: str, rank: Column) -> Column:
    return F.max(F.when(rank.between(F.col("rank_from"), F.col("rank_to")), F.col(value)))


def _with_totals(ranked: DataFrame, group: str) -> DataFrame:
    totals = ranked.groupBy(group).agg(F.max("rank_to").alias("_total"))
    return ranked.join(totals, group)


def nearest_rank(
    rows: DataFrame, group: str, value: str, quantiles: dict[str, float]
) -> DataFrame:
    """Nearest-rank percentiles per group: the value at rank max(1, ceil(q * n)).

    NULL and NaN are no values; a group without values has no row.
    """
    ranked = _with_totals(_ranked_values(rows, group, value), group)

    def rank(q: float) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.lit(q) * F.col("_total")))

    return ranked.groupBy(group).agg(
        F.max("_total").alias("n"),
        *[_value_at(value, rank(q)).alias(name) for name, q in quantiles.items()],
        F.max(value).alias("max"),
    )


def summary(rows: DataFrame, group: str, value: str) -> DataFrame:
    """n, mean, median, sample deviation, coefficient of variation, min and max.

    NULL and NaN are no values; a group without values has no row.
    """
    rows = _known(rows, value)
    ranked = _with_totals(_ranked_values(rows, group, value), group)
    low = F.floor((F.col("_total") + 1) / 2)
    high = F.floor(F.col("_total") / 2) + 1
    medians = ranked.groupBy(group).agg(
        ((_value_at(value, low) + _value_at(value, high)) / 2).alias("median")
    )
    moments = rows.groupBy(group).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("sample_standard_deviation"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    applicable = F.col("mean") > 0
    variation = F.col("sample_standard_deviation") / F.col("mean") * 100
    return moments.join(medians, group).select(
        group,
        "n",
        "mean",
        "median",
        "sample_standard_deviation",
        applicable.alias("coefficient_of_variation_applicable"),
        F.when(applicable, variation).alias("coefficient_of_variation_percent"),
        "min",
        "max",
    )


def drift(series: DataFrame, group: str, order: Sequence[str], value: str) -> DataFrame:
    """First half against second half of a series, and its least-squares slope.

    ``series`` is an already aggregated series (one value per run or per time bucket),
    so a group is as long as its number of buckets.
    """
    by_order = Window.partitionBy(group).orderBy(*order)
    numbered = series.withColumn("_i", F.row_number().over(by_order)).withColumn(
        "_size", F.count("*").over(Window.partitionBy(group))
    )
    first_half = F.col("_i") <= F.floor(F.col("_size") / 2)
    first = F.avg(F.when(first_half, F.col(value)))
    second = F.avg(F.when(~first_half, F.col(value)))
    means = numbered.groupBy(group).agg(
        F.count("*").alias("n"),
        first.alias("first_half_mean"),
        second.alias("second_half_mean"),
        F.regr_slope(F.col(value).cast("double"), F.col("_i").cast("double")).alias("_slope"),
    )
    change = F.when(F.col("first_half_mean") == 0, F.lit(0.0)).otherwise(
        (F.col("second_half_mean") - F.col("first_half_mean"))
        / F.col("first_half_mean")
        * 100
    )
    two_halves = F.col("n") > 1
    return means.select(
        group,
        "n",
        F.when(two_halves, F.col("first_half_mean")).alias("first_half_mean"),
        F.when(two_halves, F.col("second_half_mean")).alias("second_half_mean"),
        F.when(two_halves, change).alias("second_half_vs_first_half_percent"),
        F.when(two_halves, F.coalesce("_slope", F.lit(0.0))).alias("linear_slope"),
    )
