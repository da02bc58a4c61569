"""Exact quantiles that never gather a group in one task."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayloom.session import shared_dir


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct value, combined in the map tasks."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))


def exact_quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` per group; output name -> probability.

    The built-in exact percentile keeps all distinct values of a group in one task's memory. Here the
    distinct values are range-partitioned by (group, value), so a large group spreads over many tasks.
    Each range counts on its own; ranges learn their starting rank from the range totals, of which
    there is one per group and range. The ranges are written to the checkpoint folder once, because
    both steps must see the same ranges.
    """
    shared_dir(df.sparkSession)
    ranges = (
        value_counts(df, value, by)
        .repartitionByRange(*by, value)
        .withColumn("_range", F.spark_partition_id())
        .checkpoint()
    )
    totals = ranges.groupBy(*by, "_range").agg(F.sum("_n").alias("_rows"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *by,
        "_range",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_rows").over(group).alias("_total"),
    )
    within = Window.partitionBy(*by, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.join(starts, [*by, "_range"]).withColumn(
        "_before", F.col("_start") + F.coalesce(F.sum("_n").over(within), F.lit(0))
    )

    def at(rank):
        return F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n")), F.col(value)))

    picks = []
    for name, probability in probabilities.items():
        place = (F.col("_total") - 1) * F.lit(float(probability))
        picks += [
            at(F.floor(place)).alias(f"_low_{name}"),
            at(F.ceil(place)).alias(f"_high_{name}"),
            F.max(place - F.floor(place)).alias(f"_part_{name}"),
        ]
    found = placed.groupBy(*by).agg(*picks)
    return found.select(
        *by,
        *[
            (F.col(f"_low_{n}") + (F.col(f"_high_{n}") - F.col(f"_low_{n}")) * F.col(f"_part_{n}")).alias(n)
            for n in probabilities
        ],
    )
