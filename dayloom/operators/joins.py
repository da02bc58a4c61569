"""Joins beyond a plain equi-join."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom.session import shared_dir


def outer_chain(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Full outer join of all frames, keys coalesced."""
    return reduce(lambda left, right: left.join(right, list(on), "full"), frames)


def choose_feed(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """The primary feed when it has a row, otherwise the fallback."""
    return fallback if primary.isEmpty() else primary.select(*fallback.columns)


def reconcile(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_value: str, right_value: str, tolerance: float
) -> DataFrame:
    """Totals of two feeds side by side; a side without the key counts as zero."""
    ours = left.groupBy(*on).agg(F.sum(left_value).alias("left_total"))
    theirs = right.groupBy(*on).agg(F.sum(right_value).alias("right_total"))
    filled = ours.join(theirs, list(on), "full").select(
        *on,
        F.coalesce("left_total", F.lit(0.0)).alias("left_total"),
        F.coalesce("right_total", F.lit(0.0)).alias("right_total"),
    )
    difference = F.col("left_total") - F.col("right_total")
    return filled.withColumn("difference", difference).withColumn("within", F.abs(difference) <= tolerance)


def window_totals(
    probes: DataFrame,
    events: DataFrame,
    *,
    on: Sequence[str],
    probe_time: str,
    event_time: str,
    measures: dict[str, Column],
    before_s: int,
    after_s: int,
    parts: int = 64,
) -> DataFrame:
    """Sum event measures over ``[t - before_s, t + after_s)`` around each probe time ``t``.

    A range join would emit every (probe, event) pair. Here the sum is a difference of running totals.
    Time is cut into cells no shorter than the window, so a window touches at most two cells, and each
    cell into ``parts`` (more of them where a cell holds very many distinct times). Totals run within a part; a part learns what came before it in its cell from the
    part totals. Events are first combined per key and microsecond and probes per key and time, so a hot
    key costs one row per distinct time, and no task sees more than one part of a cell. The combined rows
    are checkpointed once, as they feed both the running totals and the part totals. Times are zone-less
    timestamps. A probe without a time or key gets null measures.
    """
    shared_dir(events.sparkSession)
    wanted = list(measures)
    # A NaN would spoil every later running total, so sums leave NaN out and its occurrences are counted beside them.
    measures = {n: F.nanvl(m.cast("double"), F.lit(0.0)) for n, m in measures.items()} | {
        f"_nan_{n}": F.isnan(m.cast("double")).cast("double") for n, m in measures.items()
    }
    names = list(measures)
    part_us = -(-(before_s + after_s) * 1_000_000 // parts)
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])

    def micros(column: str) -> Column:
        return F.unix_micros(F.col(column).cast("timestamp"))

    def start_of(width: int) -> Column:
        return F.col("_t") - F.pmod(F.col("_t"), F.lit(width).cast("bigint"))

    steps = (
        events.where(keyed & F.col(event_time).isNotNull())
        .select(*on, micros(event_time).alias("_t"), *[measures[n].alias(n) for n in names])
        .groupBy(*on, "_t")
        .agg(*[F.sum(n).alias(n) for n in names])
        .withColumns({"_at": F.lit(None).cast("bigint"), "_opens": F.lit(None).cast("boolean")})
    )
    timed = probes.withColumn("_at", micros(probe_time))
    window_ends = F.array(
        F.struct((F.col("_at") - before_s * 1_000_000).alias("_t"), F.lit(True).alias("_opens")),
        F.struct((F.col("_at") + after_s * 1_000_000).alias("_t"), F.lit(False).alias("_opens")),
    )
    ends = (
        timed.where(keyed & F.col("_at").isNotNull())
        .select(*on, "_at")
        .distinct()
        .select(*on, "_at", F.explode(window_ends).alias("_e"))
        .select(*on, "_e._t", *[F.lit(None).cast("double").alias(n) for n in names], "_at", "_e._opens")
    )
    line = (
        steps.unionByName(ends)
        .withColumns({"_part": start_of(part_us), "_cell": start_of(part_us * parts)})
        .checkpoint()
    )
    # At most ``parts`` rows per key and cell.
    cell = Window.partitionBy(*on, "_cell")
    earlier = cell.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = line.groupBy(*on, "_cell", "_part").agg(*[F.coalesce(F.sum(n), F.lit(0.0)).alias(n) for n in names])
    starts = sums.select(
        *on,
        "_part",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0.0)).alias(f"_start_{n}") for n in names],
        *[F.sum(n).over(cell).alias(f"_cell_{n}") for n in names],
    )
    within = Window.partitionBy(*on, "_part").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    running = line.select(
        *on, "_at", "_opens", "_cell", "_part", *[F.coalesce(F.sum(n).over(within), F.lit(0.0)).alias(n) for n in names]
    ).where(F.col("_opens").isNotNull())

    def pick(opens: bool, value: Column) -> Column:
        return F.max(F.when(F.col("_opens") == opens, value))

    crossed = pick(False, F.col("_cell")) > pick(True, F.col("_cell"))

    def total(n: str) -> Column:
        upto = F.col(f"_start_{n}") + F.col(n)
        carried = F.when(crossed, pick(True, F.col(f"_cell_{n}"))).otherwise(F.lit(0.0))
        return pick(False, upto) - pick(True, upto) + carried

    totals = running.join(starts, [*on, "_part"]).groupBy(*on, "_at").agg(*[total(n).alias(n) for n in names])
    nan = F.lit(float("nan"))
    totals = totals.select(*on, "_at", *[F.when(F.col(f"_nan_{n}") > 0.5, nan).otherwise(F.col(n)).alias(n) for n in wanted])
    return timed.join(totals, [*on, "_at"], "left").drop("_at")
