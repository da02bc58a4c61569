"""Calendar, lag, exposure and switching features."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom.fixed_values import COMMUTE_WINDOWS, LOCAL_ZONE
from dayloom.functions.calendar import NSW_HOLIDAYS, Holiday, holiday_name
from dayloom.functions.conform import conform
from dayloom.functions.scalars import local_date, local_time, weekday_dummies
from dayloom.operators.ranking import column_mode


def zscore_by_month(df: DataFrame, columns: Sequence[str], entity_keys: Sequence[str] = ()) -> DataFrame:
    """Each column against its calendar month: ``(x - mean) / sample deviation``.

    A window holds one month of one entity, so at most 31 rows.
    """
    month = Window.partitionBy(*entity_keys, F.year("date"), F.month("date"))
    return df.select(
        "*",
        *[
            F.try_divide(F.col(c) - F.avg(c).over(month), F.stddev_samp(c).over(month)).alias(f"{c}_z")
            for c in columns
        ],
    )


def shifted_days(
    df: DataFrame,
    entity_keys: Sequence[str] = (),
    lags: dict[str, Sequence[int]] | None = None,
    trailing_sums: dict[str, int] | None = None,
    stretch_days: int = 366,
) -> DataFrame:
    """Add values of earlier calendar days, and sums over the last calendar days, today included.

    Input has one row per entity and day; the lag onto a day that does not exist is null, and so are all features of a row
    without a date. A window over a
    whole history would be one task per entity, or a single task without entities. So time is cut into
    stretches, and the last days of a stretch are also sent to the next one: one shuffle of little more
    than the input, and no window longer than a stretch.
    """
    lags, trailing_sums = lags or {}, trailing_sums or {}
    reach = max([0, *[k for ks in lags.values() for k in ks], *[d - 1 for d in trailing_sums.values()]])
    length = max(stretch_days, 4 * reach)
    numbered = df.withColumn("_day", F.datediff(F.to_date("date"), F.lit("1970-01-01").cast("date")))
    own = F.floor(F.col("_day") / F.lit(length))
    near_end = F.pmod(F.col("_day"), F.lit(length)) >= length - reach
    sent = numbered.withColumn("_own", own).withColumn(
        "_stretch", F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    # Rows without a date have no neighbours: they stay, each alone, with null features.
    alone = F.when(F.col("_day").isNull(), F.monotonically_increasing_id())
    sent, dated = sent.withColumn("_alone", alone), F.col("_day").isNotNull()
    history = Window.partitionBy(*entity_keys, "_stretch", "_alone").orderBy("_day")
    columns = [
        F.when(dated, F.max(name).over(history.rangeBetween(-k, -k))).alias(f"{name}_lag{k}")
        for name, steps in lags.items()
        for k in steps
    ]
    columns += [
        F.when(dated, F.sum(name).over(history.rangeBetween(-(days - 1), 0))).alias(f"{name}_{days}d")
        for name, days in trailing_sums.items()
    ]
    shifted = sent.select("*", *columns).where(F.col("_stretch").eqNullSafe(F.col("_own")))
    return shifted.drop("_day", "_own", "_stretch", "_alone")


# Public holidays that fall on the same date every year (month-day).
FIXED_HOLIDAYS = ["01-01", "01-26", "04-25", "12-25", "12-26"]


def calendar_features(df: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Month, quarter, weekday dummies and a holiday flag.

    ``holidays`` is a table with a ``date`` column; without one the fixed-date holidays apply.
    """
    day = F.to_date("date")
    out = df.select(
        "*",
        F.quarter(day).alias("quarter"),
        *[column.cast("int").alias(name) for name, column in weekday_dummies("weekday").items()],
    )
    if holidays is None:
        return out.withColumn("is_holiday", F.date_format(day, "MM-dd").isin(FIXED_HOLIDAYS))
    listed = holidays.select(F.to_date("date").alias("_day")).distinct().withColumn("_listed", F.lit(True))
    return (
        out.join(listed, day == F.col("_day"), "left")
        .withColumn("is_holiday", F.coalesce("_listed", F.lit(False)))
        .drop("_day", "_listed")
    )


def observed_holidays(df: DataFrame, rules: Sequence[Holiday] = NSW_HOLIDAYS, date: str = "date") -> DataFrame:
    """Add ``holiday``, the name of the public holiday or substitute day, null on other days, and ``is_holiday``; nothing is joined or shuffled."""
    named = df.withColumn("holiday", holiday_name(F.to_date(date), tuple(rules)))
    return named.withColumn("is_holiday", F.col("holiday").isNotNull())


def mode_switch(days: DataFrame, entity_keys: Sequence[str] = ()) -> DataFrame:
    """Add the usual mode of the entity and whether this day's mode differs from it.

    Input has one row per entity and day, so an entity is no longer than the calendar. Both windows run on
    one shuffle by entity; joining the usual modes back would read the trips twice.
    """
    if entity_keys:
        same_mode = Window.partitionBy(*entity_keys, "primary_mode")
        entity = Window.partitionBy(*entity_keys)
        order = F.struct(-F.col("_n"), F.col("primary_mode"))
        out = (
            days.repartition(*entity_keys)
            .withColumn("_n", F.count(F.lit(1)).over(same_mode))
            .withColumn("usual_mode", F.min_by("primary_mode", order).over(entity))
            .drop("_n")
        )
    else:
        row = column_mode(days, "primary_mode").first()
        out = days.withColumn("usual_mode", F.lit(row["primary_mode"] if row else None).cast("string"))
    return out.withColumn("mode_switch", F.col("primary_mode") != F.col("usual_mode"))


def _in_windows(hour: Column, windows: Sequence[tuple[int, int]]) -> Column:
    return reduce(lambda a, b: a | b, [(hour >= start) & (hour < end) for start, end in windows])


def exposure_days(
    air: DataFrame, windows: Sequence[tuple[int, int]] = COMMUTE_WINDOWS, zone: str = LOCAL_ZONE
) -> DataFrame:
    """Mean concentration in the commuting hours against the whole day."""
    base = conform(air, "air_quality").where(F.col("observation_ts").isNotNull())
    inside = _in_windows(F.hour(local_time("observation_ts", zone)), windows)
    return (
        base.select(
            local_date("observation_ts", zone).alias("date"),
            "pm25",
            F.when(inside, F.col("pm25")).alias("commuting"),
        )
        .groupBy("date")
        .agg(
            F.avg("pm25").alias("pm25_day"),
            F.avg("commuting").alias("pm25_commute"),
            (F.avg("commuting") - F.avg("pm25")).alias("difference"),
        )
    )


def pedestrian_days(
    counts: DataFrame, windows: Sequence[tuple[int, int]] = COMMUTE_WINDOWS, zone: str = LOCAL_ZONE
) -> DataFrame:
    """People per site and day, and those in the commuting hours. Times are zone-less UTC."""
    inside = _in_windows(F.hour(local_time("counted_ts", zone)), windows)
    return (
        counts.select(
            "site_id",
            local_date("counted_ts", zone).alias("date"),
            "people",
            F.when(inside, F.col("people")).otherwise(F.lit(0)).alias("commuting"),
        )
        .groupBy("site_id", "date")
        .agg(F.sum("people").alias("people"), F.sum("commuting").alias("people_commuting"))
    )
