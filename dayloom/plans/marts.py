"""Marts and dimensions built on the staging tables."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayloom.fixed_values import DEFAULT_MODE, FACT_DAY_COLUMNS
from dayloom.functions import scalars as S


BROADCAST_DAYS = 100_000  # days whose environment every executor can hold: some 10 MB


def fact_day(
    commute: DataFrame,
    environment: DataFrame,
    personal: DataFrame,
    entity_keys: Sequence[str] = (),
    environment_days: int | None = None,
) -> DataFrame:
    """One wide row per commute day (and entity). Commute days drive; other feeds fill in.

    Environment has no entity and joins on the day alone. The staging tables arrive grouped by their
    keys: the personal join reuses that partitioning, and at day grain the environment join does too.
    Given the counted number of ``environment_days``, up to ``BROADCAST_DAYS`` are sent to every executor, which spares the
    entity-days a second shuffle; beyond, and without a count, the sides are shuffled, and AQE splits hot days.
    """
    if environment_days is not None and environment_days <= BROADCAST_DAYS:
        environment = F.broadcast(environment)
    joined = commute.join(personal, [*entity_keys, "date"], "left").join(environment, "date", "left")

    def filled(name: str):
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))

    def counted(name: str):
        return F.coalesce(F.col(name).cast("bigint"), F.lit(0).cast("bigint"))

    cost, total, late = filled("opal_cost"), counted("total_trip_count"), counted("late_trip_count")
    status = S.status_name("beach_status_primary")
    columns = {
        "date": S.iso_date("date"),
        "weekday": S.weekday_name("date"),
        "month": F.month("date"),
        "primary_mode": F.coalesce("primary_mode", F.lit(DEFAULT_MODE)),
        "commute_minutes": filled("commute_minutes"),
        "opal_cost": cost,
        "cost_per_trip": S.cost_per_trip(cost, total),
        "total_trip_count": total,
        "late_trip_count": late,
        "reliability": S.reliability(late, total),
        "mean_delay_s": filled("mean_delay_s"),
        "max_delay_s": filled("max_delay_s"),
        "pm25_mean": filled("pm25_mean"),
        "pm10_mean": filled("pm10_mean"),
        "rain_24h_mm": filled("rain_24h_mm"),
        "temp_mean_c": filled("temp_mean_c"),
        "after_rain": S.after_rain(filled("rain_24h_mm")),
        "beach_status": status,
        "beach_ok": S.beach_ok(status),
        "enterococci_mean": filled("enterococci_mean"),
        "beach_site_id": F.col("beach_site_id"),
        "steps": counted("steps"),
        "sleep_hours": F.col("sleep_hours").cast("double"),
        "mood_1_5": F.col("mood_1_5").cast("double"),
        "caffeine_mg": counted("caffeine_mg"),
        "meeting_count": counted("meeting_count"),
        "meeting_minutes": counted("meeting_minutes"),
    }
    return joined.select(*entity_keys, *[columns[name].alias(name) for name in FACT_DAY_COLUMNS])


def dim_commute_mode(commute_days: DataFrame) -> DataFrame:
    """Days, mean minutes, delay and late share per primary mode."""
    rate = F.col("late_trip_count").cast("double") / F.nullif(F.col("total_trip_count"), F.lit(0))
    modes = commute_days.groupBy("primary_mode").agg(
        F.count("*").alias("day_count"),
        F.avg("commute_minutes").alias("avg_minutes"),
        F.avg("mean_delay_s").alias("avg_delay_s"),
        F.avg(rate).alias("late_trip_rate"),
    )
    return modes.withColumn("commute_band", S.commute_band("avg_minutes"))


def dim_environment_metric(env_days: DataFrame) -> DataFrame:
    """SQL-model environment days with their categories."""
    return env_days.select(
        "*",
        S.pm25_category("pm25_mean").alias("pm25_category"),
        S.rainfall_category("rain_24h").alias("rainfall_category"),
        S.is_swimmable("beach_status_primary").alias("is_swimmable"),
    )


def dim_site(typed_sites: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distinct sites of several feeds: type -> (feed, site column)."""
    parts = [
        feed.select(F.col(column).cast("string").alias("site_id"), F.lit(kind).alias("site_type"))
        for kind, (feed, column) in typed_sites.items()
    ]
    stacked = reduce(DataFrame.unionByName, parts)
    return stacked.where(F.col("site_id").isNotNull()).dropDuplicates(["site_id", "site_type"])


def dim_area(areas: DataFrame, code: str, name: str, region: str) -> DataFrame:
    """One row per statistical area: code, name, region."""
    named = areas.select(
        F.col(code).cast("string").alias("sa2_code"),
        F.col(name).alias("name"),
        F.col(region).alias("region"),
    )
    return named.groupBy("sa2_code").agg(F.min("name").alias("name"), F.min("region").alias("region"))
