"""Day-grain staging tables.

Every table takes ``entity_keys``: with none the grain is the day, with e.g. ``("entity_id",)`` it is
the entity and day. Raw rows meet only sums, counts and maxima, which Spark combines inside each map
task, so a hot day or source crosses the network as a few rows per task. Choices that need an ordering
(primary mode, primary station, last status) run on those small combined rows.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayloom.fixed_values import DEFAULT_MODE, LOCAL_ZONE, SCORE_DELAY_DIVISOR
from dayloom.functions.conform import conform
from dayloom.functions.scalars import is_late, local_date, nonzero, round_even
from dayloom.operators.ranking import arg_top, last_known


# ---- commute ------------------------------------------------------------------------------------


def mode_days(
    trips: DataFrame, entity_keys: Sequence[str] = (), zone: str = LOCAL_ZONE, count_rows: bool = False
) -> DataFrame:
    """Totals and score per day and mode: trips minus mean delay in hundreds of seconds.

    ``count_rows`` counts rows without a trip id too and keeps rows without a time.
    """
    keys = [*entity_keys, "date"]
    feed = conform(trips, "commute_trips", entity_keys)
    if not count_rows:
        feed = feed.where(F.col("trip_start_ts").isNotNull())
    base = feed.select(
        *entity_keys,
        local_date("trip_start_ts", zone).alias("date"),
        F.coalesce("primary_mode", F.lit(DEFAULT_MODE)).alias("primary_mode"),
        "trip_id",
        F.coalesce("trip_minutes", F.lit(0.0)).alias("minutes"),
        F.coalesce("fare_amount", F.lit(0.0)).alias("fare"),
        F.coalesce("delay_seconds", F.lit(0.0)).alias("delay"),
    )
    counted = F.count("*") if count_rows else F.count("trip_id")
    totals = base.groupBy(*keys, "primary_mode").agg(
        counted.alias("trip_count"),
        F.avg("delay").alias("avg_delay"),
        F.sum("minutes").alias("minutes"),
        F.sum("fare").alias("fare"),
        F.count_if(is_late("delay")).alias("late"),
        F.sum(nonzero("delay")).alias("delay_sum"),
        F.count(nonzero("delay")).alias("delay_n"),
        F.max("delay").alias("delay_max"),
    )
    return totals.withColumn("score", F.col("trip_count") - F.col("avg_delay") / SCORE_DELAY_DIVISOR)


def primary_modes(modes: DataFrame, entity_keys: Sequence[str] = ()) -> DataFrame:
    """The best scored mode per day, alphabetical on ties."""
    return modes.groupBy(*entity_keys, "date").agg(
        arg_top(F.col("primary_mode"), F.col("score")).alias("primary_mode")
    )


def stg_commute_day(
    trips: DataFrame, entity_keys: Sequence[str] = (), zone: str = LOCAL_ZONE, count_rows: bool = False
) -> DataFrame:
    """Daily commute totals with the primary mode, in one pass over the trips.

    ``count_rows=True`` is the SQL-model variant: it counts all rows and has no ``max_delay_s``.
    """
    best = arg_top(F.col("primary_mode"), F.col("score"))
    if count_rows:
        # The model joins the mode back on the date, which never matches a missing date.
        best = F.when(F.col("date").isNotNull(), best)
    days = mode_days(trips, entity_keys, zone, count_rows).groupBy(*entity_keys, "date").agg(
        best.alias("primary_mode"),
        F.sum("minutes").alias("commute_minutes"),
        F.sum("fare").alias("opal_cost"),
        F.sum("late").alias("late_trip_count"),
        F.sum("trip_count").alias("total_trip_count"),
        F.try_divide(F.sum("delay_sum"), F.sum("delay_n")).alias("mean_delay_s"),
        F.max("delay_max").alias("max_delay_s"),
    )
    return days.drop("max_delay_s") if count_rows else days


# ---- environment --------------------------------------------------------------------------------


def station_days(
    air: DataFrame, entity_keys: Sequence[str] = (), zone: str = LOCAL_ZONE, keep_missing: bool = False
) -> DataFrame:
    """Mean concentrations per day and station."""
    base = conform(air, "air_quality", entity_keys).withColumn("date", local_date("observation_ts", zone))
    if not keep_missing:
        base = base.where(F.col("observation_ts").isNotNull() & F.col("station_id").isNotNull())
    return base.groupBy(*entity_keys, "date", "station_id").agg(
        F.avg("pm25").alias("pm25_mean"), F.avg("pm10").alias("pm10_mean")
    )


def weather_days(
    weather: DataFrame, entity_keys: Sequence[str] = (), zone: str = LOCAL_ZONE, keep_missing: bool = False
) -> DataFrame:
    """Rain total and mean temperature per day.

    A day whose rain is all missing has 0 mm; with ``keep_missing`` it stays null.
    """
    base = conform(weather, "weather", entity_keys).withColumn("date", local_date("observation_ts", zone))
    rain = F.sum("rain_mm")
    if not keep_missing:
        base = base.where(F.col("observation_ts").isNotNull())
        rain = F.coalesce(rain, F.lit(0.0))
    return base.groupBy(*entity_keys, "date").agg(
        rain.alias("rain_mm"), F.avg("temperature_c").alias("temp_mean_c")
    )


def beach_days(
    beach: DataFrame, entity_keys: Sequence[str] = (), zone: str = LOCAL_ZONE, keep_missing: bool = False
) -> DataFrame:
    """Last known status and site of the day, each skipping its own gaps, and mean enterococci.

    The latest time per site and status is taken first. That needs no text in the aggregation state,
    so it runs as a hash aggregation, and the ordered choice sees a handful of rows per day.
    """
    keys = [*entity_keys, "date"]
    base = conform(beach, "beachwatch", entity_keys).withColumn("date", local_date("observation_ts", zone))
    if not keep_missing:
        base = base.where(F.col("observation_ts").isNotNull())
    latest = base.groupBy(*keys, "site_id", "status").agg(
        F.max("observation_ts").alias("seen"),
        F.sum("enterococci").alias("ent_sum"),
        F.count("enterococci").alias("ent_n"),
    )
    return latest.groupBy(*keys).agg(
        last_known(F.col("status"), F.col("seen"), F.col("site_id"), F.col("status")).alias("beach_status_primary"),
        F.try_divide(F.sum("ent_sum"), F.sum("ent_n")).alias("enterococci_mean"),
        last_known(F.col("site_id"), F.col("seen"), F.col("site_id")).alias("beach_site_id"),
    )


def _air_days(stations: DataFrame, keys: Sequence[str]) -> DataFrame:
    return stations.groupBy(*keys).agg(
        arg_top(F.col("station_id"), F.col("pm25_mean")).alias("primary_station_id"),
        F.avg("pm25_mean").alias("pm25_mean"),
        F.avg("pm10_mean").alias("pm10_mean"),
    )


def stg_env_day(
    air: DataFrame,
    weather: DataFrame,
    beach: DataFrame,
    entity_keys: Sequence[str] = (),
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """Daily environment: air, weather and beach days, any of which may be missing.

    The three day tables have one row per key, so their full outer join is a union regrouped by key:
    one shuffle where two full joins would need one each per side, as they lose the partitioning.
    """
    keys = [*entity_keys, "date"]
    daily = [
        _air_days(station_days(air, entity_keys, zone), keys),
        weather_days(weather, entity_keys, zone).withColumnRenamed("rain_mm", "rain_24h_mm"),
        beach_days(beach, entity_keys, zone),
    ]
    stacked = daily[0]
    for frame in daily[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    measures = [
        "primary_station_id",
        "pm25_mean",
        "pm10_mean",
        "rain_24h_mm",
        "temp_mean_c",
        "beach_status_primary",
        "enterococci_mean",
        "beach_site_id",
    ]
    return stacked.groupBy(*keys).agg(*[F.max(name).alias(name) for name in measures])


def stg_env_day_sql(
    air: DataFrame,
    weather: DataFrame,
    beach: DataFrame,
    entity_keys: Sequence[str] = (),
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """The SQL-model variant: stations joined to the daily feeds, then folded back to the day.

    Differences: missing rain stays missing, a station needs a value to be primary, and the beach site
    needs a measured count.
    """
    keys = [*entity_keys, "date"]
    stations = station_days(air, entity_keys, zone, keep_missing=True)
    rain = weather_days(weather, entity_keys, zone, keep_missing=True)
    sites = beach_days(beach, entity_keys, zone, keep_missing=True)
    joined = stations.join(rain, keys, "full").join(sites, keys, "full")
    station_ok = F.col("station_id").isNotNull() & F.col("pm25_mean").isNotNull()
    site_ok = F.col("beach_site_id").isNotNull() & F.col("enterococci_mean").isNotNull()
    return joined.groupBy(*keys).agg(
        F.min_by("station_id", F.when(station_ok, F.struct(-round_even("pm25_mean", 8), "station_id"))).alias(
            "primary_station_id"
        ),
        F.avg("pm25_mean").alias("pm25_mean"),
        F.avg("pm10_mean").alias("pm10_mean"),
        F.max("rain_mm").alias("rain_24h"),
        F.avg("temp_mean_c").alias("temp_mean_c"),
        F.max("beach_status_primary").alias("beach_status_primary"),
        F.avg("enterococci_mean").alias("enterococci_mean"),
        F.max_by("beach_site_id", F.when(site_ok, F.struct("enterococci_mean", "beach_site_id"))).alias(
            "beach_site_id"
        ),
    )


# ---- personal -----------------------------------------------------------------------------------


def stg_personal_day(personal: DataFrame, entity_keys: Sequence[str] = ()) -> DataFrame:
    """Daily personal metrics: counts are summed, sleep and mood averaged to two digits."""
    base = conform(personal, "personal", entity_keys).where(F.col("date").isNotNull())

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    return base.groupBy(*entity_keys, "date").agg(
        total("steps"),
        round_even(F.avg("sleep_hours")).alias("sleep_hours"),
        round_even(F.avg("mood_1_5")).alias("mood_1_5"),
        total("caffeine_mg"),
        total("meeting_count"),
        total("meeting_minutes"),
    )
