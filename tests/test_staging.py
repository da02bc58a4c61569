from datetime import date, datetime

from pyspark.sql import functions as F

from dayloom.operators import cleaning, joins
from dayloom.plans import marts, staging
from dayloom.sources.datasets import empty_feed
from tests.cases import TYPES

D1, D2 = date(2025, 1, 1), date(2025, 1, 2)
T1, T2 = "2025-01-01T01:00:00+00:00", "2025-01-02T01:00:00+00:00"


def frame(spark, feed, rows):
    return spark.createDataFrame(rows, TYPES[feed])


def test_mode_ties_go_to_the_first_name(spark):
    trips = frame(spark, "commute_trips", [
        ("a", T1, "train", 1.0, 1.0, 0.0), ("b", T1, "bus", 1.0, 1.0, 0.0),
        ("c", T2, "train", 1.0, 1.0, 0.0), ("d", T2, "bus", 1.0, 1.0, 10.0),
    ])
    got = staging.stg_commute_day(trips).orderBy("date").collect()
    assert [r["primary_mode"] for r in got] == ["bus", "train"]


def test_trip_gaps(spark):
    trips = frame(spark, "commute_trips", [
        (None, T1, None, None, None, None), ("b", T1, None, 5.0, float("nan"), 60.0), ("c", None, "bus", 9.0, 9.0, 9.0),
    ])
    row = staging.stg_commute_day(trips).collect()
    assert [tuple(r) for r in row] == [(D1, "unknown", 5.0, 0.0, 0, 1, 60.0, 60.0)]
    by_rows = {r["date"]: r for r in staging.stg_commute_day(trips, count_rows=True).collect()}
    assert by_rows[D1]["total_trip_count"] == 2
    assert by_rows[None]["primary_mode"] is None and by_rows[None]["total_trip_count"] == 1


def test_mean_delay_is_missing_without_delays(spark):
    trips = frame(spark, "commute_trips", [("a", T1, "bus", 1.0, 1.0, 0.0), ("b", T1, "bus", 1.0, 1.0, None)])
    row = staging.stg_commute_day(trips).first()
    assert (row["mean_delay_s"], row["max_delay_s"], row["late_trip_count"]) == (None, 0.0, 0)


def test_station_means_are_averaged(spark):
    air = frame(spark, "air_quality", [
        ("s1", T1, 10.0, 1.0), ("s1", T1, 20.0, 3.0), ("s1", T1, 30.0, 5.0), ("s2", T1, 40.0, 7.0),
    ])
    empty = {f: empty_feed(spark, f) for f in ("weather", "beachwatch")}
    row = staging.stg_env_day(air, empty["weather"], empty["beachwatch"]).first()
    assert (row["pm25_mean"], row["pm10_mean"], row["primary_station_id"]) == (30.0, 5.0, "s2")
    assert row["rain_24h_mm"] is None


def test_all_missing_station_values(spark):
    air = frame(spark, "air_quality", [("s2", T1, None, 1.0), ("s1", T1, None, 2.0)])
    w, b = empty_feed(spark, "weather"), empty_feed(spark, "beachwatch")
    assert staging.stg_env_day(air, w, b).first()["primary_station_id"] == "s1"
    assert staging.stg_env_day_sql(air, w, b).first()["primary_station_id"] is None


def test_all_missing_rain(spark):
    weather = frame(spark, "weather", [(T1, None, 20.0)])
    a, b = empty_feed(spark, "air_quality"), empty_feed(spark, "beachwatch")
    assert staging.stg_env_day(a, weather, b).first()["rain_24h_mm"] == 0.0
    assert staging.stg_env_day_sql(a, weather, b).first()["rain_24h"] is None


def test_last_status_skips_gaps_and_breaks_ties(spark):
    beach = frame(spark, "beachwatch", [
        ("2025-01-01T01:00:00+00:00", "a", "good", 1.0),
        ("2025-01-01T02:00:00+00:00", "b", None, 3.0),
        ("2025-01-01T02:00:00+00:00", None, "poor", None),
        ("2025-01-01T01:30:00+00:00", "z", "closed", None),
    ])
    row = staging.beach_days(beach).first()
    assert (row["beach_status_primary"], row["beach_site_id"], row["enterococci_mean"]) == ("poor", "b", 2.0)


def test_sql_beach_site_needs_a_count(spark):
    beach = frame(spark, "beachwatch", [(T1, "a", "good", None)])
    a, w = empty_feed(spark, "air_quality"), empty_feed(spark, "weather")
    assert staging.stg_env_day(a, w, beach).first()["beach_site_id"] == "a"
    assert staging.stg_env_day_sql(a, w, beach).first()["beach_site_id"] is None


def test_union_regroup_equals_full_joins(spark, rows):
    air = frame(spark, "air_quality", [("s", T1, 1.0, 2.0), ("t", T1, 3.0, 4.0)])
    weather = frame(spark, "weather", [(T2, 1.0, 2.0)])
    beach = frame(spark, "beachwatch", [(T1, "a", "good", 1.0), ("2025-01-05T00:00:00+00:00", "b", "poor", 2.0)])
    air_day = staging.station_days(air).groupBy("date").agg(F.avg("pm25_mean").alias("pm25_mean"))
    chained = joins.outer_chain([air_day, staging.weather_days(weather), staging.beach_days(beach)], ["date"])
    direct = staging.stg_env_day(air, weather, beach).withColumnRenamed("rain_24h_mm", "rain_mm")
    columns = ["date", "pm25_mean", "rain_mm", "temp_mean_c", "beach_status_primary", "beach_site_id"]
    assert rows(chained, *columns) == rows(direct, *columns)


def test_personal_repeats_and_absent_columns(spark):
    feed = spark.createDataFrame([("2025-01-01", 10, 7.0), ("2025-01-01", 5, 7.25), ("2025-01-02", None, None)],
                                 "date string, steps bigint, sleep_hours double")
    got = {r["date"]: r for r in staging.stg_personal_day(feed).collect()}
    assert (got[D1]["steps"], got[D1]["sleep_hours"], got[D1]["mood_1_5"], got[D1]["caffeine_mg"]) == (15, 7.12, None, 0)
    assert (got[D2]["steps"], got[D2]["sleep_hours"]) == (0, None)


def test_commute_days_drive_the_fact(spark):
    trips = frame(spark, "commute_trips", [("a", T1, "bus", 1.0, 1.0, 0.0)])
    weather = frame(spark, "weather", [(T1, 1.0, 2.0), (T2, 1.0, 2.0)])
    env = staging.stg_env_day(empty_feed(spark, "air_quality"), weather, empty_feed(spark, "beachwatch"))
    personal = staging.stg_personal_day(empty_feed(spark, "personal"))
    got = marts.fact_day(staging.stg_commute_day(trips), env, personal).collect()
    assert [r["date"] for r in got] == ["2025-01-01"]
    row = got[0]
    assert (row["steps"], row["sleep_hours"], row["beach_status"], row["beach_ok"]) == (0, None, None, False)
    nothing = marts.fact_day(staging.stg_commute_day(empty_feed(spark, "commute_trips")), env, personal)
    assert nothing.count() == 0 and len(nothing.columns) == 27


def test_clean_feeds(spark):
    air = spark.createDataFrame(
        [("s", "2025-01-01T00:00:00Z", "1.5", "2"), ("s", "bad", "1", "2"), ("s", T1, "n/a", "2"), ("s", T1, "1", None)],
        "StationCode string, TimeStamp string, `PM2.5` string, PM10 string",
    )
    assert [tuple(r) for r in cleaning.clean_air_quality(air).collect()] == [("s", datetime(2025, 1, 1), 1.5, 2.0)]
    beach = spark.createDataFrame(
        [("2025-01-01", "a", " \t", "1"), ("2025-01-01", "b", None, "<10"), ("", "c", "good", "1"),
         ("2025-01-01", "d", " Good\n", "7")],
        "sample_date string, Beach string, advice string, enterococci_cfu string",
    )
    got = sorted(tuple(r)[1:] for r in cleaning.clean_beachwatch(beach).collect())
    assert got == [("b", None, None), ("d", "Good", 7.0)]


def test_feed_overlay(spark):
    own = frame(spark, "weather", [(T1, 1.0, 2.0)])
    outside = frame(spark, "weather", [(T2, 3.0, 4.0)])
    assert joins.choose_feed(outside, own).first()["rain_mm"] == 3.0
    assert joins.choose_feed(outside.limit(0), own).first()["rain_mm"] == 1.0


def test_dim_commute_mode_handles_no_trips(spark):
    days = spark.createDataFrame(
        [(D1, "bus", 40.0, 10.0, 1, 4), (D2, "bus", 60.0, None, 0, 0)],
        "date date, primary_mode string, commute_minutes double, mean_delay_s double, late_trip_count bigint, "
        "total_trip_count bigint",
    )
    row = marts.dim_commute_mode(days).first()
    assert tuple(row) == ("bus", 2, 50.0, 10.0, 0.25, "moderate")
