from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dayloom.functions import scalars as S
from dayloom.functions.conform import conform, rename_synonyms, require_columns


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, name",
    [
        (" very GOOD ", "Very good"),
        ("\tgood\n", "Good"),
        ("poor", "Poor"),
        ("CLOSED", "Closed"),
        (" Good ", "Good"),
        ("mystery", None),
        ("", None),
        (None, None),
    ],
)
def test_status_name(spark, text, name):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(S.status_name("s")).first()[0] == name


def test_strict_status_stops(spark):
    df = spark.createDataFrame([("mystery",)], "s string")
    with pytest.raises(Exception, match="unknown status: mystery"):
        df.select(S.status_name("s", strict=True)).collect()
    assert spark.createDataFrame([("poor ",)], "s string").select(S.status_name("s", strict=True)).first()[0] == "Poor"


@pytest.mark.parametrize("value, want", [(0.125, 0.12), (2.675, 2.68), (1.005, 1.0), (3.775, 3.78), (-0.125, -0.12)])
def test_round_even(spark, value, want):
    assert one(spark, S.round_even(F.lit(value))) == want


@pytest.mark.parametrize(
    "utc, day",
    [
        (datetime(2024, 12, 31, 12, 59, 59), date(2024, 12, 31)),
        (datetime(2024, 12, 31, 13, 0), date(2025, 1, 1)),
        (datetime(2024, 7, 1, 13, 59), date(2024, 7, 1)),
        (datetime(2024, 7, 1, 14, 0), date(2024, 7, 2)),
        # Daylight saving starts 2024-10-06 and ends 2024-04-07, both at 16:00 UTC the day before.
        (datetime(2024, 10, 6, 12, 59), date(2024, 10, 6)),
        (datetime(2024, 10, 6, 13, 0), date(2024, 10, 7)),
        (datetime(2024, 4, 6, 13, 0), date(2024, 4, 7)),
        (datetime(2024, 4, 7, 13, 30), date(2024, 4, 7)),
        (datetime(2024, 4, 7, 14, 0), date(2024, 4, 8)),
    ],
)
@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_local_date(spark, utc, day, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        stamp = F.lit(utc.isoformat(sep=" ")).cast("timestamp_ntz")
        assert one(spark, S.local_date(stamp)) == day
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_reliability_and_cost(spark):
    df = spark.createDataFrame([(2, 4, 15.1), (0, 0, 3.0), (5, 4, 1.0), (0, 4, 15.1)], "late int, total int, cost double")
    got = df.select(S.reliability("late", "total").alias("r"), S.cost_per_trip("cost", "total").alias("c")).collect()
    assert [(x["r"], x["c"]) for x in got] == [(0.5, 3.78), (1.0, 0.0), (0.0, 0.25), (1.0, 3.78)]


def test_missing_values_fall_to_the_last_band(spark):
    nothing = F.lit(None).cast("double")
    assert one(spark, S.pm25_category(nothing)) == "unhealthy"
    assert one(spark, S.rainfall_category(nothing)) == "storm"
    assert one(spark, S.commute_band(nothing)) == "long"
    assert one(spark, S.beach_ok(F.lit(None).cast("string"))) is False
    assert one(spark, S.is_swimmable(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    "function, edges",
    [
        (S.pm25_category, {15.0: "good", 15.01: "moderate", 25.0: "moderate", 25.01: "unhealthy"}),
        (S.rainfall_category, {0.99: "dry", 1.0: "wet", 9.99: "wet", 10.0: "storm"}),
        (S.commute_band, {45.0: "short", 75.0: "moderate", 75.1: "long"}),
        (S.delay_band, {59.9: "on_time", 60.0: "minor", 300.0: "moderate", 900.0: "severe"}),
        (S.risk_status, {0.29: "Very good", 0.3: "Good", 0.65: "Poor", 0.85: "Closed"}),
    ],
)
def test_band_edges(spark, function, edges):
    for value, want in edges.items():
        assert one(spark, function(F.lit(value))) == want


def test_late_is_strict(spark):
    assert one(spark, S.is_late(F.lit(60.0))) is False
    assert one(spark, S.is_late(F.lit(60.5))) is True


def test_after_rain_advice(spark):
    df = spark.createDataFrame(
        [(10.0, None), (9.9, "Good"), (0.0, "Poor"), (None, "Very poor"), (None, None)], "rain double, status string"
    )
    got = [r[0] for r in df.select(S.after_rain_advice("rain", "status")).collect()]
    assert got == [True, False, True, True, False]


def test_required_columns_are_named(spark):
    df = spark.range(1).selectExpr("1 AS date", "2 AS weekday")
    with pytest.raises(ValueError, match="commute_minutes"):
        require_columns(df, ["date", "weekday", "commute_minutes"])
    assert require_columns(df, ["weekday", "date"]).columns == ["weekday", "date"]


def test_first_synonym_wins(spark):
    df = spark.range(1).selectExpr("1 AS PM10", "'b' AS pm10value", "'c' AS `PM2.5`", "'d' AS pm2_5")
    got = rename_synonyms(df, ["pm25", "pm10"], {"pm25": ["pm25", "pm2_5", "pm2.5"], "pm10": ["pm10", "pm10value"]})
    assert tuple(got.first()) == ("d", 1)
    with pytest.raises(KeyError, match="site"):
        rename_synonyms(df, ["site"], {"site": ["site", "place"]})


def test_conform_coerces_and_fills(spark):
    df = spark.createDataFrame([("x", "n/a", float("nan")), ("2024-01-01T10:00:00+02:00", "1.5", 2.0)],
                               "observation_ts string, pm25 string, pm10 double")
    with pytest.raises(Exception, match="observation_ts|pm25"):
        conform(df, "air_quality").collect()
    got = conform(df, "air_quality", on_bad="null").collect()
    assert tuple(got[0]) == (None, None, None, None)
    assert tuple(got[1]) == (None, datetime(2024, 1, 1, 8, 0), 1.5, 2.0)
