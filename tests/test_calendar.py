from datetime import date, timedelta

from pyspark.sql import functions as F

from dayloom.catalog.oracles import EASTER_SUNDAYS
from dayloom.functions.calendar import NSW_HOLIDAYS, easter_sunday, holiday_name, nth_weekday


def test_easter_of_every_year(spark):
    got = {r["y"]: r["e"] for r in spark.range(1990, 2051).select(F.col("id").cast("int").alias("y")).select("y", easter_sunday(F.col("y")).alias("e")).collect()}
    assert {y: e.strftime("%m-%d") for y, e in got.items()} == {1990 + i: d for i, d in enumerate(EASTER_SUNDAYS)}
    odd = {1818: "03-22", 1943: "04-25", 1954: "04-18", 1981: "04-19", 2076: "04-19", 2285: "03-22"}  # earliest, latest, and corrected moons
    rows = spark.createDataFrame([(y,) for y in odd], "y int").select("y", easter_sunday(F.col("y")).alias("e")).collect()
    assert {r["y"]: r["e"].strftime("%m-%d") for r in rows} == odd


def plain(day: date) -> str | None:
    easter = date.fromisoformat(f"{day.year}-{EASTER_SUNDAYS[day.year - 1990]}")
    nth = lambda month, n: next(d for i in range(31) if (d := date(day.year, month, 1) + timedelta(i)).weekday() == 0) + timedelta(7 * (n - 1))
    fixed = {"New Year's Day": date(day.year, 1, 1), "Australia Day": date(day.year, 1, 26), "Good Friday": easter - timedelta(2),
             "Easter Saturday": easter - timedelta(1), "Easter Sunday": easter, "Easter Monday": easter + timedelta(1), "Anzac Day": date(day.year, 4, 25),
             "King's Birthday": nth(6, 2), "Labour Day": nth(10, 1), "Christmas Day": date(day.year, 12, 25), "Boxing Day": date(day.year, 12, 26)}
    for name, when in fixed.items():
        if when == day:
            return name
    for name, when in fixed.items():
        if when.weekday() >= 5 and name in ("New Year's Day", "Australia Day") and day == when + timedelta(7 - when.weekday()):
            return f"{name} (substitute)"
        if when.weekday() >= 5 and name in ("Christmas Day", "Boxing Day") and day == when + timedelta(2):
            return f"{name} (substitute)"
    return None


def test_every_day_of_sixty_years(spark):
    days = spark.sql("SELECT explode(sequence(DATE '1990-01-01', DATE '2050-12-31')) AS d")
    for d, name in days.select("d", holiday_name(F.col("d"))).collect():
        assert name == plain(d), d


def test_nulls_and_other_rules(spark):
    df = spark.createDataFrame([(None,), (date(2024, 5, 20),)], "d date")
    assert [r[0] for r in df.select(holiday_name(F.col("d"), NSW_HOLIDAYS[:2])).collect()] == [None, None]
    got = df.select(nth_weekday(F.year("d"), 5, 0, 3)).collect()
    assert [r[0] for r in got] == [None, date(2024, 5, 20)]
