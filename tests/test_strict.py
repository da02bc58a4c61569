"""No row is lost without a word, and results at the edges are defined."""
from __future__ import annotations

import math
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.functions.conform import conform, refused_rows
from dayloom.operators import bootstrap, features, inference, joins, quality, ranking
from dayloom.operators import regression as R
from dayloom.plans import staging
from dayloom.session import scratch_path
from dayloom.sources import datasets, records
from dayloom.streaming import delays

TRIPS = "trip_id string, trip_start_ts string, primary_mode string, trip_minutes string, fare_amount string, delay_seconds string"


def test_text_that_does_not_convert_stops_staging_and_is_counted(spark):
    good = ("a", "2025-01-01T00:00:00Z", "bus", "5", "1.5", None)
    df = spark.createDataFrame([good, ("b", "soon", "bus", "5", "1", "0"), ("c", None, "bus", "n/a", "1", "0")], TRIPS)
    for text in ("trip_start_ts", "trip_minutes"):
        rows = df.where("trip_id <> 'c'" if text == "trip_start_ts" else "trip_id <> 'b'")
        with pytest.raises(Exception, match=f"commute_trips.{text}"):
            staging.stg_commute_day(rows).collect()
            conform(rows, "commute_trips").collect()
    assert staging.stg_commute_day(df.where("trip_id = 'a'")).first()["commute_minutes"] == 5.0
    assert conform(df, "commute_trips", on_bad="null").count() == 3
    counts = {r["column"]: r["refused"] for r in refused_rows(df, "commute_trips").collect()}
    assert counts["trip_start_ts"] == 1 and counts["trip_minutes"] == 1 and counts["fare_amount"] == 0
    with pytest.raises(ValueError):
        conform(df, "commute_trips", on_bad="ignore")


RECORD = T.StructType([T.StructField("a", T.LongType())])


def test_record_pages_of_many_lines_and_broken_pages(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"result": {\n "records": [{"a": 1},\n {"a": 2}], "total": 4}}')
    (tmp_path / "two.json").write_text('{"result": {"records": [{"a": 3}], "total": 4}}\n{"result": {"records": [{"a": 4}], "total": 4}}\n')
    assert sorted(r["a"] for r in records.read_record_pages(spark, str(tmp_path), RECORD).collect()) == [1, 2, 3, 4]
    assert tuple(records.record_page_totals(spark, str(tmp_path), RECORD).first()) == (3, 4, 4, True)
    (tmp_path / "three.json").write_text('{"result": {"records": [], "total": 9}}')
    assert tuple(records.record_page_totals(spark, str(tmp_path), RECORD).first()) == (4, 4, 9, False)
    (tmp_path / "four.json").write_text('{"result": {"records": [{"a": 5}')
    with pytest.raises(Exception, match="does not parse"):
        records.read_record_pages(spark, str(tmp_path), RECORD).collect()


def test_rows_without_a_date_keep_their_place(spark):
    df = spark.createDataFrame([(date(2025, 1, 1), 1.0), (date(2025, 1, 2), 2.0), (None, 5.0), (None, 6.0)], "date date, x double")
    got = features.shifted_days(df, lags={"x": [1]}, trailing_sums={"x": 2}).collect()
    assert sorted((str(r["date"]), r["x"], r["x_lag1"], r["x_2d"]) for r in got) == [
        ("2025-01-01", 1.0, None, 1.0), ("2025-01-02", 2.0, 1.0, 3.0), ("None", 5.0, None, None), ("None", 6.0, None, None)]


DESIGN = R.Design(numeric=("x",), weekday=None, target="y")


def test_models_refuse_missing_values_unless_told_to_drop_them(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(9)] + [(1.0, None), (None, 3.0)], "x double, y double")
    with pytest.raises(Exception, match="missing value"):
        R.fit_linear(df, DESIGN)
    model = R.fit_linear(df, DESIGN, on_null="drop")
    assert model.slopes["x"] == pytest.approx(2.0)
    assert tuple(R.unusable_rows(df, DESIGN).first()) == (11, 2)
    assert R.scorable_rows(df, DESIGN).count() == 10


def test_the_last_days_are_chosen_before_they_are_scored(spark):
    rows = [(f"2025-01-{i:02d}", float(i), 2.0 * i if i < 9 else None) for i in range(1, 10)] + [("2025-01-10", None, None)]
    df = spark.createDataFrame(rows, "date string, x double, y double")
    got = bootstrap.prediction_intervals(df, ["date"], DESIGN, 16, on_null="drop", score=bootstrap.recent_days(df, 2)).collect()
    found = {r["date"]: r for r in got}
    assert set(found) == {"2025-01-09", "2025-01-10"}
    assert found["2025-01-09"]["prediction"] == pytest.approx(18.0) and found["2025-01-09"]["lower_ci"] is not None
    assert found["2025-01-10"]["prediction"] is None and found["2025-01-10"]["lower_ci"] is None


def test_default_weights_need_no_rows_times_replicates(spark):
    df = spark.range(50).selectExpr("cast(id as string) date", "cast(id as double) x", "cast(2 * id as double) y")
    plan = bootstrap.with_weights(df, ["date"], 1, 200, "poisson")._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Exchange" not in plan


def test_quality_rules_see_nan_and_odd_booleans(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, "yes", 1.0, True), (nan, "t", 0.0, None)], "x double, s string, f double, b boolean")
    status = lambda rule: quality.run_suite(df, [rule]).first()["status"]
    assert status(quality.not_null(["x"])) == "fail" and status(quality.not_null(["f", "s"])) == "pass"
    assert status(quality.completeness(["x"])) == "fail"
    assert quality.completeness_report(df, ["x"]).first()["present"] == 0.5
    assert status(quality.boolean_domain(df, "s")) == "fail" and status(quality.boolean_domain(df, "f")) == "pass"
    assert status(quality.boolean_domain(df, "b")) == "pass"
    odd = df.withColumn("f", F.col("f") + 0.5)
    assert quality.run_suite(odd, [quality.boolean_domain(odd, "f")]).first()["status"] == "fail"


def test_schema_report_names_columns(spark):
    row = quality.sql_mart_report({"stg_commute_day": spark.createDataFrame([(1,)], "date int")}, date(2025, 1, 1)).collect()
    found = {r["check"]: r for r in row}
    assert found["schema"]["status"] == found["freshness"]["status"] == "fail"
    assert "primary_mode" in found["schema"]["missing"] and found["schema"]["mismatched"] == "date:int"


def test_nan_measures_touch_only_their_own_windows(spark):
    at = lambda s: f"2025-01-01 00:00:{s:02d}"
    events = spark.createDataFrame([("k", at(1), float("nan")), ("k", at(20), 3.0), ("k", at(21), 4.0)], "k string, t string, v double")
    probes = spark.createDataFrame([("k", at(2)), ("k", at(21)), ("k", at(40))], "k string, p string")
    got = joins.window_totals(
        probes.withColumn("p", F.col("p").cast("timestamp_ntz")), events.withColumn("t", F.col("t").cast("timestamp_ntz")),
        on=["k"], probe_time="p", event_time="t", measures={"v": F.col("v")}, before_s=5, after_s=5,
    ).orderBy("p").collect()
    assert math.isnan(got[0]["v"]) and got[1]["v"] == 7.0 and got[2]["v"] == 0.0


def test_constant_values(spark):
    df = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "mood_1_5 double, prediction double")
    assert R.regression_metrics(df).first()["r2"] == 1.0
    assert R.regression_metrics(df.withColumn("prediction", F.lit(1.0))).first()["r2"] == 0.0
    groups = spark.createDataFrame([(1.0, True), (1.0, True), (3.0, False), (3.0, False)], "v double, f boolean")
    row = inference.difference_in_means(groups, "v", F.col("f")).first()
    assert (row["difference"], row["lower_ci"], row["upper_ci"], row["freedom"]) == (-2.0, -2.0, -2.0, None)


@pytest.mark.parametrize("freedom,quantile", [(4, 2.7764), (5, 2.5706), (10, 2.2281), (30, 2.0423), (1000, 1.9623)])
def test_student_quantile(spark, freedom, quantile):
    got = spark.range(1).select(inference.student_975(F.lit(float(freedom))).alias("q")).first()["q"]
    assert got == pytest.approx(quantile, abs=3e-3 if freedom < 5 else 1e-3)


def test_a_fit_that_does_not_converge_raises(spark):
    df = spark.createDataFrame([(i % 3 == 0, float(i)) for i in range(60)], "s boolean, x double")
    with pytest.raises(RuntimeError, match="converge"):
        inference.fit_logit(df, "s", ["x"], max_iterations=1)


def test_open_days_of_a_stream_are_reported(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [("2025-01-01 01:00:00", "a", 90.0), ("2025-01-02 20:00:00", "a", 10.0), ("2025-01-03 03:00:00", "a", 20.0)]
    spark.createDataFrame(rows, "ts string, route string, delay_s double").withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(path)
    stream = delays.read_reports(spark, path, "ts timestamp_ntz, route string, delay_s double")
    got = {str(r["date"]): (r["report_count"], r["is_final"]) for r in delays.run_days(stream, "t", zone="UTC").collect()}
    assert got == {"2025-01-01": (1, True), "2025-01-02": (1, True), "2025-01-03": (1, False)}


def test_parts_of_other_types_are_read(spark, tmp_path):
    base = str(tmp_path)
    for day, kind in ((1, "double"), (2, "string")):
        part = spark.createDataFrame([(f"2025-01-0{day} 00:00:00", 1.5)], "observation_ts string, rain_mm double")
        datasets.land(part.withColumn("rain_mm", F.col("rain_mm").cast(kind)), base, "weather", date(2025, 1, day))
    got = datasets.read_feed(spark, base, "weather", keep_ingest_date=True)
    assert sorted((r["rain_mm"], str(r["ingest_date"])) for r in got.collect()) == [(1.5, "2025-01-01"), (1.5, "2025-01-02")]
    assert datasets.read_feed(spark, base, "weather").count() == 2


def test_manifest_skips_times_that_do_not_parse(spark):
    feed = spark.createDataFrame([("2025-01-02",), ("soon",)], "t string")
    row = datasets.feed_manifest({"x": (feed, "t")}).first()
    assert row["rows"] == 2 and str(row["min_date"]) == "2025-01-02"


def test_parts_of_the_numbering_follow_the_rows(spark):
    df = spark.range(300).selectExpr("cast(id as string) k")
    numbered = ranking.hash_numbering(df, ["k"], 1, part_rows=1 / 64)  # as if there were many rows: five digits
    assert sorted(r["position"] for r in numbered.collect()) == list(range(300))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
