from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dayloom.fixed_values import FACT_DAY_COLUMNS
from dayloom.operators import quality as Q


def status(df, rule):
    return Q.run_suite(df, [rule]).first()["status"]


def test_required_columns(spark):
    df = spark.createDataFrame([("2025-01-01", "x")], "date string, weekday string")
    row = Q.run_suite(df, [Q.required_columns(df, ["date", "weekday", "commute_minutes"])]).first()
    assert tuple(row) == ("required_columns", "fail", "commute_minutes")


@pytest.mark.parametrize(
    "values, low, high, want",
    [
        ([0.5, 0.9], 0.0, 1.0, "pass"),
        ([0.5, 1.1], 0.0, 1.0, "fail"),
        ([0.5, None], 0.0, 1.0, "fail"),
        ([0.5, float("nan")], 0.0, None, "fail"),
        ([-1.0], None, 0.0, "pass"),
        ([], 0.0, 1.0, "pass"),
    ],
)
def test_value_range(spark, values, low, high, want):
    df = spark.createDataFrame([(v,) for v in values], "reliability double")
    assert status(df, Q.value_range("reliability", low, high)) == want


def test_not_null_lists_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 3, None)], "a int, b int, c string")
    row = Q.run_suite(df, [Q.not_null(["a", "b", "c"])]).first()
    assert tuple(row) == ("not_null", "fail", "b,c")


def test_domains_and_completeness(spark):
    df = spark.createDataFrame([("Good", True, "yes")] * 19 + [(None, None, "maybe")], "s string, b boolean, t string")
    assert status(df, Q.value_domain("s", ["Good"])) == "pass"
    assert status(df, Q.value_domain("t", ["yes"])) == "fail"
    assert status(df, Q.boolean_domain(df, "b")) == "pass"
    assert status(df, Q.boolean_domain(df, "t")) == "fail"
    assert status(df, Q.completeness(["s", "t"])) == "pass"
    assert status(df, Q.completeness(["s"], 0.96)) == "fail"
    report = {r["column"]: r["status"] for r in Q.completeness_report(df, ["s", "t"], 0.96).collect()}
    assert report == {"s": "fail", "t": "pass"}


def test_suite_is_one_job_worth_of_plan(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("a"), F.lit("x").alias("b"))
    rules = [Q.not_null(["a", "b"]), Q.value_range("a", 0, 9), Q.value_domain("b", ["x"]), Q.completeness(["a"])]
    report = Q.run_suite(df, rules)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert report.count() == 4


def test_summary_and_enforce(spark):
    good = spark.createDataFrame([("a", "pass", ""), ("b", "skipped", "")], "check string, status string, failing string")
    bad = spark.createDataFrame([("a", "pass", ""), ("b", "fail", "x")], "check string, status string, failing string")
    assert Q.summary(good).first()["status"] == "pass"
    assert Q.summary(bad).first()["status"] == "fail"
    assert Q.enforce(bad, "record") is bad
    assert Q.enforce(good, "fail") is good
    with pytest.raises(RuntimeError, match="b"):
        Q.enforce(bad, "fail")
    with pytest.raises(ValueError):
        Q.enforce(good, "ask")


def test_range_report_ignores_missing_and_skips_empty(spark):
    df = spark.createDataFrame([(1.0, None), (None, 900.0)], "a double, b double")
    got = {r["check"]: r for r in Q.range_report(df, {"a": (0, None), "b": (0, 800)}, "t").collect()}
    assert got["range_a"]["status"] == "pass"
    assert (got["range_b"]["status"], got["range_b"]["max"], got["range_b"]["expected_max"]) == ("fail", 900.0, 800.0)
    empty = Q.range_report(df.limit(0), {"a": (0, None)}, "t").first()
    assert empty["status"] == "skipped"


def test_freshness(spark):
    df = spark.createDataFrame([(date(2025, 1, 1),), (date(2025, 1, 10),)], "date date")
    assert Q.freshness_report(df, "t", 7, date(2025, 1, 17)).first()["status"] == "pass"
    old = Q.freshness_report(df, "t", 7, date(2025, 1, 18)).first()
    assert (old["status"], old["age_days"]) == ("fail", 8)
    assert Q.freshness_report(df.limit(0), "t", 7).first()["status"] == "skipped"
    assert Q.freshness_report(df.select(F.lit(None).cast("date").alias("date")), "t", 7).first()["status"] == "fail"
    assert Q.freshness_report(df, "t", 7).first()["status"] == "fail"


def test_schema_problems(spark):
    df = spark.createDataFrame([(1, 1.0, "x")], "a bigint, b float, c string")
    assert Q.schema_problems(df, {"a": "bigint", "b": "double", "c": "string"}) == {}
    assert Q.schema_problems(df, {"a": "double", "z": "date"}) == {"a": "bigint", "z": "missing"}


def test_unique_key(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert tuple(Q.unique_key_report(df, ["k"]).first()) == ("unique_k", "fail", 2, 1, 3)
    assert Q.unique_key_report(df.distinct(), ["k"]).first()["status"] == "pass"


def test_feed_reports(spark):
    df = spark.createDataFrame([(datetime(2025, 1, 1),)], "ts timestamp_ntz")
    rows = {r["dataset"]: r["status"] for r in Q.feed_rows_report({"a": df, "b": df.limit(0)}).collect()}
    assert rows == {"a": "pass", "b": "fail"}
    feeds = {"a": (df, "ts"), "b": (df.limit(0), "ts")}
    stale = {r["dataset"]: r["status"] for r in Q.staleness_report(feeds, datetime(2025, 1, 3)).collect()}
    assert stale == {"a": "pass", "b": "fail"}
    assert Q.staleness_report(feeds, datetime(2025, 1, 3, 1)).where("dataset = 'a'").first()["status"] == "fail"


def test_health(spark):
    fact = spark.createDataFrame([tuple("x" for _ in FACT_DAY_COLUMNS)], FACT_DAY_COLUMNS)

    def problem(df):
        row = Q.health_report(df).first()
        assert (row["status"] == "pass") == (row["problem"] == "")
        return row["problem"]

    assert problem(fact) == ""
    assert "missing: ['steps']" in problem(fact.drop("steps"))
    assert "unexpected: ['extra']" in problem(fact.withColumn("extra", F.lit(1)))
    assert "order" in problem(fact.select(*reversed(FACT_DAY_COLUMNS)))
    assert problem(fact.limit(0)) == "no rows"
