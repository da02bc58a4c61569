import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayloom.operators import features, inference, joins, profile, ranking
from dayloom.operators.quantiles import exact_quantiles
from dayloom.operators.ranking import arg_top


def skewed_rows(n=3000, seed=1):
    """A third of the rows share one key; values repeat."""
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}", float(rng.randrange(500)) / 4) for _ in range(n)]


def test_exact_quantiles_match_numpy(spark):
    data = skewed_rows()
    df = spark.createDataFrame(data + [("hot", None)], "k string, v double").repartition(6)
    probabilities = {"low": 0.025, "mid": 0.5, "high": 0.975, "least": 0.0, "most": 1.0}
    got = {r["k"]: r for r in exact_quantiles(df, "v", probabilities, ["k"]).collect()}
    groups = defaultdict(list)
    for k, v in data:
        groups[k].append(v)
    assert set(got) == set(groups)
    for k, values in groups.items():
        for name, p in probabilities.items():
            assert got[k][name] == pytest.approx(np.percentile(values, 100 * p))
    whole = exact_quantiles(df, "v", probabilities).first()
    assert whole["high"] == pytest.approx(np.percentile([v for _, v in data], 97.5))


def test_hash_numbering_is_dense_and_stable(spark):
    df = spark.range(1, 501).repartition(5)
    got = ranking.hash_numbering(df, ["id"], 7).collect()
    assert sorted(r["position"] for r in got) == list(range(500))
    assert {r["total"] for r in got} == {500}
    again = ranking.hash_numbering(df.repartition(3), ["id"], 7).collect()
    assert {r["id"]: r["position"] for r in got} == {r["id"]: r["position"] for r in again}


def test_arg_top_orders_missing_scores_last(spark):
    df = spark.createDataFrame([("a", None), ("c", 1.0), ("b", 1.0), ("d", 0.5)], "n string, s double")
    assert df.agg(arg_top(F.col("n"), F.col("s"))).first()[0] == "b"
    assert df.where("s IS NULL").agg(arg_top(F.col("n"), F.col("s"))).first()[0] == "a"


def test_column_mode_ties(spark):
    df = spark.createDataFrame([("x",), ("b",), ("b",), ("a",), ("a",), (None,), (None,), (None,)], "v string")
    assert ranking.column_mode(df, "v").first()["v"] == "a"


def test_latest_per_key_keeps_one_row(spark):
    rows = [("a", date(2025, 1, 1), 1), ("a", date(2025, 1, 2), 5), ("a", date(2025, 1, 2), 7), ("b", date(2025, 1, 1), None)]
    df = spark.createDataFrame(rows, "k string, ingest_date date, v int")
    got = sorted(tuple(r) for r in ranking.latest_per_key(df, ["k"]).select("k", "ingest_date", "v").collect())
    assert got == [("a", date(2025, 1, 2), 7), ("b", date(2025, 1, 1), None)]


def test_window_totals_match_pairs(spark):
    """A third of the events and probes on one route, many in the same second."""
    rng = random.Random(5)
    start = datetime(2024, 1, 1)

    def moment():
        return start + timedelta(seconds=rng.randrange(0, 20_000, 7), microseconds=rng.choice([0, 0, 500_000]))

    def route():
        return "hot" if rng.random() < 0.34 else f"r{rng.randrange(5)}"

    events = [(route(), moment(), float(rng.randrange(300))) for _ in range(800)]
    probes = [(i, route(), moment()) for i in range(500)] + [(900, "none", start), (901, "hot", None)]
    got = joins.window_totals(
        spark.createDataFrame(probes, "id int, route string, at timestamp_ntz").repartition(4),
        spark.createDataFrame(events, "route string, ts timestamp_ntz, delay double").repartition(4),
        on=["route"], probe_time="at", event_time="ts",
        measures={"n": F.lit(1.0), "total": F.col("delay")}, before_s=600, after_s=1200,
    ).collect()
    assert len(got) == len(probes)
    found = {r["id"]: (r["n"], r["total"]) for r in got}
    for i, r, at in probes:
        if at is None:
            assert found[i] == (None, None)
            continue
        inside = [d for k, ts, d in events
                  if k == r and at - timedelta(seconds=600) <= ts < at + timedelta(seconds=1200)]
        assert found[i] == (float(len(inside)), sum(inside))


@pytest.mark.parametrize("stretch", [366, 8, 5])
def test_shifted_days_across_stretches(spark, stretch):
    rng = random.Random(2)
    days = [(e, date(2024, 1, 1) + timedelta(days=i), float(rng.randrange(50)))
            for e in ("a", "b") for i in range(60) if rng.random() < 0.8]
    df = spark.createDataFrame(days, "entity_id string, date date, x double")
    got = features.shifted_days(df, ["entity_id"], lags={"x": (1, 2)}, trailing_sums={"x": 3}, stretch_days=stretch).collect()
    value = {(e, d): x for e, d, x in days}
    assert len(got) == len(days)
    for r in got:
        back = [value.get((r["entity_id"], r["date"] - timedelta(days=k))) for k in range(3)]
        assert (r["x_lag1"], r["x_lag2"]) == (back[1], back[2])
        assert r["x_3d"] == sum(v for v in back if v is not None)


def test_zscore_is_missing_for_a_constant_month(spark):
    df = spark.createDataFrame([("2024-01-01", 1.0), ("2024-01-02", 3.0), ("2024-02-01", 5.0), ("2024-02-02", 5.0)],
                               "date string, x double")
    got = [r["x_z"] for r in features.zscore_by_month(df, ["x"]).orderBy("date").collect()]
    assert got == [pytest.approx(-(0.5**0.5)), pytest.approx(0.5**0.5), None, None]


def test_mode_switch_per_entity_and_overall(spark):
    rows = [("a", "2024-01-01", "bus"), ("a", "2024-01-02", "bus"), ("a", "2024-01-03", "train"),
            ("b", "2024-01-01", "train"), ("b", "2024-01-02", "bus")]
    df = spark.createDataFrame(rows, "entity_id string, date string, primary_mode string")
    got = sorted((r["entity_id"], r["date"], r["usual_mode"], r["mode_switch"])
                 for r in features.mode_switch(df, ["entity_id"]).collect())
    assert got == [("a", "2024-01-01", "bus", False), ("a", "2024-01-02", "bus", False), ("a", "2024-01-03", "bus", True),
                   ("b", "2024-01-01", "bus", True), ("b", "2024-01-02", "bus", False)]
    assert {r["usual_mode"] for r in features.mode_switch(df).collect()} == {"bus"}


def test_holiday_table(spark):
    df = spark.createDataFrame([("2024-01-01", "Monday"), ("2024-06-10", "Monday")], "date string, weekday string")
    fixed = features.calendar_features(df).orderBy("date").collect()
    assert [(r["quarter"], r["is_monday"], r["is_sunday"], r["is_holiday"]) for r in fixed] == [(1, 1, 0, True), (2, 1, 0, False)]
    table = spark.createDataFrame([("2024-06-10",), ("2024-06-10",)], "date string")
    listed = features.calendar_features(df, table).orderBy("date").collect()
    assert [r["is_holiday"] for r in listed] == [False, True]


def test_reconcile_fills_absent_sides(spark):
    a = spark.createDataFrame([("d1", 5.0), ("d1", 3.0), ("d2", 1.0)], "date string, fare double")
    b = spark.createDataFrame([("d1", 10.0), ("d3", 4.0)], "date string, spend double")
    got = {r["date"]: (r["difference"], r["within"]) for r in joins.reconcile(a, b, ["date"], "fare", "spend", 2.0).collect()}
    assert got == {"d1": (-2.0, True), "d2": (1.0, True), "d3": (-4.0, False)}


def test_profile_matches_pandas(spark):
    rng = random.Random(4)
    data = [(rng.choice("abcc"), None if i % 9 == 0 else rng.random(), i) for i in range(200)]
    df = spark.createDataFrame(data, "t string, x double, i bigint")
    got = {r["column"]: r for r in profile.profile(df).collect()}
    want = df.toPandas().describe(include="all")
    for c in ("x", "i"):
        for mine, theirs in {"count": "count", "mean": "mean", "std": "std", "min": "min", "q25": "25%", "q50": "50%",
                             "q75": "75%", "max": "max"}.items():
            assert got[c][mine] == pytest.approx(want[c][theirs])
    counts = Counter(t for t, _, _ in data)
    assert (got["t"]["unique"], got["t"]["top"], got["t"]["freq"]) == (3, "c", counts["c"])


def test_weekday_summary_rounds_half_even(spark):
    df = spark.createDataFrame([("Monday", 0.125), ("Monday", 0.125), ("Sunday", 2.0)], "weekday string, x double")
    got = {r["weekday"]: r["x"] for r in profile.weekday_summary(df, ["x"], digits=2).collect()}
    assert got == {"Monday": 0.12, "Sunday": 2.0}


def test_cross_table_and_cube(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("b", None)], "r string, c boolean")
    got = {r["r"]: (r["n_true"], r["n_false"]) for r in profile.cross_table(df, "r", "c", [True, False]).collect()}
    assert got == {"a": (1, 1), "b": (1, 0)}
    cube = [tuple(r) for r in profile.cube_counts(df, "r", "c").collect()]
    assert (None, None, 4, 3) in cube and ("b", None, 1, 0) in cube and ("b", None, 2, 1) in cube


def test_difference_in_means(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(1, 2, 50), rng.normal(0, 1, 70)
    df = spark.createDataFrame([(float(v), True) for v in a] + [(float(v), False) for v in b] + [(1.0, None)], "v double, f boolean")
    row = inference.difference_in_means(df, "v", F.col("f")).first()
    va, vb = a.var(ddof=1) / 50, b.var(ddof=1) / 70
    assert row["difference"] == pytest.approx(a.mean() - b.mean())
    assert row["std_error"] == pytest.approx((va + vb) ** 0.5)
    assert row["freedom"] == pytest.approx((va + vb) ** 2 / (va**2 / 49 + vb**2 / 69))


def test_held_and_ranged_quartiles_agree(spark):
    df = spark.range(500).selectExpr("CAST((id * 37) % 101 AS DOUBLE) / 8 AS a", "IF(id % 7 = 0, NULL, id) AS b", "CAST(id % 3 AS STRING) AS c")
    names = ["column", "count", "q25", "q50", "q75", "mean", "top"]
    few, many = (sorted(map(tuple, profile.profile(df, n).select(*names).collect())) for n in (10**6, 10))
    assert few == many
