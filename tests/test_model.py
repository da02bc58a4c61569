import random
from hashlib import md5

import numpy as np
import pytest
from pyspark.sql import functions as F

from dayloom.catalog.queries import QUERIES
from dayloom.fixed_values import NUMERIC_FEATURES, WEEKDAYS
from dayloom.operators import bootstrap as B
from dayloom.operators import inference, scenarios
from dayloom.operators import regression as R
from dayloom.sources.datasets import default_scenarios
from tests.cases import write_feed_tables

DESIGN = R.Design()


def days(n=120, seed=3, weekdays=WEEKDAYS):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        weekday = weekdays[i % len(weekdays)]
        x = [rng.uniform(20, 120), rng.uniform(3, 20), rng.random(), rng.uniform(2, 40), rng.choice([0.0, 3.5, 12.0]),
             float(rng.random() < 0.5), float(rng.randrange(3000, 15000)), rng.uniform(5, 9), float(rng.randrange(0, 400))]
        mood = 3 - 0.01 * x[0] + 0.5 * x[2] + 0.2 * x[7] + 0.3 * (weekday == "Friday") + rng.gauss(0, 0.2)
        out.append((f"d{i:04d}", weekday, *x, mood))
    return out


SCHEMA = "date string, weekday string, " + ", ".join(f"{c} double" for c in NUMERIC_FEATURES) + ", mood_1_5 double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def matrix(rows, weekdays=WEEKDAYS):
    return np.array([[*[float(r[1] == w) for w in WEEKDAYS], *r[2:-1]] for r in rows]), np.array([r[-1] for r in rows])


def minimum_norm(x, y, weights=None):
    """Centre, divide numerics by their population deviation, solve by least squares."""
    w = np.ones(len(y)) if weights is None else weights
    mean = (w @ x) / w.sum()
    spread = np.ones(x.shape[1])
    var = (w @ (x - mean) ** 2) / w.sum()
    spread[7:] = np.where(var[7:] > 1e-12, np.sqrt(var[7:]), 1.0)
    root = np.sqrt(w)[:, None]
    z = (x - mean) / spread * root
    ym = (w @ y) / w.sum()
    beta = np.linalg.lstsq(z, (y - ym) * root[:, 0], rcond=1e-10)[0] / spread
    return ym - mean @ beta, beta


def test_fit_is_the_minimum_norm_solution(spark):
    rows = days()
    model = R.fit_linear(frame(spark, rows))
    x, y = matrix(rows)
    intercept, beta = minimum_norm(x, y)
    assert model.intercept == pytest.approx(intercept, abs=1e-8)
    assert list(model.slopes.values()) == pytest.approx(list(beta), abs=1e-8)
    got = {r["date"]: r["prediction"] for r in model.predict(frame(spark, rows)).collect()}
    for r, want in zip(rows, intercept + x @ beta):
        assert got[r[0]] == pytest.approx(want, abs=1e-8)


def test_absent_weekday_and_constant_feature(spark):
    rows = [(*r[:3], 5.0, *r[4:]) for r in days(weekdays=WEEKDAYS[:5])]
    model = R.fit_linear(frame(spark, rows))
    assert model.slopes["is_saturday"] == pytest.approx(0.0, abs=1e-10)
    assert model.slopes["opal_cost"] == pytest.approx(0.0, abs=1e-10)
    intercept, beta = minimum_norm(*matrix(rows))
    assert list(model.slopes.values()) == pytest.approx(list(beta), abs=1e-8)


def test_missing_values(spark):
    rows = days(40)
    rows[3] = (*rows[3][:-1], None)
    df = frame(spark, rows)
    assert R.model_rows(df, DESIGN, "drop").count() == 39
    with pytest.raises(Exception, match="missing value in a model column"):
        R.model_rows(df, DESIGN).collect()
    with pytest.raises(ValueError):
        R.model_rows(df, DESIGN, "ignore")
    with pytest.raises(ValueError, match="no rows"):
        R.fit_linear(df.limit(0))


def test_gram_in_sql_equals_gram_in_numpy(spark):
    rows = days(60)
    df = frame(spark, rows)
    got = {(r["row_name"], r["col_name"]): r["value"] for r in R.gram_matrix(df, DESIGN).collect()}
    x, _ = matrix(rows)
    x[:, 7:] = (x[:, 7:] - x[:, 7:].mean(axis=0)) / x[:, 7:].std(axis=0)
    names = list(DESIGN.columns())
    for i, a in enumerate(names):
        for j in range(i, len(names)):
            assert got[a, names[j]] == pytest.approx(x[:, i] @ x[:, j], abs=1e-8)


def test_exact_split(spark):
    df = frame(spark, days(41))
    split = R.split_holdout(df, ["date"], 42)
    assert split.where("is_test").count() == 21
    again = R.split_holdout(df.repartition(2), ["date"], 42)
    assert {r[0] for r in split.where("is_test").select("date").collect()} == {
        r[0] for r in again.where("is_test").select("date").collect()
    }
    loose = R.split_holdout(spark.range(4000), ["id"], 1, 0.3, exact=False)
    assert 0.26 < loose.where("is_test").count() / 4000 < 0.34


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "mood_1_5 double, prediction double")
    row = R.regression_metrics(df).first()
    y, p = np.array([1.0, 2.0, 4.0]), np.array([1.5, 2.0, 3.0])
    assert row["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert row["mae"] == pytest.approx(0.5)


@pytest.mark.parametrize("method", ["multinomial", "poisson"])
def test_intervals_match_explicit_refits(spark, method):
    rows = days(50)
    df = frame(spark, rows)
    weights = np.zeros((24, 50))
    at = {r[0]: i for i, r in enumerate(rows)}
    for r in B.weight_table(df, ["date"], 9, 24, method).collect():
        weights[r["replicate"], at[r["date"]]] = r["weight"]
    if method == "multinomial":
        assert set(weights.sum(axis=1)) == {50}
    assert 0.85 < weights.mean() < 1.15
    x, y = matrix(rows)
    fits = [minimum_norm(x, y, w) for w in weights]
    predictions = np.array([a + x @ b for a, b in fits])
    low, high = np.percentile(predictions, [2.5, 97.5], axis=0)
    a, b = minimum_norm(x, y)
    got = B.prediction_intervals(df, ["date"], replicates=24, seed=9, method=method, keep=["weekday"]).collect()
    assert len(got) == 50
    for r in got:
        i = at[r["date"]]
        assert r["prediction"] == pytest.approx((a + x @ b)[i], abs=1e-7)
        assert (r["lower_ci"], r["upper_ci"]) == (pytest.approx(low[i], abs=1e-6), pytest.approx(high[i], abs=1e-6))
        assert r["weekday"] == rows[i][1]


def test_poisson_weights_have_unit_mean_and_variance(spark):
    table = B.weight_table(spark.range(4000), ["id"], 5, 8, "poisson")
    totals = table.groupBy("replicate").agg(F.sum("weight").alias("s"), F.sum(F.col("weight") ** 2).alias("q")).collect()
    assert len(totals) == 8
    for r in totals:
        mean = r["s"] / 4000
        assert mean == pytest.approx(1.0, abs=0.08)
        assert r["q"] / 4000 - mean**2 == pytest.approx(1.0, abs=0.15)


def test_weights_do_not_depend_on_partitioning(spark, rows):
    a = B.weight_table(spark.range(50).repartition(1), ["id"], 5, 6, "multinomial")
    b = B.weight_table(spark.range(50).repartition(7), ["id"], 5, 6, "multinomial")
    assert rows(a, "id", "replicate", "weight") == rows(b, "id", "replicate", "weight")


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        B.weight_table(spark.range(5), ["id"], 5, 6, "jackknife")


def test_recent_days(spark):
    df = spark.createDataFrame([(f"2025-01-{d:02d}",) for d in range(1, 12)], "date string")
    assert [r[0] for r in B.recent_days(df, 3).collect()] == ["2025-01-11", "2025-01-10", "2025-01-09"]
    assert B.recent_days(df.limit(2)).count() == 2


def test_scenarios_move_the_baseline(spark):
    rows = days()
    df = frame(spark, rows)
    start = scenarios.baseline(df)
    assert start["weekday"] == "Monday"
    model = R.fit_linear(df)
    inputs = {r["scenario"]: r for r in scenarios.scenario_inputs(default_scenarios(spark), start).collect()}
    assert inputs["Rainy Commute"]["commute_minutes"] == pytest.approx(start["commute_minutes"] + 15)
    assert inputs["Rainy Commute"]["opal_cost"] == pytest.approx(start["opal_cost"])
    scored = {r["scenario"]: r for r in scenarios.score_scenarios(default_scenarios(spark), start, model).collect()}
    assert scored["Baseline"]["delta_vs_baseline"] == pytest.approx(0.0, abs=1e-12)
    want = sum(model.slopes[c] * d for c, d in zip(
        ["commute_minutes", "reliability", "pm25_mean", "rain_24h_mm", "steps", "sleep_hours", "caffeine_mg"],
        [15, -0.15, 8, 20, -400, -0.3, 80]))
    assert scored["Rainy Commute"]["delta_vs_baseline"] == pytest.approx(want)
    high = scenarios.custom_scenario(spark, {"reliability": 5.0})
    assert scenarios.scenario_inputs(high, start).first()["reliability"] == 1.0


def test_sensitivity_moves_one_feature(spark):
    df = frame(spark, days())
    start, model = scenarios.baseline(df), R.fit_linear(df)
    inputs = scenarios.sensitivity_inputs(spark, start)
    assert inputs.count() == 14
    scored = {(r["feature"], r["delta"]): r["change_vs_baseline"]
              for r in scenarios.score_sensitivity(inputs, start, model).collect()}
    assert scored["steps", 1500.0] == pytest.approx(1500 * model.slopes["steps"])
    assert scored["steps", -1500.0] == pytest.approx(-1500 * model.slopes["steps"])


def test_ols_standard_errors(spark):
    rows = days()
    design = R.Design(numeric=("commute_minutes", "sleep_hours"), weekday=None)
    got = {r["term"]: r for r in R.ols_table(spark, frame(spark, rows), design).collect()}
    x = np.array([[1.0, r[2], r[9]] for r in rows])
    y = np.array([r[-1] for r in rows])
    beta = np.linalg.solve(x.T @ x, x.T @ y)
    sigma = ((y - x @ beta) ** 2).sum() / (len(y) - 3)
    errors = np.sqrt(sigma * np.diag(np.linalg.inv(x.T @ x)))
    assert got["commute_minutes"]["coefficient"] == pytest.approx(beta[1])
    assert got["commute_minutes"]["std_error"] == pytest.approx(errors[1])
    assert got["sleep_hours"]["t_value"] == pytest.approx(beta[2] / errors[2])


def test_outlier_days_leave(spark):
    df = spark.createDataFrame([(float(i % 3),) for i in range(40)] + [(1000.0,), (None,)], "x double")
    assert R.without_outlier_days(df, ["x"]).count() == 41


def test_logit_matches_newton(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=400).round(1)
    y = rng.random(400) < 1 / (1 + np.exp(-(0.4 - 0.9 * x)))
    df = spark.createDataFrame([(bool(a), float(b)) for a, b in zip(y, x)] + [(None, 1.0)], "s boolean, x double")
    model = inference.fit_logit(df, "s", ["x"])
    beta, z = np.zeros(2), np.column_stack([np.ones(400), x])
    for _ in range(20):
        p = 1 / (1 + np.exp(-z @ beta))
        beta = beta + np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z, z.T @ (y - p))
    got = [r["coefficient"] for r in inference.logit_table(spark, model, ["x"]).collect()]
    assert got == pytest.approx(list(beta), abs=1e-4)


def test_weights_are_drawn_once_a_key_and_not_for_every_raw_row(spark):
    """Codes follow from the key alone; no filter on them may sink below the groups the keys come from."""
    raw = spark.range(400).select((F.col("id") % 40).cast("string").alias("date"), F.col("id").cast("double").alias("x"))
    days = raw.groupBy("date").agg(F.sum("x").alias("mood"))
    for table in (B.weight_table(days, ["date"], 5, 12, "poisson"), B.bootstrap_means(days, "mood", ["date"], 5, 12)):
        lines = table._jdf.queryExecution().optimizedPlan().toString().splitlines()
        hashed = [i for i, line in enumerate(lines) if "md5" in line]
        assert len(hashed) == 1 and hashed[0] <= max(i for i, line in enumerate(lines) if "Aggregate" in line)
    codes = {r["date"]: r["_codes"] for r in B.with_weights(days, ["date"], 5, 12, "poisson").collect()}
    want = sorted((d, c >> 32, c & 0xFFFFFFFF) for d, line in codes.items() for c in line)
    assert sorted(map(tuple, B.weight_table(days, ["date"], 5, 12, "poisson").collect())) == want


def test_bootstrap_weights_poisson_draws_its_weights_once_a_day(spark, tmp_path):
    """Over raw tables, the query hashes days that the groups have made and no raw row; its weights are those of plain Python."""
    write_feed_tables(spark, str(tmp_path))
    drawn = QUERIES["bootstrap_weights_poisson"](spark, str(tmp_path))
    lines = drawn._jdf.queryExecution().optimizedPlan().toString().splitlines()
    hashed, grouped = ([i for i, line in enumerate(lines) if word in line] for word in ("md5", "Aggregate"))
    assert len(hashed) == 1 and hashed[0] < min(grouped)
    days = {r["date"] for r in QUERIES["fact_day"](spark, str(tmp_path)).collect() if r["mood_1_5"] is not None}

    def weight(day, replicate):
        text = md5(f"42|{replicate // 4}|{day}".encode()).hexdigest()
        word = int(text[replicate % 4 * 8 :][:8], 16)
        return sum(word >= step for step in B.POISSON_STEPS)

    want = {(day, r, weight(day, r)) for day in days for r in range(20)}
    assert {tuple(r) for r in drawn.collect()} == {line for line in want if line[2]}
