"""M-estimates and sandwich errors against plain numpy."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from dayloom.catalog import queries
from dayloom.operators import robust
from dayloom.operators.regression import Design
from tests.cases import write_feed_tables

DESIGN = Design(numeric=("a", "b"), weekday=None, target="y")


def table(spark, rows):
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], "a double, b double, y double").repartition(4)


def sample(n=400, seed=1, outliers=30):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(1000, 50, n), rng.normal(0, 0.01, n)
    y = 3 + 0.02 * a - 40 * b + rng.normal(0, 1, n) * (1 + np.abs(a - 1000) / 50)
    y[:outliers] += 60
    return np.column_stack([a, b, y])


def plain_huber(rows, c=1.345, passes=300):
    z, y = np.column_stack([np.ones(len(rows)), rows[:, :2]]), rows[:, 2]
    mean, spread = z[:, 1:].mean(0), z[:, 1:].std(0)
    z[:, 1:] = (z[:, 1:] - mean) / spread
    beta = np.linalg.lstsq(z, y, rcond=None)[0]
    scale = np.sqrt(((y - z @ beta) ** 2).sum() / (len(y) - 3))
    grid = np.linspace(-9, 9, 400001)
    kappa = np.trapezoid(np.minimum(grid**2, c * c) * np.exp(-grid**2 / 2) / np.sqrt(2 * np.pi), grid)
    for _ in range(passes):
        u = (y - z @ beta) / scale
        w = np.where(np.abs(u) <= c, 1.0, c / np.maximum(np.abs(u), 1e-300))
        new = np.linalg.solve(z.T @ (w[:, None] * z), z.T @ (w * y))
        scale *= np.sqrt(((w * u) ** 2).sum() / ((len(y) - 3) * kappa))
        beta = new
    return beta[1:] / spread, scale


def test_huber_equals_plain_numpy_and_ignores_outliers(spark):
    rows = sample()
    fit = robust.fit_robust(table(spark, rows), DESIGN)
    slopes, scale = plain_huber(rows)
    assert [fit.slopes["a"], fit.slopes["b"]] == pytest.approx(slopes, rel=1e-6) and fit.scale == pytest.approx(scale, rel=1e-6)
    assert fit.slopes["a"] == pytest.approx(0.02, abs=0.01)


def test_tukey_leaves_far_rows_out(spark):
    rows = sample(outliers=0)
    clean = robust.fit_robust(table(spark, rows), DESIGN, robust.TUKEY)
    far = np.vstack([rows, [[1000, 0, 1e6]] * 5])
    other = robust.fit_robust(table(spark, far), DESIGN, robust.TUKEY)
    assert other.slopes["a"] == pytest.approx(clean.slopes["a"], abs=0.004)
    assert all(e > 0 for e in other.errors.values())


def test_sandwich_errors_equal_plain_numpy(spark):
    rows = sample(150)
    z, y = np.column_stack([np.ones(len(rows)), rows[:, :2]]), rows[:, 2]
    inverse = np.linalg.inv(z.T @ z)
    e = y - z @ (inverse @ z.T @ y)
    h = np.einsum("ij,jk,ik->i", z, inverse, z)
    hc1 = np.sqrt(np.diag(inverse @ (z.T * e**2) @ z @ inverse) * len(y) / (len(y) - 3))
    hc3 = np.sqrt(np.diag(inverse @ (z.T * (e / (1 - h)) ** 2) @ z @ inverse))
    got = {r["term"]: r for r in robust.sandwich_table(table(spark, rows), DESIGN).collect()}
    for i, name in enumerate("ab", 1):
        assert (got[name]["hc1_error"], got[name]["hc3_error"]) == pytest.approx((hc1[i], hc3[i]), rel=1e-6)


def test_edges(spark):
    flat = [(i, (i * 7) % 5, 2 + 3 * i - (i * 7) % 5) for i in range(30)]
    fit = robust.fit_robust(table(spark, flat), DESIGN)
    assert fit.slopes == pytest.approx({"a": 3.0, "b": -1.0}) and fit.scale == 0 and set(fit.errors.values()) == {0.0}
    with pytest.raises(ValueError, match="collinear"):
        robust.fit_robust(table(spark, [(i, 2 * i, i % 3) for i in range(30)]), DESIGN)
    with pytest.raises(ValueError, match="cannot determine"):
        robust.fit_robust(table(spark, flat[:3]), DESIGN)
    with pytest.raises(RuntimeError, match="did not settle in 2 passes"):
        robust.fit_robust(table(spark, sample()), DESIGN, most=2)
    with pytest.raises(ValueError, match="full rank"):
        robust.fit_robust(table(spark, flat), Design(numeric=("a", "b"), target="y"))
    holes = table(spark, flat).unionByName(spark.createDataFrame([(None, 1.0, 2.0), (1.0, 1.0, None)], "a double, b double, y double"))
    assert robust.fit_robust(holes, DESIGN, on_null="drop").slopes == pytest.approx({"a": 3.0, "b": -1.0})
    with pytest.raises(Exception, match="missing value"):
        robust.fit_robust(holes, DESIGN)


def test_a_constant_feature_is_left_to_the_intercept(spark):
    rows = sample(200)
    wide, plain = Design(numeric=("a", "one", "b"), weekday=None, target="y"), table(spark, rows)
    held = plain.withColumn("one", F.lit(0.1))
    for loss in (robust.HUBER, robust.TUKEY):
        got = {r["term"]: r for r in robust.robust_table(held, wide, loss).collect()}
        for want in robust.robust_table(plain, DESIGN, loss).collect():
            assert tuple(got[want["term"]])[1:] == pytest.approx(tuple(want)[1:])
        assert list(got) == ["a", "one", "b"] and tuple(got["one"]) == ("one", None, None, None)
    got = {r["term"]: r for r in robust.sandwich_table(held, wide).collect()}
    for want in robust.sandwich_table(plain, DESIGN).collect():
        assert tuple(got[want["term"]])[1:] == pytest.approx(tuple(want)[1:])
    assert list(got) == ["a", "one", "b"] and tuple(got["one"]) == ("one", None, None, None)


@pytest.fixture(scope="module")
def rainy(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("rainy"))
    write_feed_tables(spark, folder)
    return folder


def lines_where_it_always_rains(spark, folder, name):
    """The lines of a query by term, but for ``after_rain``, which holds nulls."""
    got = {r["term"]: tuple(r)[1:] for r in queries.QUERIES[name](spark, folder).collect()}
    assert list(got) == list(queries.CONTROLS.numeric) and got.pop("after_rain") == (None, None, None)
    return got


def test_robust_tukey_answers_where_it_rains_on_every_day(spark, rainy):
    for coefficient, error, t in lines_where_it_always_rains(spark, rainy, "robust_tukey").values():
        assert error > 0 and t == pytest.approx(coefficient / error, rel=0.05, abs=0.02)


def test_sandwich_errors_answers_where_it_rains_on_every_day(spark, rainy):
    got = lines_where_it_always_rains(spark, rainy, "sandwich_errors")
    dry = Design(numeric=tuple(n for n in queries.CONTROLS.numeric if n != "after_rain"), weekday=None)
    want = {r["term"]: tuple(r)[1:] for r in robust.sandwich_table(queries._analysis(spark, rainy), dry, "drop").collect()}
    assert got.keys() == want.keys()
    for term, line in want.items():
        assert got[term] == pytest.approx(line, abs=2e-6) and line[1] > 0
