"""Linear models that outlier days and unequal variances do not bend: M-estimates and sandwich errors.

Rows are encoded and written once. Every pass is one aggregation of as many sums as the design has pairs of terms; weights and
residuals are column expressions of the last coefficients, and only sums reach the driver.
"""
from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.operators.regression import Design, Scaling, encode, fit_scaling, model_rows
from dayloom.session import scratch_path

Y = "y"


@dataclass(frozen=True)
class Loss:
    """How a residual, in units of the scale, counts: ``weight`` of its square, ``slope`` of its influence."""

    name: str
    tuning: float
    weight: Callable[[Column, float], Column]
    slope: Callable[[Column, float], Column]


def _huber_weight(u: Column, c: float) -> Column:
    return F.when(F.abs(u) <= c, F.lit(1.0)).otherwise(F.lit(c) / F.abs(u))


def _huber_slope(u: Column, c: float) -> Column:
    return F.when(F.abs(u) <= c, F.lit(1.0)).otherwise(F.lit(0.0))


def _tukey_weight(u: Column, c: float) -> Column:
    inner = 1 - (u / c) * (u / c)
    return F.when(F.abs(u) < c, inner * inner).otherwise(F.lit(0.0))


def _tukey_slope(u: Column, c: float) -> Column:
    v = (u / c) * (u / c)
    return F.when(F.abs(u) < c, (1 - v) * (1 - 5 * v)).otherwise(F.lit(0.0))


# Tuning constants of 95 % efficiency under normal errors.
HUBER = Loss("huber", 1.345, _huber_weight, _huber_slope)
TUKEY = Loss("tukey", 4.685, _tukey_weight, _tukey_slope)


def huber_consistency(c: float) -> float:
    """Mean squared Huber influence of a standard normal residual."""
    density, below = math.exp(-c * c / 2) / math.sqrt(2 * math.pi), 0.5 * (1 + math.erf(c / math.sqrt(2)))
    return 2 * c * c * (1 - below) + 2 * below - 1 - 2 * c * density


@dataclass(frozen=True)
class _Rows:
    """Encoded rows in the shared folder, with the terms of the model in deviations from the mean. Of ``every`` feature those that vary have
    ``names`` and terms."""

    table: DataFrame
    names: list[str]
    scaling: Scaling
    every: list[str]

    def terms(self) -> list[Column]:
        return [F.lit(1.0), *[F.col(f"x_{name}") for name in self.names]]

    def fitted(self, beta: np.ndarray) -> Column:
        return reduce(lambda a, b: a + b, [F.lit(float(b)) * z for b, z in zip(beta, self.terms(), strict=True)])

    def sums(self, weight: Column, *more: Column) -> tuple[np.ndarray, np.ndarray, list[float]]:
        """Weighted products of the terms with each other and with the target, and further sums, in one pass."""
        terms = [*self.terms(), F.col(Y)]
        pairs = [(i, j) for i in range(len(terms)) for j in range(i, len(terms))]
        row = self.table.select(*[c.alias(f"t{i}") for i, c in enumerate(terms)], weight.alias("w"), *[c.alias(f"m{i}") for i, c in enumerate(more)]).agg(
            *[F.sum(F.col("w") * F.col(f"t{i}") * F.col(f"t{j}")) for i, j in pairs], *[F.sum(f"m{i}") for i in range(len(more))]
        ).first()
        size = len(terms) - 1
        square, target = np.zeros((size, size)), np.zeros(size)
        for (i, j), value in zip(pairs, row, strict=False):
            if j < size:
                square[i, j] = square[j, i] = value or 0.0
            elif i < size:
                target[i] = value or 0.0
        return square, target, [float(v or 0.0) for v in row[len(pairs) :]]


def _written(df: DataFrame, design: Design, on_null: str) -> _Rows:
    if design.weekday is not None:
        raise ValueError("a weekday dummy for every day and the intercept are collinear; errors need a design of full rank")
    rows = model_rows(df, design, on_null)
    names = list(design.columns())
    scaling = fit_scaling(rows, design.numeric)
    encoded = encode(rows, design, scaling).select(*[f"x_{n}" for n in names], F.col(design.target).cast("double").alias(Y))
    path = scratch_path(df.sparkSession, "robust")
    encoded.write.parquet(path)
    table = df.sparkSession.read.schema(encoded.schema).parquet(path)
    ends = table.agg(*[F.struct(F.min(f"x_{n}").alias("low"), F.max(f"x_{n}").alias("high")).alias(n) for n in names]).first()
    return _Rows(table, [n for n in names if ends[n]["low"] != ends[n]["high"]], scaling, names)


@dataclass(frozen=True)
class _LeastSquares:
    beta: np.ndarray
    inverse: np.ndarray
    n: float
    residual_sum: float


def _least_squares(rows: _Rows) -> _LeastSquares:
    square, target, (n, squares) = rows.sums(F.lit(1.0), F.lit(1.0), F.col(Y) * F.col(Y))
    if n <= len(square):
        raise ValueError(f"{int(n)} rows cannot determine {len(square)} coefficients and a scale")
    if np.linalg.matrix_rank(square, hermitian=True) < len(square):
        raise ValueError("the features are collinear")
    beta = np.linalg.solve(square, target)
    return _LeastSquares(beta, np.linalg.inv(square), n, max(0.0, squares - float(beta @ target)))


@dataclass(frozen=True)
class RobustFit:
    """Coefficients in the units of the features, with the scale of the residuals and the number of passes. A feature that is constant in
    the rows has neither slope nor error: None."""

    intercept: float
    slopes: dict[str, float | None]
    errors: dict[str, float | None]
    scale: float
    passes: int


def fit_robust(df: DataFrame, design: Design, loss: Loss = HUBER, on_null: str = "error", most: int = 100, tolerance: float = 1e-9) -> RobustFit:
    """M-estimate by iteratively reweighted least squares.

    Huber's estimate solves for coefficients and scale at once (proposal 2: the scale is such that the mean squared influence is that
    of normal errors), so no pass sorts residuals. Tukey's starts from it and keeps its scale, as its own equations have many solutions.
    Rows may be repeated; missing values are handled as ``on_null`` says. A feature that is constant in the rows is left to the intercept. A fit that
    has not settled after ``most`` passes raises; so do collinear features and too few rows. Rows on one plane give that plane, with scale and errors of zero.

    Errors follow from the influence: its mean square over the squared mean of its slope, with Huber's correction for the number of terms.
    """
    rows = _written(df, design, on_null)
    start = _least_squares(rows)
    terms = len(start.beta)
    free = start.n - terms
    beta, scale = start.beta, math.sqrt(start.residual_sum / free)
    size = math.sqrt(rows.table.agg(F.avg(F.col(Y) * F.col(Y))).first()[0] or 0.0)
    if scale <= 1e-7 * max(size, 1e-300):
        return _in_units(rows, beta, np.zeros(terms), 0.0, 1)
    passes = 1

    def settle(how: Loss, beta: np.ndarray, scale: float, moves: bool) -> tuple[np.ndarray, float]:
        nonlocal passes
        for _ in range(most):
            u = (F.col(Y) - rows.fitted(beta)) / F.lit(scale)
            weight = how.weight(u, how.tuning)
            square, target, (squares,) = rows.sums(weight, weight * u * weight * u)
            passes += 1
            if np.linalg.matrix_rank(square, hermitian=True) < terms:
                raise RuntimeError(f"too few rows keep a weight under the {how.name} loss")
            new = np.linalg.solve(square, target)
            wider = scale * math.sqrt(squares / (free * huber_consistency(how.tuning))) if moves else scale
            change = max(float(np.abs(new - beta).max()) / scale, abs(wider - scale) / scale)
            beta, scale = new, wider
            if change < tolerance:
                return beta, scale
        raise RuntimeError(f"the {how.name} fit did not settle in {most} passes")

    beta, scale = settle(HUBER, beta, scale, True)
    if loss is not HUBER:
        beta, scale = settle(loss, beta, scale, False)
    u = (F.col(Y) - rows.fitted(beta)) / F.lit(scale)
    influence, slope = loss.weight(u, loss.tuning) * u, loss.slope(u, loss.tuning)
    _, _, (squares, slopes, slope_squares) = rows.sums(F.lit(1.0), influence * influence, slope, slope * slope)
    mean = slopes / start.n
    correction = 1 + terms / start.n * (slope_squares / start.n - mean * mean) / (mean * mean)
    variance = correction**2 * scale**2 * (squares / free) / (mean * mean) * np.diag(start.inverse)
    return _in_units(rows, beta, np.sqrt(variance), scale, passes + 1)


def _in_units(rows: _Rows, beta: np.ndarray, errors: np.ndarray, scale: float, passes: int) -> RobustFit:
    deviation = [rows.scaling.deviation[n] for n in rows.names]
    unknown = dict.fromkeys(rows.every)
    slopes = unknown | {n: float(b) / d for n, b, d in zip(rows.names, beta[1:], deviation, strict=True)}
    spread = unknown | {n: float(e) / d for n, e, d in zip(rows.names, errors[1:], deviation, strict=True)}
    intercept = float(beta[0]) - sum(slopes[n] * rows.scaling.mean[n] for n in rows.names)
    return RobustFit(intercept, slopes, spread, scale, passes)


def robust_table(df: DataFrame, design: Design, loss: Loss = HUBER, on_null: str = "error") -> DataFrame:
    """``term, coefficient, std_error, t_value`` of an M-estimate; a row a feature, with nulls where the feature is constant in the rows."""
    fit = fit_robust(df, design, loss, on_null)
    rows = [(n, b, fit.errors[n], b / fit.errors[n] if fit.errors[n] else None) for n, b in fit.slopes.items()]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double, std_error double, t_value double")


def sandwich_table(df: DataFrame, design: Design, on_null: str = "error") -> DataFrame:
    """``term, coefficient, hc1_error, hc3_error``: least squares with errors that do not assume equal variances.

    HC1 scales the squared residuals by ``n / (n - terms)``, HC3 divides each by its squared distance from full leverage. The variance of a coefficient is a sum over
    the rows of the squared residual times the squared influence of the row on it, so the second pass needs one sum a coefficient and kind. A row
    of full leverage has no residual and adds nothing. A feature that is constant in the rows has nulls.
    """
    rows = _written(df, design, on_null)
    fit = _least_squares(rows)
    terms = rows.terms()
    residual = F.col(Y) - rows.fitted(fit.beta)

    def along(weights: np.ndarray) -> Column:
        return reduce(lambda a, b: a + b, [F.lit(float(w)) * z for w, z in zip(weights, terms, strict=True)])

    influences = [along(line) for line in fit.inverse]
    leverage = reduce(lambda a, b: a + b, [z * t for z, t in zip(terms, influences, strict=True)])
    away = F.greatest(1 - leverage, F.lit(0.0))
    parts = rows.table.select((residual * residual).alias("e"), away.alias("away"), *[(t * t).alias(f"t{i}") for i, t in enumerate(influences)])
    apart = F.when(F.col("away") > 1e-10, F.col("e") / (F.col("away") * F.col("away"))).otherwise(F.lit(0.0))
    sums = parts.agg(*[F.sum(F.col("e") * F.col(f"t{i}")) for i in range(len(terms))], *[F.sum(apart * F.col(f"t{i}")) for i in range(len(terms))]).first()
    hc1 = np.sqrt(np.array(sums[: len(terms)]) * fit.n / (fit.n - len(terms)))
    hc3 = np.sqrt(np.array(sums[len(terms) :]))
    plain, first = _in_units(rows, fit.beta, hc1, 0.0, 2), _in_units(rows, fit.beta, hc3, 0.0, 2)
    lines = [(n, b, plain.errors[n], first.errors[n]) for n, b in plain.slopes.items()]
    return df.sparkSession.createDataFrame(lines, "term string, coefficient double, hc1_error double, hc3_error double")
