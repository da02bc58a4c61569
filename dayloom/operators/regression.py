"""Least squares of a daily target on weekday and numeric features.

Spark computes sums of products per partition and adds them up; what is solved has the size of the
feature list, never of the data.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.fixed_values import NUMERIC_FEATURES, TARGET
from dayloom.functions.arrow_math import moment_partials, solve_moments
from dayloom.functions.scalars import hash_text, hash_word, weekday_dummies
from dayloom.operators.ranking import hash_numbering

MOMENT_SCHEMA = "replicate int, slot int, value double"
SOLUTION_SCHEMA = (
    "replicate int, n double, intercept double, slopes array<double>, residual_sum double, "
    "inverse_diagonal array<double>"
)


@dataclass(frozen=True)
class Design:
    """Which columns enter the model: weekday dummies (optional) and numeric features."""

    numeric: tuple[str, ...] = tuple(NUMERIC_FEATURES)
    weekday: str | None = "weekday"
    target: str = TARGET

    def columns(self) -> dict[str, Column]:
        dummies = weekday_dummies(self.weekday) if self.weekday else {}
        return {**dummies, **{name: F.col(name).cast("double") for name in self.numeric}}

    def scaled(self) -> list[bool]:
        return [name in self.numeric for name in self.columns()]

    def inputs(self) -> list[str]:
        return [*([self.weekday] if self.weekday else []), *self.numeric]


def model_rows(df: DataFrame, design: Design, on_null: str = "error") -> DataFrame:
    """Rows a model can use. ``error`` stops the job at the first missing value, ``drop`` leaves it out; ``unusable_rows`` counts those."""
    needed = [*design.inputs(), design.target]
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in needed])
    if on_null == "drop":
        return df.where(complete)
    if on_null == "error":
        # assert_true is null when it holds.
        return df.where(F.assert_true(complete, F.lit("missing value in a model column")).isNull())
    raise ValueError("on_null must be 'drop' or 'error'")


def unusable_rows(df: DataFrame, design: Design) -> DataFrame:
    """``rows, dropped``: all rows, and those with a missing value in a model column."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in [*design.inputs(), design.target]])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("dropped"))


def scorable_rows(df: DataFrame, design: Design) -> DataFrame:
    """Rows with all features; the target may be missing."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in design.inputs()]))


@dataclass(frozen=True)
class Scaling:
    """Mean and population deviation of the numeric features (1 where constant)."""

    mean: dict[str, float]
    deviation: dict[str, float]

    def apply(self, name: str) -> Column:
        return (F.col(name).cast("double") - F.lit(self.mean[name])) / F.lit(self.deviation[name])


def fit_scaling(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """One pass; the result is one row of two numbers per feature."""
    row = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns],
    ).first()
    if row[f"m_{columns[0]}"] is None:
        raise ValueError("no rows to fit")
    return Scaling(
        {c: row[f"m_{c}"] for c in columns},
        {c: row[f"s_{c}"] if row[f"s_{c}"] and row[f"s_{c}"] > 1e-12 else 1.0 for c in columns},
    )


def encode(df: DataFrame, design: Design, scaling: Scaling | None = None) -> DataFrame:
    """Model columns beside the originals: ``x_<name>``; numerics standardised when a scaling is given."""
    numeric = {name: scaling.apply(name) if scaling else F.col(name).cast("double") for name in design.numeric}
    columns = {**design.columns(), **numeric}
    return df.select("*", *[column.alias(f"x_{name}") for name, column in columns.items()])


def moment_sums(
    encoded: DataFrame, columns: Sequence[str], replicates: int = 1, weights: str | None = None
) -> DataFrame:
    """Sums of products of ``[1, columns…]`` per replicate, as ``(replicate, slot, value)``."""
    needed = [*columns, *([weights] if weights else [])]
    partials = encoded.select(*needed).mapInArrow(
        moment_partials(replicates, list(columns), weights), MOMENT_SCHEMA
    )
    return partials.groupBy("replicate", "slot").agg(F.sum("value").alias("value"))


def gram_matrix(df: DataFrame, design: Design, on_null: str = "error") -> DataFrame:
    """Standardised cross products of all model columns as ``(row_name, col_name, value)``, built in SQL."""
    rows = model_rows(df, design, on_null)
    encoded = encode(rows, design, fit_scaling(rows, design.numeric))
    names = list(design.columns())
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = encoded.agg(*[F.sum(F.col(f"x_{a}") * F.col(f"x_{b}")).alias(f"{a}*{b}") for a, b in pairs])
    lines = [
        F.struct(F.lit(a).alias("row_name"), F.lit(b).alias("col_name"), F.col(f"`{a}*{b}`").alias("value"))
        for a, b in pairs
    ]
    return sums.select(F.explode(F.array(*lines)).alias("g")).select("g.*")


@dataclass(frozen=True)
class LinearModel:
    """Coefficients in the units of the features."""

    design: Design
    intercept: float
    slopes: dict[str, float]
    n: float = 0.0
    residual_sum: float = 0.0
    inverse_diagonal: dict[str, float] | None = None

    def score(self) -> Column:
        """The prediction as a built-in expression."""
        terms = [F.lit(self.slopes[name]) * column for name, column in self.design.columns().items()]
        return reduce(lambda a, b: a + b, terms, F.lit(self.intercept))

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        return df.withColumn(name, self.score())


def solve_replicates(
    rows: DataFrame, design: Design, replicates: int = 1, weights: str | None = None
) -> list[LinearModel]:
    """One model per replicate. Only coefficients reach the driver: replicates x features numbers.

    Features are first shifted and scaled by overall means, which keeps the sums of products accurate.
    """
    scaling = fit_scaling(rows.drop(weights) if weights else rows, design.numeric)
    encoded = encode(rows, design, scaling)
    names = list(design.columns())
    columns = [*[f"x_{name}" for name in names], design.target]
    typed = encoded.withColumn(design.target, F.col(design.target).cast("double"))
    solved = (
        moment_sums(typed, columns, replicates, weights)
        .groupBy("replicate")
        .applyInPandas(solve_moments(columns, design.scaled()), SOLUTION_SCHEMA)
        .collect()
    )
    models = []
    for row in sorted(solved, key=lambda r: r["replicate"]):
        slopes, intercept, spread = {}, row["intercept"], {}
        for name, slope, inverse in zip(names, row["slopes"], row["inverse_diagonal"]):
            if name in scaling.mean:
                slope, inverse = slope / scaling.deviation[name], inverse / scaling.deviation[name] ** 2
                intercept -= slope * scaling.mean[name]
            slopes[name], spread[name] = slope, inverse
        models.append(LinearModel(design, intercept, slopes, row["n"], row["residual_sum"], spread))
    return models


def fit_linear(df: DataFrame, design: Design = Design(), on_null: str = "error") -> LinearModel:
    """Least-squares model; the minimum-norm one, as weekday dummies and intercept are collinear."""
    return solve_replicates(model_rows(df, design, on_null), design)[0]


def coefficient_table(spark, model: LinearModel) -> DataFrame:
    """``(term, coefficient)``; a handful of rows."""
    rows = [("intercept", model.intercept), *model.slopes.items()]
    return spark.createDataFrame(rows, "term string, coefficient double")


def ols_table(spark, df: DataFrame, design: Design, on_null: str = "error") -> DataFrame:
    """Coefficients with standard errors and t values, for a design of full rank."""
    model = fit_linear(df, design, on_null)
    free = model.n - len(model.slopes) - 1
    variance = model.residual_sum / free
    rows = []
    for name, slope in model.slopes.items():
        error = (variance * model.inverse_diagonal[name]) ** 0.5
        rows.append((name, slope, error, slope / error if error else None))
    return spark.createDataFrame(rows, "term string, coefficient double, std_error double, t_value double")


def without_outlier_days(df: DataFrame, columns: Sequence[str], limit: float = 3.0) -> DataFrame:
    """Leave out days more than ``limit`` population deviations from the mean in any column."""
    scaling = fit_scaling(df, columns)
    near = [F.coalesce(F.abs(scaling.apply(c)) <= limit, F.lit(True)) for c in columns]
    return df.where(reduce(lambda a, b: a & b, near))


def split_holdout(
    df: DataFrame, key: Sequence[str], seed: int, share: float = 0.5, exact: bool = True
) -> DataFrame:
    """Add ``is_test``. Exact: ``ceil(share * n)`` rows in hash order. Otherwise each row by its own hash,
    which needs no shuffle and meets the share on average."""
    if not exact:
        draw = hash_word(hash_text(seed, *[F.col(k) for k in key]))
        return df.withColumn("is_test", draw < F.lit(int(share * 2**32)))
    numbered = hash_numbering(df, key, seed)
    return numbered.withColumn("is_test", F.col("position") < F.ceil(F.col("total") * F.lit(share))).drop(
        "position", "total"
    )


def regression_metrics(predicted: DataFrame, target: str = TARGET, prediction: str = "prediction") -> DataFrame:
    """R squared and mean absolute error over the given predictions, in one pass. Of a target that does not vary R squared is 1 where every
    prediction is right, else 0."""
    y, error = F.col(target).cast("double"), F.col(target).cast("double") - F.col(prediction)
    return predicted.agg(
        F.count(F.lit(1)).alias("n"),
        F.when(F.var_pop(y) == 0, F.when(F.sum(error * error) == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(1 - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(y)))
        .alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
    )


def simple_regressions(df: DataFrame, features: Sequence[str], target: str = TARGET) -> DataFrame:
    """One-feature fits side by side, from Spark's own regression aggregates."""
    def fits(c: str) -> list[Column]:
        x, y = F.col(c).cast("double"), F.col(target).cast("double")
        return [
            F.regr_slope(y, x).alias(f"{c}.slope"),
            F.regr_intercept(y, x).alias(f"{c}.intercept"),
            F.regr_r2(y, x).alias(f"{c}.r2"),
            F.regr_count(y, x).alias(f"{c}.n"),
        ]

    one_row = df.agg(*[column for c in features for column in fits(c)])
    lines = [
        F.struct(
            F.lit(c).alias("feature"),
            *[F.col(f"`{c}.{part}`").alias(part) for part in ("slope", "intercept", "r2", "n")],
        )
        for c in features
    ]
    return one_row.select(F.explode(F.array(*lines)).alias("line")).select("line.*")
