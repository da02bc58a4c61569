"""Baselines, what-if scenarios and one-at-a-time sensitivity."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayloom.fixed_values import NUMERIC_FEATURES, SCENARIO_FEATURES, SENSITIVITY_DELTAS
from dayloom.functions.scalars import clip
from dayloom.operators.ranking import column_mode
from dayloom.operators.regression import LinearModel


def baseline(fact: DataFrame) -> dict[str, object]:
    """The average day: feature means and the most frequent weekday. One row reaches the driver."""
    means = fact.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in NUMERIC_FEATURES]).first().asDict()
    weekday = column_mode(fact, "weekday").first()
    return {"weekday": weekday["weekday"] if weekday else None, **means}


def _moved(name: str, start: float, delta: Column) -> Column:
    value = F.lit(start) + delta
    return clip(value, 0.0, 1.0) if name == "reliability" else value


def scenario_inputs(scenarios: DataFrame, start: Mapping[str, object]) -> DataFrame:
    """Each scenario applied to the baseline; reliability stays within 0 and 1."""
    columns = []
    for name in NUMERIC_FEATURES:
        if name in SCENARIO_FEATURES:
            columns.append(_moved(name, start[name], F.col(f"delta_{name}")).alias(name))
        else:
            columns.append(F.lit(start[name]).alias(name))
    return scenarios.select("scenario", "description", F.lit(start["weekday"]).alias("weekday"), *columns)


def _against_baseline(inputs: DataFrame, model: LinearModel, start: Mapping[str, object], name: str, change: str):
    scored = model.predict(inputs, name)
    at_start = score_row(model, start)
    return scored.withColumn(change, F.col(name) - F.lit(at_start))


def score_row(model: LinearModel, row: Mapping[str, object]) -> float:
    """The prediction for a single row of plain values."""
    total = model.intercept
    for name, slope in model.slopes.items():
        if name in row:
            total += slope * row[name]
        elif name == f"is_{str(row['weekday']).lower()}":
            total += slope
    return total


def score_scenarios(scenarios: DataFrame, start: Mapping[str, object], model: LinearModel) -> DataFrame:
    """Predicted target per scenario and its change against the baseline."""
    inputs = scenario_inputs(scenarios, start)
    scored = _against_baseline(inputs, model, start, "predicted_mood", "delta_vs_baseline")
    return scored.select("scenario", "description", "predicted_mood", "delta_vs_baseline")


def custom_scenario(spark, deltas: Mapping[str, float], name: str = "Custom") -> DataFrame:
    """A one-row scenario table from given changes; features not named stay put."""
    unknown = set(deltas) - set(SCENARIO_FEATURES)
    if unknown:
        raise ValueError(f"unknown features: {sorted(unknown)}")
    columns = ", ".join(f"delta_{c} double" for c in SCENARIO_FEATURES)
    row = (name, name, *[float(deltas.get(c, 0.0)) for c in SCENARIO_FEATURES])
    return spark.createDataFrame([row], f"scenario string, description string, {columns}")


def sensitivity_inputs(
    spark, start: Mapping[str, object], deltas: Mapping[str, list[float]] = SENSITIVITY_DELTAS
) -> DataFrame:
    """One row per feature and delta, with only that feature moved."""
    moves = [(feature, delta) for feature, steps in deltas.items() for delta in steps]
    table = spark.createDataFrame(moves, "feature string, delta double")
    columns = []
    for name in NUMERIC_FEATURES:
        still = F.lit(start[name])
        moved = F.when(F.col("feature") == name, _moved(name, start[name], F.col("delta"))).otherwise(still)
        columns.append((moved if name in deltas else still).alias(name))
    return table.select("feature", "delta", F.lit(start["weekday"]).alias("weekday"), *columns)


def score_sensitivity(inputs: DataFrame, start: Mapping[str, object], model: LinearModel) -> DataFrame:
    scored = _against_baseline(inputs, model, start, "prediction", "change_vs_baseline")
    return scored.select("feature", "delta", "prediction", "change_vs_baseline")
