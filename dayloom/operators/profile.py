"""Descriptive tables: dataset profile, summaries by group, cross tables, distributions."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.functions.scalars import round_even
from dayloom.operators.quantiles import exact_quantiles, value_counts
from dayloom.operators.ranking import arg_top
from dayloom.session import scratch_path

# Up to so many rows the built-in exact percentiles, which hold the distinct values of a column in one task, go with the other sums.
HELD_ROWS = 1_000_000
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _long(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.column", "p.value")


def profile(df: DataFrame, held_rows: int = HELD_ROWS) -> DataFrame:
    """Per column: count; for text and flags unique, top, freq; for numbers mean, std, quartiles, range.

    Quartiles are exact. Ties for ``top`` go to the smallest value. The table is written once to the shared folder, as several passes read
    it, and counted on the way: quartiles of up to ``held_rows`` rows come with the other numbers, those of more from ranges of sorted values.
    """
    path, seen = scratch_path(df.sparkSession, "profiled"), Observation("profiled")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    df = df.sparkSession.read.schema(df.schema).parquet(path)
    held = seen.get["rows"] <= held_rows
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    other = [c for c in df.columns if c not in numeric]
    parts = []
    if numeric:
        stats = {
            "count": F.count,
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": F.min,
            "max": F.max,
        }
        if held:
            stats |= {name: (lambda c, at=at: F.percentile(c, F.lit(at))) for name, at in QUARTILES.items()}
        one_row = df.agg(
            *[f(F.col(c).cast("double")).alias(f"{c}.{s}") for c in numeric for s, f in stats.items()]
        )
        rows = [
            F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}.{s}`").alias(s) for s in stats]) for c in numeric
        ]
        summary = one_row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        if not held:
            summary = summary.join(exact_quantiles(_long(df, numeric, "double"), "value", QUARTILES, ["column"]), "column", "left")
        parts.append(summary)
    if other:
        counts = value_counts(_long(df, other, "string"), "value", ["column"])
        tops = counts.groupBy("column").agg(
            F.sum("_n").alias("count"),
            F.count("*").alias("unique"),
            arg_top(F.col("value"), F.col("_n")).alias("top"),
            F.max("_n").alias("freq"),
        )
        parts.append(tops)
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    order = ["column", "count", "unique", "top", "freq", "mean", "std", "min", "q25", "q50", "q75", "max"]
    return out.select(*[F.col(f"`{c}`") if c in out.columns else F.lit(None).alias(c) for c in order])


def weekday_summary(fact: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """Mean of each column by weekday, rounded half to even when ``digits`` is given."""
    means = [F.avg(c) for c in columns]
    if digits is not None:
        means = [round_even(m, digits) for m in means]
    return fact.groupBy("weekday").agg(*[m.alias(c) for m, c in zip(means, columns)])


def cross_table(df: DataFrame, rows: str, columns: str, values: Sequence) -> DataFrame:
    """Counts of ``rows`` by ``columns``. The column values are given, so no extra job looks for them."""
    table = df.groupBy(rows).pivot(columns, list(values)).agg(F.count(F.lit(1)))
    return table.select(rows, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(f"n_{v}".lower()) for v in values])


def cube_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Counts for every combination with subtotals; ``grouping`` tells a subtotal from a missing value."""
    return df.cube(*columns).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("grouping"))


def shares_over_time(df: DataFrame, date: str, column: str) -> DataFrame:
    """``year_month, value, n, share``: the part of a month's rows that each value has, missing ones counted as a value. Counts are combined before the window
    of a month sees them; rows without a date are a month of their own."""
    month = F.date_format(F.to_date(date), "yyyy-MM").alias("year_month")
    counts = df.groupBy(month, F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("year_month")))


def distribution(df: DataFrame, by: str, value: str) -> DataFrame:
    """Count, mean, range and exact quartiles of a value per category."""
    base = df.groupBy(by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max")
    )
    return base.join(exact_quantiles(df, value, QUARTILES, [by]), by, "left")
