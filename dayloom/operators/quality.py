"""Data-quality checks. A suite is one aggregation over the table, whatever the number of rules."""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom import fixed_values as V
from dayloom.functions.scalars import no_nan

PASS, FAIL, SKIPPED = "pass", "fail", "skipped"


@dataclass(frozen=True)
class Rule:
    """``observed`` are aggregates; ``failing`` turns their columns into a text, empty when all is well."""

    name: str
    observed: Mapping[str, Column] = field(default_factory=dict)
    failing: Callable[[Mapping[str, Column]], Column] = lambda seen: F.lit("")


def required_columns(df: DataFrame, required: Sequence[str]) -> Rule:
    missing = ",".join(c for c in required if c not in df.columns)
    return Rule("required_columns", failing=lambda seen: F.lit(missing))


def _listed(flags: Mapping[str, Column]) -> Column:
    return F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in flags.items()])


def is_missing(column: str) -> Column:
    """Null, or NaN in a floating column."""
    value = F.col(column)
    return value.isNull() | (F.typeof(value).isin("double", "float") & (value.cast("string") == "NaN"))


def not_null(columns: Sequence[str], name: str = "not_null") -> Rule:
    return Rule(
        name,
        {c: F.count_if(is_missing(c)) for c in columns},
        lambda seen: _listed({c: seen[c] > 0 for c in columns}),
    )


def value_range(column: str, low: float | None, high: float | None) -> Rule:
    """All values inside the bounds. A missing value fails; an empty table passes."""
    value = no_nan(F.col(column).cast("double"))
    bounds = [value >= low] if low is not None else []
    bounds += [value <= high] if high is not None else []
    inside = reduce(lambda a, b: a & b, bounds, F.lit(True))
    return Rule(
        f"range_{column}",
        {"ok": F.coalesce(F.bool_and(F.coalesce(inside, F.lit(False))), F.lit(True))},
        lambda seen: _listed({column: ~seen["ok"]}),
    )


def boolean_domain(df: DataFrame, column: str) -> Rule:
    """Booleans, or numbers that are 0 or 1; missing values pass, text never does."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.BooleanType):
        stray = F.lit(False)
    elif isinstance(kind, T.NumericType):
        stray = ~is_missing(column) & ~F.col(column).isin(0, 1)
    else:
        stray = F.col(column).isNotNull()
    return Rule(
        f"boolean_{column}", {"n": F.count_if(stray)}, lambda seen: _listed({column: seen["n"] > 0})
    )


def value_domain(column: str, allowed: Sequence[str]) -> Rule:
    stray = F.col(column).isNotNull() & ~F.col(column).isin(list(allowed))
    return Rule(f"domain_{column}", {"n": F.count_if(stray)}, lambda seen: _listed({column: seen["n"] > 0}))


def completeness(columns: Sequence[str], minimum: float = V.MIN_COMPLETENESS) -> Rule:
    return Rule(
        "completeness",
        {c: F.avg((~is_missing(c)).cast("double")) for c in columns},
        lambda seen: _listed({c: F.coalesce(seen[c] < minimum, F.lit(False)) for c in columns}),
    )


def run_suite(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Report ``(check, status, failing)``, from a single pass over the table."""
    aggregates = [
        expression.alias(f"{i}.{key}") for i, rule in enumerate(rules) for key, expression in rule.observed.items()
    ]
    one_row = df.agg(*(aggregates or [F.count(F.lit(1)).alias("rows")]))
    lines = []
    for i, rule in enumerate(rules):
        failing = rule.failing({key: F.col(f"`{i}.{key}`") for key in rule.observed})
        lines.append(
            F.struct(
                F.lit(rule.name).alias("check"),
                F.when(failing == "", PASS).otherwise(FAIL).alias("status"),
                failing.alias("failing"),
            )
        )
    return one_row.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def mart_rules(fact: DataFrame) -> list[Rule]:
    """The suite for a freshly built fact table."""
    return [
        required_columns(fact, V.FACT_DAY_COLUMNS),
        not_null(V.MART_NOT_NULL),
        *[value_range(*bounds) for bounds in V.MART_RANGES],
        *[boolean_domain(fact, c) for c in V.MART_BOOLEANS],
    ]


def analyze_rules(fact: DataFrame) -> list[Rule]:
    """The suite for a saved fact table."""
    return [
        required_columns(fact, V.ANALYZE_REQUIRED),
        not_null(V.ANALYZE_NOT_NULL),
        *[value_range(*bounds) for bounds in V.ANALYZE_RANGES],
    ]


def summary(report: DataFrame) -> DataFrame:
    """``pass`` unless a check failed; skipped checks do not fail a run."""
    failed = F.count_if(F.col("status") == FAIL)
    return report.agg(
        F.count(F.lit(1)).alias("checks"),
        failed.alias("failed"),
        F.when(failed == 0, PASS).otherwise(FAIL).alias("status"),
    )


def enforce(report: DataFrame, mode: str = "record") -> DataFrame:
    """``record`` hands the report on; ``fail`` raises when a check failed."""
    if mode == "fail":
        names = [row["check"] for row in report.where(F.col("status") == FAIL).select("check").collect()]
        if names:
            raise RuntimeError(f"quality checks failed: {', '.join(sorted(names))}")
    elif mode != "record":
        raise ValueError("mode must be 'record' or 'fail'")
    return report


# ---- table reports of the SQL marts -------------------------------------------------------------


def _extremes(columns: Sequence[str]) -> list[Column]:
    out = []
    for c in columns:
        value = no_nan(F.col(c).cast("double"))
        out += [F.min(value).alias(f"{c}.min"), F.max(value).alias(f"{c}.max")]
    return out


def _range_status(column: str, low: float | None, high: float | None) -> Column:
    under = F.coalesce(F.col(f"`{column}.min`") < low, F.lit(False)) if low is not None else F.lit(False)
    over = F.coalesce(F.col(f"`{column}.max`") > high, F.lit(False)) if high is not None else F.lit(False)
    return F.when(F.col("rows") == 0, SKIPPED).when(under | over, FAIL).otherwise(PASS)


def _age_days(as_of: date | None) -> Column:
    today = F.lit(as_of) if as_of is not None else F.to_date(F.convert_timezone(None, F.lit("UTC"), F.now()))
    return F.datediff(today, F.col("max_value")).cast("bigint")


def _fresh_status(max_age_days: int, as_of: date | None) -> Column:
    return (
        F.when(F.col("rows") == 0, SKIPPED)
        .when(F.col("max_value").isNull(), FAIL)
        .when(_age_days(as_of) <= max_age_days, PASS)
        .otherwise(FAIL)
    )


def range_report(df: DataFrame, rules: Mapping[str, tuple[float | None, float | None]], table: str) -> DataFrame:
    """Minimum and maximum against the bounds. Missing values are ignored, an empty table is skipped."""
    one_row = df.agg(F.count(F.lit(1)).alias("rows"), *_extremes(list(rules)))
    lines = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(f"range_{c}").alias("check"),
            _range_status(c, low, high).alias("status"),
            F.col(f"`{c}.min`").alias("min"),
            F.col(f"`{c}.max`").alias("max"),
            F.lit(low).cast("double").alias("expected_min"),
            F.lit(high).cast("double").alias("expected_max"),
        )
        for c, (low, high) in rules.items()
    ]
    return one_row.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


_TYPE_FAMILIES = {
    "bigint": (T.LongType,),
    "double": (T.DoubleType, T.FloatType, T.DecimalType),
    "string": (T.StringType,),
    "boolean": (T.BooleanType,),
    "date": (T.DateType,),
}


def schema_problems(df: DataFrame, expected: Mapping[str, str]) -> dict[str, str]:
    """Columns that are missing or of another type family: name -> what was found."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    problems = {}
    for name, kind in expected.items():
        if name not in actual:
            problems[name] = "missing"
        elif not isinstance(actual[name], _TYPE_FAMILIES[kind]):
            problems[name] = actual[name].simpleString()
    return problems


def freshness_report(
    df: DataFrame, table: str, max_age_days: int, as_of: date | None = None, column: str = "date"
) -> DataFrame:
    """Age in days of the newest day. A missing newest day fails, an empty table is skipped."""
    seen = df.agg(F.count(F.lit(1)).alias("rows"), F.max(F.to_date(column)).alias("max_value"))
    return seen.select(
        F.lit(table).alias("table"),
        F.lit("freshness").alias("check"),
        _fresh_status(max_age_days, as_of).alias("status"),
        "max_value",
        _age_days(as_of).alias("age_days"),
        F.lit(max_age_days).cast("bigint").alias("max_age_days"),
    )


def sql_mart_report(tables: Mapping[str, DataFrame], as_of: date | None = None) -> DataFrame:
    """Schema, range and freshness checks of the SQL marts: ``table, check, status``, the columns that are ``missing`` or ``mismatched``
    (with the type found), the values ``seen_min`` and ``seen_max`` and the bounds ``expected_min`` and ``expected_max``.

    For freshness, ``seen_max`` and ``expected_max`` are ages in days. One aggregation per table answers all of its checks.
    """
    parts = []
    for name, df in tables.items():
        ranges = {c: r for c, r in V.SQL_MART_RANGES.get(name, {}).items() if c in df.columns}  # an absent column is a schema problem
        problems = schema_problems(df, V.SQL_MART_SCHEMAS[name])
        number = lambda value: F.lit(value).cast("double")
        nothing = [number(None)] * 4
        statuses = {"schema": (F.lit(FAIL if problems else PASS), nothing)}
        statuses |= {
            f"range_{c}": (_range_status(c, low, high), [F.col(f"`{c}.min`"), F.col(f"`{c}.max`"), number(low), number(high)])
            for c, (low, high) in ranges.items()
        }
        aggregates = [F.count(F.lit(1)).alias("rows"), *_extremes(list(ranges))]
        if name in V.SQL_MART_FRESHNESS_DAYS:
            most = V.SQL_MART_FRESHNESS_DAYS[name]
            status, age = F.lit(FAIL), number(None)  # without a date column nothing can be fresh
            if "date" not in problems:
                aggregates.append(F.max("date").alias("max_value"))
                status, age = _fresh_status(most, as_of), _age_days(as_of).cast("double")
            statuses["freshness"] = (status, [number(None), age, number(None), number(most)])
        of_kind = lambda check, missing: ",".join(
            c if missing else f"{c}:{found}" for c, found in problems.items() if check == "schema" and (found == "missing") == missing
        )
        lines = [
            F.struct(
                F.lit(name).alias("table"), F.lit(check).alias("check"), status.alias("status"),
                F.lit(of_kind(check, True)).alias("missing"), F.lit(of_kind(check, False)).alias("mismatched"),
                *[v.cast("double").alias(n) for n, v in zip(("seen_min", "seen_max", "expected_min", "expected_max"), seen, strict=True)],
            )
            for check, (status, seen) in statuses.items()
        ]
        parts.append(df.agg(*aggregates).select(F.explode(F.array(*lines)).alias("line")).select("line.*"))
    return reduce(DataFrame.unionByName, parts)


# ---- further checks -----------------------------------------------------------------------------


def unique_key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, counted per key so that no task holds all keys."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.count_if(F.col("n") > 1)
    return per_key.agg(
        F.lit(f"unique_{'_'.join(keys)}").alias("check"),
        F.when(repeated == 0, PASS).otherwise(FAIL).alias("status"),
        F.count(F.lit(1)).alias("keys"),
        repeated.alias("repeated_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
    )


def completeness_report(df: DataFrame, columns: Sequence[str], minimum: float = V.MIN_COMPLETENESS) -> DataFrame:
    """Share of present values per column."""
    one_row = df.agg(*[F.avg((~is_missing(c)).cast("double")).alias(c) for c in columns])
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(c).alias("present"),
            F.when(F.col(c) < minimum, FAIL).otherwise(PASS).alias("status"),
        )
        for c in columns
    ]
    return one_row.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def with_row_status(counts: DataFrame) -> DataFrame:
    return counts.withColumn("status", F.when(F.col("rows") > 0, PASS).otherwise(FAIL))


def feed_rows_report(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Each feed must have rows."""
    parts = [
        df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("rows")) for name, df in feeds.items()
    ]
    return with_row_status(reduce(DataFrame.unionByName, parts))


def staleness_report(
    feeds: Mapping[str, tuple[DataFrame, str]], as_of: datetime, max_hours: int = V.FEED_STALE_HOURS
) -> DataFrame:
    """Hours since the newest observation of each feed; stale above the limit or without any."""
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    parts = [
        df.agg(F.lit(name).alias("dataset"), F.max(F.col(column).cast("timestamp_ntz")).alias("newest"))
        for name, (df, column) in feeds.items()
    ]
    seen = reduce(DataFrame.unionByName, parts)
    micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))
    aged = seen.withColumn("age_hours", micros / 3_600_000_000)
    return aged.withColumn(
        "status", F.when(F.coalesce(F.col("age_hours") <= max_hours, F.lit(False)), PASS).otherwise(FAIL)
    )


def column_problem(df: DataFrame, expected: Sequence[str]) -> str | None:
    found = list(df.columns)
    missing = [c for c in expected if c not in found]
    extra = [c for c in found if c not in expected]
    if missing or extra:
        return f"columns differ; missing: {missing}, unexpected: {extra}"
    return None if found == list(expected) else "columns are in another order"


def health_report(df: DataFrame, expected: Sequence[str] = tuple(V.FACT_DAY_COLUMNS)) -> DataFrame:
    """The health of a saved mart as one row: status, problem, rows."""
    problem = column_problem(df, expected)
    text = F.when(F.lit(problem is not None), F.lit(problem)).when(F.col("rows") == 0, F.lit("no rows"))
    counted = df.agg(F.count(F.lit(1)).alias("rows")).withColumn("problem", F.coalesce(text, F.lit("")))
    return counted.select(
        F.lit("health").alias("check"),
        F.when(F.col("problem") == "", PASS).otherwise(FAIL).alias("status"),
        "problem",
        "rows",
    )
