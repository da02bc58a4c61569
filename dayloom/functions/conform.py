"""Column-set and type rules applied when a feed enters the library."""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.fixed_values import FEED_SCHEMAS
from dayloom.functions.scalars import no_nan, utc_time


def require_columns(df: DataFrame, required: Sequence[str], name: str = "dataset") -> DataFrame:
    """Keep the required columns in order; name the missing ones in the error."""
    missing = [column for column in required if column not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks required columns: {', '.join(missing)}")
    return df.select(*[F.col(f"`{column}`") for column in required])


def rename_synonyms(
    df: DataFrame, required: Sequence[str], synonyms: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Give outside columns their feed names, ignoring case; the first listed synonym wins."""
    present = {column.lower(): column for column in df.columns}
    chosen = {column: column for column in df.columns if column in required}
    for target, candidates in synonyms.items():
        match = next((present[c.lower()] for c in candidates if c.lower() in present), None)
        if match is not None:
            chosen[target] = match
    missing = [column for column in required if column not in chosen]
    if missing:
        raise KeyError(f"missing required columns: {', '.join(missing)}")
    return df.select(*[F.col(f"`{chosen[column]}`").alias(column) for column in required])


def value_type(target: str) -> str:
    return "timestamp_ntz" if target == "timestamp" else target


def cast_or_null(df: DataFrame, column: str, target: str):
    """The column in its declared type; values that do not convert become null."""
    source = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if target == "timestamp":
        return utc_time(value, source)
    if target == "double":
        return no_nan(value if isinstance(source, T.DoubleType) else value.try_cast("double"))
    if target == "bigint" and isinstance(source, (T.DoubleType, T.FloatType)):
        return no_nan(value.cast("double")).cast("bigint")
    return value.try_cast(target)


def refused(df: DataFrame, column: str, target: str) -> Column:
    """Whether a value is there but does not convert to its declared type. NaN is a missing number, not a refused one."""
    source = df.schema[column].dataType
    there = F.col(f"`{column}`").isNotNull()
    if isinstance(source, (T.DoubleType, T.FloatType)):
        there = there & ~F.isnan(F.col(f"`{column}`"))
    return there & cast_or_null(df, column, target).isNull()


def refused_rows(df: DataFrame, feed: str) -> DataFrame:
    """Per declared column how many values ``conform`` refuses: ``feed, column, rows, refused``."""
    present = {name: kind for name, kind in FEED_SCHEMAS[feed].items() if name in df.columns}
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(refused(df, c, kind)).alias(f"n.{c}") for c, kind in present.items()])
    lines = [F.struct(F.lit(c).alias("column"), F.col(f"`n.{c}`").alias("refused")) for c in present]
    return counted.select(F.lit(feed).alias("feed"), "rows", F.explode(F.array(*lines)).alias("line")).select(
        "feed", "line.column", "rows", "line.refused"
    )


def conform(df: DataFrame, feed: str, keep: Iterable[str] = (), on_bad: str = "error") -> DataFrame:
    """A feed with its declared columns and types; absent columns are null.

    Timestamps come out as zone-less UTC. ``keep`` names further columns, such as entity keys. A value that does not convert
    stops the job, naming its column; with ``on_bad="null"`` it counts as missing, and ``refused_rows`` tells how many did.
    """
    if on_bad not in ("error", "null"):
        raise ValueError("on_bad must be 'error' or 'null'")
    schema = FEED_SCHEMAS[feed]
    present = set(df.columns)
    columns = []
    for name, target in schema.items():
        if name in present:
            value = cast_or_null(df, name, target)
            if on_bad == "error" and isinstance(df.schema[name].dataType, T.StringType) and target != "string":
                text = F.concat(F.lit(f"{feed}.{name} holds a value that is no {target}: "), F.col(f"`{name}`"))
                value = F.when(refused(df, name, target), F.raise_error(text).cast(value_type(target))).otherwise(value)
            columns.append(value.alias(name))
        else:
            columns.append(F.lit(None).cast(value_type(target)).alias(name))
    return df.select(*[F.col(name) for name in keep], *columns)


def empty_feed(spark, feed: str) -> DataFrame:
    """No rows, declared columns and types."""
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in FEED_SCHEMAS[feed].items())
    return spark.createDataFrame([], ddl)
