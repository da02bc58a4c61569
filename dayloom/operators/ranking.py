"""Best row per group, last known value, and dense numbering without a single-task sort."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayloom.functions.scalars import hash_text, round_even


def arg_top(value: Column, score: Column, *tiebreak: Column, digits: int = 8) -> Column:
    """Aggregate: the ``value`` with the highest score, missing scores last, ties by ``tiebreak``.

    Scores built from floating sums differ in their last bits with the order of the rows, so they
    are compared at ``digits`` decimals.
    """
    rank = round_even(score, digits)
    order = F.struct(rank.isNull(), -rank, *(tiebreak or (value,)))
    return F.min_by(value, order)


def last_known(value: Column, *order: Column) -> Column:
    """Aggregate: the latest non-null ``value``. (``max_by`` alone would return a late null.)"""
    return F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))


def keep_first(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key. Spark limits each map task to one row per key before it shuffles."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_position", F.row_number().over(window))
    return ranked.where(F.col("_position") == 1).drop("_position")


def latest_per_key(df: DataFrame, keys: Sequence[str], ingest: str = "ingest_date") -> DataFrame:
    """Only the most recently landed row of each key; other columns break ties."""
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys and c != ingest]
    return keep_first(df, keys, F.col(ingest).desc_nulls_last(), *rest)


def column_mode(df: DataFrame, column: str, by: Sequence[str] = (), name: str | None = None) -> DataFrame:
    """Most frequent value per group, the smallest on ties.

    Counts are combined per value before the group sees them, so a group never holds its raw rows.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("_n"))
    return counts.groupBy(*by).agg(arg_top(F.col(column), F.col("_n")).alias(name or column))


def hash_numbering(
    df: DataFrame, key: Sequence[str], seed: int | str, prefix: int = 3, part_rows: float | None = None
) -> DataFrame:
    """Add ``position`` (0, 1, … in hash order of the unique key) and ``total``.

    The hash prefix splits the rows into 16**prefix even parts, 4,096 as it stands. Each part is numbered by itself, in a sort that may spill, and
    shifted by the sizes of the parts before it, so no task sees more than one part. ``part_rows`` asks for more parts where a part would hold more rows; the rows are
    then counted first, which runs the input once more.
    """
    if part_rows is not None:
        rows = df.count()
        while 16**prefix * part_rows < rows:
            prefix += 1
    hashed = df.withColumn("_hash", hash_text(seed, *[F.col(k) for k in key])).withColumn(
        "_part", F.substring("_hash", 1, prefix)
    )
    sizes = hashed.groupBy("_part").agg(F.count("*").alias("_size"))
    # 16**prefix rows: one task orders them; up to 4,096 are sent to each executor.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shifts = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"),
        F.sum("_size").over(whole).alias("total"),
    )
    within = Window.partitionBy("_part").orderBy("_hash", *key)
    return (
        hashed.join(F.broadcast(shifts) if prefix <= 3 else shifts, "_part")
        .withColumn("position", F.row_number().over(within) - 1 + F.col("_shift"))
        .drop("_hash", "_part", "_shift")
    )
