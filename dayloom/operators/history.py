"""Versions of slowly changing descriptions, folded from observations."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def versions(observations: DataFrame, keys: Sequence[str], attributes: Sequence[str], time: str) -> DataFrame:
    """``keys, attributes, valid_from, valid_to, is_current, version``: a row for each run of equal attributes in the order of time.

    ``valid_to`` is the start of the next version, null for the current one; versions count from 1. Nulls are values like any other. Of observations at one
    time the largest attributes count; those without a time take no part. A description that comes back is a version of its own.

    Changes are found within each key and day first, so that of a key with very many observations only its days' first rows and its changes meet in
    one window.
    """
    values = F.struct(*[F.struct(F.col(a).isNotNull().alias("there"), F.col(a).alias("value")).alias(a) for a in attributes])
    one = observations.where(F.col(time).isNotNull()).select(*keys, F.col(time).alias("_at"), values.alias("_v"))
    one = one.groupBy(*keys, "_at").agg(F.max("_v").alias("_v")).withColumn("_day", F.to_date("_at"))
    in_day = Window.partitionBy(*keys, "_day").orderBy("_at")
    changes = one.withColumn("_last", F.lag("_v").over(in_day)).where(~F.col("_v").eqNullSafe(F.col("_last"))).drop("_last", "_day")
    whole = Window.partitionBy(*keys).orderBy("_at")
    kept = changes.withColumn("_last", F.lag("_v").over(whole)).where(~F.col("_v").eqNullSafe(F.col("_last")))
    ends = F.lead("_at").over(whole)
    return kept.select(
        *keys, *[F.col(f"_v.{a}.value").alias(a) for a in attributes], F.col("_at").alias("valid_from"), ends.alias("valid_to"),
        ends.isNull().alias("is_current"), F.row_number().over(whole).cast("bigint").alias("version"),
    )


def version_at(facts: DataFrame, history: DataFrame, keys: Sequence[str], time: str, attributes: Sequence[str]) -> DataFrame:
    """``facts`` with the attributes that held at their time; null before the first version, without a time, and for unknown keys.

    A key has few versions, so they come as one sorted array a key and are looked up in the row: facts are neither sorted by time nor multiplied.
    """
    listed = history.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("valid_from", *attributes))).alias("_versions"))
    joined = facts.join(listed, list(keys), "left")
    held = F.filter("_versions", lambda v: v["valid_from"] <= F.col(time))
    last = F.element_at(held, -1)
    found = F.when(F.size(held) > 0, last)
    return joined.withColumn("_held", found).select(*facts.columns, *[F.col(f"_held.{a}").alias(a) for a in attributes])
