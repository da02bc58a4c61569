"""Turning outside feeds into declared ones."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayloom.fixed_values import AIR_QUALITY_SYNONYMS, BEACHWATCH_SYNONYMS, FEED_SCHEMAS
from dayloom.functions.conform import conform, rename_synonyms
from dayloom.functions.scalars import strip_text


def clean_air_quality(raw: DataFrame) -> DataFrame:
    """Declared names and types; rows need a time and both concentrations."""
    named = rename_synonyms(raw, list(FEED_SCHEMAS["air_quality"]), AIR_QUALITY_SYNONYMS)
    return conform(named, "air_quality", on_bad="null").dropna(subset=["observation_ts", "pm25", "pm10"])


def clean_beachwatch(raw: DataFrame) -> DataFrame:
    """Declared names and types; rows need a time and a status that is not blank.

    A missing status stays missing and is kept, as is a missing bacteria count.
    """
    named = rename_synonyms(raw, list(FEED_SCHEMAS["beachwatch"]), BEACHWATCH_SYNONYMS)
    trimmed = conform(named, "beachwatch", on_bad="null").withColumn("status", strip_text("status"))
    not_blank = F.col("status").isNull() | (F.length("status") > 0)
    return trimmed.where(F.col("observation_ts").isNotNull() & not_blank)
