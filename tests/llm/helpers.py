"""Small tables for the edge cases that every operator meets."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
PAGES = "page_id bigint, url string, html string"


def documents(spark: SparkSession, texts: list, extra: bool = False) -> DataFrame:
    """Documents numbered from 0; ``extra`` adds columns named like those the operators make."""
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    return with_clashes(df) if extra else df


def with_clashes(df: DataFrame) -> DataFrame:
    names = "size key draw n words spans rule host path verdict class_id part place times kept ids digest start end shingles bucket".split()
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("x") for n in names if n not in df.columns})
