"""Feeds that arrive as record pages or as binary payloads."""
from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_record_pages(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Landed response pages (``{"result": {"records": […], "total": n}}``) as one table of records.

    Pages overlap only if the sender repeats them; no row is dropped. An empty folder is an empty table. A file holds one page over any
    number of lines, or one page a line; a page that does not parse stops the job. ``record_page_totals`` compares with the stated totals.
    """
    return _pages(spark, path, record).select(F.explode("page.result.records").alias("r")).select("r.*")


def record_page_totals(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """``pages, rows, total, complete``: what was read against the largest total any page states. Without a stated total, or
    without pages, nothing is missing."""
    size = F.coalesce(F.array_size("page.result.records"), F.lit(0)).cast("bigint")
    seen = _pages(spark, path, record).agg(
        F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum(size), F.lit(0)).alias("rows"), F.max("page.result.total").alias("total")
    )
    return seen.withColumn("complete", F.coalesce(F.col("rows") >= F.col("total"), F.lit(True)))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return lines.where(F.trim("value") != "")


def _page_texts(spark: SparkSession, path: str) -> DataFrame:
    """``value, file``: a row a page; rows without a value are none. Files of a page a line are read in splits, by as many tasks as their size asks for.

    A file none of whose lines is a page by itself holds one page over several lines and is read whole. Which files these are takes one pass over
    the lines; only their names reach the driver, as the names of all files do in any read.
    """
    lines = _lines(spark, path)
    page = F.coalesce(F.array_contains(F.json_object_keys("value"), "result"), F.lit(False))
    odd = [r["file"] for r in lines.groupBy("file").agg(F.bool_or(page).alias("paged")).where("NOT paged").select("file").collect()]
    if not odd:
        return lines
    jvm = spark._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name)).toString() for name in odd]
    whole = spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    # their lines stay as nulls, so that no check of a page can be moved ahead of leaving them out
    rest = lines.select(F.when(~F.col("file").isin(odd), F.col("value")).alias("value"), "file")
    return rest.unionByName(whole)


def _pages(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    result = T.StructType([T.StructField("records", T.ArrayType(record)), T.StructField("total", T.LongType())])
    page = T.StructType([T.StructField("result", result), T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = _page_texts(spark, path).select("value", "file", F.from_json("value", page, options).alias("page"))
    broken = F.col("page").isNull() | F.col("page._bad").isNotNull() | F.json_object_keys("value").isNull()
    text = F.concat(F.lit("a record page does not parse: "), F.substring("value", 1, 80), F.lit(" in "), F.col("file"))
    there = F.col("value").isNotNull()
    return parsed.where(F.when(there & broken, F.raise_error(text).cast("boolean")).otherwise(there)).select("page")


def filter_records(records: DataFrame, filters: Mapping[str, object] | None = None) -> DataFrame:
    """Rows equal to every given value. Plain predicates, so a Parquet scan skips what cannot match."""
    if not filters:
        return records
    return records.where(reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in filters.items()]))


def filter_text(records: DataFrame, filters: Mapping[str, str]) -> DataFrame:
    """Add the filter map as JSON text, the form a remote record store takes."""
    encoded = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in filters.items()]))
    return records.withColumn("filters", encoded)


def read_payloads(spark: SparkSession, path: str, pattern: str = "*", with_content: bool = True) -> DataFrame:
    """Binary payload files: code from the file name, time, size and, if asked for, the bytes. Spark holds a payload in one value, so a
    file may have at most 2 GB."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    name = F.element_at(F.split("path", "/"), -1)
    columns = [
        F.regexp_replace(name, r"\.[^.]*$", "").alias("feed_code"),
        F.col("modificationTime").alias("retrieved_at"),
        F.col("length").alias("size_bytes"),
    ]
    return files.select(*columns, *([F.col("content")] if with_content else []))
