"""Reading and writing landed feeds and marts."""
from __future__ import annotations

from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.fixed_values import FEED_SCHEMAS, LANDING_SOURCES, SCENARIO_COLUMNS, SCENARIO_TEXTS, SCENARIOS
from dayloom.functions.conform import conform, empty_feed, require_columns
from dayloom.functions.scalars import iso_date


def has_parquet(spark: SparkSession, path: str) -> bool:
    """Whether any Parquet file lies below the folder. Stops at the first one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return False
    found = files.listFiles(folder, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def read_feed(
    spark: SparkSession,
    base: str,
    feed: str,
    first_ingest: date | None = None,
    last_ingest: date | None = None,
    keep_ingest_date: bool = False,
    schema: T.StructType | None = None,
) -> DataFrame:
    """All landed parts of a feed as one table with declared columns and types.

    Parts may sit at any depth and lack columns. A feed that never landed is an empty table. Bounds on
    the ingest date skip whole folders. Giving the stored ``schema`` saves reading the footers of all
    files, which matters with very many parts; parts that lack one of its columns still read as null.
    """
    path = f"{base.rstrip('/')}/{LANDING_SOURCES.get(feed, feed)}"
    by_date = first_ingest is not None or last_ingest is not None or keep_ingest_date
    if not has_parquet(spark, path):
        empty = conform(empty_feed(spark, feed), feed)
        return empty.withColumn("ingest_date", F.lit(None).cast("date")) if keep_ingest_date else empty
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    if not by_date:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        raw = reader.parquet(path)
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
        raw = _read_by_schema(spark, path, feed, by_date)
    if first_ingest is not None:
        raw = raw.where(F.col("ingest_date") >= F.lit(first_ingest))
    if last_ingest is not None:
        raw = raw.where(F.col("ingest_date") <= F.lit(last_ingest))
    return conform(raw, feed, ["ingest_date"] if keep_ingest_date else [])


def _read_by_schema(spark: SparkSession, path: str, feed: str, by_date: bool) -> DataFrame:
    """Parts whose types differ, read in groups of types that merge and brought to the declared types.

    Footers are read by tasks, as in any read with merged schemas. The list of parts, in the order of their paths and so of their ingest dates, is halved where it
    does not merge: a feed whose types changed k times takes some k log(parts) such reads, not one a part.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True)
    names = []
    while found.hasNext():
        name = found.next().getPath().toString()
        if name.endswith(".parquet"):
            names.append(name)
    merged = spark.read.option("basePath", path).option("mergeSchema", "true")
    kinds: dict[str, list[str]] = {}
    waiting = [sorted(names)]
    while waiting:
        part = waiting.pop()
        try:
            kinds.setdefault(merged.parquet(*part).schema.json(), []).extend(part)
        except (PySparkException, Py4JJavaError) as error:
            if "CANNOT_MERGE" not in str(error) or len(part) < 2:
                raise
            waiting += [part[: len(part) // 2], part[len(part) // 2 :]]
    keep = ["ingest_date"] if by_date else []
    groups = [conform(merged.parquet(*part), feed, keep) for part in kinds.values()]
    return reduce(DataFrame.unionByName, groups)


def register_feed_views(spark: SparkSession, base: str, prefix: str = "raw_") -> list[str]:
    """A temporary view per feed, empty where nothing landed."""
    names = []
    for feed in FEED_SCHEMAS:
        read_feed(spark, base, feed).createOrReplaceTempView(prefix + feed)
        names.append(prefix + feed)
    return names


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The saved mart for analysis: a real date and a 0/1 beach flag. Fails when it is absent."""
    return analysis_view(spark.read.parquet(path))


def analysis_view(fact: DataFrame) -> DataFrame:
    return fact.withColumn("date", F.to_date("date")).withColumn("beach_ok", F.col("beach_ok").cast("int"))


_SCENARIO_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType() if c in ("scenario", "description") else T.DoubleType()) for c in SCENARIO_COLUMNS]
)


def read_scenarios(spark: SparkSession, path: str) -> DataFrame:
    """Scenario deltas from CSV with a header; every delta column must be there."""
    header = spark.read.option("header", "true").csv(path)
    checked = require_columns(header, SCENARIO_COLUMNS, "scenario file")
    return checked.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in _SCENARIO_SCHEMA.fields]
    )


def default_scenarios(spark: SparkSession) -> DataFrame:
    rows = [(name, SCENARIO_TEXTS[name], *deltas) for name, *deltas in SCENARIOS]
    return spark.createDataFrame(rows, _SCENARIO_SCHEMA)


# ---- landing and marts --------------------------------------------------------------------------


def land(df: DataFrame, base: str, source: str, ingest_date: date) -> dict:
    """Append a part to ``<base>/<source>/ingest_date=…``; the row count comes from the write itself."""
    path = f"{base.rstrip('/')}/{LANDING_SOURCES.get(source, source)}"
    seen = Observation(f"land_{source}")
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .withColumn("ingest_date", F.lit(ingest_date))
        .write.mode("append")
        .partitionBy("ingest_date")
        .parquet(path)
    )
    return {"dataset": source, "rows": seen.get["rows"], "path": path, "ingest_date": ingest_date.isoformat()}


def land_feeds(feeds: dict[str, DataFrame], base: str, ingest_date: date) -> list[dict]:
    """Land each feed with exactly its declared columns."""
    landed = []
    for name, feed in feeds.items():
        checked = require_columns(feed, list(FEED_SCHEMAS[name]), name) if name in FEED_SCHEMAS else feed
        landed.append(land(checked, base, name, ingest_date))
    return landed


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_mart(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_sorted(df: DataFrame, path: str) -> None:
    """Whole-table export in order of its first column.

    The other columns break ties, so that a value with very many rows can still spread over several
    ranges.
    """
    df.orderBy(*df.columns).write.mode("overwrite").parquet(path)


def write_by_month(df: DataFrame, path: str, day: str = "date") -> None:
    """Mart in month folders. The rebalance keeps a month in few files and splits a month that is too big."""
    month = F.substring(iso_date(F.to_date(day)), 1, 7)
    rebalanced = df.withColumn("year_month", month).hint("rebalance", "year_month")
    rebalanced.write.mode("overwrite").partitionBy("year_month").parquet(path)


def feed_manifest(feeds: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per feed: rows and the first and last day seen. Input: name -> (feed, time column). A time that does not parse counts as a
    row without a day."""
    parts = []
    for name, (feed, column) in feeds.items():
        time = F.col(column)
        if isinstance(feed.schema[column].dataType, T.StringType):
            time = F.try_to_timestamp(time)
        parts.append(
            feed.select(time.cast("date").alias("day")).agg(
                F.lit(name).alias("dataset"),
                F.count(F.lit(1)).alias("rows"),
                F.min("day").alias("min_date"),
                F.max("day").alias("max_date"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
