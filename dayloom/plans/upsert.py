"""A mart kept at the latest row of each key, brought up to date by landings."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayloom.operators.ranking import latest_per_key
from dayloom.session import scratch_path
from dayloom.sources.datasets import has_parquet


def _bucket_column(buckets: int) -> str:
    return f"bucket_of_{buckets}"


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """The mart's rows, without the bucket."""
    mart = spark.read.parquet(path)
    return mart.drop(*[c for c in mart.columns if c.startswith("bucket_of_")])


def upsert(landed: DataFrame, path: str, keys: Sequence[str], ingest: str = "ingest_date", buckets: int = 64) -> dict:
    """Bring a mart up to date with a landing: of each key the row with the latest ``ingest`` stays, other columns break ties as in ``latest_per_key``.

    The mart lies in folders by a hash of the key. Only folders that the landing has keys for are read and replaced; files of the others
    keep their names and times. A landing that is older than the mart changes nothing; the same landing twice gives the same mart, so
    a run that failed is run again. Null keys are one key. An empty landing touches no folder. What is replaced is written to the shared folder first, as it is read from
    where it goes. The number of buckets is fixed with the first landing, another one is refused.

    Returns how many rows landed (``rows``, of distinct keys), and the folders ``touched``.
    """
    spark, bucket = landed.sparkSession, _bucket_column(buckets)
    numbered = landed.withColumn(bucket, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    new_path = scratch_path(spark, "upsert-landed")
    latest_per_key(numbered, [*keys, bucket], ingest).write.parquet(new_path)
    new = spark.read.schema(numbered.schema).parquet(new_path)
    counts = {r[bucket]: r["n"] for r in new.groupBy(bucket).agg(F.count("*").alias("n")).collect()}  # a row a bucket
    report = {"rows": sum(counts.values()), "touched": sorted(counts)}
    if not counts:
        return report
    merged = new
    if has_parquet(spark, path):
        mart = spark.read.parquet(path)
        if bucket not in mart.columns:
            raise ValueError(f"the mart at {path} has another number of buckets than {buckets}")
        old = mart.where(F.col(bucket).isin(sorted(counts)))
        merged = latest_per_key(old.unionByName(new, allowMissingColumns=True), [*keys, bucket], ingest)
    out_path = scratch_path(spark, "upsert-merged")
    merged.write.parquet(out_path)
    ready = spark.read.schema(merged.schema).parquet(out_path).repartition(bucket)
    ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(bucket).parquet(path)
    return report
