"""A mart brought up to date by landings equals one built from all of them."""
import os
import random

import pytest
from pyspark.sql import functions as F

from dayloom.operators.ranking import latest_per_key
from dayloom.plans import upsert
from dayloom.session import scratch_path

SCHEMA = "k bigint, name string, v double, ingest_date string"


def landing(spark, day, ids, seed):
    random.seed(seed)
    return spark.createDataFrame([(i, random.choice(["a", "b", None]), random.random(), day) for i in ids], SCHEMA)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_landings_equal_a_rebuild_and_leave_other_folders_alone(spark, rows):
    path = scratch_path(spark, "mart")
    parts = [
        landing(spark, "2024-01-01", [*range(200), None, 5, 5], 1), landing(spark, "2024-01-03", [3, 9, 9, None, 500], 2),
        landing(spark, "2024-01-02", range(0, 200, 40), 3), landing(spark, "2024-01-04", [], 4),
    ]
    whole = None
    for part in parts:
        before = files(path)
        report = upsert.upsert(part, path, ["k"], buckets=32)
        whole = part if whole is None else whole.unionByName(part)
        assert report["rows"] == part.select("k").distinct().count()
        after = files(path)
        kept = [f for f in before if int(f.split("bucket_of_32=")[1].split("/")[0]) not in report["touched"]]
        assert all(after.get(f) == before[f] for f in kept) and (not before or len(report["touched"]) > 25 or kept)
        assert rows(upsert.read_mart(spark, path), "k", "name", "v", "ingest_date") == rows(latest_per_key(whole, ["k"]), "k", "name", "v", "ingest_date")
    again = rows(upsert.read_mart(spark, path), "k", "v")
    upsert.upsert(parts[1], path, ["k"], buckets=32)
    assert rows(upsert.read_mart(spark, path), "k", "v") == again
    with pytest.raises(ValueError, match="number of buckets"):
        upsert.upsert(parts[1], path, ["k"], buckets=8)


def test_new_columns_come_with_a_later_landing(spark):
    path = scratch_path(spark, "mart")
    upsert.upsert(landing(spark, "2024-01-01", range(9), 1), path, ["k"], buckets=1)
    upsert.upsert(landing(spark, "2024-01-02", [4], 2).withColumn("more", F.lit("x")), path, ["k"], buckets=1)
    mart = upsert.read_mart(spark, path)
    assert mart.where("more = 'x'").count() == 1 and mart.count() == 9
