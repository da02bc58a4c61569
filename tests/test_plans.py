"""The physical plans we rely on at scale."""
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dayloom.catalog.queries import QUERIES
from dayloom.operators import ranking
from dayloom.plans import runs, staging
from dayloom.sources import table_feeds as tf

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Their table is a driver-sized report, or they run their own jobs first and return what those wrote.
LAZY = [
    "stg_commute_day", "stg_commute_entity_day", "stg_env_day", "stg_env_day_sql", "stg_personal_day", "fact_day",
    "fact_entity_day", "dim_commute_mode", "dim_environment_metric", "latest_per_key", "quality_mart_suite",
    "quality_sql_marts", "unique_key", "zscore_month", "lag_features", "rain_72h", "entity_lag_features", "mode_switch",
    "crosstab_bands", "difference_wet_dry", "trip_delays", "reconciliation", "bootstrap_weights",
    "bootstrap_weights_poisson", "holdout_split", "clean_air_quality", "clean_beachwatch", "dim_site", "dim_area",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "MapInPandas"):
        assert bad not in text, bad


def test_trips_are_scanned_once_and_pruned(spark):
    text = plan(staging.stg_commute_day(tf.commute_trips(spark, FOLDER)))
    assert text.count("FileScan") == 1
    read = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "l_extendedprice" not in read and "l_partkey" not in read and "l_suppkey" not in read
    assert "PushedFilters: [IsNotNull(l_shipdate)" in text


def test_raw_rows_meet_hash_aggregation_before_any_shuffle(spark):
    """Reading up from each scan, a partial hash aggregation comes before the first exchange."""
    feeds = {
        "trips": staging.stg_commute_day(tf.commute_trips(spark, FOLDER)),
        "air": staging.station_days(tf.air_quality(spark, FOLDER)),
        "beach": staging.beach_days(tf.beachwatch(spark, FOLDER)),
        "personal": staging.stg_personal_day(tf.personal(spark, FOLDER)),
    }
    for name, df in feeds.items():
        lines = plan(df).splitlines()
        scan = max(i for i, line in enumerate(lines) if "FileScan" in line)
        above = [line for line in reversed(lines[:scan]) if "Aggregate" in line or "Exchange" in line or "Sort [" in line]
        assert "HashAggregate" in above[0] and "partial_" in above[0], name
        assert "Exchange hashpartitioning" in above[1], name


def test_fact_joins_reuse_the_staging_partitioning(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        feeds = {
            "commute_trips": tf.commute_trips(spark, FOLDER), "air_quality": tf.air_quality(spark, FOLDER),
            "weather": tf.weather(spark, FOLDER), "beachwatch": tf.beachwatch(spark, FOLDER),
            "personal": tf.personal(spark, FOLDER),
        }
        text = plan(runs.fact_from_feeds(feeds))
        assert text.count("SortMergeJoin") == 2
        # Trips 2, air 2, weather 1, beach 2, personal 1; none for the joins.
        assert text.count("Exchange hashpartitioning") == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_keep_first_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(ranking.keep_first(df, ["k"], F.col("id")))
    assert text.count("WindowGroupLimit") == 2


def test_mode_switch_reads_trips_once(spark):
    assert plan(QUERIES["mode_switch"](spark, FOLDER)).count("FileScan") == 1


def test_quality_suite_reads_the_mart_once(spark):
    fact_scans = plan(QUERIES["fact_day"](spark, FOLDER)).count("FileScan")
    assert plan(QUERIES["quality_mart_suite"](spark, FOLDER)).count("FileScan") <= fact_scans
