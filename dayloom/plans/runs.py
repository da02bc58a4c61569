"""Whole pipelines: landed feeds to checked marts."""
from __future__ import annotations

from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from dayloom.fixed_values import FEED_SCHEMAS
from dayloom.operators.joins import choose_feed
from dayloom.operators.quality import (
    analyze_rules,
    enforce,
    mart_rules,
    run_suite,
    sql_mart_report,
    with_row_status,
)
from dayloom.plans import marts, staging
from dayloom.sources.datasets import land_feeds, read_feed, write_csv, write_mart, write_sorted


def stage(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "stg_commute_day": staging.stg_commute_day(feeds["commute_trips"]),
        "stg_env_day": staging.stg_env_day(feeds["air_quality"], feeds["weather"], feeds["beachwatch"]),
        "stg_personal_day": staging.stg_personal_day(feeds["personal"]),
    }


def fact_from_feeds(feeds: dict[str, DataFrame]) -> DataFrame:
    staged = stage(feeds)
    return marts.fact_day(staged["stg_commute_day"], staged["stg_env_day"], staged["stg_personal_day"])


def sql_marts(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    commute = staging.stg_commute_day(feeds["commute_trips"], count_rows=True)
    env = staging.stg_env_day_sql(feeds["air_quality"], feeds["weather"], feeds["beachwatch"])
    return {
        "stg_commute_day": commute,
        "stg_env_day": env,
        "dim_commute_mode": marts.dim_commute_mode(commute),
        "dim_environment_metric": marts.dim_environment_metric(env),
    }


def ingest(
    feeds: dict[str, DataFrame], live: dict[str, DataFrame], raw: str, ingest_date: date
) -> tuple[list[dict], DataFrame]:
    """Land every feed, a live one in place of its counterpart when it has rows.

    Returns what was landed and the check that each feed has rows.
    """
    chosen = {name: choose_feed(live[name], feed) if name in live else feed for name, feed in feeds.items()}
    landed = land_feeds(chosen, raw, ingest_date)
    spark = next(iter(feeds.values())).sparkSession
    counts = spark.createDataFrame([(r["dataset"], r["rows"]) for r in landed], "dataset string, rows bigint")
    return landed, with_row_status(counts)


def build_fact(spark: SparkSession, raw: str, out: str, mode: str = "record") -> DataFrame:
    """Raw folder to staging CSV, ``fact_day`` Parquet and a quality report.

    Staging tables are kept while their sinks and the fact read them, so each feed is scanned once.
    """
    feeds = {name: read_feed(spark, raw, name) for name in FEED_SCHEMAS}
    staged = {name: df.persist(StorageLevel.DISK_ONLY) for name, df in stage(feeds).items()}
    try:
        for name, df in staged.items():
            write_csv(df, f"{out}/staging/{name}")
        fact = marts.fact_day(staged["stg_commute_day"], staged["stg_env_day"], staged["stg_personal_day"])
        write_mart(fact, f"{out}/fact_day")
    finally:
        for df in staged.values():
            df.unpersist()
    saved = spark.read.parquet(f"{out}/fact_day")
    report = run_suite(saved, mart_rules(saved))
    write_mart(report, f"{out}/quality_report")
    return enforce(spark.read.parquet(f"{out}/quality_report"), mode)


def build_sql_marts(
    spark: SparkSession, raw: str, out: str, as_of: date | None = None, mode: str = "fail"
) -> DataFrame:
    """The four SQL-model marts, each exported in order of its first column, then checked."""
    feeds = {name: read_feed(spark, raw, name) for name in FEED_SCHEMAS}
    order = ("stg_commute_day", "stg_env_day", "dim_commute_mode", "dim_environment_metric")
    models = sql_marts(feeds)
    for name in order[:2]:
        write_sorted(models[name], f"{out}/{name}")
    # The dimensions are built on what was saved, so the feeds are not scanned again.
    saved = {name: spark.read.parquet(f"{out}/{name}") for name in order[:2]}
    write_sorted(marts.dim_commute_mode(saved["stg_commute_day"]), f"{out}/dim_commute_mode")
    write_sorted(marts.dim_environment_metric(saved["stg_env_day"]), f"{out}/dim_environment_metric")
    tables = {name: spark.read.parquet(f"{out}/{name}") for name in order}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    write_mart(sql_mart_report(tables, as_of), f"{out}/quality_report")
    return enforce(spark.read.parquet(f"{out}/quality_report"), mode)


def analyze(spark: SparkSession, fact_path: str, mode: str = "record") -> DataFrame:
    """Checks of a saved fact table; fails when it is absent."""
    saved = spark.read.parquet(fact_path)
    return enforce(run_suite(saved, analyze_rules(saved)), mode)
