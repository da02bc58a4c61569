"""Every operator as a named query over the order, line item and event tables.

Each query takes ``(spark, folder)``. Results are tidied for comparison across engines: floating values
at a fixed number of decimals, dates and times as text, whole numbers as bigint.
"""
from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom import fixed_values as V
from dayloom.functions import scalars as S
from dayloom.functions.conform import conform, require_columns
from dayloom.functions.conform import refused_rows as refused
from dayloom.operators import bootstrap as B
from dayloom.operators import asof, cleaning, features, history, inference, joins, profile, quality, ranking, robust, scenarios
from dayloom.operators import regression as R
from dayloom.plans import marts, runs, staging, upsert
from dayloom.session import scratch_path
from dayloom.sources import datasets, records
from dayloom.sources import table_feeds as tf
from dayloom.streaming import closing, delays

AS_OF = date(2001, 11, 10)
SEED = 42
MODEL_DIGITS = 6
# Order-independent features for the coefficient table with standard errors.
CONTROLS = R.Design(numeric=("commute_minutes", "reliability", "pm25_mean", "after_rain", "meeting_count"), weekday=None)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def tidy(df: DataFrame, digits: int = 8) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            column = S.round_even(column.cast("double"), digits) + F.lit(0.0)
        elif isinstance(kind, T.DateType):
            column = S.iso_date(column)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.IntegralType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "commute_trips": tf.commute_trips(spark, folder).drop("entity_id"),
        "air_quality": tf.air_quality(spark, folder),
        "weather": tf.weather(spark, folder),
        "beachwatch": tf.beachwatch(spark, folder),
        "personal": tf.personal(spark, folder).drop("entity_id"),
    }


def _fact(spark: SparkSession, folder: str) -> DataFrame:
    return runs.fact_from_feeds(_feeds(spark, folder))


def _analysis(spark: SparkSession, folder: str) -> DataFrame:
    """The fact table as the model reads it, written once so that its several passes do not rebuild it."""
    path = scratch_path(spark, "fact")
    datasets.write_mart(_fact(spark, folder), path)
    fact = datasets.read_fact(spark, path)
    return fact.withColumn("date", S.iso_date("date"))


def _entity_days(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stg_commute_day(tf.commute_trips(spark, folder), ["entity_id"])


# ---- staging ------------------------------------------------------------------------------------


@query
def mode_rank(spark, folder):
    """A4"""
    modes = staging.mode_days(tf.commute_trips(spark, folder))
    return tidy(modes.select("date", "primary_mode", "trip_count", "avg_delay", "score"))


@query
def primary_mode(spark, folder):
    """A5, W1"""
    return tidy(staging.primary_modes(staging.mode_days(tf.commute_trips(spark, folder))))


@query
def primary_mode_keep_first(spark, folder):
    """The same choice by sorting and keeping the first row"""
    modes = staging.mode_days(tf.commute_trips(spark, folder))
    best = ranking.keep_first(modes, ["date"], S.round_even("score", 8).desc_nulls_last(), F.col("primary_mode"))
    return tidy(best.select("date", "primary_mode"))


@query
def stg_commute_day(spark, folder):
    """P6, P7, A1-A5, J1"""
    return tidy(staging.stg_commute_day(tf.commute_trips(spark, folder)))


@query
def stg_commute_entity_day(spark, folder):
    """C1 per entity and day"""
    return tidy(_entity_days(spark, folder))


@query
def stg_commute_day_sql(spark, folder):
    """C1, SQL-model rules"""
    return tidy(staging.stg_commute_day(tf.commute_trips(spark, folder), count_rows=True))


@query
def station_day(spark, folder):
    """A6, first level"""
    return tidy(staging.station_days(tf.air_quality(spark, folder)))


@query
def primary_station(spark, folder):
    """A7"""
    stations = staging.station_days(tf.air_quality(spark, folder))
    return tidy(
        stations.groupBy("date").agg(
            ranking.arg_top(F.col("station_id"), F.col("pm25_mean")).alias("primary_station_id")
        )
    )


@query
def weather_day(spark, folder):
    """A8"""
    return tidy(staging.weather_days(tf.weather(spark, folder)))


@query
def beach_last_status(spark, folder):
    """A9, A10"""
    return tidy(staging.beach_days(tf.beachwatch(spark, folder)))


@query
def stg_env_day(spark, folder):
    """A6-A10, J2, J5"""
    return tidy(
        staging.stg_env_day(tf.air_quality(spark, folder), tf.weather(spark, folder), tf.beachwatch(spark, folder))
    )


@query
def env_outer_chain(spark, folder):
    """J2 by full joins"""
    air = staging.station_days(tf.air_quality(spark, folder)).groupBy("date").agg(
        F.avg("pm25_mean").alias("pm25_mean"), F.avg("pm10_mean").alias("pm10_mean")
    )
    rain = staging.weather_days(tf.weather(spark, folder))
    return tidy(joins.outer_chain([air, rain, staging.beach_days(tf.beachwatch(spark, folder))], ["date"]))


@query
def stg_env_day_sql(spark, folder):
    """C2, SQL-model rules: J3"""
    return tidy(
        staging.stg_env_day_sql(
            tf.air_quality(spark, folder), tf.weather(spark, folder), tf.beachwatch(spark, folder)
        )
    )


@query
def stg_personal_day(spark, folder):
    """P8, A11, T5"""
    return tidy(staging.stg_personal_day(tf.personal(spark, folder)))


@query
def stg_personal_entity_day(spark, folder):
    """C3 per entity and day"""
    return tidy(staging.stg_personal_day(tf.personal(spark, folder), ["entity_id"]))


# ---- marts --------------------------------------------------------------------------------------


@query
def fact_day(spark, folder):
    """C4: J4, P9, P10, T1-T6, T11, T12"""
    return tidy(_fact(spark, folder))


@query
def fact_entity_day(spark, folder):
    """C4 per entity and day"""
    env = staging.stg_env_day(
        tf.air_quality(spark, folder), tf.weather(spark, folder), tf.beachwatch(spark, folder)
    )
    path = scratch_path(spark, "environment")
    seen = Observation("environment")
    datasets.write_mart(env.observe(seen, F.count(F.lit(1)).alias("days")), path)
    env = spark.read.schema(env.schema).parquet(path)
    personal = staging.stg_personal_day(tf.personal(spark, folder), ["entity_id"])
    return tidy(marts.fact_day(_entity_days(spark, folder), env, personal, ["entity_id"], seen.get["days"]))


@query
def dim_commute_mode(spark, folder):
    """A12, T10"""
    days = staging.stg_commute_day(tf.commute_trips(spark, folder), count_rows=True)
    return tidy(marts.dim_commute_mode(days))


@query
def dim_environment_metric(spark, folder):
    """T7-T9"""
    env = staging.stg_env_day_sql(
        tf.air_quality(spark, folder), tf.weather(spark, folder), tf.beachwatch(spark, folder)
    )
    dim = marts.dim_environment_metric(env)
    return tidy(dim.withColumn("is_swimmable", F.col("is_swimmable").cast("string")))


SITE = ["site_name", "latitude", "longitude", "type"]


@query
def dim_site_versions(spark, folder):
    """Sites with name, place and type, a row for each time these held"""
    return tidy(history.versions(tf.site_observations(spark, folder), ["site_id"], SITE, "observation_ts"))


@query
def observations_by_site_name(spark, folder):
    """Beach observations counted under the name their site had then"""
    named = history.version_at(
        tf.beachwatch(spark, folder), history.versions(tf.site_observations(spark, folder), ["site_id"], SITE, "observation_ts"),
        ["site_id"], "observation_ts", SITE,
    )
    return tidy(named.groupBy("site_id", "site_name").agg(F.count("*").alias("observations"), F.count("latitude").alias("placed")))


@query
def dim_site(spark, folder):
    """D14"""
    return tidy(
        marts.dim_site(
            {
                "beach": (tf.beachwatch(spark, folder), "site_id"),
                "air_station": (tf.air_quality(spark, folder), "station_id"),
                "pedestrian_counter": (tf.pedestrian_counts(spark, folder), "site_id"),
            }
        )
    )


@query
def dim_area(spark, folder):
    """D14"""
    return tidy(marts.dim_area(tf.areas(spark, folder), "n_nationkey", "n_name", "r_name"))


# ---- scalars ------------------------------------------------------------------------------------


@query
def status_normalised(spark, folder):
    """T4, T6, T7, P5 over every observation"""
    seen = tf.beachwatch(spark, folder).select(
        "observation_ts",
        S.status_name("status").alias("status_name"),
        S.beach_ok(S.status_name("status")).alias("beach_ok"),
        S.is_swimmable("status").cast("string").alias("is_swimmable"),
        S.status_is_unknown("status").alias("is_unknown"),
    )
    return tidy(seen)


@query
def local_dates(spark, folder):
    """P6, T11, T12 over every trip"""
    days = tf.commute_trips(spark, folder).select(S.local_date("trip_start_ts").alias("day"))
    return tidy(
        days.groupBy("day").agg(F.count("*").alias("trips")).select(
            S.iso_date("day").alias("date"),
            S.weekday_name("day").alias("weekday"),
            F.month("day").alias("month"),
            "trips",
        )
    )


@query
def observation_bands(spark, folder):
    """T8, T9, T14 counted over raw observations"""
    air = tf.air_quality(spark, folder).select(
        S.pm25_category("pm25").alias("pm25_category"),
        S.risk_status(S.clip(F.col("pm25") / 48, 0.0, 1.0)).alias("risk_status"),
    )
    rain = tf.weather(spark, folder).select(S.rainfall_category("rain_mm").alias("band"))
    counted = [
        air.groupBy(F.col("pm25_category").alias("band")).agg(F.count("*").alias("n")),
        air.groupBy(F.col("risk_status").alias("band")).agg(F.count("*").alias("n")),
        rain.groupBy("band").agg(F.count("*").alias("n")),
    ]
    kinds = ["pm25", "risk", "rain"]
    return tidy(reduce(DataFrame.unionByName, [c.withColumn("kind", F.lit(k)) for c, k in zip(counted, kinds)]))


@query
def encoded_filters(spark, folder):
    """The filters applied, as text"""
    filters = {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}
    encoded = records.filter_text(records.filter_records(tf.table(spark, folder, "orders"), filters), filters)
    return tidy(encoded.groupBy("filters").agg(F.count("*").alias("n")))


@query
def hashed_sites(spark, folder):
    """D22"""
    sites = tf.beachwatch(spark, folder).select(S.hashed_id("site_id", "pepper").alias("site_hash"))
    return tidy(sites.groupBy("site_hash").agg(F.count("*").alias("n")))


# ---- sources, cleaning, sinks -------------------------------------------------------------------


@query
def required_projection(spark, folder):
    """P1, P10"""
    return tidy(require_columns(tf.air_quality(spark, folder), list(V.FEED_SCHEMAS["air_quality"])))


@query
def clean_air_quality(spark, folder):
    """P2, P3, P4"""
    return tidy(cleaning.clean_air_quality(tf.outside_air_quality(spark, folder)))


@query
def clean_beachwatch(spark, folder):
    """P2, P3, P4, P5"""
    return tidy(cleaning.clean_beachwatch(tf.outside_beachwatch(spark, folder)))


@query
def filtered_records(spark, folder):
    """S6"""
    rows = records.filter_records(
        tf.table(spark, folder, "orders"), {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}
    )
    return tidy(rows.select("o_orderkey", "o_custkey", "o_totalprice"))


@query
def record_pages(spark, folder):
    """The order table landed as response pages, read back as records"""
    orders = tf.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    page = F.struct(F.collect_list(F.struct("*")).alias("records"), F.count("*").alias("total"))
    pages = orders.groupBy(F.floor(F.col("o_orderkey") / 1000).alias("page")).agg(page.alias("result"))
    path = scratch_path(spark, "pages")
    pages.drop("page").write.json(path)
    return tidy(records.read_record_pages(spark, path, orders.schema))


@query
def record_page_totals(spark, folder):
    """Rows read from pages against the total they state"""
    orders = tf.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    total = F.lit(orders.count()).alias("total")
    records_of = orders.groupBy(F.floor(F.col("o_orderkey") / 1000).alias("page")).agg(F.collect_list(F.struct("*")).alias("records"))
    path = scratch_path(spark, "pages")
    records_of.select(F.struct("records", total).alias("result")).write.json(path)
    return tidy(records.record_page_totals(spark, path, orders.schema))


@query
def refused_rows(spark, folder):
    """Values of a feed landed as text that do not convert, counted instead of lost"""
    trips = tf.commute_trips(spark, folder).drop("entity_id")
    odd = F.col("trip_minutes") % 7 == 0
    texts = trips.select(
        "trip_id", "primary_mode",
        F.when(odd, F.lit("not a time")).otherwise(F.date_format("trip_start_ts", "yyyy-MM-dd HH:mm:ss")).alias("trip_start_ts"),
        F.when(F.col("trip_minutes") % 5 == 0, F.lit("n/a")).otherwise(F.col("trip_minutes").cast("string")).alias("trip_minutes"),
        F.col("fare_amount").cast("string").alias("fare_amount"), "delay_seconds",
    )
    return tidy(refused(texts, "commute_trips"))


@query
def payload_files(spark, folder):
    """Payload files of the suppliers of 20 keys each, so that no file grows with the table, read back with their bytes"""
    rows = tf.table(spark, folder, "supplier").select("s_suppkey", F.floor(F.col("s_suppkey") / 20).alias("part"))
    lines = rows.groupBy("part").agg(F.array_join(F.sort_array(F.collect_list(F.col("s_suppkey").cast("string"))), ",").alias("value"))
    path = scratch_path(spark, "payloads")
    lines.repartition("part").write.partitionBy("part").text(path)
    files = records.read_payloads(spark, path, "*.txt")
    return tidy(files.select("size_bytes", F.sha2("content", 256).alias("sha256")))


@query
def feed_views(spark, folder):
    """Views over landed feeds, queried with SQL text"""
    path = scratch_path(spark, "raw")
    datasets.land_feeds(_feeds(spark, folder), path, AS_OF)
    datasets.register_feed_views(spark, path)
    return tidy(
        spark.sql(
            """
            SELECT to_date(convert_timezone('UTC', 'Australia/Sydney', observation_ts)) AS date,
                   sum(rain_mm) AS rain_24h, avg(temperature_c) AS temp_mean_c,
                   (SELECT count(*) FROM raw_beachwatch) AS beach_rows
            FROM raw_weather GROUP BY 1
            """
        )
    )


@query
def landed_twice(spark, folder):
    """The same window landed on two dates counts twice"""
    path = scratch_path(spark, "raw")
    feed = {"personal": tf.personal(spark, folder).drop("entity_id")}
    for day in (date(2001, 11, 9), AS_OF):
        datasets.land_feeds(feed, path, day)
    return tidy(staging.stg_personal_day(datasets.read_feed(spark, path, "personal")))


@query
def landed_pruned(spark, folder):
    """S1 with partition pruning: only the later landing is read"""
    path = scratch_path(spark, "raw")
    feed = tf.personal(spark, folder).drop("entity_id")
    datasets.land_feeds({"personal": feed.withColumn("steps", F.col("steps") + 1)}, path, date(2001, 11, 9))
    datasets.land_feeds({"personal": feed}, path, AS_OF)
    return tidy(staging.stg_personal_day(datasets.read_feed(spark, path, "personal", first_ingest=AS_OF)))


@query
def latest_per_key(spark, folder):
    """Of all line items with the same trip id, the one shipped last"""
    trips = tf.commute_trips(spark, folder).drop("entity_id").withColumn(
        "ingest_date", S.local_date("trip_start_ts")
    )
    return tidy(ranking.latest_per_key(trips, ["trip_id"]))


@query
def upserted_trips(spark, folder):
    """A mart of trips by key buckets, brought up to date by three landings, the second one the newest"""
    trips = tf.commute_trips(spark, folder).drop("entity_id").withColumn("ingest_date", S.local_date("trip_start_ts"))
    path = scratch_path(spark, "upserted")
    line = F.substring_index("trip_id", "-", -1).cast("int")
    for part in (line <= 3, line > 5, (line > 3) & (line <= 5)):
        upsert.upsert(trips.where(part).withColumn("trip_id", F.substring_index("trip_id", "-", 1)), path, ["trip_id"])
    return tidy(upsert.read_mart(spark, path))


@query
def overlay_feed(spark, folder):
    """The outside feed replaces the own one when it has rows"""
    outside = cleaning.clean_air_quality(tf.outside_air_quality(spark, folder))
    chosen = joins.choose_feed(outside, conform(tf.air_quality(spark, folder), "air_quality"))
    return tidy(staging.station_days(chosen))


@query
def saved_fact(spark, folder):
    """K4, S3"""
    path = scratch_path(spark, "fact")
    datasets.write_mart(_fact(spark, folder), path)
    fact = datasets.read_fact(spark, path)
    return tidy(fact.select("date", "weekday", "beach_ok", "commute_minutes", "steps"))


@query
def staging_csv(spark, folder):
    """K3: staging table written as CSV and read back"""
    path = scratch_path(spark, "csv")
    datasets.write_csv(staging.stg_personal_day(tf.personal(spark, folder)), path)
    ddl = "date date, steps bigint, sleep_hours double, mood_1_5 double, caffeine_mg bigint, " \
          "meeting_count bigint, meeting_minutes bigint"
    return tidy(spark.read.option("header", "true").schema(ddl).csv(path))


@query
def sorted_export(spark, folder):
    """Exported in date order, read back"""
    path = scratch_path(spark, "sorted")
    datasets.write_sorted(staging.weather_days(tf.weather(spark, folder)), path)
    return tidy(spark.read.parquet(path).orderBy("date"))


@query
def month_partitioned_mart(spark, folder):
    """One month read from a mart partitioned by month"""
    path = scratch_path(spark, "months")
    datasets.write_by_month(_fact(spark, folder), path)
    month = spark.read.parquet(path).where(F.col("year_month") == "1996-02")
    return tidy(month.select("date", "weekday", "commute_minutes", "rain_24h_mm"))


@query
def feed_manifest(spark, folder):
    """K7, A17"""
    feeds = _feeds(spark, folder)
    times = {
        "commute_trips": "trip_start_ts", "air_quality": "observation_ts", "weather": "observation_ts",
        "beachwatch": "observation_ts", "personal": "date",
    }
    return tidy(datasets.feed_manifest({name: (feeds[name], column) for name, column in times.items()}))


@query
def feed_rows(spark, folder):
    """A19, Q12"""
    return tidy(quality.feed_rows_report(_feeds(spark, folder)))


# ---- summaries ----------------------------------------------------------------------------------


@query
def weekday_summary(spark, folder):
    """A13"""
    return tidy(profile.weekday_summary(_fact(spark, folder), V.WEEKDAY_SUMMARY_COLUMNS))


@query
def weekday_summary_rounded(spark, folder):
    """Two digits"""
    columns = ["mood_1_5", "commute_minutes", "opal_cost", "rain_24h_mm", "steps", "sleep_hours"]
    return tidy(profile.weekday_summary(_fact(spark, folder), columns, digits=2))


@query
def weekday_mode(spark, folder):
    """A15"""
    return tidy(ranking.column_mode(_fact(spark, folder), "weekday"))


@query
def usual_mode_per_entity(spark, folder):
    """A15 per entity"""
    return tidy(ranking.column_mode(_entity_days(spark, folder), "primary_mode", ["entity_id"], "usual_mode"))


@query
def baseline_features(spark, folder):
    """A16"""
    fact = _fact(spark, folder)
    return tidy(fact.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in V.NUMERIC_FEATURES]))


@query
def profile_fact_day(spark, folder):
    """Exact quartiles"""
    out = profile.profile(_analysis(spark, folder))
    return tidy(out.withColumn("unique", F.col("unique").cast("double")).withColumn("freq", F.col("freq").cast("double")))


@query
def station_distribution(spark, folder):
    """Concentrations by station, over all observations"""
    return tidy(profile.distribution(tf.air_quality(spark, folder), "station_id", "pm25"))


@query
def commute_distribution(spark, folder):
    """Commuting time by mode"""
    return tidy(profile.distribution(staging.stg_commute_day(tf.commute_trips(spark, folder)), "primary_mode", "commute_minutes"))


# ---- quality ------------------------------------------------------------------------------------


@query
def quality_mart_suite(spark, folder):
    """Q9: Q1, Q2, Q3, Q7"""
    fact = _fact(spark, folder)
    return tidy(quality.run_suite(fact, quality.mart_rules(fact)))


@query
def quality_analyze_suite(spark, folder):
    """Q10"""
    fact = _fact(spark, folder)
    return tidy(quality.run_suite(fact, quality.analyze_rules(fact)))


@query
def quality_failing_suite(spark, folder):
    """Q1, Q2, Q3, D12 on rules the data breaks"""
    fact = _fact(spark, folder)
    rules = [
        quality.required_columns(fact, ["date", "spend_total"]),
        quality.not_null(["date", "beach_status", "beach_site_id"]),
        quality.value_range("reliability", 0.9, 1.0),
        quality.value_range("mood_1_5", 1.0, 5.0),
        quality.value_domain("beach_status", ["Very good", "Good"]),
        quality.value_domain("primary_mode", ["train", "bus", "ferry", "unknown"]),
        quality.completeness(["date", "beach_status", "mood_1_5"]),
        quality.boolean_domain(fact, "beach_ok"),
    ]
    return tidy(quality.run_suite(fact, rules))


@query
def quality_summary(spark, folder):
    """Q8"""
    fact = _fact(spark, folder)
    return tidy(quality.summary(quality.run_suite(fact, quality.mart_rules(fact))))


@query
def quality_ranges(spark, folder):
    """Q4"""
    env = staging.stg_env_day_sql(
        tf.air_quality(spark, folder), tf.weather(spark, folder), tf.beachwatch(spark, folder)
    )
    commute = staging.stg_commute_day(tf.commute_trips(spark, folder), count_rows=True)
    return tidy(
        quality.range_report(env, V.SQL_MART_RANGES["stg_env_day"], "stg_env_day").unionByName(
            quality.range_report(commute, V.SQL_MART_RANGES["stg_commute_day"], "stg_commute_day")
        )
    )


@query
def quality_freshness(spark, folder):
    """Q6"""
    days = staging.stg_commute_day(tf.commute_trips(spark, folder), count_rows=True)
    weather = staging.weather_days(tf.weather(spark, folder))
    return tidy(
        quality.freshness_report(days, "stg_commute_day", 7, AS_OF).unionByName(
            quality.freshness_report(weather, "weather_day", 7, AS_OF)
        )
    )


@query
def quality_sql_marts(spark, folder):
    """Q4-Q6 over all SQL marts as they were saved"""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "marts")
    datasets.land_feeds(_feeds(spark, folder), raw, AS_OF)
    return tidy(runs.build_sql_marts(spark, raw, out, AS_OF, "record"))


@query
def saved_sql_mart(spark, folder):
    """K6: the four models in order; the environment dimension as it was saved"""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "marts")
    datasets.land_feeds(_feeds(spark, folder), raw, AS_OF)
    runs.build_sql_marts(spark, raw, out, AS_OF, "record")
    saved = spark.read.parquet(f"{out}/dim_environment_metric")
    return tidy(saved.withColumn("is_swimmable", F.col("is_swimmable").cast("string")))


@query
def built_fact(spark, folder):
    """The mart of a whole run over landed feeds, one of which lacks its optional columns"""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "marts")
    datasets.land_feeds(_feeds(spark, folder), raw, AS_OF)
    runs.build_fact(spark, raw, out)
    return tidy(spark.read.parquet(f"{out}/fact_day"))


@query
def built_fact_report(spark, folder):
    """The checks of a whole run"""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "marts")
    datasets.land_feeds(_feeds(spark, folder), raw, AS_OF)
    return tidy(runs.build_fact(spark, raw, out))


@query
def analyzed_fact(spark, folder):
    """Checks of a saved mart"""
    path = scratch_path(spark, "fact")
    datasets.write_mart(_fact(spark, folder), path)
    return tidy(runs.analyze(spark, path))


@query
def ingested_feeds(spark, folder):
    """All feeds landed, a live feed without rows leaving its counterpart in place"""
    feeds = _feeds(spark, folder)
    _, report = runs.ingest(feeds, {"weather": feeds["weather"].limit(0)}, scratch_path(spark, "raw"), AS_OF)
    return tidy(report)


@query
def absent_columns(spark, folder):
    """A landed feed without its optional columns reads as null in them"""
    path = scratch_path(spark, "raw")
    datasets.land(tf.weather(spark, folder).select("observation_ts", "rain_mm"), path, "weather", AS_OF)
    return tidy(staging.weather_days(datasets.read_feed(spark, path, "weather")))


@query
def mart_health(spark, folder):
    """Q11"""
    path = scratch_path(spark, "fact")
    datasets.write_mart(_fact(spark, folder), path)
    return tidy(quality.health_report(spark.read.parquet(path)))


@query
def unique_key(spark, folder):
    """D12"""
    reports = [
        quality.unique_key_report(tf.commute_trips(spark, folder), ["trip_id"]),
        quality.unique_key_report(_fact(spark, folder), ["date"]),
    ]
    return tidy(reduce(DataFrame.unionByName, reports))


@query
def completeness(spark, folder):
    """D12"""
    return tidy(quality.completeness_report(_fact(spark, folder), V.FACT_DAY_COLUMNS))


@query
def feed_staleness(spark, folder):
    """D20"""
    feeds = {
        "air_quality": (tf.air_quality(spark, folder), "observation_ts"),
        "beachwatch": (tf.beachwatch(spark, folder), "observation_ts"),
        "commute_trips": (tf.commute_trips(spark, folder), "trip_start_ts"),
    }
    return tidy(quality.staleness_report(feeds, datetime(2001, 8, 4)))


@query
def reconciliation(spark, folder):
    """D13"""
    fares = tf.commute_trips(spark, folder).select(S.local_date("trip_start_ts").alias("date"), "fare_amount")
    spend = tf.table(spark, folder, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"), (F.col("o_custkey") % 30).cast("double").alias("spend")
    )
    return tidy(joins.reconcile(fares, spend, ["date"], "fare_amount", "spend", V.RECONCILE_TOLERANCE))


# ---- features -----------------------------------------------------------------------------------


@query
def zscore_month(spark, folder):
    """D1"""
    columns = ["commute_minutes", "pm25_mean", "steps"]
    scored = features.zscore_by_month(_fact(spark, folder), columns)
    return tidy(scored.select("date", *[f"{c}_z" for c in columns]))


@query
def lag_features(spark, folder):
    """D2"""
    fact = _fact(spark, folder).select("date", "pm25_mean")
    return tidy(features.shifted_days(fact, lags={"pm25_mean": (1, 2)}))


@query
def rain_72h(spark, folder):
    """D3"""
    fact = _fact(spark, folder).select("date", "rain_24h_mm")
    return tidy(features.shifted_days(fact, trailing_sums={"rain_24h_mm": 3}))


@query
def entity_lag_features(spark, folder):
    """D2, D3 per entity"""
    days = _entity_days(spark, folder).select("entity_id", "date", "commute_minutes", "opal_cost")
    return tidy(
        features.shifted_days(
            days, ["entity_id"], lags={"commute_minutes": (1,)}, trailing_sums={"opal_cost": 7}
        )
    )


@query
def calendar_features(spark, folder):
    """D4"""
    out = features.calendar_features(_fact(spark, folder).select("date", "weekday", "month"))
    return tidy(out)


@query
def observed_holidays(spark, folder):
    """Movable and substitute holidays of the mart's days"""
    return tidy(features.observed_holidays(_fact(spark, folder).select("date", "weekday")))


@query
def holiday_mood(spark, folder):
    """Mean mood by holiday"""
    days = features.observed_holidays(_fact(spark, folder).select("date", "mood_1_5"))
    kind = F.coalesce("holiday", F.lit("none")).alias("holiday")
    return tidy(days.groupBy(kind).agg(F.count("*").alias("days"), F.avg("mood_1_5").alias("mood")))


@query
def mode_switch(spark, folder):
    """D5 per entity"""
    days = features.mode_switch(_entity_days(spark, folder), ["entity_id"])
    return tidy(days.select("entity_id", "date", "primary_mode", "usual_mode", "mode_switch"))


@query
def mode_switch_day(spark, folder):
    """D5 for all trips of a day"""
    days = features.mode_switch(staging.stg_commute_day(tf.commute_trips(spark, folder)))
    return tidy(days.select("date", "primary_mode", "usual_mode", "mode_switch"))


@query
def delay_bands(spark, folder):
    """D6"""
    days = _entity_days(spark, folder)
    return tidy(days.select("entity_id", "date", S.delay_band("mean_delay_s").alias("delay_band")))


@query
def exposure_window(spark, folder):
    """D7"""
    return tidy(features.exposure_days(tf.air_quality(spark, folder)))


@query
def crosstab_bands(spark, folder):
    """D8"""
    days = features.mode_switch(_entity_days(spark, folder), ["entity_id"])
    banded = days.withColumn("delay_band", S.delay_band("mean_delay_s"))
    return tidy(profile.cross_table(banded, "delay_band", "mode_switch", [True, False]))


@query
def cube_rain_status(spark, folder):
    """Rain by status with subtotals"""
    fact = _fact(spark, folder).withColumn("rainfall", S.rainfall_category("rain_24h_mm"))
    return tidy(profile.cube_counts(fact, "rainfall", "beach_status"))


@query
def cube_rain_status_steps(spark, folder):
    """Rain by status by whether one was out and about, with all subtotals"""
    rows = _fact(spark, folder).withColumn("rainfall", S.rainfall_category("rain_24h_mm")).withColumn("active", F.col("steps") >= 1500)
    return tidy(profile.cube_counts(rows, "rainfall", "beach_status", "active"))


@query
def status_over_time(spark, folder):
    """How the days of each month spread over the beach's status"""
    return tidy(profile.shares_over_time(_fact(spark, folder), "date", "beach_status"))


@query
def difference_wet_dry(spark, folder):
    """D9"""
    return tidy(inference.difference_in_means(_fact(spark, folder), "steps", F.col("after_rain")))


@query
def after_rain_advice(spark, folder):
    """D10"""
    fact = _fact(spark, folder)
    advice = S.after_rain_advice("rain_24h_mm", "beach_status")
    return tidy(fact.select("date", "after_rain", advice.alias("after_rain_advice")))


@query
def pedestrian_day(spark, folder):
    """D15"""
    return tidy(features.pedestrian_days(tf.pedestrian_counts(spark, folder)))


@query
def trip_delays(spark, folder):
    """Delay reports of the route within half an hour of each trip's start"""
    matched = joins.window_totals(
        tf.routed_trips(spark, folder),
        tf.delay_reports(spark, folder),
        on=["route"],
        probe_time="trip_start_ts",
        event_time="ts",
        measures={"reports": F.lit(1.0), "delay_total": F.col("delay_s")},
        before_s=1800,
        after_s=1800,
    )
    mean = F.try_divide(F.col("delay_total"), F.col("reports"))
    return tidy(matched.select("trip_id", "route", "reports", "delay_total", mean.alias("mean_delay_s")))


def _nearest(spark, folder, direction: str) -> DataFrame:
    reports = tf.delay_reports(spark, folder).select("ts", "route", "delay_s", F.col("trip_id").alias("report"))
    return asof.nearest_event(
        tf.routed_trips(spark, folder), reports, on=["route"], probe_time="trip_start_ts", event_time="ts", within_s=1800,
        values=["report", "delay_s"], ties=["report"], direction=direction,
    )


@query
def nearest_report(spark, folder):
    """The delay report of the route that is nearest to each trip's start, within half an hour"""
    return tidy(_nearest(spark, folder, "nearest").select("trip_id", "route", "report", "delay_s", "distance_us"))


@query
def last_report(spark, folder):
    """The last report of the route up to each trip's start"""
    return tidy(_nearest(spark, folder, "before").select("trip_id", "route", "report", "delay_s", "distance_us"))


@query
def reports_within(spark, folder):
    """Every report of the route in the ten minutes around each trip's start"""
    reports = tf.delay_reports(spark, folder).select("ts", "route", "delay_s", F.col("trip_id").alias("report"))
    met = asof.events_within(
        tf.routed_trips(spark, folder), reports, on=["route"], probe_time="trip_start_ts", event_time="ts", before_s=300, after_s=300,
        values=["report", "delay_s"],
    )
    return tidy(met.select("trip_id", "route", "report", "delay_s", "distance_us"))


# ---- model --------------------------------------------------------------------------------------


@query
def encoded_features(spark, folder):
    """M1"""
    design = R.Design()
    rows = R.model_rows(_analysis(spark, folder), design, "drop")
    encoded = R.encode(rows, design, R.fit_scaling(rows, design.numeric))
    return tidy(encoded.select("date", *[f"x_{c}" for c in design.columns()]))


@query
def gram_matrix(spark, folder):
    """M2, sufficient statistics"""
    return tidy(R.gram_matrix(_analysis(spark, folder), R.Design(), "drop"), MODEL_DIGITS)


@query
def model_coefficients(spark, folder):
    """M2"""
    return tidy(R.coefficient_table(spark, R.fit_linear(_analysis(spark, folder), on_null="drop")), MODEL_DIGITS)


@query
def predictions(spark, folder):
    """M3"""
    fact = _analysis(spark, folder)
    rows = R.scorable_rows(fact, R.Design())
    model = R.fit_linear(fact, on_null="drop")
    return tidy(model.predict(rows).select("date", "weekday", "mood_1_5", "prediction"), MODEL_DIGITS)


@query
def unusable_days(spark, folder):
    """M1: days a fit leaves out when it is told to drop missing values"""
    return tidy(R.unusable_rows(_fact(spark, folder), R.Design()))


@query
def holdout_split(spark, folder):
    """M4, exact half"""
    rows = R.model_rows(_fact(spark, folder), R.Design(), "drop")
    return tidy(R.split_holdout(rows, ["date"], SEED).select("date", "is_test"))


@query
def holdout_split_by_hash(spark, folder):
    """M4, each row by its own hash"""
    trips = tf.commute_trips(spark, folder)
    split = R.split_holdout(trips, ["trip_id"], SEED, 0.5, exact=False)
    return tidy(split.groupBy("is_test").agg(F.count("*").alias("n"), F.sum("trip_minutes").alias("minutes")))


@query
def holdout_metrics(spark, folder):
    """M5: fitted on one half, measured on the other"""
    path = scratch_path(spark, "split")
    rows = R.model_rows(_analysis(spark, folder), R.Design(), "drop")
    datasets.write_mart(R.split_holdout(rows, ["date"], SEED), path)
    split = spark.read.parquet(path)
    model = R.fit_linear(split.where(~F.col("is_test")))
    return tidy(R.regression_metrics(model.predict(split.where("is_test"))), MODEL_DIGITS)


@query
def simple_regressions(spark, folder):
    """M2 with one feature"""
    return tidy(R.simple_regressions(_fact(spark, folder), ["commute_minutes", "reliability", "pm25_mean", "steps"]), MODEL_DIGITS)


@query
def ols_with_controls(spark, folder):
    """Coefficients with standard errors"""
    return tidy(R.ols_table(spark, _analysis(spark, folder), CONTROLS, "drop"), MODEL_DIGITS)


@query
def robust_coefficients(spark, folder):
    """Refitted without outlier days"""
    fact = R.without_outlier_days(_analysis(spark, folder), ["commute_minutes", "steps"], 2.0)
    return tidy(R.coefficient_table(spark, R.fit_linear(fact, on_null="drop")), MODEL_DIGITS)


@query
def robust_huber(spark, folder):
    """M-estimate with Huber's loss"""
    return tidy(robust.robust_table(_analysis(spark, folder), CONTROLS, robust.HUBER, "drop"), MODEL_DIGITS)


@query
def robust_tukey(spark, folder):
    """M-estimate that gives far days no weight"""
    return tidy(robust.robust_table(_analysis(spark, folder), CONTROLS, robust.TUKEY, "drop"), MODEL_DIGITS)


@query
def sandwich_errors(spark, folder):
    """Errors under unequal variances"""
    return tidy(robust.sandwich_table(_analysis(spark, folder), CONTROLS, "drop"), MODEL_DIGITS)


@query
def logit_mode_switch(spark, folder):
    """Probability of a mode switch by mean delay in minutes"""
    days = features.mode_switch(_entity_days(spark, folder), ["entity_id"])
    rows = days.withColumn("delay_min", F.coalesce("mean_delay_s", F.lit(0.0)) / 60)
    model = inference.fit_logit(rows, "mode_switch", ["delay_min"])
    return tidy(inference.logit_table(spark, model, ["delay_min"]), 4)


@query
def bootstrap_weights(spark, folder):
    """M6: drawn rows per replicate"""
    rows = R.model_rows(_fact(spark, folder), R.Design(), "drop")
    return tidy(B.weight_table(rows, ["date"], SEED, 20, "multinomial"))


@query
def bootstrap_weights_poisson(spark, folder):
    """M6: independent weights"""
    rows = R.model_rows(_fact(spark, folder), R.Design(), "drop")
    return tidy(B.weight_table(rows, ["date"], SEED, 20, "poisson"))


@query
def bootstrap_mean_ci(spark, folder):
    """A18, M6 for a mean"""
    means = B.bootstrap_means(_fact(spark, folder), V.TARGET, ["date"], SEED, 200, "multinomial")
    return tidy(B.percentile_interval(means, "mean"))


def _intervals(spark, folder, method: str) -> DataFrame:
    return B.prediction_intervals(
        _analysis(spark, folder), ["date"], seed=SEED, method=method, keep=["weekday"], on_null="drop"
    )


@query
def bootstrap_mean_ci_poisson(spark, folder):
    """A18, M6 for a mean, without a join"""
    means = B.bootstrap_means(_fact(spark, folder), V.TARGET, ["date"], SEED, 200)
    return tidy(B.percentile_interval(means, "mean"))


@query
def bootstrap_intervals(spark, folder):
    """M6, the default: independent weights"""
    return tidy(_intervals(spark, folder, "poisson"), MODEL_DIGITS)


@query
def bootstrap_intervals_poisson(spark, folder):
    """M6 without a join, by name"""
    return tidy(_intervals(spark, folder, "poisson"), MODEL_DIGITS)


@query
def bootstrap_intervals_multinomial(spark, folder):
    """M6, n draws with replacement"""
    return tidy(_intervals(spark, folder, "multinomial"), MODEL_DIGITS)


@query
def recent_days(spark, folder):
    """The last days of the mart, scored after they are chosen"""
    fact = _analysis(spark, folder)
    scored = B.prediction_intervals(
        fact, ["date"], seed=SEED, keep=["weekday"], on_null="drop", score=B.recent_days(fact)
    )
    return tidy(scored, MODEL_DIGITS)


@query
def scenario_features(spark, folder):
    """J6, M8 inputs, S4"""
    path = scratch_path(spark, "scenarios")
    datasets.write_csv(datasets.default_scenarios(spark), path)
    start = scenarios.baseline(_fact(spark, folder))
    return tidy(scenarios.scenario_inputs(datasets.read_scenarios(spark, path), start))


@query
def scenario_predictions(spark, folder):
    """M8"""
    fact = _analysis(spark, folder)
    scored = scenarios.score_scenarios(
        datasets.default_scenarios(spark), scenarios.baseline(fact), R.fit_linear(fact, on_null="drop")
    )
    return tidy(scored, MODEL_DIGITS)


@query
def custom_scenario(spark, folder):
    """M9"""
    fact = _analysis(spark, folder)
    row = scenarios.custom_scenario(spark, {"commute_minutes": -30.0, "reliability": 0.3, "steps": 5000.0})
    return tidy(scenarios.score_scenarios(row, scenarios.baseline(fact), R.fit_linear(fact, on_null="drop")), MODEL_DIGITS)


@query
def sensitivity_inputs(spark, folder):
    """M7 inputs"""
    return tidy(scenarios.sensitivity_inputs(spark, scenarios.baseline(_fact(spark, folder))))


@query
def sensitivity(spark, folder):
    """M7: baseline and model of the training half"""
    path = scratch_path(spark, "split")
    rows = R.model_rows(_analysis(spark, folder), R.Design(), "drop")
    datasets.write_mart(R.split_holdout(rows, ["date"], SEED), path)
    half = spark.read.parquet(path).where(~F.col("is_test"))
    start = scenarios.baseline(half)
    scored = scenarios.score_sensitivity(scenarios.sensitivity_inputs(spark, start), start, R.fit_linear(half))
    return tidy(scored, MODEL_DIGITS)


# ---- streams ------------------------------------------------------------------------------------

_EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _report_stream(spark, folder) -> DataFrame:
    events = delays.read_reports(spark, folder, _EVENT_SCHEMA, "events.parquet")
    return events.select(
        "ts",
        F.col("event_type").alias("route"),
        F.col("event_id").cast("string").alias("trip_id"),
        (F.get_json_object("props", "$.k").cast("double") * 3).alias("delay_s"),
    )


@query
def stream_delay_day(spark, folder):
    """Every day, with whether the watermark has closed it"""
    return tidy(delays.run_days(_report_stream(spark, folder), "delays"))


@query
def stream_closed_days(spark, folder):
    """Each day once, when the watermark has closed it, with the reports that came after that"""
    rows = closing.run_closing(_report_stream(spark, folder))
    joined = closing.days_of(rows).join(closing.late_counts(rows), ["date", "route"], "left")
    return tidy(joined.withColumn("too_late", F.coalesce("too_late", F.lit(0))))


@query
def stream_distinct_reports(spark, folder):
    """Two overlapping snapshots, each report once"""
    twice = _report_stream(spark, folder).union(_report_stream(spark, folder))
    return tidy(delays.run_available(delays.distinct_reports(twice, ["trip_id"]), "reports"))
