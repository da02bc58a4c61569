"""The five feeds, expressed over order, line item and event tables.

Measures are whole numbers or binary fractions, so their sums do not depend on the order of the rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_SCHEMAS: dict[tuple[str, str, int], T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder. Its schema is inferred once a session, not again for every feed built on it, and anew when the table changes."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    changed = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).getModificationTime()
    key = (spark.sparkContext.applicationId, path, changed)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def _hours(column: Column) -> Column:
    return F.make_dt_interval(F.lit(0), column.cast("int"))


def _cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def commute_trips(spark: SparkSession, folder: str) -> DataFrame:
    mode = (
        F.when(F.col("l_linenumber") == 7, None)
        .when(F.col("l_returnflag") == "A", "train")
        .when(F.col("l_returnflag") == "N", "bus")
        .otherwise("ferry")
    )
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("entity_id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("trip_id"),
        (F.col("l_shipdate") + _hours(F.col("l_linenumber") * 3)).alias("trip_start_ts"),
        mode.alias("primary_mode"),
        F.col("l_quantity").alias("trip_minutes"),
        F.round(F.col("l_tax") * 100).alias("fare_amount"),
        F.when(F.col("l_discount") != 0, F.round(F.col("l_discount") * 1000)).alias("delay_seconds"),
    )


def _order_time() -> Column:
    """Order day, an hour and a microsecond offset from the order key: unique per order."""
    micros = F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.col("o_orderkey") / 1_000_000).cast("decimal(18,6)")
    )
    return F.col("o_orderdate") + _hours(F.col("o_orderkey") % 24) + micros


def air_quality(spark: SparkSession, folder: str) -> DataFrame:
    pm25 = (_cents("o_totalprice") % 400_000).cast("double") / 8192
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("station_id"),
        _order_time().alias("observation_ts"),
        pm25.alias("pm25"),
        (pm25 * 1.5 + 3).alias("pm10"),
    )


def weather(spark: SparkSession, folder: str) -> DataFrame:
    rain = F.when(F.col("o_custkey") % 3 == 0, (F.col("o_custkey") % 40).cast("double") / 8).otherwise(F.lit(0.0))
    return table(spark, folder, "orders").select(
        _order_time().alias("observation_ts"),
        rain.alias("rain_mm"),
        (F.col("o_custkey") % 20 + 12).cast("double").alias("temperature_c"),
    )


def beachwatch(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("o_orderkey") % 5
    status = (
        F.when(F.col("o_orderkey") % 11 == 0, None)
        .when(kind == 0, "Very good")
        .when(kind == 1, " good ")
        .when(kind == 2, "POOR")
        .when(kind == 3, "closed")
        .otherwise("mystery")
    )
    return table(spark, folder, "orders").select(
        _order_time().alias("observation_ts"),
        F.concat(F.lit("site_"), (F.col("o_custkey") % 7).cast("string")).alias("site_id"),
        status.alias("status"),
        ((_cents("o_totalprice") % 40_000).cast("double") / 128).alias("enterococci"),
    )


def site_observations(spark: SparkSession, folder: str) -> DataFrame:
    """Descriptions of the beach sites as they were seen: two sites move and are renamed, one of them and back again, one has no place for a year."""
    site, day = F.col("o_custkey") % 7, F.col("o_orderdate").cast("date")
    moved = (site == 2) & (day >= F.lit("1995-06-01").cast("date"))
    there = (site == 3) & day.between(F.lit("1994-01-01").cast("date"), F.lit("1996-12-31").cast("date"))
    lost = (site == 5) & (F.year(day) == 1995)
    latitude = F.lit(-33.5) - site.cast("double") / 16 + F.when(moved | there, F.lit(0.25)).otherwise(F.lit(0.0))
    return table(spark, folder, "orders").select(
        F.concat(F.lit("site_"), site.cast("string")).alias("site_id"),
        F.concat(F.lit("Beach "), site.cast("string"), F.when(moved | there, F.lit(" North")).otherwise(F.lit(""))).alias("site_name"),
        F.when(~lost, latitude).alias("latitude"),
        F.when(~lost, F.lit(151.25) + site.cast("double") / 32).alias("longitude"),
        F.lit("beach").alias("type"),
        _order_time().alias("observation_ts"),
    )


def personal(spark: SparkSession, folder: str) -> DataFrame:
    sleep = F.when(F.col("o_orderkey") % 9 != 0, F.lit(4.0) + (F.col("o_orderkey") % 24).cast("double") / 4)
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("entity_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        ((F.col("o_custkey") * 7) % 3000).alias("steps"),
        sleep.alias("sleep_hours"),
        (F.lit(1.0) + (F.col("o_orderkey") % 17).cast("double") / 4).alias("mood_1_5"),
        ((F.col("o_custkey") * 13) % 300).alias("caffeine_mg"),
        (F.col("o_orderkey") % 4).alias("meeting_count"),
        ((F.col("o_orderkey") % 4) * 15).alias("meeting_minutes"),
    )


def delay_reports(spark: SparkSession, folder: str) -> DataFrame:
    delay = F.get_json_object("props", "$.k").cast("double") * 3
    return table(spark, folder, "events").select(
        F.col("ts"),
        F.col("event_type").alias("route"),
        F.col("event_id").cast("string").alias("trip_id"),
        delay.alias("delay_s"),
    )


def routed_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips on the delay reports' routes, spread over the same month to the second."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), ((F.col("o_orderkey") * 7919) % 2_592_000).cast("decimal(18,6)")
    )
    routes = F.array(*[F.lit(r) for r in ("click", "error", "purchase", "signup", "view")])
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("trip_id"),
        F.element_at(routes, (F.col("o_custkey") % 5 + 1).cast("int")).alias("route"),
        start.alias("trip_start_ts"),
    )


def pedestrian_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counter readings: one per event, at the sensor of its type."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("site_id"),
        F.col("ts").alias("counted_ts"),
        (F.col("user_id") % 50 + 1).alias("people"),
    )


def areas(spark: SparkSession, folder: str) -> DataFrame:
    """Customers' nations as areas, with their region."""
    customers = table(spark, folder, "customer").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    nations = table(spark, folder, "nation").withColumn("n_nationkey", F.col("n_nationkey").cast("int"))
    regions = table(spark, folder, "region")
    return (
        customers.join(nations, "n_nationkey")
        .join(regions, nations["n_regionkey"] == regions["r_regionkey"])
        .select("n_nationkey", "n_name", "r_name")
    )


def outside_air_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The air feed as an outside party sends it: other names, text values, some of them unusable."""
    key = F.col("o_orderkey")
    stamp = F.date_format(F.col("o_orderdate") + _hours(key % 24), "yyyy-MM-dd'T'HH:mm:ss")
    pm25 = (F.round(F.col("o_totalprice") * 100).cast("bigint") % 500).cast("string")
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("Station"),
        F.when(key % 13 == 0, "not a time").otherwise(stamp).alias("DateTime"),
        F.when(key % 10 == 0, "n/a").otherwise(pm25).alias("PM2_5"),
        F.when(key % 17 == 0, None).otherwise((key % 90).cast("string")).alias("pm10value"),
        F.col("o_orderstatus").alias("ignored"),
    )


def outside_beachwatch(spark: SparkSession, folder: str) -> DataFrame:
    """The beach feed as an outside party sends it."""
    key = F.col("o_orderkey")
    stamp = F.date_format(F.col("o_orderdate") + _hours(key % 24), "yyyy-MM-dd'T'HH:mm:ss")
    status = (
        F.when(key % 6 == 0, " \t ")
        .when(key % 6 == 1, None)
        .when(key % 6 == 2, "\tGood\n")
        .when(key % 6 == 3, " POOR")
        .otherwise("very good")
    )
    return table(spark, folder, "orders").select(
        F.when(key % 13 == 0, "").otherwise(stamp).alias("Sample_Date"),
        F.concat(F.lit("site_"), (F.col("o_custkey") % 7).cast("string")).alias("Beach"),
        status.alias("Advice"),
        F.when(key % 7 == 0, "<10").otherwise((key % 300).cast("string")).alias("enterococci_count"),
        key.alias("row_key"),
    )
