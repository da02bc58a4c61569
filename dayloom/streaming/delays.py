"""Streaming aggregates over delay reports."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dayloom.fixed_values import LOCAL_ZONE
from dayloom.functions.scalars import is_late
from dayloom.operators.ranking import keep_first
from dayloom.session import scratch_path


def read_reports(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet") -> DataFrame:
    """Report files of a landing folder as a stream; new files are picked up as they appear."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def daily_delays(
    reports: DataFrame, zone: str = LOCAL_ZONE, lateness: str = "2 hours", time: str = "ts"
) -> DataFrame:
    """Reports, late reports and mean delay per route and local day, final once the watermark has passed.

    The watermark is on local time, as the window is. Clocks step back by an hour once a year, so the
    allowed lateness must be at least two hours. Also runs on a plain table, without a watermark.
    """
    local = reports.withColumn("local_ts", F.from_utc_timestamp(F.col(time).cast("timestamp"), zone))
    if reports.isStreaming:
        local = local.withWatermark("local_ts", lateness)
    return (
        local.groupBy(F.window("local_ts", "1 day"), "route")
        .agg(
            F.count(F.lit(1)).alias("report_count"),
            F.count_if(is_late("delay_s")).alias("late_count"),
            F.avg("delay_s").alias("mean_delay_s"),
        )
        .select(F.to_date("window.start").alias("date"), "route", "report_count", "late_count", "mean_delay_s")
    )


def distinct_reports(reports: DataFrame, keys: list[str], lateness: str = "2 hours", time: str = "ts") -> DataFrame:
    """Each report once, however many snapshots repeat it within the lateness; later ones are dropped."""
    timed = reports.withColumn(time, F.col(time).cast("timestamp"))
    if not reports.isStreaming:
        return timed.dropDuplicates(keys)
    return timed.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


def run_available(stream: DataFrame, label: str) -> DataFrame:
    """Process everything that is there, then read the result back from the shared folder."""
    spark = stream.sparkSession
    out, state = scratch_path(spark, f"{label}-out"), scratch_path(spark, f"{label}-state")
    query: StreamingQuery = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", state)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_days(reports: DataFrame, label: str, **options) -> DataFrame:
    """Daily delays of everything that is there, open days included: ``is_final`` tells the days the watermark has closed.

    The stream emits each change of a day; a batch writes its changes to a folder of its own, which it replaces when it is run again,
    and the last change of a route and day counts.
    """
    spark = reports.sparkSession
    out, state = scratch_path(spark, f"{label}-out"), scratch_path(spark, f"{label}-state")
    days = daily_delays(reports, **options)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = days.writeStream.foreachBatch(write).option("checkpointLocation", state).outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p.get("eventTime", {})]
    closed = F.lit(max(marks)).try_cast("timestamp") if marks else F.lit(None).cast("timestamp")
    kind = T.StructType([*days.schema.fields, T.StructField("batch", T.IntegerType())])
    if not query.recentProgress:
        return spark.createDataFrame([], days.schema).withColumn("is_final", F.lit(False))
    written = spark.read.schema(kind).parquet(out)
    last = keep_first(written, ["date", "route"], F.col("batch").desc()).drop("batch")
    ends = (F.col("date") + F.expr("INTERVAL 1 DAY")).cast("timestamp")
    return last.withColumn("is_final", F.coalesce(ends <= closed, F.lit(False)))
