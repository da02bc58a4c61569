from datetime import datetime, timedelta

from pyspark.sql import functions as F

from dayloom.session import scratch_path
from dayloom.streaming import closing, delays

SCHEMA = "ts timestamp_ntz, route string, trip_id string, delay_s double"


def land(spark, rows, path, mode="append"):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode(mode).parquet(path)


def test_stream_equals_batch_on_closed_days(spark, rows):
    path = scratch_path(spark, "reports")
    start = datetime(2024, 4, 5)  # clocks step back on the 7th
    data = [(start + timedelta(hours=3 * i), f"r{i % 3}", str(i), float(i % 5 * 30)) for i in range(40)]
    land(spark, data, path)
    stream = delays.run_available(delays.daily_delays(delays.read_reports(spark, path, SCHEMA)), "t")
    batch = delays.daily_delays(spark.read.schema(SCHEMA).parquet(path))
    last = batch.agg(F.max("date")).first()[0]
    columns = ["date", "route", "report_count", "late_count", "mean_delay_s"]
    assert rows(stream, *columns) == rows(batch.where(F.col("date") < F.lit(last)), *columns)
    assert stream.count() > 9


def test_snapshots_are_deduplicated(spark, rows):
    path = scratch_path(spark, "reports")
    data = [(datetime(2024, 4, 5, 1, i), "r", str(i), 1.0) for i in range(20)]
    land(spark, data, path)
    land(spark, data[5:] + data[:10], path)
    reports = delays.read_reports(spark, path, SCHEMA)
    got = delays.run_available(delays.distinct_reports(reports, ["trip_id"]), "t")
    assert sorted(int(r["trip_id"]) for r in got.collect()) == list(range(20))
    batch = delays.distinct_reports(spark.read.schema(SCHEMA).parquet(path), ["trip_id"])
    assert batch.count() == 20


def test_late_reports_are_dropped(spark):
    """Two batches: the second holds a report from before the watermark."""
    path, out, state = (scratch_path(spark, n) for n in ("reports", "out", "state"))
    land(spark, [(datetime(2024, 4, 5, 1), "r", "a", 1.0), (datetime(2024, 4, 9, 1), "r", "b", 1.0)], path)

    def run():
        stream = delays.daily_delays(delays.read_reports(spark, path, SCHEMA))
        query = (
            stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
            .outputMode("append").trigger(availableNow=True).start()
        )
        query.awaitTermination()

    run()
    land(spark, [(datetime(2024, 4, 5, 2), "r", "late", 500.0), (datetime(2024, 4, 20), "r", "c", 1.0)], path)
    run()
    got = {str(r["date"]): r["report_count"] for r in spark.read.parquet(out).collect()}
    assert got == {"2024-04-05": 1, "2024-04-09": 1}


def test_closed_days_equal_batch_and_late_reports_are_told(spark, rows):
    path, out, state = (scratch_path(spark, n) for n in ("reports", "out", "state"))
    start = datetime(2024, 4, 5)
    data = [(start + timedelta(hours=3 * i), f"r{i % 3}", str(i), None if i % 7 == 0 else float(i % 5 * 30)) for i in range(40)]
    land(spark, data[:25], path)
    first = closing.run_closing(delays.read_reports(spark, path, SCHEMA), out, state)
    assert closing.late_counts(first).count() == 0
    closed = {r["date"] for r in closing.days_of(first).collect()}
    # a report of a closed day, one of an open day behind the watermark, and rows without a time or route
    more = [(start + timedelta(hours=1), "r9", "late", 500.0), (None, "r1", "x", 1.0), (start, None, "y", 1.0)]
    land(spark, more, path)
    land(spark, data[25:], path)
    second = closing.run_closing(delays.read_reports(spark, path, SCHEMA), out, state)  # goes on from the checkpoint
    batch = delays.daily_delays(spark.createDataFrame(data, SCHEMA))
    last = batch.agg(F.max("date")).first()[0]
    columns = ["date", "route", "report_count", "late_count", "mean_delay_s"]
    assert rows(closing.days_of(second), *columns) == rows(batch.where(F.col("date") < F.lit(last)), *columns)
    late = closing.late_counts(second).collect()
    assert [(r["route"], r["too_late"]) for r in late] == [("r9", 1)] and late[0]["date"] in closed
    assert [r["delay_s"] for r in second.where("kind = 'late'").collect()] == [500.0]
    again = closing.run_closing(delays.read_reports(spark, path, SCHEMA), out, state)
    assert again.count() == second.count()


def test_an_empty_stream_closes_nothing(spark):
    path = scratch_path(spark, "reports")
    land(spark, [], path)
    assert closing.run_closing(delays.read_reports(spark, path, SCHEMA)).count() == 0
