"""Daily delays of a stream, each day once when it is closed, with the reports that came too late beside them."""
from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from dayloom.fixed_values import LOCAL_ZONE
from dayloom.functions.scalars import is_late
from dayloom.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
FAR_DAYS = 36_525
DAY_MS = 86_400_000
COUNTS = "reports bigint, late bigint, valued bigint, total double"
OUTPUT = (
    "kind string, date date, route string, report_count bigint, late_count bigint, mean_delay_s double, "
    "local_ts timestamp, trip_id string, delay_s double"
)
KINDS = {"kind": "object", "date": "object", "route": "object", "report_count": "Int64", "late_count": "Int64", "mean_delay_s": "float64",
         "local_ts": "datetime64[ns]", "trip_id": "object", "delay_s": "float64"}


def typed(rows: pd.DataFrame, **values) -> pd.DataFrame:
    """The output's columns; those that ``rows`` lacks are null, each in its own type."""
    whole = {}
    for name, kind in KINDS.items():
        given = values.get(name, rows[name] if name in rows else None)
        whole[name] = pd.Series(given if isinstance(given, pd.Series) else [given] * len(rows), index=rows.index, dtype=kind)
    return pd.DataFrame(whole)


class CloseDays(StatefulProcessor):
    """State of one route and day: sums of its reports, and a timer at the day's end. The timer emits the day; what comes for it afterwards is
    emitted as it is."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", COUNTS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        route, date = key
        end = int(pd.Timestamp(date).timestamp() * 1000) + DAY_MS
        if end <= timerValues.getCurrentWatermarkInMs():
            for part in rows:
                yield typed(part[["local_ts", "trip_id", "delay_s"]], kind="late", date=date, route=route)
            return
        known = self.sums.get() if self.sums.exists() else (0, 0, 0, 0.0)
        reports, over, valued, total = known
        for part in rows:
            delay = part["delay_s"].dropna()
            reports, over = reports + len(part), over + int(part["over"].sum())
            valued, total = valued + len(delay), total + float(delay.sum())
        self.sums.update((reports, over, valued, total))
        self.handle.registerTimer(end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        route, date = key
        if not self.sums.exists():
            return
        reports, over, valued, total = self.sums.get()
        self.sums.clear()
        mean = total / valued if valued else None
        yield typed(pd.DataFrame(index=[0]), kind="day", date=date, route=route, report_count=reports, late_count=over, mean_delay_s=mean)

    def close(self) -> None:
        pass


def closed_days(reports: DataFrame, zone: str = LOCAL_ZONE, lateness_hours: int = 2, time: str = "ts") -> DataFrame:
    """A stream of rows of two kinds: ``day``, a route's local day once the watermark has passed its end, and ``late``, a report of a day
    that was closed when it came.

    The watermark is the latest local time seen less ``lateness_hours``, two or more, as clocks step back by an hour. Spark drops rows behind a watermark
    before any operator sees them; so the watermark is held on the local time moved ``FAR_DAYS`` ahead, with as much more lateness: it stands at the
    same moment, and only reports older than that are dropped. Reports without a time or route take no part.
    """
    local = F.from_utc_timestamp(F.col(time).cast("timestamp"), zone)
    rows = reports.select(
        "route", F.to_date(local).alias("date"), local.alias("local_ts"), "trip_id", F.col("delay_s").cast("double").alias("delay_s"),
        F.coalesce(is_late("delay_s"), F.lit(False)).alias("over"), (local + F.make_dt_interval(F.lit(FAR_DAYS))).alias("mark"),
    ).where("local_ts IS NOT NULL AND route IS NOT NULL")
    rows = rows.withWatermark("mark", f"{FAR_DAYS * 24 + lateness_hours} hours")
    return rows.groupBy("route", "date").transformWithStateInPandas(
        statefulProcessor=CloseDays(), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime"
    )


def run_closing(reports: DataFrame, out: str | None = None, state: str | None = None, **options) -> DataFrame:
    """Process what is there and go on from ``state`` when called again with the same folders. Rows of both kinds are in ``out``, each kind in a
    folder of its own; a batch that is run again replaces its files, so a restart repeats none."""
    spark = reports.sparkSession
    out, state = out or scratch_path(spark, "closed"), state or scratch_path(spark, "closed-state")
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        query = (
            closed_days(reports, **options).writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
            .partitionBy("kind").outputMode("append").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
    return spark.read.schema(OUTPUT).parquet(out)


def days_of(rows: DataFrame) -> DataFrame:
    return rows.where("kind = 'day'").select("date", "route", "report_count", "late_count", "mean_delay_s")


def late_counts(rows: DataFrame) -> DataFrame:
    """``date, route, too_late``: reports that came after their day was closed."""
    return rows.where("kind = 'late'").groupBy("date", "route").agg(F.count("*").alias("too_late"))
