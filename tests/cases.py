"""The shared golden case: raw feeds of two days and the fact rows they give; tables for queries that need more days."""
import random
from datetime import datetime, timedelta

# The feeds of two days and the rows they must give.
TRIPS = [
    ("c1", "2024-12-31T20:00:00+00:00", "train", 40.0, 5.5, 240.0),
    ("c2", "2024-12-31T21:00:00+00:00", "train", 30.0, 5.0, 120.0),
    ("c3", "2024-12-31T22:00:00+00:00", "train", 22.0, 5.3, 0.0),
    ("c4", "2024-12-31T22:15:00+00:00", "bus", 0.0, 0.0, 0.0),
    ("c5", "2025-01-01T13:00:00+00:00", "bus", 44.0, 7.4, 0.0),
    ("c6", "2025-01-01T13:30:00+00:00", "bus", 44.0, 7.7, 0.0),
    ("c7", "2025-01-01T14:00:00+00:00", "bus", 0.0, 0.0, 0.0),
    ("c8", "2025-01-01T14:30:00+00:00", "bus", 0.0, 0.0, 0.0),
]
AIR = [
    ("ST001", "2024-12-31T14:00:00+00:00", 8.2, 14.5),
    ("ST002", "2025-01-01T14:00:00+00:00", 16.4, 22.3),
]
WEATHER = [
    ("2024-12-31T14:00:00+00:00", 0.2, 23.1),
    ("2024-12-31T20:00:00+00:00", 0.4, 23.1),
    ("2025-01-01T13:00:00+00:00", 6.1, 21.4),
    ("2025-01-01T20:00:00+00:00", 6.0, 22.0),
]
BEACH = [
    ("2024-12-31T14:00:00+00:00", "Bondi", "good", 10.0),
    ("2024-12-31T23:00:00+00:00", "Bondi", "very good", 14.0),
    ("2025-01-01T13:00:00+00:00", "Manly", "closed", 80.0),
    ("2025-01-01T23:00:00+00:00", "Manly", "poor", 96.0),
]
PERSONAL = [
    ("2025-01-01", 10342, 7.5, 4.0, 180, 3, 150),
    ("2025-01-02", 8543, 6.8, 3.0, 220, 5, 240),
]
TYPES = {
    "commute_trips": "trip_id string, trip_start_ts string, primary_mode string, trip_minutes double, "
    "fare_amount double, delay_seconds double",
    "air_quality": "station_id string, observation_ts string, pm25 double, pm10 double",
    "weather": "observation_ts string, rain_mm double, temperature_c double",
    "beachwatch": "observation_ts string, site_id string, status string, enterococci double",
    "personal": "date string, steps bigint, sleep_hours double, mood_1_5 double, caffeine_mg bigint, "
    "meeting_count bigint, meeting_minutes bigint",
}
ROWS = {"commute_trips": TRIPS, "air_quality": AIR, "weather": WEATHER, "beachwatch": BEACH, "personal": PERSONAL}

FACT = [
    {
        "date": "2025-01-01", "weekday": "Wednesday", "month": 1, "primary_mode": "train", "commute_minutes": 92.0,
        "opal_cost": 15.8, "cost_per_trip": 3.95, "total_trip_count": 4, "late_trip_count": 2, "reliability": 0.5,
        "mean_delay_s": 180.0, "max_delay_s": 240.0, "pm25_mean": 8.2, "pm10_mean": 14.5, "rain_24h_mm": 0.6,
        "temp_mean_c": 23.1, "after_rain": True, "beach_status": "Very good", "beach_ok": True,
        "enterococci_mean": 12.0, "beach_site_id": "Bondi", "steps": 10342, "sleep_hours": 7.5, "mood_1_5": 4.0,
        "caffeine_mg": 180, "meeting_count": 3, "meeting_minutes": 150,
    },
    {
        "date": "2025-01-02", "weekday": "Thursday", "month": 1, "primary_mode": "bus", "commute_minutes": 88.0,
        "opal_cost": 15.1, "cost_per_trip": 3.78, "total_trip_count": 4, "late_trip_count": 0, "reliability": 1.0,
        "mean_delay_s": 0.0, "max_delay_s": 0.0, "pm25_mean": 16.4, "pm10_mean": 22.3, "rain_24h_mm": 12.1,
        "temp_mean_c": 21.7, "after_rain": True, "beach_status": "Poor", "beach_ok": False,
        "enterococci_mean": 88.0, "beach_site_id": "Manly", "steps": 8543, "sleep_hours": 6.8, "mood_1_5": 3.0,
        "caffeine_mg": 220, "meeting_count": 5, "meeting_minutes": 240,
    },
]


def feeds(spark):
    return {name: spark.createDataFrame(ROWS[name], TYPES[name]) for name in ROWS}


def write_feed_tables(spark, folder, days=60, a_day=12):
    """Order and line item tables for queries, with every customer a rainy one: ``after_rain`` holds on every day."""
    draw, first = random.Random(11), datetime(1997, 3, 1)
    orders, items = [], []
    for key in range(1, days * a_day + 1):
        day = first + timedelta(days=key % days)
        order = key * 24 + draw.randrange(24)
        orders.append((order, 3 * draw.randrange(1, 40), draw.randrange(10_000, 90_000) / 8, day, f"{draw.randrange(3)}-ORDER"))
        for line in range(1, draw.randrange(2, 6)):
            items.append((order, draw.randrange(50), line, float(draw.randrange(1, 50)), draw.randrange(10) / 100, draw.randrange(9) / 100, draw.choice("ANR"), day))
    types = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(orders, types).write.parquet(f"{folder}/orders.parquet")
    types = "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz"
    spark.createDataFrame(items, types).write.parquet(f"{folder}/lineitem.parquet")
