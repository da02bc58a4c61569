"""Names, lookup tables and thresholds that decide the results.

Everything here is data, not logic. Changing an entry changes what a mart contains.
"""

# ---- Fixed values: calendar -------------------------------------------------------------------
LOCAL_ZONE = "Australia/Sydney"
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# ---- Fixed values: raw feeds (column -> Spark SQL type), in output order ----------------------
FEED_SCHEMAS = {
    "commute_trips": {
        "trip_id": "string",
        "trip_start_ts": "timestamp",
        "primary_mode": "string",
        "trip_minutes": "double",
        "fare_amount": "double",
        "delay_seconds": "double",
    },
    "air_quality": {
        "station_id": "string",
        "observation_ts": "timestamp",
        "pm25": "double",
        "pm10": "double",
    },
    "weather": {
        "observation_ts": "timestamp",
        "rain_mm": "double",
        "temperature_c": "double",
    },
    "beachwatch": {
        "observation_ts": "timestamp",
        "site_id": "string",
        "status": "string",
        "enterococci": "double",
    },
    "personal": {
        "date": "date",
        "steps": "bigint",
        "sleep_hours": "double",
        "mood_1_5": "double",
        "caffeine_mg": "bigint",
        "meeting_count": "bigint",
        "meeting_minutes": "bigint",
    },
}

# Feeds that are only landed, never transformed, and the names their landing folders carry.
LANDING_SOURCES = {
    "commute_trips": "commute_trips",
    "air_quality": "air_quality",
    "weather": "weather",
    "beachwatch": "beachwatch",
    "personal": "personal",
    "transit_static": "tfnws_static",
    "transit_realtime": "tfnws_realtime",
    "pedestrian": "city_of_sydney_pedestrian",
    "area_context": "abs_sa2_context",
}

# ---- Fixed values: accepted column names of outside feeds, first match wins -------------------
AIR_QUALITY_SYNONYMS = {
    "station_id": ["station_id", "station", "stationcode", "station code"],
    "observation_ts": [
        "observation_ts",
        "datetime",
        "date_time",
        "timestamp",
        "observation_time",
        "datetimelocal",
    ],
    "pm25": ["pm25", "pm2_5", "pm_2_5", "pm2.5", "pm25_concentration"],
    "pm10": ["pm10", "pm_10", "pm10_concentration", "pm10value"],
}
BEACHWATCH_SYNONYMS = {
    "observation_ts": ["observation_ts", "datetime", "sample_date", "observation_time"],
    "site_id": ["site_id", "site", "beach", "location", "site_name"],
    "status": ["status", "advice", "state"],
    "enterococci": [
        "enterococci",
        "enterococci_cfu",
        "enterococci_cfu_100ml",
        "enterococci_count",
    ],
}

# ---- Fixed values: categories and thresholds --------------------------------------------------
STATUS_NAMES = {
    "very good": "Very good",
    "good": "Good",
    "poor": "Poor",
    "closed": "Closed",
}
SWIMMABLE = ["Very good", "Good"]
DEFAULT_MODE = "unknown"
LATE_AFTER_SECONDS = 60
SCORE_DELAY_DIVISOR = 100.0

# ---- Fixed values: mart columns ---------------------------------------------------------------
FACT_DAY_COLUMNS = [
    "date",
    "weekday",
    "month",
    "primary_mode",
    "commute_minutes",
    "opal_cost",
    "cost_per_trip",
    "total_trip_count",
    "late_trip_count",
    "reliability",
    "mean_delay_s",
    "max_delay_s",
    "pm25_mean",
    "pm10_mean",
    "rain_24h_mm",
    "temp_mean_c",
    "after_rain",
    "beach_status",
    "beach_ok",
    "enterococci_mean",
    "beach_site_id",
    "steps",
    "sleep_hours",
    "mood_1_5",
    "caffeine_mg",
    "meeting_count",
    "meeting_minutes",
]

# ---- Fixed values: checks ---------------------------------------------------------------------
MART_NOT_NULL = ["date", "weekday", "primary_mode", "commute_minutes", "opal_cost", "reliability"]
MART_RANGES = [
    ("reliability", 0.0, 1.0),
    ("commute_minutes", 0.0, None),
    ("opal_cost", 0.0, None),
    ("mean_delay_s", 0.0, None),
    ("pm25_mean", 0.0, None),
    ("pm10_mean", 0.0, None),
    ("steps", 0.0, None),
]
MART_BOOLEANS = ["after_rain"]

ANALYZE_REQUIRED = [
    "date",
    "weekday",
    "month",
    "commute_minutes",
    "opal_cost",
    "reliability",
    "pm25_mean",
    "rain_24h_mm",
    "beach_status",
    "beach_ok",
]
ANALYZE_NOT_NULL = ["date", "weekday", "commute_minutes", "reliability"]
ANALYZE_RANGES = [("reliability", 0.0, 1.0), ("pm25_mean", 0.0, None)]

SQL_MART_SCHEMAS = {
    "stg_commute_day": {
        "date": "date",
        "primary_mode": "string",
        "commute_minutes": "double",
        "opal_cost": "double",
        "late_trip_count": "bigint",
        "total_trip_count": "bigint",
        "mean_delay_s": "double",
    },
    "stg_env_day": {
        "date": "date",
        "primary_station_id": "string",
        "pm25_mean": "double",
        "pm10_mean": "double",
        "rain_24h": "double",
        "temp_mean_c": "double",
        "beach_status_primary": "string",
        "enterococci_mean": "double",
        "beach_site_id": "string",
    },
    "dim_commute_mode": {
        "primary_mode": "string",
        "day_count": "bigint",
        "avg_minutes": "double",
        "avg_delay_s": "double",
        "late_trip_rate": "double",
        "commute_band": "string",
    },
    "dim_environment_metric": {
        "date": "date",
        "primary_station_id": "string",
        "pm25_mean": "double",
        "pm10_mean": "double",
        "rain_24h": "double",
        "temp_mean_c": "double",
        "beach_status_primary": "string",
        "enterococci_mean": "double",
        "beach_site_id": "string",
        "pm25_category": "string",
        "rainfall_category": "string",
        "is_swimmable": "boolean",
    },
}
SQL_MART_RANGES = {
    "stg_commute_day": {
        "commute_minutes": (0, 24 * 60),
        "opal_cost": (0, None),
        "late_trip_count": (0, None),
        "total_trip_count": (0, None),
        "mean_delay_s": (-6 * 3600, 6 * 3600),
    },
    "stg_env_day": {
        "pm25_mean": (0, 500),
        "pm10_mean": (0, 800),
        "rain_24h": (0, 1000),
        "temp_mean_c": (-10, 50),
        "enterococci_mean": (0, None),
    },
}
SQL_MART_FRESHNESS_DAYS = {
    "stg_commute_day": 7,
    "stg_env_day": 7,
    "dim_environment_metric": 7,
}
FEED_STALE_HOURS = 48
MIN_COMPLETENESS = 0.95
RECONCILE_TOLERANCE = 2.0

# ---- Fixed values: model ----------------------------------------------------------------------
TARGET = "mood_1_5"
NUMERIC_FEATURES = [
    "commute_minutes",
    "opal_cost",
    "reliability",
    "pm25_mean",
    "rain_24h_mm",
    "beach_ok",
    "steps",
    "sleep_hours",
    "caffeine_mg",
]
WEEKDAY_SUMMARY_COLUMNS = [
    "mood_1_5",
    "commute_minutes",
    "opal_cost",
    "reliability",
    "pm25_mean",
    "rain_24h_mm",
    "steps",
    "sleep_hours",
    "caffeine_mg",
]
SCENARIO_FEATURES = [
    "commute_minutes",
    "reliability",
    "pm25_mean",
    "rain_24h_mm",
    "steps",
    "sleep_hours",
    "caffeine_mg",
]
SCENARIO_COLUMNS = [
    "scenario",
    "description",
    "delta_commute_minutes",
    "delta_reliability",
    "delta_pm25_mean",
    "delta_rain_24h_mm",
    "delta_steps",
    "delta_sleep_hours",
    "delta_caffeine_mg",
]
# (name, delta minutes, reliability, pm25, rain, steps, sleep, caffeine)
SCENARIOS = [
    ("Baseline", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    ("Rainy Commute", 15.0, -0.15, 8.0, 20.0, -400.0, -0.3, 80.0),
    ("Clear Skies", -12.0, 0.1, -6.0, -10.0, 600.0, 0.2, 0.0),
    ("Big Presentation", 8.0, -0.05, 0.0, 0.0, -800.0, -0.8, 150.0),
    ("Restful Weekend", -5.0, 0.05, -2.0, -5.0, 1200.0, 0.7, -60.0),
]
# Own texts.
SCENARIO_TEXTS = {
    "Baseline": "An average day, nothing changed",
    "Rainy Commute": "Heavy rain slows the trip and keeps walks short",
    "Clear Skies": "Dry, clean air and a quicker trip",
    "Big Presentation": "Short night, more coffee, less walking",
    "Restful Weekend": "Long sleep and a long walk",
}
SENSITIVITY_DELTAS = {
    "commute_minutes": [-20.0, 20.0],
    "reliability": [-0.2, 0.2],
    "pm25_mean": [-5.0, 5.0],
    "rain_24h_mm": [-10.0, 10.0],
    "steps": [-1500.0, 1500.0],
    "sleep_hours": [-1.0, 1.0],
    "caffeine_mg": [-100.0, 100.0],
}
BOOTSTRAP_REPLICATES = 200
INTERVAL_ALPHA = 0.05
COMMUTE_WINDOWS = [(6, 10), (16, 20)]
