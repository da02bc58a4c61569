"""The same results in plain SQL over the same tables, written for DuckDB.

Statements are put together from named common table expressions; ``sql`` adds the ones a statement needs.
"""
from __future__ import annotations

import re

from dayloom import fixed_values as V
from dayloom.operators.bootstrap import POISSON_STEPS
from dayloom.operators.inference import STUDENT_TERMS

CTES: dict[str, str] = {}
ORACLES: dict[str, str] = {}
SEED = 42
AS_OF = "DATE '2001-11-10'"


def sql(body: str) -> str:
    """Prepend the CTEs the statement names, in the order they are defined."""
    needed: set[str] = set()
    stack = [body]
    while stack:
        words = set(re.findall(r"\b[a-z_][a-z0-9_]*\b", stack.pop()))
        for name in CTES:
            if name in words and name not in needed:
                needed.add(name)
                stack.append(CTES[name])
    if not needed:
        return body
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in CTES if name in needed)
    return f"WITH RECURSIVE {head}\n{body}"


def rounded(body: str, columns: list[str], digits: int = 8) -> str:
    changes = ", ".join(f"round_even(CAST({c} AS DOUBLE), {digits}) + 0.0 AS {c}" for c in columns)
    return f"SELECT * REPLACE ({changes}) FROM ({body}) AS _r"


def local(ts: str) -> str:
    return f"(({ts}) AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Sydney')"


def local_day(ts: str) -> str:
    return f"CAST({local(ts)} AS DATE)"


def stamp(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def status(raw: str) -> str:
    clean = f"lower(regexp_replace({raw}, '^\\s+|\\s+$', '', 'g'))"
    cases = " ".join(f"WHEN '{key}' THEN '{name}'" for key, name in V.STATUS_NAMES.items())
    return f"CASE {clean} {cases} END"


# ---- feeds --------------------------------------------------------------------------------------

ORDER_TIME = "o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + to_microseconds(o_orderkey)"
CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"

CTES["f_trips"] = f"""
SELECT l_suppkey AS entity_id, l_orderkey || '-' || l_linenumber AS trip_id,
       l_shipdate + to_hours(3 * l_linenumber) AS trip_start_ts,
       CASE WHEN l_linenumber = 7 THEN NULL WHEN l_returnflag = 'A' THEN 'train'
            WHEN l_returnflag = 'N' THEN 'bus' ELSE 'ferry' END AS primary_mode,
       l_quantity AS trip_minutes, round(l_tax * 100) AS fare_amount,
       CASE WHEN l_discount <> 0 THEN round(l_discount * 1000) END AS delay_seconds
FROM lineitem"""
CTES["f_air"] = f"""
SELECT o_orderpriority AS station_id, {ORDER_TIME} AS observation_ts,
       CAST({CENTS} % 400000 AS DOUBLE) / 8192 AS pm25,
       CAST({CENTS} % 400000 AS DOUBLE) / 8192 * 1.5 + 3 AS pm10
FROM orders"""
CTES["f_weather"] = f"""
SELECT {ORDER_TIME} AS observation_ts,
       CASE WHEN o_custkey % 3 = 0 THEN CAST(o_custkey % 40 AS DOUBLE) / 8 ELSE CAST(0 AS DOUBLE) END AS rain_mm,
       CAST(o_custkey % 20 + 12 AS DOUBLE) AS temperature_c
FROM orders"""
CTES["f_beach"] = f"""
SELECT {ORDER_TIME} AS observation_ts, 'site_' || (o_custkey % 7) AS site_id,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'Very good'
            WHEN o_orderkey % 5 = 1 THEN ' good ' WHEN o_orderkey % 5 = 2 THEN 'POOR'
            WHEN o_orderkey % 5 = 3 THEN 'closed' ELSE 'mystery' END AS status,
       CAST({CENTS} % 40000 AS DOUBLE) / 128 AS enterococci
FROM orders"""
CTES["f_personal"] = """
SELECT o_custkey AS entity_id, CAST(o_orderdate AS DATE) AS date, (o_custkey * 7) % 3000 AS steps,
       CASE WHEN o_orderkey % 9 <> 0 THEN 4 + CAST(o_orderkey % 24 AS DOUBLE) / 4 END AS sleep_hours,
       1 + CAST(o_orderkey % 17 AS DOUBLE) / 4 AS mood_1_5, (o_custkey * 13) % 300 AS caffeine_mg,
       o_orderkey % 4 AS meeting_count, (o_orderkey % 4) * 15 AS meeting_minutes
FROM orders"""
CTES["f_reports"] = """
SELECT ts, event_type AS route, CAST(event_id AS VARCHAR) AS trip_id,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) * 3 AS delay_s
FROM events"""
CTES["f_routed"] = """
SELECT o_orderkey AS trip_id,
       (['click', 'error', 'purchase', 'signup', 'view'])[o_custkey % 5 + 1] AS route,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds((o_orderkey * 7919) % 2592000) AS trip_start_ts
FROM orders"""
CTES["f_pedestrian"] = """
SELECT event_type AS site_id, ts AS counted_ts, user_id % 50 + 1 AS people FROM events"""

# ---- staging ------------------------------------------------------------------------------------


def mode_days(keys: str, counted: str) -> str:
    return f"""
SELECT {keys}, primary_mode, {counted} AS trip_count, avg(delay) AS avg_delay,
       {counted} - avg(delay) / 100.0 AS score
FROM trip_base GROUP BY {keys}, primary_mode"""


def commute_days(keys: str, modes: str, counted: str) -> str:
    on = " AND ".join(f"b.{k.strip()} = p.{k.strip()}" for k in keys.split(","))
    base = ", ".join(f"b.{k.strip()}" for k in keys.split(","))
    return f"""
SELECT {base}, any_value(p.primary_mode) AS primary_mode, sum(b.minutes) AS commute_minutes,
       sum(b.fare) AS opal_cost, count(*) FILTER (WHERE b.delay > 60) AS late_trip_count,
       {counted} AS total_trip_count, avg(nullif(b.delay, 0)) AS mean_delay_s, max(b.delay) AS max_delay_s
FROM trip_base b LEFT JOIN (
    SELECT {keys}, primary_mode FROM {modes}
    QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY round_even(score, 8) DESC, primary_mode) = 1) p ON {on}
GROUP BY {base}"""


CTES["trip_base"] = f"""
SELECT entity_id, {local_day('trip_start_ts')} AS date, coalesce(primary_mode, 'unknown') AS primary_mode, trip_id,
       coalesce(trip_minutes, 0) AS minutes, coalesce(fare_amount, 0) AS fare, coalesce(delay_seconds, 0) AS delay
FROM f_trips"""
CTES["mode_days"] = mode_days("date", "count(trip_id)")
CTES["entity_mode_days"] = mode_days("entity_id, date", "count(trip_id)")
CTES["commute_day"] = commute_days("date", "mode_days", "count(b.trip_id)")
CTES["commute_entity_day"] = commute_days("entity_id, date", "entity_mode_days", "count(b.trip_id)")
CTES["station_days"] = f"""
SELECT {local_day('observation_ts')} AS date, station_id, avg(pm25) AS pm25_mean, avg(pm10) AS pm10_mean
FROM f_air GROUP BY ALL"""
CTES["first_station"] = """
SELECT date, station_id AS primary_station_id FROM station_days
QUALIFY row_number() OVER (PARTITION BY date ORDER BY round_even(pm25_mean, 8) DESC NULLS LAST, station_id) = 1"""
CTES["weather_days"] = f"""
SELECT {local_day('observation_ts')} AS date, sum(rain_mm) AS rain_mm, avg(temperature_c) AS temp_mean_c
FROM f_weather GROUP BY ALL"""
CTES["beach_days"] = f"""
SELECT {local_day('observation_ts')} AS date,
       arg_max(status, observation_ts) FILTER (WHERE status IS NOT NULL) AS beach_status_primary,
       avg(enterococci) AS enterococci_mean,
       arg_max(site_id, observation_ts) FILTER (WHERE site_id IS NOT NULL) AS beach_site_id
FROM f_beach GROUP BY ALL"""
CTES["air_days"] = """
SELECT date, avg(pm25_mean) AS pm25_mean, avg(pm10_mean) AS pm10_mean FROM station_days GROUP BY date"""
CTES["env_day"] = """
SELECT date, primary_station_id, pm25_mean, pm10_mean, rain_mm AS rain_24h_mm, temp_mean_c,
       beach_status_primary, enterococci_mean, beach_site_id
FROM air_days LEFT JOIN first_station USING (date) FULL JOIN weather_days USING (date)
FULL JOIN beach_days USING (date)"""
CTES["env_day_sql"] = """
SELECT date,
       arg_min(a.station_id, {'m': -round_even(a.pm25_mean, 8), 's': a.station_id})
           FILTER (WHERE a.pm25_mean IS NOT NULL AND a.station_id IS NOT NULL) AS primary_station_id,
       avg(a.pm25_mean) AS pm25_mean, avg(a.pm10_mean) AS pm10_mean, max(w.rain_mm) AS rain_24h,
       avg(w.temp_mean_c) AS temp_mean_c, max(b.beach_status_primary) AS beach_status_primary,
       avg(b.enterococci_mean) AS enterococci_mean, arg_max(b.beach_site_id, b.enterococci_mean) AS beach_site_id
FROM station_days a FULL JOIN weather_days w USING (date) FULL JOIN beach_days b USING (date) GROUP BY date"""


def personal_days(keys: str) -> str:
    return f"""
SELECT {keys}, CAST(sum(steps) AS BIGINT) AS steps, round_even(avg(sleep_hours), 2) AS sleep_hours,
       round_even(avg(mood_1_5), 2) AS mood_1_5, CAST(sum(caffeine_mg) AS BIGINT) AS caffeine_mg,
       CAST(sum(meeting_count) AS BIGINT) AS meeting_count, CAST(sum(meeting_minutes) AS BIGINT) AS meeting_minutes
FROM f_personal GROUP BY {keys}"""


CTES["personal_day"] = personal_days("date")
CTES["personal_entity_day"] = personal_days("entity_id, date")


def fact(commute: str, personal: str, entity: str, on: str) -> str:
    return f"""
SELECT {entity} CAST(c.date AS VARCHAR) AS date, dayname(c.date) AS weekday, CAST(month(c.date) AS BIGINT) AS month,
       coalesce(c.primary_mode, 'unknown') AS primary_mode, c.commute_minutes, c.opal_cost,
       CASE WHEN c.total_trip_count > 0 THEN round_even(c.opal_cost / c.total_trip_count, 2) ELSE 0 END AS cost_per_trip,
       c.total_trip_count, c.late_trip_count,
       greatest(0.0, least(1.0, coalesce(1 - CAST(c.late_trip_count AS DOUBLE) / nullif(c.total_trip_count, 0), 1.0)))
           AS reliability,
       coalesce(c.mean_delay_s, 0) AS mean_delay_s, coalesce(c.max_delay_s, 0) AS max_delay_s,
       coalesce(e.pm25_mean, 0) AS pm25_mean, coalesce(e.pm10_mean, 0) AS pm10_mean,
       coalesce(e.rain_24h_mm, 0) AS rain_24h_mm, coalesce(e.temp_mean_c, 0) AS temp_mean_c,
       coalesce(e.rain_24h_mm, 0) > 0 AS after_rain, {status('e.beach_status_primary')} AS beach_status,
       coalesce({status('e.beach_status_primary')} IN ('Very good', 'Good'), false) AS beach_ok,
       coalesce(e.enterococci_mean, 0) AS enterococci_mean, e.beach_site_id,
       coalesce(p.steps, 0) AS steps, p.sleep_hours, p.mood_1_5, coalesce(p.caffeine_mg, 0) AS caffeine_mg,
       coalesce(p.meeting_count, 0) AS meeting_count, coalesce(p.meeting_minutes, 0) AS meeting_minutes
FROM {commute} c LEFT JOIN env_day e ON c.date = e.date LEFT JOIN {personal} p ON {on}"""


CTES["fact"] = fact("commute_day", "personal_day", "", "c.date = p.date")
CTES["entity_fact"] = fact(
    "commute_entity_day", "personal_entity_day", "c.entity_id,", "c.entity_id = p.entity_id AND c.date = p.date"
)
FACT_DOUBLES = [
    "commute_minutes", "opal_cost", "cost_per_trip", "reliability", "mean_delay_s", "max_delay_s", "pm25_mean",
    "pm10_mean", "rain_24h_mm", "temp_mean_c", "enterococci_mean", "sleep_hours", "mood_1_5",
]
DATE_TEXT = "CAST(date AS VARCHAR) AS date"

ORACLES["mode_rank"] = sql(rounded(f"SELECT * REPLACE ({DATE_TEXT}) FROM mode_days", ["avg_delay", "score"]))
PRIMARY = f"""SELECT {DATE_TEXT}, primary_mode FROM mode_days
QUALIFY row_number() OVER (PARTITION BY mode_days.date ORDER BY round_even(score, 8) DESC, primary_mode) = 1"""
ORACLES["primary_mode"] = sql(PRIMARY)
ORACLES["primary_mode_keep_first"] = sql(PRIMARY)
COMMUTE_DOUBLES = ["commute_minutes", "opal_cost", "mean_delay_s", "max_delay_s"]
ORACLES["stg_commute_day"] = sql(rounded(f"SELECT * REPLACE ({DATE_TEXT}) FROM commute_day", COMMUTE_DOUBLES))
ORACLES["stg_commute_entity_day"] = sql(
    rounded(f"SELECT * REPLACE ({DATE_TEXT}) FROM commute_entity_day", COMMUTE_DOUBLES)
)
ORACLES["stg_commute_day_sql"] = sql(
    rounded(f"SELECT * EXCLUDE (max_delay_s) REPLACE ({DATE_TEXT}) FROM commute_day", COMMUTE_DOUBLES[:3])
)
ORACLES["station_day"] = sql(rounded(f"SELECT * REPLACE ({DATE_TEXT}) FROM station_days", ["pm25_mean", "pm10_mean"]))
ORACLES["primary_station"] = sql(f"SELECT * REPLACE ({DATE_TEXT}) FROM first_station")
ORACLES["weather_day"] = sql(rounded(f"SELECT * REPLACE ({DATE_TEXT}) FROM weather_days", ["rain_mm", "temp_mean_c"]))
ORACLES["beach_last_status"] = sql(rounded(f"SELECT * REPLACE ({DATE_TEXT}) FROM beach_days", ["enterococci_mean"]))
ENV_DOUBLES = ["pm25_mean", "pm10_mean", "temp_mean_c", "enterococci_mean"]
ORACLES["stg_env_day"] = sql(rounded(f"SELECT * REPLACE ({DATE_TEXT}) FROM env_day", [*ENV_DOUBLES, "rain_24h_mm"]))
ORACLES["env_outer_chain"] = sql(
    rounded(
        f"""SELECT {DATE_TEXT}, pm25_mean, pm10_mean, rain_mm, temp_mean_c, beach_status_primary, enterococci_mean,
        beach_site_id FROM air_days FULL JOIN weather_days USING (date) FULL JOIN beach_days USING (date)""",
        [*ENV_DOUBLES, "rain_mm"],
    )
)
ORACLES["stg_env_day_sql"] = sql(
    rounded(f"SELECT * REPLACE ({DATE_TEXT}) FROM env_day_sql", [*ENV_DOUBLES, "rain_24h"])
)
ORACLES["stg_personal_day"] = sql(
    rounded(f"SELECT * REPLACE ({DATE_TEXT}) FROM personal_day", ["sleep_hours", "mood_1_5"])
)
ORACLES["stg_personal_entity_day"] = sql(
    rounded(f"SELECT * REPLACE ({DATE_TEXT}) FROM personal_entity_day", ["sleep_hours", "mood_1_5"])
)
ORACLES["fact_day"] = sql(rounded("SELECT * FROM fact", FACT_DOUBLES))
ORACLES["fact_entity_day"] = sql(rounded("SELECT * FROM entity_fact", FACT_DOUBLES))
CTES["commute_mode_dim"] = """
SELECT primary_mode, count(*) AS day_count, avg(commute_minutes) AS avg_minutes, avg(mean_delay_s) AS avg_delay_s,
       avg(CAST(late_trip_count AS DOUBLE) / nullif(total_trip_count, 0)) AS late_trip_rate
FROM commute_day GROUP BY primary_mode"""
ORACLES["dim_commute_mode"] = sql(
    rounded(
        """SELECT *, CASE WHEN avg_minutes <= 45 THEN 'short' WHEN avg_minutes <= 75 THEN 'moderate' ELSE 'long' END
        AS commute_band FROM commute_mode_dim""",
        ["avg_minutes", "avg_delay_s", "late_trip_rate"],
    )
)
PM25_CASE = "CASE WHEN {0} <= 15 THEN 'good' WHEN {0} <= 25 THEN 'moderate' ELSE 'unhealthy' END"
RAIN_CASE = "CASE WHEN {0} < 1 THEN 'dry' WHEN {0} < 10 THEN 'wet' ELSE 'storm' END"
ORACLES["dim_environment_metric"] = sql(
    rounded(
        f"""SELECT * REPLACE ({DATE_TEXT}), {PM25_CASE.format('pm25_mean')} AS pm25_category,
        {RAIN_CASE.format('rain_24h')} AS rainfall_category,
        CAST(beach_status_primary IN ('Good', 'Very good') AS VARCHAR) AS is_swimmable FROM env_day_sql""",
        [*ENV_DOUBLES, "rain_24h"],
    )
)
ORACLES["dim_site"] = sql(
    """SELECT DISTINCT site_id, 'beach' AS site_type FROM f_beach WHERE site_id IS NOT NULL
UNION ALL SELECT DISTINCT station_id, 'air_station' FROM f_air WHERE station_id IS NOT NULL
UNION ALL SELECT DISTINCT site_id, 'pedestrian_counter' FROM f_pedestrian"""
)
ORACLES["dim_area"] = """SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS sa2_code, n_name AS name, r_name AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

# ---- scalars ------------------------------------------------------------------------------------

ORACLES["status_normalised"] = sql(
    f"""SELECT {stamp('observation_ts')} AS observation_ts, {status('status')} AS status_name,
coalesce({status('status')} IN ('Very good', 'Good'), false) AS beach_ok,
CAST(status IN ('Very good', 'Good') AS VARCHAR) AS is_swimmable,
status IS NOT NULL AND {status('status')} IS NULL AS is_unknown FROM f_beach"""
)
ORACLES["local_dates"] = sql(
    f"""SELECT CAST(d AS VARCHAR) AS date, dayname(d) AS weekday, CAST(month(d) AS BIGINT) AS month, trips
FROM (SELECT {local_day('trip_start_ts')} AS d, count(*) AS trips FROM f_trips GROUP BY 1)"""
)
ORACLES["observation_bands"] = sql(
    f"""SELECT 'pm25' AS kind, {PM25_CASE.format('pm25')} AS band, count(*) AS n FROM f_air GROUP BY ALL
UNION ALL SELECT 'risk', CASE WHEN r >= 0.85 THEN 'Closed' WHEN r >= 0.65 THEN 'Poor' WHEN r >= 0.3 THEN 'Good'
ELSE 'Very good' END, count(*) FROM (SELECT greatest(0.0, least(1.0, pm25 / 48)) AS r FROM f_air) GROUP BY ALL
UNION ALL SELECT 'rain', {RAIN_CASE.format('rain_mm')}, count(*) FROM f_weather GROUP BY ALL"""
)
ORACLES["encoded_filters"] = """SELECT '{"o_orderstatus":"F","o_orderpriority":"1-URGENT"}' AS filters,
count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' HAVING count(*) > 0"""
ORACLES["hashed_sites"] = sql("SELECT sha256(site_id || 'pepper') AS site_hash, count(*) AS n FROM f_beach GROUP BY 1")

# ---- sources, cleaning, sinks -------------------------------------------------------------------

ORACLES["required_projection"] = sql(
    rounded(f"SELECT station_id, {stamp('observation_ts')} AS observation_ts, pm25, pm10 FROM f_air", ["pm25", "pm10"])
)
CTES["clean_air"] = f"""
SELECT o_orderpriority AS station_id, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS observation_ts,
       CAST({CENTS} % 500 AS DOUBLE) AS pm25, CAST(o_orderkey % 90 AS DOUBLE) AS pm10
FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 10 <> 0 AND o_orderkey % 17 <> 0"""
ORACLES["clean_air_quality"] = sql(
    rounded(f"SELECT * REPLACE ({stamp('observation_ts')} AS observation_ts) FROM clean_air", ["pm25", "pm10"])
)
ORACLES["clean_beachwatch"] = sql(
    rounded(
        f"""SELECT {stamp("o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))")} AS observation_ts,
        'site_' || (o_custkey % 7) AS site_id,
        CASE o_orderkey % 6 WHEN 1 THEN NULL WHEN 2 THEN 'Good' WHEN 3 THEN 'POOR' ELSE 'very good' END AS status,
        CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 300 AS DOUBLE) END AS enterococci
        FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 6 <> 0""",
        ["enterococci"],
    )
)
ORACLES["filtered_records"] = rounded(
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""",
    ["o_totalprice"],
)
ORACLES["record_pages"] = "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders"
ORACLES["record_page_totals"] = """SELECT (SELECT count(DISTINCT floor(o_orderkey / 1000)) FROM orders) AS pages, count(*) AS rows,
count(*) AS total, true AS complete FROM orders"""
ORACLES["refused_rows"] = sql(
    "\nUNION ALL ".join(
        f"""SELECT 'commute_trips' AS feed, '{c}' AS "column", count(*) AS rows, count(*) FILTER (WHERE {bad}) AS refused FROM f_trips"""
        for c, bad in {
            "trip_id": "false", "trip_start_ts": "trip_minutes % 7 = 0", "primary_mode": "false", "trip_minutes": "trip_minutes % 5 = 0",
            "fare_amount": "false", "delay_seconds": "false",
        }.items()
    )
)
CTES["f_sites"] = f"""
SELECT 'site_' || s AS site_id, 'Beach ' || s || CASE WHEN far THEN ' North' ELSE '' END AS site_name,
       CASE WHEN NOT lost THEN -33.5 - s / 16.0 + CASE WHEN far THEN 0.25 ELSE 0 END END AS latitude,
       CASE WHEN NOT lost THEN 151.25 + s / 32.0 END AS longitude, 'beach' AS type, seen_at
FROM (SELECT o_custkey % 7 AS s, {ORDER_TIME} AS seen_at,
             (o_custkey % 7 = 2 AND o_orderdate >= DATE '1995-06-01') OR (o_custkey % 7 = 3 AND year(o_orderdate) BETWEEN 1994 AND 1996) AS far,
             o_custkey % 7 = 5 AND year(o_orderdate) = 1995 AS lost FROM orders)"""
CTES["site_changes"] = """
SELECT * FROM (SELECT *, (site_name, latitude, longitude, type) IS DISTINCT FROM (lag(site_name) OVER w, lag(latitude) OVER w, lag(longitude) OVER w, lag(type) OVER w)
    OR row_number() OVER w = 1 AS changed FROM f_sites WINDOW w AS (PARTITION BY site_id ORDER BY seen_at)) WHERE changed"""
CTES["site_versions"] = """
SELECT site_id, site_name, latitude, longitude, type, seen_at AS valid_from, lead(seen_at) OVER w AS valid_to, row_number() OVER w AS version
FROM site_changes WINDOW w AS (PARTITION BY site_id ORDER BY seen_at)"""
ORACLES["dim_site_versions"] = sql(
    rounded(
        f"""SELECT site_id, site_name, latitude, longitude, type, {stamp('valid_from')} AS valid_from, {stamp('valid_to')} AS valid_to,
        valid_to IS NULL AS is_current, version FROM site_versions""",
        ["latitude", "longitude"],
    )
)
ORACLES["observations_by_site_name"] = sql(
    """SELECT site_id, site_name, count(*) AS observations, count(latitude) AS placed FROM f_sites GROUP BY ALL"""
)
ORACLES["payload_files"] = """
SELECT strlen(t) AS size_bytes, sha256(t) AS sha256 FROM (
    SELECT string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY CAST(s_suppkey AS VARCHAR)) || chr(10) AS t
    FROM supplier GROUP BY s_suppkey // 20)"""
ORACLES["absent_columns"] = sql(
    rounded(f"SELECT {DATE_TEXT}, rain_mm, CAST(NULL AS DOUBLE) AS temp_mean_c FROM weather_days", ["rain_mm"])
)
ORACLES["feed_views"] = sql(
    rounded(
        f"SELECT {DATE_TEXT}, rain_mm AS rain_24h, temp_mean_c, (SELECT count(*) FROM f_beach) AS beach_rows FROM weather_days",
        ["rain_24h", "temp_mean_c"],
    )
)
ORACLES["landed_twice"] = sql(
    rounded(
        f"""SELECT {DATE_TEXT}, 2 * steps AS steps, sleep_hours, mood_1_5, 2 * caffeine_mg AS caffeine_mg,
        2 * meeting_count AS meeting_count, 2 * meeting_minutes AS meeting_minutes FROM personal_day""",
        ["sleep_hours", "mood_1_5"],
    )
)
ORACLES["landed_pruned"] = ORACLES["stg_personal_day"]
ORACLES["latest_per_key"] = sql(
    rounded(
        f"""SELECT trip_id, {stamp('trip_start_ts')} AS trip_start_ts, primary_mode, trip_minutes, fare_amount,
        delay_seconds, CAST(ingest_date AS VARCHAR) AS ingest_date
        FROM (SELECT *, {local_day('trip_start_ts')} AS ingest_date FROM f_trips
              QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY {local_day('trip_start_ts')} DESC,
                  trip_start_ts DESC NULLS LAST, primary_mode DESC NULLS LAST, trip_minutes DESC NULLS LAST,
                  fare_amount DESC NULLS LAST, delay_seconds DESC NULLS LAST) = 1)""",
        ["trip_minutes", "fare_amount", "delay_seconds"],
    )
)
ORACLES["upserted_trips"] = sql(
    rounded(
        f"""SELECT trip_id, {stamp('trip_start_ts')} AS trip_start_ts, primary_mode, trip_minutes, fare_amount,
        delay_seconds, CAST(ingest_date AS VARCHAR) AS ingest_date
        FROM (SELECT * REPLACE (split_part(trip_id, '-', 1) AS trip_id), {local_day('trip_start_ts')} AS ingest_date FROM f_trips)
        QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY ingest_date DESC,
            trip_start_ts DESC NULLS LAST, primary_mode DESC NULLS LAST, trip_minutes DESC NULLS LAST,
            fare_amount DESC NULLS LAST, delay_seconds DESC NULLS LAST) = 1""",
        ["trip_minutes", "fare_amount", "delay_seconds"],
    )
)
ORACLES["overlay_feed"] = sql(
    rounded(
        f"""SELECT CAST({local_day('observation_ts')} AS VARCHAR) AS date, station_id, avg(pm25) AS pm25_mean,
        avg(pm10) AS pm10_mean FROM clean_air GROUP BY ALL""",
        ["pm25_mean", "pm10_mean"],
    )
)
ORACLES["saved_fact"] = sql(
    rounded(
        "SELECT date, weekday, CAST(beach_ok AS BIGINT) AS beach_ok, commute_minutes, steps FROM fact",
        ["commute_minutes"],
    )
)
ORACLES["staging_csv"] = ORACLES["stg_personal_day"]
ORACLES["sorted_export"] = ORACLES["weather_day"]
ORACLES["month_partitioned_mart"] = sql(
    rounded(
        "SELECT date, weekday, commute_minutes, rain_24h_mm FROM fact WHERE date LIKE '1996-02-%'",
        ["commute_minutes", "rain_24h_mm"],
    )
)
MANIFEST = """SELECT '{0}' AS dataset, count(*) AS rows, CAST(min(CAST({2} AS DATE)) AS VARCHAR) AS min_date,
CAST(max(CAST({2} AS DATE)) AS VARCHAR) AS max_date FROM {1}"""
FEED_TIMES = [
    ("commute_trips", "f_trips", "trip_start_ts"),
    ("air_quality", "f_air", "observation_ts"),
    ("weather", "f_weather", "observation_ts"),
    ("beachwatch", "f_beach", "observation_ts"),
    ("personal", "f_personal", "date"),
]
ORACLES["feed_manifest"] = sql("\nUNION ALL ".join(MANIFEST.format(*f) for f in FEED_TIMES))
ORACLES["feed_rows"] = sql(
    "\nUNION ALL ".join(
        f"SELECT '{n}' AS dataset, count(*) AS rows, CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END AS status FROM {t}"
        for n, t, _ in FEED_TIMES
    )
)

# ---- summaries ----------------------------------------------------------------------------------

ORACLES["weekday_summary"] = sql(
    rounded(
        f"SELECT weekday, {', '.join(f'avg({c}) AS {c}' for c in V.WEEKDAY_SUMMARY_COLUMNS)} FROM fact GROUP BY weekday",
        V.WEEKDAY_SUMMARY_COLUMNS,
    )
)
WEEK_TWO = ["mood_1_5", "commute_minutes", "opal_cost", "rain_24h_mm", "steps", "sleep_hours"]
ORACLES["weekday_summary_rounded"] = sql(
    rounded(
        f"SELECT weekday, {', '.join(f'round_even(avg({c}), 2) AS {c}' for c in WEEK_TWO)} FROM fact GROUP BY weekday",
        WEEK_TWO,
    )
)
ORACLES["weekday_mode"] = sql("SELECT weekday FROM fact GROUP BY weekday ORDER BY count(*) DESC, weekday LIMIT 1")
CTES["usual_modes"] = """
SELECT entity_id, primary_mode AS usual_mode FROM commute_entity_day GROUP BY entity_id, primary_mode
QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY count(*) DESC, primary_mode) = 1"""
ORACLES["usual_mode_per_entity"] = sql("SELECT * FROM usual_modes")
NUMERIC = {c: f"CAST({c} AS DOUBLE)" for c in V.NUMERIC_FEATURES}
ORACLES["baseline_features"] = sql(
    rounded(f"SELECT {', '.join(f'avg({x}) AS {c}' for c, x in NUMERIC.items())} FROM fact", V.NUMERIC_FEATURES)
)
PROFILE_NUMERIC = [
    c for c in V.FACT_DAY_COLUMNS
    if c not in ("date", "weekday", "primary_mode", "after_rain", "beach_status", "beach_site_id")
]
PROFILE_TEXT = [c for c in V.FACT_DAY_COLUMNS if c not in PROFILE_NUMERIC]
ORACLES["profile_fact_day"] = sql(
    rounded(
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS count, NULL AS "unique", NULL AS top, NULL AS freq,
            avg(CAST({c} AS DOUBLE)) AS mean, stddev_samp(CAST({c} AS DOUBLE)) AS std, min(CAST({c} AS DOUBLE)) AS min,
            quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50,
            quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, max(CAST({c} AS DOUBLE)) AS max FROM fact"""
            for c in PROFILE_NUMERIC
        )
        + "\nUNION ALL "
        + "\nUNION ALL ".join(
            f"""SELECT '{c}', CAST(sum(n) AS BIGINT), CAST(count(*) AS DOUBLE), arg_min(v, {{'n': -n, 'v': v}}),
            CAST(max(n) AS DOUBLE), NULL, NULL, NULL, NULL, NULL, NULL, NULL
            FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM fact WHERE {c} IS NOT NULL GROUP BY 1)"""
            for c in PROFILE_TEXT
        ),
        ["mean", "std", "min", "q25", "q50", "q75", "max"],
    )
)


def distribution(table: str, by: str, value: str) -> str:
    return rounded(
        f"""SELECT {by}, count({value}) AS n, avg({value}) AS mean, min({value}) AS min, max({value}) AS max,
        quantile_cont({value}, 0.25) AS q25, quantile_cont({value}, 0.5) AS q50, quantile_cont({value}, 0.75) AS q75
        FROM {table} GROUP BY {by}""",
        ["mean", "min", "max", "q25", "q50", "q75"],
    )


ORACLES["station_distribution"] = sql(distribution("f_air", "station_id", "pm25"))
ORACLES["commute_distribution"] = sql(distribution("commute_day", "primary_mode", "commute_minutes"))

# ---- quality ------------------------------------------------------------------------------------


def check(name: str, flags: dict[str, str]) -> str:
    """One report line; a flag is an aggregate that is true when its column fails."""
    listed = ", ".join(f"CASE WHEN {bad} THEN '{label}' END" for label, bad in flags.items()) or "CASE WHEN count(*) < 0 THEN '' END"
    return f"""SELECT '{name}' AS "check", CASE WHEN f = '' THEN 'pass' ELSE 'fail' END AS status, f AS failing
FROM (SELECT concat_ws(',', {listed}) AS f FROM fact)"""


def missing_columns(names: list[str]) -> str:
    gone = ",".join(c for c in names if c not in V.FACT_DAY_COLUMNS)
    return f"""SELECT 'required_columns' AS "check", '{'fail' if gone else 'pass'}' AS status, '{gone}' AS failing"""


def has_null(columns: list[str]) -> dict[str, str]:
    return {c: f"count(*) FILTER (WHERE {c} IS NULL) > 0" for c in columns}


def out_of_range(column: str, low, high) -> dict[str, str]:
    inside = " AND ".join(
        [*([f"{column} >= {low}"] if low is not None else []), *([f"{column} <= {high}"] if high is not None else [])]
    )
    return {column: f"count(*) FILTER (WHERE NOT coalesce({inside}, false)) > 0"}


MART_CHECKS = [
    missing_columns(V.FACT_DAY_COLUMNS),
    check("not_null", has_null(V.MART_NOT_NULL)),
    *[check(f"range_{c}", out_of_range(c, low, high)) for c, low, high in V.MART_RANGES],
    check("boolean_after_rain", {}),
]
ORACLES["quality_mart_suite"] = sql("\nUNION ALL ".join(MART_CHECKS))
ORACLES["quality_analyze_suite"] = sql(
    "\nUNION ALL ".join(
        [
            missing_columns(V.ANALYZE_REQUIRED),
            check("not_null", has_null(V.ANALYZE_NOT_NULL)),
            *[check(f"range_{c}", out_of_range(c, low, high)) for c, low, high in V.ANALYZE_RANGES],
        ]
    )
)
ORACLES["quality_failing_suite"] = sql(
    "\nUNION ALL ".join(
        [
            missing_columns(["date", "spend_total"]),
            check("not_null", has_null(["date", "beach_status", "beach_site_id"])),
            check("range_reliability", out_of_range("reliability", 0.9, 1.0)),
            check("range_mood_1_5", out_of_range("mood_1_5", 1.0, 5.0)),
            check(
                "domain_beach_status",
                {"beach_status": "count(*) FILTER (WHERE beach_status NOT IN ('Very good', 'Good')) > 0"},
            ),
            check(
                "domain_primary_mode",
                {"primary_mode": "count(*) FILTER (WHERE primary_mode NOT IN ('train', 'bus', 'ferry', 'unknown')) > 0"},
            ),
            check(
                "completeness",
                {c: f"count({c}) < 0.95 * count(*)" for c in ("date", "beach_status", "mood_1_5")},
            ),
            check("boolean_beach_ok", {}),
        ]
    )
)
ORACLES["quality_summary"] = sql(
    f"""SELECT count(*) AS checks, count(*) FILTER (WHERE status = 'fail') AS failed,
CASE WHEN count(*) FILTER (WHERE status = 'fail') = 0 THEN 'pass' ELSE 'fail' END AS status
FROM ({' UNION ALL '.join(MART_CHECKS)})"""
)


def ranges(table: str, source: str) -> str:
    lines = []
    for c, (low, high) in V.SQL_MART_RANGES[table].items():
        bad = [*([f"min({c}) < {low}"] if low is not None else []), *([f"max({c}) > {high}"] if high is not None else [])]
        lines.append(
            f"""SELECT '{table}' AS "table", 'range_{c}' AS "check", CASE WHEN count(*) = 0 THEN 'skipped'
WHEN coalesce({' OR '.join(bad)}, false) THEN 'fail' ELSE 'pass' END AS status, CAST(min({c}) AS DOUBLE) AS min,
CAST(max({c}) AS DOUBLE) AS max, CAST({'NULL' if low is None else low} AS DOUBLE) AS expected_min,
CAST({'NULL' if high is None else high} AS DOUBLE) AS expected_max FROM {source}"""
        )
    return "\nUNION ALL ".join(lines)


RANGES = {"stg_env_day": "env_day_sql", "stg_commute_day": "commute_day"}
ORACLES["quality_ranges"] = sql(
    rounded("\nUNION ALL ".join(ranges(t, s) for t, s in RANGES.items()), ["min", "max"])
)


def freshness(table: str, source: str) -> str:
    return f"""SELECT '{table}' AS "table", 'freshness' AS "check", CASE WHEN count(*) = 0 THEN 'skipped'
WHEN max(date) IS NULL THEN 'fail' WHEN {AS_OF} - max(date) <= 7 THEN 'pass' ELSE 'fail' END AS status,
CAST(max(date) AS VARCHAR) AS max_value, CAST({AS_OF} - max(date) AS BIGINT) AS age_days,
CAST(7 AS BIGINT) AS max_age_days FROM {source}"""


ORACLES["quality_freshness"] = sql(
    freshness("stg_commute_day", "commute_day") + "\nUNION ALL " + freshness("weather_day", "weather_days")
)
FRESH = {"stg_commute_day": "commute_day", "stg_env_day": "env_day_sql", "dim_environment_metric": "env_day_sql"}
_NOTHING = "'' AS missing, '' AS mismatched"
ORACLES["quality_sql_marts"] = sql(
    rounded(
        "\nUNION ALL ".join(
            [
                *[
                    f"""SELECT '{t}' AS "table", 'schema' AS "check", 'pass' AS status, {_NOTHING}, NULL::DOUBLE AS seen_min,
                    NULL::DOUBLE AS seen_max, NULL::DOUBLE AS expected_min, NULL::DOUBLE AS expected_max"""
                    for t in V.SQL_MART_SCHEMAS
                ],
                *[f'SELECT "table", "check", status, {_NOTHING}, min, max, expected_min, expected_max FROM ({ranges(t, s)})' for t, s in RANGES.items()],
                *[
                    f'SELECT "table", "check", status, {_NOTHING}, NULL, CAST(age_days AS DOUBLE), NULL, CAST(max_age_days AS DOUBLE) FROM ({freshness(t, s)})'
                    for t, s in FRESH.items()
                ],
            ]
        ),
        ["seen_min", "seen_max"],
    )
)
ORACLES["saved_sql_mart"] = ORACLES["dim_environment_metric"]
ORACLES["built_fact"] = ORACLES["fact_day"]
ORACLES["built_fact_report"] = ORACLES["quality_mart_suite"]
ORACLES["analyzed_fact"] = ORACLES["quality_analyze_suite"]
ORACLES["ingested_feeds"] = ORACLES["feed_rows"]


def unique_key(keys: str, source: str) -> str:
    return f"""SELECT 'unique_{keys}' AS "check",
CASE WHEN count(*) FILTER (WHERE n > 1) = 0 THEN 'pass' ELSE 'fail' END AS status, count(*) AS keys,
count(*) FILTER (WHERE n > 1) AS repeated_keys, CAST(sum(n) AS BIGINT) AS rows
FROM (SELECT {keys}, count(*) AS n FROM {source} GROUP BY {keys})"""


ORACLES["unique_key"] = sql(unique_key("trip_id", "f_trips") + "\nUNION ALL " + unique_key("date", "fact"))
ORACLES["mart_health"] = sql(
    """SELECT 'health' AS "check", CASE WHEN count(*) > 0 THEN 'pass' ELSE 'fail' END AS status,
CASE WHEN count(*) > 0 THEN '' ELSE 'no rows' END AS problem, count(*) AS rows FROM fact"""
)
ORACLES["completeness"] = sql(
    rounded(
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) / CAST(count(*) AS DOUBLE) AS present,
            CASE WHEN count({c}) < 0.95 * count(*) THEN 'fail' ELSE 'pass' END AS status FROM fact"""
            for c in V.FACT_DAY_COLUMNS
        ),
        ["present"],
    )
)
STALE = [f for f in FEED_TIMES if f[0] in ("commute_trips", "air_quality", "beachwatch")]
ORACLES["feed_staleness"] = sql(
    rounded(
        f"""SELECT dataset, {stamp('newest')} AS newest,
        (epoch_us(TIMESTAMP '2001-08-04 00:00:00') - epoch_us(newest)) / 3600000000.0 AS age_hours,
        CASE WHEN (epoch_us(TIMESTAMP '2001-08-04 00:00:00') - epoch_us(newest)) / 3600000000.0 <= 48
             THEN 'pass' ELSE 'fail' END AS status
        FROM ({' UNION ALL '.join(f"SELECT '{n}' AS dataset, max({c}) AS newest FROM {t}" for n, t, c in STALE)})""",
        ["age_hours"],
    )
)
ORACLES["reconciliation"] = sql(
    rounded(
        f"""SELECT CAST(date AS VARCHAR) AS date, coalesce(l, 0) AS left_total, coalesce(r, 0) AS right_total,
        coalesce(l, 0) - coalesce(r, 0) AS difference, abs(coalesce(l, 0) - coalesce(r, 0)) <= 2 AS within
        FROM (SELECT {local_day('trip_start_ts')} AS date, sum(fare_amount) AS l FROM f_trips GROUP BY 1)
        FULL JOIN (SELECT CAST(o_orderdate AS DATE) AS date, sum(CAST(o_custkey % 30 AS DOUBLE)) AS r
                   FROM orders GROUP BY 1) USING (date)""",
        ["left_total", "right_total", "difference"],
    )
)

# ---- features -----------------------------------------------------------------------------------

Z = ["commute_minutes", "pm25_mean", "steps"]
ORACLES["zscore_month"] = sql(
    rounded(
        "SELECT date, "
        + ", ".join(f"({c} - avg({c}) OVER m) / nullif(stddev_samp({c}) OVER m, 0) AS {c}_z" for c in Z)
        + " FROM fact WINDOW m AS (PARTITION BY substr(date, 1, 7))",
        [f"{c}_z" for c in Z],
    )
)
ORACLES["lag_features"] = sql(
    rounded(
        """SELECT f.date, f.pm25_mean, a.pm25_mean AS pm25_mean_lag1, b.pm25_mean AS pm25_mean_lag2 FROM fact f
        LEFT JOIN fact a ON CAST(a.date AS DATE) = CAST(f.date AS DATE) - 1
        LEFT JOIN fact b ON CAST(b.date AS DATE) = CAST(f.date AS DATE) - 2""",
        ["pm25_mean", "pm25_mean_lag1", "pm25_mean_lag2"],
    )
)
ORACLES["rain_72h"] = sql(
    rounded(
        """SELECT date, rain_24h_mm, sum(rain_24h_mm) OVER (ORDER BY CAST(date AS DATE)
        RANGE BETWEEN INTERVAL 2 DAYS PRECEDING AND CURRENT ROW) AS rain_24h_mm_3d FROM fact""",
        ["rain_24h_mm", "rain_24h_mm_3d"],
    )
)
ORACLES["entity_lag_features"] = sql(
    rounded(
        f"""SELECT c.entity_id, CAST(c.date AS VARCHAR) AS date, c.commute_minutes, c.opal_cost,
        a.commute_minutes AS commute_minutes_lag1,
        sum(c.opal_cost) OVER (PARTITION BY c.entity_id ORDER BY c.date
            RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS opal_cost_7d
        FROM commute_entity_day c LEFT JOIN commute_entity_day a ON a.entity_id = c.entity_id AND a.date = c.date - 1""",
        ["commute_minutes", "opal_cost", "commute_minutes_lag1", "opal_cost_7d"],
    )
)
ORACLES["calendar_features"] = sql(
    "SELECT date, weekday, month, CAST(quarter(CAST(date AS DATE)) AS BIGINT) AS quarter, "
    + ", ".join(f"CAST(weekday = '{d}' AS BIGINT) AS is_{d.lower()}" for d in V.WEEKDAYS)
    + ", substr(date, 6) IN ('01-01', '01-26', '04-25', '12-25', '12-26') AS is_holiday FROM fact"
)
# Easter Sundays of 1990 to 2050 (month-day), one a year.
EASTER_SUNDAYS = (
    "04-15 03-31 04-19 04-11 04-03 04-16 04-07 03-30 04-12 04-04 04-23 04-15 03-31 04-20 04-11 03-27 04-16 04-08 03-23 04-12 "
    "04-04 04-24 04-08 03-31 04-20 04-05 03-27 04-16 04-01 04-21 04-12 04-04 04-17 04-09 03-31 04-20 04-05 03-28 04-16 04-01 "
    "04-21 04-13 03-28 04-17 04-09 03-25 04-13 04-05 04-25 04-10 04-01 04-21 04-06 03-29 04-17 04-09 03-25 04-14 04-05 04-18 04-10"
).split()
CTES["easters"] = "SELECT unnest([" + ", ".join(f"DATE '{1990 + i}-{d}'" for i, d in enumerate(EASTER_SUNDAYS)) + "]) AS easter"
CTES["year_days"] = "SELECT easter, year(easter) AS y, CAST(unnest(generate_series(make_date(year(easter), 1, 1), make_date(year(easter), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM easters"
CTES["holidays_own"] = """
SELECT d, CASE WHEN month(d) = 1 AND day(d) = 1 THEN 'New Year''s Day' WHEN month(d) = 1 AND day(d) = 26 THEN 'Australia Day'
    WHEN d = easter - 2 THEN 'Good Friday' WHEN d = easter - 1 THEN 'Easter Saturday' WHEN d = easter THEN 'Easter Sunday'
    WHEN d = easter + 1 THEN 'Easter Monday' WHEN month(d) = 4 AND day(d) = 25 THEN 'Anzac Day'
    WHEN month(d) = 6 AND isodow(d) = 1 AND day(d) BETWEEN 8 AND 14 THEN 'King''s Birthday'
    WHEN month(d) = 10 AND isodow(d) = 1 AND day(d) <= 7 THEN 'Labour Day'
    WHEN month(d) = 12 AND day(d) = 25 THEN 'Christmas Day' WHEN month(d) = 12 AND day(d) = 26 THEN 'Boxing Day' END AS name
FROM year_days"""
CTES["holidays_all"] = """
SELECT d, name, 0 AS later FROM holidays_own WHERE name IS NOT NULL
UNION ALL SELECT d + CASE WHEN isodow(d) = 6 THEN 2 ELSE 1 END, name || ' (substitute)', 1 FROM holidays_own
WHERE name IN ('New Year''s Day', 'Australia Day') AND isodow(d) >= 6
UNION ALL SELECT d + 2, name || ' (substitute)', 1 FROM holidays_own WHERE name IN ('Christmas Day', 'Boxing Day') AND isodow(d) >= 6"""
CTES["holidays_kept"] = "SELECT d, first(name ORDER BY later, name) AS holiday FROM holidays_all GROUP BY d"
ORACLES["observed_holidays"] = sql(
    "SELECT date, weekday, holiday, holiday IS NOT NULL AS is_holiday FROM fact LEFT JOIN holidays_kept ON d = CAST(date AS DATE)"
)
ORACLES["holiday_mood"] = sql(
    rounded(
        """SELECT coalesce(holiday, 'none') AS holiday, count(*) AS days, avg(mood_1_5) AS mood
        FROM fact LEFT JOIN holidays_kept ON d = CAST(date AS DATE) GROUP BY 1""",
        ["mood"],
    )
)
CTES["switches"] = """
SELECT c.entity_id, CAST(c.date AS VARCHAR) AS date, c.primary_mode, u.usual_mode,
       c.primary_mode <> u.usual_mode AS mode_switch, c.mean_delay_s
FROM commute_entity_day c LEFT JOIN usual_modes u USING (entity_id)"""
ORACLES["mode_switch"] = sql("SELECT * EXCLUDE (mean_delay_s) FROM switches")
ORACLES["mode_switch_day"] = sql(
    f"""SELECT {DATE_TEXT}, primary_mode, usual_mode, primary_mode <> usual_mode AS mode_switch
FROM commute_day, (SELECT primary_mode AS usual_mode FROM commute_day GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"""
)
BAND = """CASE WHEN coalesce(mean_delay_s, 0) < 60 THEN 'on_time' WHEN mean_delay_s < 300 THEN 'minor'
WHEN mean_delay_s < 900 THEN 'moderate' ELSE 'severe' END"""
ORACLES["delay_bands"] = sql(f"SELECT entity_id, {DATE_TEXT}, {BAND} AS delay_band FROM commute_entity_day")


def in_windows(ts: str) -> str:
    hour = f"hour({local(ts)})"
    return " OR ".join(f"({hour} >= {a} AND {hour} < {b})" for a, b in V.COMMUTE_WINDOWS)


ORACLES["exposure_window"] = sql(
    rounded(
        f"""SELECT CAST({local_day('observation_ts')} AS VARCHAR) AS date, avg(pm25) AS pm25_day,
        avg(pm25) FILTER (WHERE {in_windows('observation_ts')}) AS pm25_commute,
        avg(pm25) FILTER (WHERE {in_windows('observation_ts')}) - avg(pm25) AS difference
        FROM f_air GROUP BY 1""",
        ["pm25_day", "pm25_commute", "difference"],
    )
)
ORACLES["crosstab_bands"] = sql(
    f"""SELECT {BAND} AS delay_band, count(*) FILTER (WHERE mode_switch) AS n_true,
count(*) FILTER (WHERE NOT mode_switch) AS n_false FROM switches GROUP BY 1"""
)
ORACLES["cube_rain_status"] = sql(
    f"""SELECT rainfall, beach_status, count(*) AS n, CAST(grouping(rainfall, beach_status) AS BIGINT) AS grouping
FROM (SELECT {RAIN_CASE.format('rain_24h_mm')} AS rainfall, beach_status FROM fact)
GROUP BY CUBE (rainfall, beach_status)"""
)
ORACLES["cube_rain_status_steps"] = sql(
    f"""SELECT rainfall, beach_status, active, count(*) AS n, CAST(grouping(rainfall, beach_status, active) AS BIGINT) AS grouping
FROM (SELECT {RAIN_CASE.format('rain_24h_mm')} AS rainfall, beach_status, steps >= 1500 AS active FROM fact)
GROUP BY CUBE (rainfall, beach_status, active)"""
)
ORACLES["status_over_time"] = sql(
    rounded(
        """SELECT substr(date, 1, 7) AS year_month, beach_status AS value, count(*) AS n, count(*) / CAST(sum(count(*)) OVER (PARTITION BY substr(date, 1, 7)) AS DOUBLE) AS share
        FROM fact GROUP BY 1, 2""",
        ["share"],
    )
)
_freedom = "((a + b) * (a + b) / (a * a / (n_yes - 1) + b * b / (n_no - 1)))"
STUDENT = " + ".join(f"{t!r} / {_freedom} ** {i}" for i, t in enumerate(STUDENT_TERMS))
ORACLES["difference_wet_dry"] = sql(
    rounded(
        f"""SELECT n_yes, n_no, mean_yes, mean_no, mean_yes - mean_no AS difference, sqrt(a + b) AS std_error,
        (a + b) * (a + b) / (a * a / (n_yes - 1) + b * b / (n_no - 1)) AS freedom,
        mean_yes - mean_no - ({STUDENT}) * sqrt(a + b) AS lower_ci,
        mean_yes - mean_no + ({STUDENT}) * sqrt(a + b) AS upper_ci
        FROM (SELECT count(steps) FILTER (WHERE after_rain) AS n_yes, count(steps) FILTER (WHERE NOT after_rain) AS n_no,
              avg(steps) FILTER (WHERE after_rain) AS mean_yes, avg(steps) FILTER (WHERE NOT after_rain) AS mean_no,
              var_samp(steps) FILTER (WHERE after_rain) / count(steps) FILTER (WHERE after_rain) AS a,
              var_samp(steps) FILTER (WHERE NOT after_rain) / count(steps) FILTER (WHERE NOT after_rain) AS b FROM fact)""",
        ["mean_yes", "mean_no", "difference", "std_error", "freedom", "lower_ci", "upper_ci"],
    )
)
ORACLES["after_rain_advice"] = sql(
    """SELECT date, after_rain, rain_24h_mm >= 10 OR coalesce(beach_status IN ('Poor', 'Very poor'), false)
AS after_rain_advice FROM fact"""
)
ORACLES["pedestrian_day"] = sql(
    f"""SELECT site_id, CAST({local_day('counted_ts')} AS VARCHAR) AS date, CAST(sum(people) AS BIGINT) AS people,
CAST(sum(CASE WHEN {in_windows('counted_ts')} THEN people ELSE 0 END) AS BIGINT) AS people_commuting
FROM f_pedestrian GROUP BY ALL"""
)
CTES["trip_hours"] = """
SELECT trip_id, route, trip_start_ts, unnest([date_trunc('hour', trip_start_ts - INTERVAL 30 MINUTES),
       date_trunc('hour', trip_start_ts - INTERVAL 30 MINUTES) + INTERVAL 1 HOUR]) AS hour FROM f_routed"""
ORACLES["trip_delays"] = sql(
    rounded(
        """SELECT t.trip_id, t.route, CAST(count(r.ts) AS DOUBLE) AS reports, coalesce(sum(r.delay_s), 0.0) AS delay_total,
        avg(r.delay_s) AS mean_delay_s
        FROM trip_hours t LEFT JOIN f_reports r ON r.route = t.route AND date_trunc('hour', r.ts) = t.hour
            AND r.ts >= t.trip_start_ts - INTERVAL 30 MINUTES AND r.ts < t.trip_start_ts + INTERVAL 30 MINUTES
        GROUP BY t.trip_id, t.route""",
        ["reports", "delay_total", "mean_delay_s"],
    )
)

CTES["near_pairs"] = """
SELECT t.trip_id, t.route, r.trip_id AS report, r.delay_s, epoch_us(r.ts) - epoch_us(t.trip_start_ts) AS distance_us
FROM (SELECT *, unnest([date_trunc('hour', trip_start_ts) - INTERVAL 1 HOUR, date_trunc('hour', trip_start_ts),
                        date_trunc('hour', trip_start_ts) + INTERVAL 1 HOUR]) AS hour FROM f_routed) t
JOIN f_reports r ON r.route = t.route AND date_trunc('hour', r.ts) = t.hour
    AND r.ts BETWEEN t.trip_start_ts - INTERVAL 30 MINUTES AND t.trip_start_ts + INTERVAL 30 MINUTES"""


def nearest(where: str) -> str:
    return rounded(
        f"""SELECT t.trip_id, t.route, p.report, p.delay_s, p.distance_us FROM f_routed t LEFT JOIN (
            SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY abs(distance_us), distance_us, report) AS nth
            FROM near_pairs WHERE {where}) p ON p.trip_id = t.trip_id AND nth = 1""",
        ["delay_s"],
    )


ORACLES["nearest_report"] = sql(nearest("true"))
ORACLES["last_report"] = sql(nearest("distance_us <= 0"))
ORACLES["reports_within"] = sql(
    rounded("SELECT trip_id, route, report, delay_s, distance_us FROM near_pairs WHERE distance_us >= -300000000 AND distance_us < 300000000", ["delay_s"])
)

# ---- model --------------------------------------------------------------------------------------

DUMMIES = [f"is_{d.lower()}" for d in V.WEEKDAYS]
MODEL_COLUMNS = [*DUMMIES, *V.NUMERIC_FEATURES]
CTES["model_rows"] = (
    "SELECT date, weekday, mood_1_5, "
    + ", ".join(f"CAST(weekday = '{d}' AS DOUBLE) AS is_{d.lower()}" for d in V.WEEKDAYS)
    + ", "
    + ", ".join(f"{x} AS {c}" for c, x in NUMERIC.items())
    + " FROM fact WHERE mood_1_5 IS NOT NULL AND weekday IS NOT NULL AND "
    + " AND ".join(f"{c} IS NOT NULL" for c in V.NUMERIC_FEATURES)
)


def encoded(source: str) -> str:
    """Numerics in population deviations from their mean."""
    return (
        f"SELECT r.* REPLACE ({', '.join(f'(r.{c} - s.m_{c}) / s.s_{c} AS {c}' for c in V.NUMERIC_FEATURES)}) FROM {source} r, (SELECT "
        + ", ".join(
            f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) > 1e-12 THEN stddev_pop({c}) ELSE 1 END AS s_{c}"
            for c in V.NUMERIC_FEATURES
        )
        + f" FROM {source}) s"
    )


CTES["encoded"] = encoded("model_rows")
ORACLES["encoded_features"] = sql(
    rounded(
        f"SELECT date, {', '.join(f'{c} AS x_{c}' for c in MODEL_COLUMNS)} FROM encoded",
        [f"x_{c}" for c in MODEL_COLUMNS],
    )
)
PAIRS = [(a, b) for i, a in enumerate(MODEL_COLUMNS) for b in MODEL_COLUMNS[i:]]
ORACLES["gram_matrix"] = sql(
    rounded(
        "SELECT unnest(["
        + ", ".join(f"{{'row_name': '{a}', 'col_name': '{b}', 'value': sum({a} * {b})}}" for a, b in PAIRS)
        + "], recursive := true) FROM encoded",
        ["value"],
        6,
    )
)


# Least squares in SQL: normal equations of a full-rank design (intercept, all weekdays but one, numerics),
# solved by Gauss-Jordan elimination, one column per step of a recursive query. The predictions are those of
# the minimum-norm fit; its weekday coefficients are these minus their mean.
def normal_equations(source: str, columns: list[str], weight: str = "1", by: str = "") -> str:
    terms = ["1", *columns]
    line = ", ".join(
        "[" + ", ".join(f"sum({weight} * {a} * {b})" for b in [*terms, "mood_1_5"]) + "]" for a in terms
    )
    group = f"GROUP BY {by}" if by else ""
    return f"SELECT {by or 0} AS rep, 1 AS k, [{line}]::DOUBLE[][] AS m FROM {source} {group}"


def eliminate(source: str, size: int, name: str) -> str:
    step = f"""list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / m[k][k])
ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END)"""
    return f"SELECT rep, k, m FROM {source} UNION ALL SELECT rep, k + 1, {step} FROM {name} WHERE k <= {size}"


def add_fit(prefix: str, source: str, columns: list[str], weight: str = "1", by: str = "") -> None:
    size = len(columns) + 1
    CTES[f"{prefix}_start"] = normal_equations(source, columns, weight, by)
    CTES[f"{prefix}_steps"] = eliminate(f"{prefix}_start", size, f"{prefix}_steps")
    CTES[f"{prefix}_beta"] = (
        f"SELECT rep, list_transform(m, lambda r: r[{size + 1}]) AS beta FROM {prefix}_steps WHERE k = {size + 1}"
    )


def design_list(columns: list[str], alias: str) -> str:
    return "[1.0, " + ", ".join(f"{alias}.{c}" for c in columns) + "]"


FULL_RANK = [*DUMMIES[1:], *V.NUMERIC_FEATURES]
X_LIST = design_list(FULL_RANK, "e")
DOT = "list_inner_product({0}, {1})"


def add_scaled_fit(prefix: str, rows: str) -> None:
    CTES[f"{prefix}_encoded"] = encoded(rows)
    add_fit(prefix, f"{prefix}_encoded", FULL_RANK)
    # Back to feature units, weekday coefficients centred.
    CTES[f"{prefix}_stats"] = (
        "SELECT "
        + ", ".join(
            f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) > 1e-12 THEN stddev_pop({c}) ELSE 1 END AS s_{c}"
            for c in V.NUMERIC_FEATURES
        )
        + f" FROM {rows}"
    )
    days = " + ".join(f"beta[{i + 2}]" for i in range(6))
    slopes = ", ".join(
        f"beta[{i + 8}] / s_{c} AS {c}" for i, c in enumerate(V.NUMERIC_FEATURES)
    )
    shift = " - ".join(f"beta[{i + 8}] / s_{c} * m_{c}" for i, c in enumerate(V.NUMERIC_FEATURES))
    dummies = ", ".join(
        [f"-({days}) / 7 AS {DUMMIES[0]}", *[f"beta[{i + 2}] - ({days}) / 7 AS {d}" for i, d in enumerate(DUMMIES[1:])]]
    )
    CTES[f"{prefix}_coef"] = (
        f"SELECT beta[1] + ({days}) / 7 - {shift} AS intercept, {dummies}, {slopes} FROM {prefix}_beta, {prefix}_stats"
    )


def terms_of(prefix: str) -> str:
    names = ["intercept", *MODEL_COLUMNS]
    lines = ", ".join(f"{{'term': '{n}', 'coefficient': {n}}}" for n in names)
    return rounded(f"SELECT unnest([{lines}], recursive := true) FROM {prefix}_coef", ["coefficient"], 6)


add_scaled_fit("ols", "model_rows")
ORACLES["model_coefficients"] = sql(terms_of("ols"))
CTES["scored"] = f"""
SELECT e.date, e.weekday, e.mood_1_5, {DOT.format('b.beta', X_LIST)} AS prediction FROM ols_encoded e, ols_beta b"""
CTES["all_days"] = CTES["model_rows"].replace("mood_1_5 IS NOT NULL AND weekday IS NOT NULL AND", "weekday IS NOT NULL AND")
_point = "ols_coef.intercept + " + " + ".join(f"ols_coef.{c} * d.{c}" for c in MODEL_COLUMNS)
ORACLES["predictions"] = sql(
    rounded(f"SELECT d.date, d.weekday, d.mood_1_5, {_point} AS prediction FROM all_days d, ols_coef", ["mood_1_5", "prediction"], 6)
)
ORACLES["unusable_days"] = sql(
    "SELECT (SELECT count(*) FROM fact) AS rows, (SELECT count(*) FROM fact) - (SELECT count(*) FROM model_rows) AS dropped"
)

CTES["numbered"] = f"""
SELECT *, row_number() OVER (ORDER BY md5('{SEED}|' || date), date) - 1 AS position, count(*) OVER () AS total
FROM model_rows"""
CTES["held_out"] = "SELECT * EXCLUDE (position, total), position < ceil(total * 0.5) AS is_test FROM numbered"
ORACLES["holdout_split"] = sql("SELECT date, is_test FROM held_out")
ORACLES["holdout_split_by_hash"] = sql(
    rounded(
        f"""SELECT ('0x' || substr(md5('{SEED}|' || trip_id), 1, 8))::BIGINT < 2147483648 AS is_test, count(*) AS n,
        sum(trip_minutes) AS minutes FROM f_trips GROUP BY 1""",
        ["minutes"],
    )
)
CTES["train_rows"] = "SELECT * EXCLUDE (is_test) FROM held_out WHERE NOT is_test"
CTES["test_rows"] = "SELECT * EXCLUDE (is_test) FROM held_out WHERE is_test"
add_scaled_fit("half", "train_rows")


def linear(prefix: str, alias: str) -> str:
    return f"{prefix}.intercept + " + " + ".join(f"{prefix}.{c} * {alias}.{c}" for c in MODEL_COLUMNS)


ORACLES["holdout_metrics"] = sql(
    rounded(
        f"""SELECT count(*) AS n, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2, avg(abs(y - p)) AS mae
        FROM (SELECT t.mood_1_5 AS y, {linear('half_coef', 't')} AS p FROM test_rows t, half_coef)""",
        ["r2", "mae"],
        6,
    )
)
ORACLES["simple_regressions"] = sql(
    rounded(
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS feature, regr_slope(mood_1_5, {c}) AS slope, regr_intercept(mood_1_5, {c}) AS intercept,
            regr_r2(mood_1_5, {c}) AS r2, CAST(regr_count(mood_1_5, {c}) AS BIGINT) AS n FROM fact"""
            for c in ("commute_minutes", "reliability", "pm25_mean", "steps")
        ),
        ["slope", "intercept", "r2"],
        6,
    )
)

# Standard errors need the inverse: eliminate the matrix with the identity beside it.
CONTROLS = ["commute_minutes", "reliability", "pm25_mean", "after_rain", "meeting_count"]
CTES["control_rows"] = (
    "SELECT mood_1_5, "
    + ", ".join(f"(CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) AS {c}" for c in CONTROLS)
    + " FROM fact WHERE mood_1_5 IS NOT NULL"
)
_lines = []
for _i, _a in enumerate(CONTROLS):
    _cells = [f"sum({_a} * {_b})" for _b in [*CONTROLS, "mood_1_5"]]
    _cells += ["1" if _i == _j else "0" for _j in range(len(CONTROLS))]
    _lines.append("[" + ", ".join(_cells) + "]")
CTES["control_start"] = f"SELECT 0 AS rep, 1 AS k, [{', '.join(_lines)}]::DOUBLE[][] AS m FROM control_rows"
CTES["control_steps"] = eliminate("control_start", 5, "control_steps")
CTES["control_solution"] = "SELECT m FROM control_steps WHERE k = 6"
CTES["control_error"] = (
    "SELECT sum(d * d) / (count(*) - 6) AS variance FROM (SELECT mood_1_5 - avg(mood_1_5) OVER () - "
    + " - ".join(f"m[{i + 1}][6] * {c}" for i, c in enumerate(CONTROLS))
    + " AS d FROM control_rows, control_solution)"
)
ORACLES["ols_with_controls"] = sql(
    rounded(
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS term, m[{i + 1}][6] AS coefficient, sqrt(variance * m[{i + 1}][{i + 7}]) AS std_error,
            m[{i + 1}][6] / sqrt(variance * m[{i + 1}][{i + 7}]) AS t_value FROM control_solution, control_error"""
            for i, c in enumerate(CONTROLS)
        ),
        ["coefficient", "std_error", "t_value"],
        6,
    )
)
CTES["near_rows"] = """
SELECT r.* FROM model_rows r, (SELECT avg(commute_minutes) AS mc, stddev_pop(commute_minutes) AS sc,
avg(steps) AS ms, stddev_pop(steps) AS ss FROM fact) s
WHERE abs((r.commute_minutes - mc) / sc) <= 2 AND abs((r.steps - ms) / ss) <= 2"""
add_scaled_fit("near", "near_rows")
ORACLES["robust_coefficients"] = sql(terms_of("near"))
# Reweighted least squares with a fixed number of passes: each solves the weighted normal equations of the standardised controls.
CTES["robust_rows"] = (
    "SELECT mood_1_5, "
    + ", ".join(f"(CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / stddev_pop(CAST({c} AS DOUBLE)) OVER () AS {c}" for c in CONTROLS)
    + " FROM fact WHERE mood_1_5 IS NOT NULL"
)
CTES["robust_spread"] = "SELECT " + ", ".join(f"stddev_pop(CAST({c} AS DOUBLE)) AS {c}" for c in CONTROLS) + " FROM fact WHERE mood_1_5 IS NOT NULL"
add_fit("plain", "robust_rows", CONTROLS)
_fitted = "beta[1] + " + " + ".join(f"beta[{i + 2}] * {c}" for i, c in enumerate(CONTROLS))
HUBER_C, TUKEY_C, PASSES = 1.345, 4.685, 60
_huber_w = f"CASE WHEN abs(u) <= {HUBER_C} THEN 1.0 ELSE {HUBER_C} / abs(u) END"
_tukey_w = f"CASE WHEN abs(u) < {TUKEY_C} THEN (1 - (u / {TUKEY_C}) * (u / {TUKEY_C})) * (1 - (u / {TUKEY_C}) * (u / {TUKEY_C})) ELSE 0.0 END"


def reweighted(name: str, start: str, weight: str, scale: str) -> str:
    terms = ["1", *CONTROLS]
    line = ", ".join("[" + ", ".join(f"sum(w * {a} * {b})" for b in [*terms, "mood_1_5"]) + "]" for a in terms)
    rows = f"SELECT step, s, mood_1_5, {', '.join(CONTROLS)}, (mood_1_5 - ({_fitted})) / s AS u FROM {name}, robust_rows WHERE step < {PASSES}"
    source = f"SELECT step, s, count(*) AS n, sum(w * u * w * u) AS squares, [{line}]::DOUBLE[][] AS m FROM (SELECT *, {weight} AS w FROM ({rows})) GROUP BY step, s"
    for k in range(1, len(terms) + 1):
        solved = f"""list_transform(m, lambda r, i: CASE WHEN i = {k} THEN list_transform(r, lambda v: v / m[{k}][{k}])
ELSE list_transform(r, lambda v, j: v - r[{k}] * m[{k}][j] / m[{k}][{k}]) END)"""
        source = f"SELECT step, s, n, squares, {solved} AS m FROM ({source})"
    size = len(terms)
    return f"""SELECT 0 AS step, beta, s FROM ({start})
UNION ALL SELECT step + 1, list_transform(m, lambda r: r[{size + 1}]), {scale} FROM ({source})"""


_density = f"exp(-{HUBER_C} * {HUBER_C} / 2.0) / sqrt(2 * pi())"
CTES["normal_below"] = f"""
SELECT 0.5 + {_density} * sum(term) AS below FROM (
    WITH RECURSIVE series(i, term) AS (SELECT 0, {HUBER_C}::DOUBLE UNION ALL SELECT i + 1, term * {HUBER_C} * {HUBER_C} / (2 * i + 3) FROM series WHERE i < 40)
    SELECT term FROM series)"""
_kappa = f"(2 * {HUBER_C} * {HUBER_C} * (1 - below) + 2 * below - 1 - 2 * {HUBER_C} * {_density})"
CTES["plain_scale"] = f"SELECT beta, sqrt(sum(d * d) / (count(*) - 6)) AS s FROM (SELECT beta, mood_1_5 - ({_fitted}) AS d FROM robust_rows, plain_beta) GROUP BY beta"
CTES["huber_passes"] = reweighted(
    "huber_passes", "SELECT beta, s FROM plain_scale", _huber_w, f"s * sqrt(squares / ((n - 6) * (SELECT {_kappa} FROM normal_below)))"
)
CTES["tukey_passes"] = reweighted("tukey_passes", f"SELECT beta, s FROM huber_passes WHERE step = {PASSES}", _tukey_w, "s")


def robust_terms(passes: str, weight: str, slope: str) -> str:
    u = f"SELECT beta, s, (mood_1_5 - ({_fitted})) / s AS u FROM {passes}, robust_rows WHERE step = {PASSES}"
    sums = f"SELECT beta, s, count(*) AS n, sum(w * u * w * u) AS squares, avg(d) AS slope, var_pop(d) AS spread FROM (SELECT *, {weight} AS w, {slope} AS d FROM ({u})) GROUP BY beta, s"
    error = "(1 + 6 / n * spread / (slope * slope)) * s * sqrt(squares / (n - 6)) / slope"
    lines = ", ".join(
        f"{{'term': '{c}', 'coefficient': beta[{i + 2}] / v.{c}, 'std_error': {error} * sqrt(m[{i + 1}][{i + 7}]), 't_value': beta[{i + 2}] / v.{c} / ({error} * sqrt(m[{i + 1}][{i + 7}]))}}"
        for i, c in enumerate(CONTROLS)
    )
    return rounded(f"SELECT unnest([{lines}], recursive := true) FROM ({sums}), robust_spread v, control_solution", ["coefficient", "std_error", "t_value"], 6)


ORACLES["robust_huber"] = sql(robust_terms("huber_passes", _huber_w, f"CASE WHEN abs(u) <= {HUBER_C} THEN 1.0 ELSE 0.0 END"))
ORACLES["robust_tukey"] = sql(
    robust_terms(
        "tukey_passes", _tukey_w,
        f"CASE WHEN abs(u) < {TUKEY_C} THEN (1 - (u / {TUKEY_C}) * (u / {TUKEY_C})) * (1 - 5 * (u / {TUKEY_C}) * (u / {TUKEY_C})) ELSE 0.0 END",
    )
)
# Centred controls are orthogonal to the intercept: the influence of a row on a slope is its product with a line of the inverse.
_along = [" + ".join(f"m[{i + 1}][{j + 7}] * {b}" for j, b in enumerate(CONTROLS)) for i in range(len(CONTROLS))]
CTES["influences"] = (
    "SELECT mood_1_5 - avg(mood_1_5) OVER () - " + " - ".join(f"m[{i + 1}][6] * {c}" for i, c in enumerate(CONTROLS)) + " AS e, count(*) OVER () AS n, "
    + ", ".join(f"{line} AS t{i}" for i, line in enumerate(_along))
    + ", 1.0 / count(*) OVER () + " + " + ".join(f"{c} * ({line})" for c, line in zip(CONTROLS, _along, strict=True)) + " AS h FROM control_rows, control_solution"
)
ORACLES["sandwich_errors"] = sql(
    rounded(
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS term, (SELECT m[{i + 1}][6] FROM control_solution) AS coefficient,
            sqrt(sum(e * e * t{i} * t{i}) * max(n) / (max(n) - 6)) AS hc1_error, sqrt(sum(e * e / ((1 - h) * (1 - h)) * t{i} * t{i})) AS hc3_error FROM influences"""
            for i, c in enumerate(CONTROLS)
        ),
        ["coefficient", "hc1_error", "hc3_error"],
        6,
    )
)
CTES["logit_rows"] = """
SELECT CAST(mode_switch AS DOUBLE) AS y, coalesce(mean_delay_s, 0) / 60 AS x FROM switches"""
CTES["newton"] = """
SELECT 0 AS step, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b
UNION ALL
SELECT step + 1, a + (sxx * ga - sx * gb) / (sw * sxx - sx * sx), b + (sw * gb - sx * ga) / (sw * sxx - sx * sx)
FROM (SELECT step, a, b, sum(p * (1 - p)) AS sw, sum(p * (1 - p) * x) AS sx, sum(p * (1 - p) * x * x) AS sxx,
             sum(y - p) AS ga, sum((y - p) * x) AS gb
      FROM (SELECT step, a, b, x, y, 1 / (1 + exp(-a - b * x)) AS p FROM newton, logit_rows WHERE step < 15)
      GROUP BY step, a, b)"""
ORACLES["logit_mode_switch"] = sql(
    rounded(
        """SELECT 'intercept' AS term, a AS coefficient FROM newton WHERE step = 15
        UNION ALL SELECT 'delay_min', b FROM newton WHERE step = 15""",
        ["coefficient"],
        4,
    )
)


# ---- bootstrap ----------------------------------------------------------------------------------


def draws(numbered: str, replicates: int) -> str:
    return f"""SELECT rep, ('0x' || substr(md5('{SEED}|' || rep || '|' || date), 1, 15))::BIGINT % total AS position,
count(*) AS weight FROM {numbered}, (SELECT unnest(range({replicates})) AS rep) GROUP BY ALL"""


def poisson(rows: str, replicates: int) -> str:
    u = f"('0x' || substr(md5('{SEED}|' || (rep // 4) || '|' || date), CAST(rep % 4 AS INTEGER) * 8 + 1, 8))::BIGINT"
    weight = " + ".join(f"CAST(u >= {step} AS BIGINT)" for step in POISSON_STEPS)
    return f"""SELECT date, rep, {weight} AS weight FROM (SELECT date, rep, {u} AS u FROM {rows},
(SELECT unnest(range({replicates})) AS rep))"""


CTES["draws_few"] = draws("numbered", 20)
ORACLES["bootstrap_weights"] = sql(
    "SELECT date, CAST(rep AS BIGINT) AS replicate, weight FROM draws_few JOIN numbered USING (position)"
)
CTES["poisson_few"] = poisson("model_rows", 20)
ORACLES["bootstrap_weights_poisson"] = sql(
    "SELECT date, CAST(rep AS BIGINT) AS replicate, weight FROM poisson_few WHERE weight > 0"
)
CTES["mood_numbered"] = f"""
SELECT date, mood_1_5, row_number() OVER (ORDER BY md5('{SEED}|' || date), date) - 1 AS position,
       count(*) OVER () AS total FROM fact WHERE mood_1_5 IS NOT NULL"""
CTES["mood_draws"] = draws("mood_numbered", 200)
CTES["mood_means"] = """
SELECT rep, sum(mood_1_5 * weight) / sum(weight) AS mean FROM mood_draws JOIN mood_numbered USING (position) GROUP BY rep"""
ORACLES["bootstrap_mean_ci"] = sql(
    rounded(
        """SELECT count(*) AS replicates, quantile_cont(mean, 0.025) AS lower_ci, quantile_cont(mean, 0.975) AS upper_ci
        FROM mood_means""",
        ["lower_ci", "upper_ci"],
    )
)
CTES["mood_poisson"] = poisson("mood_numbered", 200)
CTES["mood_poisson_means"] = """
SELECT rep, sum(mood_1_5 * weight) / sum(weight) AS mean FROM mood_poisson JOIN mood_numbered USING (date) GROUP BY rep"""
ORACLES["bootstrap_mean_ci_poisson"] = sql(
    rounded(
        """SELECT count(*) AS replicates, quantile_cont(mean, 0.025) AS lower_ci, quantile_cont(mean, 0.975) AS upper_ci
        FROM mood_poisson_means""",
        ["lower_ci", "upper_ci"],
    )
)
CTES["draws_all"] = draws("numbered", V.BOOTSTRAP_REPLICATES)
CTES["poisson_all"] = poisson("model_rows", V.BOOTSTRAP_REPLICATES)
CTES["drawn_rows"] = """
SELECT e.*, d.rep, d.weight FROM ols_encoded e JOIN numbered n ON e.date = n.date JOIN draws_all d ON d.position = n.position"""
CTES["poisson_rows"] = "SELECT e.*, d.rep, d.weight FROM ols_encoded e JOIN poisson_all d ON e.date = d.date WHERE d.weight > 0"
add_fit("drawn", "drawn_rows", FULL_RANK, "weight", "rep")
add_fit("weighted", "poisson_rows", FULL_RANK, "weight", "rep")


def intervals(beta: str) -> str:
    return f"""
SELECT s.date, s.weekday, s.mood_1_5, s.prediction, i.lower_ci, i.upper_ci FROM scored s JOIN (
    SELECT date, quantile_cont(p, 0.025) AS lower_ci, quantile_cont(p, 0.975) AS upper_ci
    FROM (SELECT e.date, {DOT.format('b.beta', X_LIST)} AS p FROM ols_encoded e, {beta} b) GROUP BY date) i USING (date)"""


INTERVAL_DOUBLES = ["mood_1_5", "prediction", "lower_ci", "upper_ci"]
ORACLES["bootstrap_intervals_multinomial"] = sql(rounded(intervals("drawn_beta"), INTERVAL_DOUBLES, 6))
ORACLES["bootstrap_intervals_poisson"] = sql(rounded(intervals("weighted_beta"), INTERVAL_DOUBLES, 6))
ORACLES["bootstrap_intervals"] = ORACLES["bootstrap_intervals_poisson"]
# The last days of the mart, whether or not they can be scored.
CTES["last_days"] = (
    "SELECT date, weekday, mood_1_5, "
    + ", ".join(f"CAST(weekday = '{d}' AS DOUBLE) AS is_{d.lower()}" for d in V.WEEKDAYS)
    + ", "
    + ", ".join(f"({x} - m_{c}) / s_{c} AS {c}" for c, x in NUMERIC.items())
    + " FROM (SELECT * FROM fact ORDER BY date DESC LIMIT 7), ols_stats"
)


def sum_of_terms(beta: str) -> str:
    """As the product of lists, but null where a feature is."""
    return f"{beta}[1] + " + " + ".join(f"{beta}[{i + 2}] * e.{c}" for i, c in enumerate(FULL_RANK))


ORACLES["recent_days"] = sql(
    rounded(
        f"""SELECT e.date, e.weekday, e.mood_1_5, {sum_of_terms('o.beta')} AS prediction, i.lower_ci, i.upper_ci
        FROM last_days e CROSS JOIN ols_beta o LEFT JOIN (
            SELECT date, quantile_cont(p, 0.025) AS lower_ci, quantile_cont(p, 0.975) AS upper_ci
            FROM (SELECT e.date, {sum_of_terms('b.beta')} AS p FROM last_days e, weighted_beta b) GROUP BY date) i ON i.date = e.date""",
        INTERVAL_DOUBLES,
        6,
    )
)

# ---- scenarios ----------------------------------------------------------------------------------

CTES["start_row"] = (
    "SELECT "
    + ", ".join(f"avg({x}) AS {c}" for c, x in NUMERIC.items())
    + ", (SELECT weekday FROM fact GROUP BY weekday ORDER BY count(*) DESC, weekday LIMIT 1) AS weekday FROM fact"
)
SCENARIO_NAMES = ", ".join(V.SCENARIO_COLUMNS)
_values = ", ".join("('" + r[0] + "', '" + V.SCENARIO_TEXTS[r[0]] + "', " + ", ".join(map(str, r[1:])) + ")" for r in V.SCENARIOS)
CTES["scenario_table"] = f"SELECT * FROM (VALUES {_values}) AS t({SCENARIO_NAMES})"
CTES["custom_table"] = f"SELECT * FROM (VALUES ('Custom', 'Custom', -30.0, 0.3, 0.0, 0.0, 5000.0, 0.0, 0.0)) AS t({SCENARIO_NAMES})"


def moved(c: str) -> str:
    if c not in V.SCENARIO_FEATURES:
        return f"s.{c}"
    value = f"s.{c} + CAST(t.delta_{c} AS DOUBLE)"
    return f"greatest(0.0, least(1.0, {value}))" if c == "reliability" else value


def scenario_rows(table: str) -> str:
    return (
        "SELECT t.scenario, t.description, s.weekday, "
        + ", ".join(f"{moved(c)} AS {c}" for c in V.NUMERIC_FEATURES)
        + f" FROM {table} t, start_row s"
    )


def day_term(alias: str) -> str:
    return "CASE " + alias + ".weekday " + " ".join(
        f"WHEN '{d}' THEN c.is_{d.lower()}" for d in V.WEEKDAYS
    ) + " ELSE 0 END"


def score(alias: str) -> str:
    return f"c.intercept + {day_term(alias)} + " + " + ".join(f"c.{n} * {alias}.{n}" for n in V.NUMERIC_FEATURES)


CTES["scenario_rows"] = scenario_rows("scenario_table")
CTES["custom_rows"] = scenario_rows("custom_table")
ORACLES["scenario_features"] = sql(rounded("SELECT * FROM scenario_rows", V.NUMERIC_FEATURES))


def scenario_scores(rows: str) -> str:
    return rounded(
        f"""SELECT r.scenario, r.description, {score('r')} AS predicted_mood,
        ({score('r')}) - ({score('s')}) AS delta_vs_baseline FROM {rows} r, start_row s, ols_coef c""",
        ["predicted_mood", "delta_vs_baseline"],
        6,
    )


ORACLES["scenario_predictions"] = sql(scenario_scores("scenario_rows"))
ORACLES["custom_scenario"] = sql(scenario_scores("custom_rows"))
_moves = ", ".join(f"('{f}', {d})" for f, ds in V.SENSITIVITY_DELTAS.items() for d in ds)


def nudged(c: str) -> str:
    if c not in V.SENSITIVITY_DELTAS:
        return f"s.{c}"
    value = f"s.{c} + CAST(t.delta AS DOUBLE)"
    value = f"greatest(0.0, least(1.0, {value}))" if c == "reliability" else value
    return f"CASE WHEN t.feature = '{c}' THEN {value} ELSE s.{c} END"


CTES["nudged_rows"] = (
    "SELECT t.feature, CAST(t.delta AS DOUBLE) AS delta, s.weekday, "
    + ", ".join(f"{nudged(c)} AS {c}" for c in V.NUMERIC_FEATURES)
    + f" FROM (VALUES {_moves}) AS t(feature, delta), start_row s"
)
CTES["half_day"] = CTES["start_row"].replace("FROM fact", "FROM train_rows")
CTES["half_nudged"] = CTES["nudged_rows"].replace("start_row s", "half_day s")
ORACLES["sensitivity_inputs"] = sql(rounded("SELECT * FROM nudged_rows", ["delta", *V.NUMERIC_FEATURES]))
ORACLES["sensitivity"] = sql(
    rounded(
        f"""SELECT r.feature, r.delta, {score('r')} AS prediction, ({score('r')}) - ({score('s')}) AS change_vs_baseline
        FROM half_nudged r, half_day s, half_coef c""",
        ["delta", "prediction", "change_vs_baseline"],
        6,
    )
)

# ---- streams ------------------------------------------------------------------------------------

CTES["local_reports"] = f"SELECT {local('ts')} AS local_ts, route, delay_s FROM f_reports"
ORACLES["stream_delay_day"] = sql(
    rounded(
        f"""SELECT {DATE_TEXT}, route, report_count, late_count, mean_delay_s,
        d.date + INTERVAL 1 DAY <= (SELECT max(local_ts) - INTERVAL 2 HOURS FROM local_reports) AS is_final FROM (
        SELECT CAST(local_ts AS DATE) AS date, route, count(*) AS report_count,
               count(*) FILTER (WHERE delay_s > 60) AS late_count, avg(delay_s) AS mean_delay_s
        FROM local_reports GROUP BY ALL) AS d""",
        ["mean_delay_s"],
    )
)
ORACLES["stream_closed_days"] = sql(
    "SELECT * EXCLUDE (is_final), CAST(0 AS BIGINT) AS too_late FROM (" + rounded(
        f"""SELECT {DATE_TEXT}, route, report_count, late_count, mean_delay_s,
        d.date + INTERVAL 1 DAY <= (SELECT max(local_ts) - INTERVAL 2 HOURS FROM local_reports) AS is_final FROM (
        SELECT CAST(local_ts AS DATE) AS date, route, count(*) AS report_count,
               count(*) FILTER (WHERE delay_s > 60) AS late_count, avg(delay_s) AS mean_delay_s
        FROM local_reports GROUP BY ALL) AS d""",
        ["mean_delay_s"],
    ) + ") WHERE is_final"
)
ORACLES["stream_distinct_reports"] = sql(
    rounded(f"SELECT {stamp('ts')} AS ts, route, trip_id, delay_s FROM f_reports", ["delay_s"])
)
