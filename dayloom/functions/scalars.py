"""Column expressions. Everything here is built-in Spark SQL, so it stays in generated code."""
from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayloom.fixed_values import LATE_AFTER_SECONDS, LOCAL_ZONE, STATUS_NAMES, SWIMMABLE, WEEKDAYS


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ---- time ---------------------------------------------------------------------------------------


def _session_is_utc() -> bool:
    session = SparkSession.getActiveSession()
    return session is not None and session.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z")


def utc_time(column: Column | str, data_type: T.DataType) -> Column:
    """The instant as a zone-less UTC timestamp; null where text does not parse.

    Zone-less timestamps are taken as UTC. Text may carry an offset.
    """
    value = _col(column)
    if isinstance(data_type, T.TimestampNTZType):
        return value
    if isinstance(data_type, T.StringType):
        value = F.try_to_timestamp(value)
    elif not isinstance(data_type, T.TimestampType):
        return value.cast("timestamp_ntz")
    if _session_is_utc():
        return value.cast("timestamp_ntz")
    return F.convert_timezone(None, F.lit("UTC"), value)


def local_time(utc: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """Wall-clock time in ``zone`` of a zone-less UTC timestamp.

    In a UTC session this is a plain shift, about ten times faster per row than ``convert_timezone``,
    which is right in any session.
    """
    if _session_is_utc():
        return F.from_utc_timestamp(_col(utc).cast("timestamp"), zone)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(utc))


def local_date(utc: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """Calendar day of a zone-less UTC timestamp in ``zone``, daylight saving included."""
    return F.to_date(local_time(utc, zone))


def weekday_name(day: Column | str) -> Column:
    return F.date_format(_col(day), "EEEE")


def iso_date(day: Column | str) -> Column:
    return F.date_format(_col(day), "yyyy-MM-dd")


def weekday_dummies(weekday: Column | str) -> dict[str, Column]:
    """One 0/1 column per weekday; an unknown name is zero in all of them."""
    return {
        f"is_{name.lower()}": F.coalesce((_col(weekday) == name).cast("double"), F.lit(0.0))
        for name in WEEKDAYS
    }


# ---- numbers ------------------------------------------------------------------------------------


def no_nan(column: Column | str) -> Column:
    """NaN counts as missing. (Spark orders NaN above every number, so ``NaN >= 0`` holds.)"""
    return F.nanvl(_col(column), F.lit(None).cast("double"))


def round_even(column: Column | str, digits: int = 2) -> Column:
    """Round half to even on the binary value, as array libraries do."""
    scale = float(10**digits)
    return F.rint(_col(column) * scale) / scale


def clip(column: Column | str, low: float, high: float) -> Column:
    value = _col(column)
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def reliability(late: Column | str, total: Column | str) -> Column:
    """Share of trips on time, 1 when there were none."""
    late, total = _col(late), _col(total)
    share = 1 - late / F.nullif(total, F.lit(0))
    return clip(F.coalesce(share, F.lit(1.0)), 0.0, 1.0)


def cost_per_trip(cost: Column | str, total: Column | str) -> Column:
    cost, total = _col(cost), _col(total)
    return F.when(total > 0, round_even(F.try_divide(cost, total.cast("double")))).otherwise(F.lit(0.0))


def is_late(delay: Column | str) -> Column:
    return _col(delay) > LATE_AFTER_SECONDS


def nonzero(column: Column | str) -> Column:
    return F.nullif(_col(column), F.lit(0.0))


# ---- text and categories ------------------------------------------------------------------------


def strip_text(column: Column | str) -> Column:
    """Remove every kind of leading and trailing white space, tabs and newlines too."""
    return F.regexp_replace(_col(column), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def status_name(column: Column | str, strict: bool = False) -> Column:
    """Canonical status. Unknown or missing values give null, or stop the job when ``strict``."""
    raw = _col(column)
    names = F.create_map(*[F.lit(text) for pair in STATUS_NAMES.items() for text in pair])
    known = F.try_element_at(names, F.lower(strip_text(raw)))
    if strict:
        message = F.concat(F.lit("unknown status: "), F.coalesce(raw, F.lit("null")))
        return F.coalesce(known, F.raise_error(message).cast("string"))
    return known


def status_is_unknown(column: Column | str) -> Column:
    return _col(column).isNotNull() & status_name(column).isNull()


def beach_ok(status: Column | str) -> Column:
    """Swimmable by canonical status; a missing status is not swimmable."""
    return F.coalesce(_col(status).isin(SWIMMABLE), F.lit(False))


def is_swimmable(raw_status: Column | str) -> Column:
    """Swimmable by the status as written; a missing status stays missing."""
    return _col(raw_status).isin(SWIMMABLE)


def after_rain(rain: Column | str) -> Column:
    return _col(rain) > 0


def after_rain_advice(rain: Column | str, status: Column | str, wet_mm: float = 10.0) -> Column:
    """The public-advice rule: heavy rain, or a poor status."""
    return F.coalesce(_col(rain) >= wet_mm, F.lit(False)) | F.coalesce(
        _col(status).isin("Poor", "Very poor"), F.lit(False)
    )


def pm25_category(pm25: Column | str) -> Column:
    value = _col(pm25)
    return F.when(value <= 15, "good").when(value <= 25, "moderate").otherwise("unhealthy")


def rainfall_category(rain: Column | str) -> Column:
    value = _col(rain)
    return F.when(value < 1, "dry").when(value < 10, "wet").otherwise("storm")


def commute_band(minutes: Column | str) -> Column:
    value = _col(minutes)
    return F.when(value <= 45, "short").when(value <= 75, "moderate").otherwise("long")


def delay_band(mean_delay_s: Column | str) -> Column:
    """on_time below one minute, then 1-5, 5-15 and 15 or more minutes."""
    value = F.coalesce(_col(mean_delay_s), F.lit(0.0))
    return (
        F.when(value < 60, "on_time").when(value < 300, "minor").when(value < 900, "moderate").otherwise("severe")
    )


def risk_status(risk: Column | str) -> Column:
    value = _col(risk)
    return (
        F.when(value >= 0.85, "Closed").when(value >= 0.65, "Poor").when(value >= 0.3, "Good").otherwise("Very good")
    )


# ---- hashing ------------------------------------------------------------------------------------


def hashed_id(identifier: Column | str, salt: str) -> Column:
    return F.sha2(F.concat(_col(identifier).cast("string"), F.lit(salt)), 256)


def hash_text(seed: int | str, *parts: Column) -> Column:
    """Hex md5 of the seed and the parts; the same text gives the same value in any SQL engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[part.cast("string") for part in parts]))


def hash_word(hex_text: Column, word: int | Column = 0) -> Column:
    """32-bit unsigned word number 0 to 3 of a hex md5, as bigint."""
    start = F.lit(word) * 8 + 1 if isinstance(word, int) else word * 8 + 1
    return F.conv(F.substring(hex_text, start, F.lit(8)), 16, 10).cast("bigint")
