"""Scalar functions as Column builders, and the same as SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values of the domain.
EARTH_RADIUS_M = 6_371_000.0
LOCAL_ZONE = "Asia/Taipei"
CITY_OF_PREFIX = {"TPE": "Taipei", "NWT": "NewTaipei"}


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), F.lit(2.0))
    a = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(a))


def local(ts: Column) -> Column:
    """A UTC timestamp as local wall time."""
    return F.from_utc_timestamp(ts, LOCAL_ZONE)


def local_date(ts: Column) -> Column:
    return F.date_format(local(ts), "yyyy-MM-dd")


def time_bucket(local_ts: Column) -> Column:
    """Night before weekend before peak before the rest; the bucket of transfers."""
    h = F.hour(local_ts)
    peak = ((h >= 7) & (h < 9)) | ((h >= 17) & (h < 19))
    return F.when((h < 6) | (h >= 23), "night").when(F.weekday(local_ts) >= 5, "weekend").when(peak, "weekday_peak").otherwise("weekday_offpeak")


def day_type(local_ts: Column) -> Column:
    return F.when(F.weekday(local_ts) >= 5, "weekend").otherwise("weekday")


def band(hour: Column) -> Column:
    """The band of hours of the baseline."""
    return F.when(hour.between(6, 9), "am_peak").when(hour.between(10, 15), "midday").when(hour.between(16, 19), "pm_peak").when(hour.between(20, 22), "evening").otherwise("night")


def poll_mode(hour: Column) -> Column:
    """(mode, seconds between polls) by local hour."""
    deep, night = hour.between(2, 3), (hour >= 22) | (hour < 6)
    return F.struct(F.when(deep, "deep_night").when(night, "night").otherwise("day").alias("mode"), F.when(deep, 150).when(night, 15).otherwise(5).alias("interval_s"))


def packed_offset(partition: Column, offset: Column) -> Column:
    """Partition and offset of a message in one long."""
    return F.shiftleft(partition.cast("long"), 48).bitwiseOR(offset.cast("long"))


def content_hash(*columns: str) -> Column:
    """First 12 digits of the SHA-256 of the columns as JSON, in the order of their names."""
    return F.substring(F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256), 1, 12)


def city_of(uid: Column) -> Column:
    """The city of an identifier's prefix; an unknown prefix raises."""
    prefix, out = F.substring(uid, 1, 3), F.raise_error(F.concat(F.lit("unknown prefix: "), F.coalesce(uid, F.lit("null")))).cast("string")
    for known, city in CITY_OF_PREFIX.items():
        out = F.when(prefix == known, city).otherwise(out)
    return out


def natural_order(name: Column) -> list[Column]:
    """Names that begin with a number first, by the number; then by name."""
    number = F.regexp_substr(name, F.lit("^[0-9]+")).try_cast("long")
    return [F.when(name.rlike("^[0-9]"), 0).otherwise(1).asc(), number.asc_nulls_last(), name.asc()]


def seconds_between(earlier: Column, later: Column) -> Column:
    """Whole seconds between timestamps, cut toward 0."""
    return ((F.unix_micros(later) - F.unix_micros(earlier)) / 1_000_000).cast("long")


SQL_FUNCTIONS = {
    "haversine_m(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE": f"2 * {EARTH_RADIUS_M} * asin(sqrt(pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)))",
    "time_bucket(t TIMESTAMP) RETURNS STRING": "CASE WHEN hour(t) < 6 OR hour(t) >= 23 THEN 'night' WHEN weekday(t) >= 5 THEN 'weekend' WHEN hour(t) IN (7, 8, 17, 18) THEN 'weekday_peak' ELSE 'weekday_offpeak' END",
    "hour_band(h INT) RETURNS STRING": "CASE WHEN h BETWEEN 6 AND 9 THEN 'am_peak' WHEN h BETWEEN 10 AND 15 THEN 'midday' WHEN h BETWEEN 16 AND 19 THEN 'pm_peak' WHEN h BETWEEN 20 AND 22 THEN 'evening' ELSE 'night' END",
}


def register_sql(spark: SparkSession) -> None:
    """The functions above as temporary SQL functions."""
    for signature, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
