"""Quality metrics of a day's positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import HOUR_US, lagged
from .observations import outlier_flags

MAX_GAP_S = 60


def _quantile(column: str, q: float) -> Column:
    """Interpolated quantile, rounded as engines differ in the last digit."""
    return F.round(F.percentile(column, q), 6)


def profile(df: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    """Counts, duplicates, delays and status of positions (plate_numb, route_uid, direction,
    gps_us, update_us, ...), one row for each key.

    Rows are reduced to messages, these to vehicles, and these to the key, so that distinct
    counts are counts of rows and a key of very many rows is no single group until few are
    left. Delays and routes are counted by value before quantiles are taken."""
    flagged = outlier_flags(df).withColumn("delay_s", (F.col("update_us") - F.col("gps_us")) / 1_000_000)
    counted = {"raw_records": F.lit(True), "duty_2": F.col("duty_status") == 2, "status_99": F.col("bus_status") == 99, "status_other": F.col("status_other"), "status_abnormal": F.col("status_abnormal"), "status_traffic": F.col("status_traffic"), "bad_count": F.col("bad_coordinates"), "bad_speed_count": F.col("bad_speed")}
    met = {"status_2_vehicles": F.col("bus_status") == 2, "bad_speed_vehicles": F.col("bad_speed")}
    message = flagged.groupBy(*keys, "plate_numb", "route_uid", "direction", "gps_us").agg(*[F.count_if(c).alias(n) for n, c in counted.items()], *[F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in met.items()])
    vehicle = message.groupBy(*keys, "plate_numb").agg(F.count("*").alias("dedup_records"), *[F.sum(n).alias(n) for n in counted], *[F.bool_or(n).alias(n) for n in met])
    known = F.col("plate_numb").isNotNull()
    whole = vehicle.groupBy(*keys).agg(F.sum("dedup_records").alias("dedup_records"), F.count("plate_numb").alias("distinct_vehicles"), *[F.sum(n).alias(n) for n in counted], *[F.count_if(F.col(n) & known).alias(n) for n in met])
    routes = flagged.groupBy(*keys, "route_uid").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.count("route_uid").alias("distinct_routes"))
    delays = flagged.groupBy(*keys, "delay_s").agg(F.count("*").alias("n")).groupBy(*keys).agg(*[F.round(F.percentile("delay_s", q, F.col("n")), 6).alias(n) for q, n in ((0.5, "delay_median_s"), (0.95, "delay_p95_s"))], F.max("delay_s").alias("delay_max_s"))
    out = whole
    for part in (routes, delays):  # a row for each key
        other = part.toDF(*[f"_{k}" for k in keys], *part.columns[len(keys) :])
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        out = out.join(other, same).drop(*[f"_{k}" for k in keys])
    out = out.withColumn("dedup_ratio", F.round(F.col("dedup_records") / F.col("raw_records"), 6))
    return out.select(*keys, "raw_records", "dedup_records", "distinct_vehicles", "distinct_routes", "duty_2", "status_99", "status_other", "status_abnormal", "status_traffic", "status_2_vehicles", "bad_count", "bad_speed_count", "bad_speed_vehicles", "delay_median_s", "delay_p95_s", "delay_max_s", "dedup_ratio")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the nulls of each column, as a map of those that have any, and in all."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = F.filter(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).alias("v")) for c in columns]), lambda e: e["v"] > 0)
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return counts.select(F.map_from_entries(entries).alias("null_counts"), total.alias("null_total"), *columns)


def snapshot_gaps(df: DataFrame, keys: Sequence[str], snapshot: str) -> DataFrame:
    """Rows of snapshots and the gaps between successive ones. Rows are reduced to snapshots
    before anything is ordered."""
    w = Window.partitionBy(*keys).orderBy(snapshot)
    snaps = df.groupBy(*keys, snapshot).agg(F.count("*").alias("n")).withColumn("gap_s", (F.col(snapshot) - F.lag(snapshot).over(w)) / 1_000_000)
    return snaps.groupBy(*keys).agg(F.count("*").alias("snapshots"), F.min("n").alias("n_min"), _quantile("n", 0.5).alias("n_median"), F.max("n").alias("n_max"), _quantile("gap_s", 0.5).alias("gap_median_s"), F.max("gap_s").alias("gap_max_s"), F.count_if(F.col("gap_s") > MAX_GAP_S).alias("gaps_over"))


def break_gaps(df: DataFrame, keys: Sequence[str], at: str, value: str, gap_s: int = MAX_GAP_S) -> DataFrame:
    """Points of a line chart, with a point without a value one second into each long gap.

    The next point is looked for in the hour, and after its last point in the hours that
    follow, of which a table has one row each: no task holds a line."""
    hour = F.floor(F.col(at) / 3_600_000_000)
    rows = df.select(*keys, at, value).withColumn("_hour", hour)
    after = Window.partitionBy(*keys).orderBy("_hour")
    hours = rows.groupBy(*keys, "_hour").agg(F.min(at).alias("_first")).withColumn("_later", F.lead("_first").over(after))
    same = [F.col(f"rows.{k}").eqNullSafe(F.col(f"hours.{k}")) for k in (*keys, "_hour")]
    w = Window.partitionBy(*keys, "_hour").orderBy(at)
    near = rows.withColumn("_near", F.lead(at).over(w))
    marked = near.alias("rows").join(hours.alias("hours"), same, "left").select("rows.*", F.coalesce("_near", "_later").alias("_next"))
    own = F.struct(F.col(at).alias("at"), F.col(value).alias("value"))
    hole = F.struct((F.col(at) + 1_000_000).alias("at"), F.lit(None).cast(df.schema[value].dataType).alias("value"))
    points = F.when(F.col("_next") - F.col(at) > gap_s * 1_000_000, F.array(own, hole)).otherwise(F.array(own))
    return marked.select(*keys, F.explode(points).alias("p")).select(*keys, F.col("p.at").alias(at), F.col("p.value").alias(value))


def adaptive_gaps(df: DataFrame, keys: Sequence[str], at: str, factor: float = 3.0, span_us: int | None = HOUR_US) -> DataFrame:
    """Gaps longer than factor times the median gap of their hour. Lines are cut into blocks, as
    a city's times are all in one."""
    timed = lagged(df.select(*keys, at).distinct(), keys, [at], {at: "_before"}, span_us)
    gaps = timed.withColumns({"gap_s": (F.col(at) - F.col("_before")) / 1_000_000, "hour": F.floor(F.col(at) / HOUR_US)}).where("gap_s is not null").drop("_before")
    usual = gaps.groupBy(*keys, "hour").agg(_quantile("gap_s", 0.5).alias("usual_s"))
    return gaps.join(usual, [*keys, "hour"]).where(F.col("gap_s") > factor * F.col("usual_s"))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, ties by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(k)


def vehicle_spans(df: DataFrame, k: int, vehicle: str = "plate_numb", at: str = "us") -> DataFrame:
    """The k vehicles with most rows, and the minutes they span."""
    return df.groupBy(vehicle).agg(F.count("*").alias("n"), F.min(at).alias("start_us"), F.max(at).alias("end_us")).withColumn("span_min", F.round((F.col("end_us") - F.col("start_us")) / 60_000_000, 2)).orderBy(F.desc("n"), vehicle).limit(k)


def hourly_vehicles(df: DataFrame, keys: Sequence[str], hour: Column, snapshot: str, least: float = 0.9) -> DataFrame:
    """Vehicles and snapshots of each hour; an hour with fewer than least times the median
    number of snapshots is incomplete."""
    hours = df.groupBy(*keys, hour.alias("hour")).agg(F.count_distinct("plate_numb").alias("vehicles"), F.count_distinct(snapshot).alias("snapshots"))
    usual = hours.groupBy(*keys).agg(F.percentile("snapshots", 0.5).alias("usual"))
    return hours.join(usual, list(keys)).withColumn("incomplete", F.col("snapshots") < least * F.col("usual")).drop("usual")


def sampling_health(df: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """90th percentile over median of the intervals between a vehicle's rows."""
    w = Window.partitionBy(*keys, "plate_numb").orderBy(at)
    gaps = df.withColumn("gap_s", (F.col(at) - F.lag(at).over(w)) / 1_000_000).where("gap_s > 0")
    out = gaps.groupBy(*keys).agg(F.count("*").alias("n"), _quantile("gap_s", 0.5).alias("p50_s"), _quantile("gap_s", 0.9).alias("p90_s"))
    return out.withColumn("ratio", F.round(F.col("p90_s") / F.col("p50_s"), 6))


def hour_crosstab(df: DataFrame, vehicle: str, hour: Column) -> DataFrame:
    """Rows of each vehicle by hour, hours without rows as 0."""
    wide = df.withColumn("_hour", hour).groupBy(vehicle).pivot("_hour", list(range(24)))
    out = wide.agg(F.count(F.lit(1))).na.fill(0)
    return out.withColumnsRenamed({str(h): f"h{h:02d}" for h in range(24)})


def ratio_of_cities(df: DataFrame, day: str, one: str, other: str) -> DataFrame:
    """Rows of two cities by day and their ratio."""
    wide = df.groupBy(day).pivot("city", [one, other]).agg(F.count(F.lit(1))).na.fill(0)
    return wide.select(day, F.col(one).alias("n_one"), F.col(other).alias("n_other"), F.round(F.try_divide(F.col(one).cast("double"), F.col(other).cast("double")), 6).alias("ratio"))


def missing_partitions(present: DataFrame, cities: DataFrame, first: str, last: str) -> DataFrame:
    """(city, data_date) from first to last that have no rows; both lists are small."""
    days = F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")))
    expected = cities.select("city", days.alias("d")).select("city", F.date_format("d", "yyyy-MM-dd").alias("data_date"))
    return expected.join(present.select("city", "data_date").distinct(), ["city", "data_date"], "left_anti")
