"""Queries of data quality and of time series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import arrivals as A
from ..operators import quality as Q
from .fixtures import ARRIVALS, POSITIONS, TRIP_STEPS, arrivals, micros, positions, table, trip_steps
from .registry import query


@query(f"""WITH {POSITIONS}, f AS (SELECT *, (update_us - gps_us) / 1000000.0::DOUBLE AS delay_s, coalesce(lat < 24 OR lat > 26 OR lon < 120 OR lon > 123, false) AS bad FROM positions)
    SELECT city, count(*) AS raw_records, count(DISTINCT (plate_numb, route_uid, direction, gps_us)) AS dedup_records, count(DISTINCT plate_numb) AS distinct_vehicles, count(DISTINCT route_uid) AS distinct_routes,
      count(*) FILTER (duty_status = 2) AS duty_2, count(*) FILTER (bus_status = 99) AS status_99, count(*) FILTER (bus_status IS NULL OR bus_status NOT IN (0, 99)) AS status_other,
      count(*) FILTER (bus_status IN (1, 2, 4, 98, 101)) AS status_abnormal, count(*) FILTER (bus_status IN (3, 100)) AS status_traffic, count(DISTINCT plate_numb) FILTER (bus_status = 2) AS status_2_vehicles,
      count(*) FILTER (bad) AS bad_count, count(*) FILTER (speed > 100) AS bad_speed_count, count(DISTINCT plate_numb) FILTER (speed > 100) AS bad_speed_vehicles,
      round(quantile_cont(delay_s, 0.5), 6) AS delay_median_s, round(quantile_cont(delay_s, 0.95), 6) AS delay_p95_s, max(delay_s) AS delay_max_s,
      round(count(DISTINCT (plate_numb, route_uid, direction, gps_us)) / count(*)::DOUBLE, 6) AS dedup_ratio FROM f GROUP BY city""")
def quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.profile(positions(spark, sf_dir))


@query(f"WITH {POSITIONS} SELECT count(*) FILTER (lat IS NULL) AS lat, count(*) FILTER (bus_status IS NULL) AS bus_status, count(*) FILTER (lon IS NULL) AS lon, count(*) FILTER (lat IS NULL) + count(*) FILTER (bus_status IS NULL) + count(*) FILTER (lon IS NULL) AS null_total FROM positions")
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.null_counts(positions(spark, sf_dir), ["lat", "bus_status", "lon"]).drop("null_counts")


@query(f"""WITH {POSITIONS}, snaps AS (SELECT city, snapshot_us, count(*) AS n FROM positions GROUP BY 1, 2), gaps AS (SELECT *, (snapshot_us - lag(snapshot_us) OVER (PARTITION BY city ORDER BY snapshot_us)) / 1000000.0::DOUBLE AS gap_s FROM snaps)
    SELECT city, count(*) AS snapshots, min(n) AS n_min, round(quantile_cont(n::DOUBLE, 0.5), 6) AS n_median, max(n) AS n_max, round(quantile_cont(gap_s, 0.5), 6) AS gap_median_s, max(gap_s) AS gap_max_s, count(*) FILTER (gap_s > 60) AS gaps_over FROM gaps GROUP BY city""")
def snapshot_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.snapshot_gaps(positions(spark, sf_dir), ["city"], "snapshot_us")


@query("""WITH p AS (SELECT event_type, epoch_us(ts) AS us, value, lead(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY ts) AS nxt FROM events)
    SELECT event_type, us, round(value, 6) AS value FROM p UNION ALL SELECT event_type, us + 1000000, NULL FROM p WHERE nxt - us > 60000000""")
def gap_break_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of a chart of each event type, with breaks."""
    points = table(spark, sf_dir, "events").select("event_type", micros("ts").alias("us"), F.round("value", 6).alias("value"))
    return Q.break_gaps(points, ["event_type"], "us", "value")


@query(f"WITH {POSITIONS} SELECT plate_numb, count(*) AS n FROM positions WHERE coalesce(lat > 26, false) OR speed > 100 GROUP BY 1 ORDER BY n DESC, plate_numb LIMIT 5")
def top_offenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.top_values(positions(spark, sf_dir).where("lat > 26 or speed > 100"), "plate_numb", 5)


@query(f"WITH {POSITIONS} SELECT plate_numb, count(*) AS n, min(us) AS start_us, max(us) AS end_us, round((max(us) - min(us)) / 60000000.0::DOUBLE, 2) AS span_min FROM positions GROUP BY 1 ORDER BY n DESC, plate_numb LIMIT 15")
def vehicle_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.vehicle_spans(positions(spark, sf_dir), 15)


@query(f"""WITH {POSITIONS}, h AS (SELECT city, us // 3600000000 AS hour, count(DISTINCT plate_numb) AS vehicles, count(DISTINCT snapshot_us) AS snapshots FROM positions GROUP BY 1, 2),
    u AS (SELECT city, quantile_cont(snapshots::DOUBLE, 0.5) AS usual FROM h GROUP BY 1) SELECT h.city, hour, vehicles, snapshots, snapshots < 0.9 * usual AS incomplete FROM h JOIN u ON h.city = u.city""")
def hourly_active_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.hourly_vehicles(positions(spark, sf_dir), ["city"], F.floor(F.col("us") / 3_600_000_000), "snapshot_us")


@query(f"""WITH {POSITIONS}, g AS (SELECT city, (us - lag(us) OVER (PARTITION BY city, plate_numb ORDER BY us)) / 1000000.0::DOUBLE AS gap_s FROM positions)
    SELECT city, count(*) AS n, round(quantile_cont(gap_s, 0.5), 6) AS p50_s, round(quantile_cont(gap_s, 0.9), 6) AS p90_s, round(round(quantile_cont(gap_s, 0.9), 6) / round(quantile_cont(gap_s, 0.5), 6), 6) AS ratio FROM g WHERE gap_s > 0 GROUP BY 1""")
def sampling_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.sampling_health(positions(spark, sf_dir), ["city"], "us")


@query(f"""WITH {POSITIONS}, d AS (SELECT DISTINCT city, us FROM positions), g AS (SELECT city, us, us // 3600000000 AS hour, (us - lag(us) OVER (PARTITION BY city ORDER BY us)) / 1000000.0::DOUBLE AS gap_s FROM d),
    u AS (SELECT city, hour, round(quantile_cont(gap_s, 0.5), 6) AS usual_s FROM g WHERE gap_s IS NOT NULL GROUP BY 1, 2)
    SELECT g.city, g.hour, us, gap_s, usual_s FROM g JOIN u ON g.city = u.city AND g.hour = u.hour WHERE gap_s > 3 * usual_s""")
def adaptive_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.adaptive_gaps(positions(spark, sf_dir), ["city"], "us").select("city", "hour", "us", "gap_s", "usual_s")


@query("WITH t AS (SELECT 'V' || (user_id % 40) AS vehicle, hour(ts + INTERVAL 8 HOUR) AS h FROM events) SELECT vehicle, " + ", ".join(f"count(*) FILTER (h = {h}) AS h{h:02d}" for h in range(24)) + " FROM t GROUP BY 1")
def hour_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("V"), (F.col("user_id") % 40).cast("string")).alias("vehicle"), micros("ts").alias("us"))
    return Q.hour_crosstab(e, "vehicle", F.hour(C.local(F.timestamp_micros("us"))))


@query(f"""WITH {ARRIVALS} SELECT data_date, count(*) FILTER (city = 'NewTaipei') AS n_one, count(*) FILTER (city = 'Taipei') AS n_other,
    round(count(*) FILTER (city = 'NewTaipei')::DOUBLE / nullif(count(*) FILTER (city = 'Taipei'), 0), 6) AS ratio FROM arrivals GROUP BY 1""")
def city_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.ratio_of_cities(arrivals(spark, sf_dir), "data_date", "NewTaipei", "Taipei")


@query("""WITH c(city) AS (VALUES ('Taipei'), ('NewTaipei')), d AS (SELECT strftime(unnest(generate_series(DATE '2024-01-01', DATE '2024-02-10', INTERVAL 1 DAY)), '%Y-%m-%d') AS data_date)
    SELECT city, data_date FROM c, d WHERE (city, data_date) NOT IN (SELECT CASE WHEN user_id % 2 = 0 THEN 'Taipei' ELSE 'NewTaipei' END, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') FROM events WHERE user_id % 10 < 2 OR day(ts) % 3 > 0)""")
def missing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where((F.col("user_id") % 10 < 2) | (F.day("ts") % 3 > 0)).select(F.when(F.col("user_id") % 2 == 0, "Taipei").otherwise("NewTaipei").alias("city"), C.local_date(F.timestamp_micros(micros("ts"))).alias("data_date"))
    cities = spark.createDataFrame([("Taipei",), ("NewTaipei",)], "city string")
    return Q.missing_partitions(e, cities, "2024-01-01", "2024-02-10")


@query(f"WITH {TRIP_STEPS} SELECT event_id, round((us - min(us) OVER (PARTITION BY trip_id)) / 1000000.0::DOUBLE, 6) AS elapsed_s FROM trip_steps")
def elapsed_since_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.elapsed(trip_steps(spark, sf_dir), ["trip_id"], "us").select("event_id", F.round("elapsed_s", 6).alias("elapsed_s"))


_VISIT = "us - lag(us) OVER w > 1200000000 OR seq // 3 <> lag(seq // 3) OVER w OR trip_id <> lag(trip_id) OVER w"


@query(f"""WITH {TRIP_STEPS}, f AS (SELECT *, CASE WHEN lag(us) OVER w IS NULL OR {_VISIT} THEN 1 ELSE 0 END AS new FROM trip_steps WINDOW w AS (PARTITION BY plate_numb ORDER BY us, event_id)),
    s AS (SELECT *, sum(new) OVER (PARTITION BY plate_numb ORDER BY us, event_id) AS event FROM f)
    SELECT plate_numb, CAST(event AS BIGINT) AS event, min(us) AS start_us, count(*) AS n_obs, round((max(us) - min(us)) / 1000000.0::DOUBLE, 6) AS dwell_s, min(min_speed) AS min_speed FROM s GROUP BY 1, 2""")
def arrival_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits: a new one with another stop, another trip, or after 20 minutes."""
    rows = trip_steps(spark, sf_dir).withColumn("stop", F.floor(F.col("seq") / 3))
    found = A.sessions(rows, ["plate_numb"], "us", "stop", "trip_id", 1200, ["event_id"])
    return found.groupBy("plate_numb", "event").agg(F.min("us").alias("start_us"), F.count("*").alias("n_obs"), F.round((F.max("us") - F.min("us")) / 1_000_000, 6).alias("dwell_s"), F.min("min_speed").alias("min_speed"))


@query(f"""WITH {TRIP_STEPS}, f AS (SELECT *, CASE WHEN seq - lag(seq) OVER w < -5 OR us - lag(us) OVER w > 1800000000 THEN 1 ELSE 0 END AS new FROM trip_steps WINDOW w AS (PARTITION BY sub_route_uid, direction, plate_numb ORDER BY us, seq))
    SELECT event_id, CAST(sum(new) OVER (PARTITION BY sub_route_uid, direction, plate_numb ORDER BY us, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS trip FROM f""")
def trip_split_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.trips_v1(trip_steps(spark, sf_dir)).select("event_id", "trip")
