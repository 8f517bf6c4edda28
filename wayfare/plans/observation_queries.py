"""Queries over positions: normalizing, filters, scalar functions, de-duplication, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import arrivals as A
from ..operators import dimensions as D
from ..operators import observations as O
from ..schemas import RAW_POSITION, conform, drift
from ..sources.lake import numbered
from .fixtures import ARRIVALS, POSITIONS, STOPS, arrivals, micros, positions, stops, table
from .registry import query


@query(f"""WITH {POSITIONS} SELECT obs_id, plate_numb, route_uid, sub_route_uid, direction, city, duty_status, round(lat, 6) AS lat, lon, '0' || speed AS operator_no,
    us // 1000000 AS gps_s, update_us // 1000000 AS update_s, speed FROM positions""")
def positions_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as the feed sends them, decoded with a fixed schema and normalized."""
    p = positions(spark, sf_dir)
    iso = lambda c: F.date_format(F.timestamp_micros(F.col(c) + 123_000), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    message = F.to_json(F.struct(
        F.col("plate_numb").alias("PlateNumb"), F.concat(F.lit("0"), F.col("speed").cast("string")).alias("OperatorNo"), F.col("route_uid").alias("RouteUID"), F.col("sub_route_uid").alias("SubRouteUID"),
        F.col("direction").alias("Direction"), F.struct(F.col("lat").alias("PositionLat"), F.col("lon").alias("PositionLon")).alias("BusPosition"), F.col("speed").alias("Speed"),
        F.col("duty_status").alias("DutyStatus"), iso("gps_us").alias("GPSTime"), iso("update_us").alias("UpdateTime"), F.lit("x").alias("Unknown"),
    ))
    raw = p.select("obs_id", "city", F.from_json(message, RAW_POSITION).alias("m")).select("obs_id", "city", "m.*")
    normal = O.normalize(raw.withColumn("SubRouteID", F.col("obs_id").cast("string")))  # carries the id
    return normal.select(F.col("sub_route_id").cast("long").alias("obs_id"), "plate_numb", "route_uid", "sub_route_uid", "direction", "city", "duty_status", F.round("lat", 6).alias("lat"), "lon", "operator_no", F.unix_seconds("gps_time").alias("gps_s"), F.unix_seconds("update_time").alias("update_s"), "speed")


@query(f"""WITH {POSITIONS} SELECT obs_id, round(lat, 6) AS lat, data_date FROM (SELECT *, strftime(make_timestamp(us) + INTERVAL 8 HOUR, '%Y-%m-%d') AS data_date FROM positions)
    WHERE duty_status = 1 AND lat IS NOT NULL AND data_date = (SELECT min(strftime(make_timestamp(us) + INTERVAL 8 HOUR, '%Y-%m-%d')) FROM positions)""")
def in_service_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In-service positions with coordinates on the first local date."""
    p = positions(spark, sf_dir).withColumns({"at": F.timestamp_micros("us"), "data_date": C.local_date(F.timestamp_micros("us"))})
    first = p.agg(F.min("data_date").alias("first"))
    rows = O.with_coordinates(O.in_service(p)).join(F.broadcast(first))  # one row
    return O.on_local_date(rows, "at", date_col="first").select("obs_id", F.round("lat", 6).alias("lat"), "data_date")


@query(f"""WITH {POSITIONS} SELECT obs_id, coalesce(lat < 24 OR lat > 26 OR lon < 120 OR lon > 123, false) AS bad_coordinates, speed > 100 AS bad_speed,
    bus_status IS NULL OR bus_status NOT IN (0, 99) AS status_other, coalesce(bus_status IN (1, 2, 4, 98, 101), false) AS status_abnormal, coalesce(bus_status IN (3, 100), false) AS status_traffic FROM positions""")
def outlier_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = ["bad_coordinates", "bad_speed", "status_other", "status_abnormal", "status_traffic"]
    out = O.outlier_flags(positions(spark, sf_dir)).withColumn("bad_coordinates", F.coalesce("bad_coordinates", F.lit(False)))
    return out.select("obs_id", *flags)


@query(f"""WITH {ARRIVALS} SELECT event_id, CASE WHEN hour(lt) < 6 OR hour(lt) >= 23 THEN 'night' WHEN isodow(lt) >= 6 THEN 'weekend' WHEN hour(lt) IN (7, 8, 17, 18) THEN 'weekday_peak' ELSE 'weekday_offpeak' END AS bucket,
    CASE WHEN hour(lt) BETWEEN 6 AND 9 THEN 'am_peak' WHEN hour(lt) BETWEEN 10 AND 15 THEN 'midday' WHEN hour(lt) BETWEEN 16 AND 19 THEN 'pm_peak' WHEN hour(lt) BETWEEN 20 AND 22 THEN 'evening' ELSE 'night' END AS band,
    CASE WHEN isodow(lt) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type, data_date, CAST(hour(lt) AS INT) AS hr,
    CASE WHEN hour(lt) IN (2, 3) THEN 'deep_night' WHEN hour(lt) >= 22 OR hour(lt) < 6 THEN 'night' ELSE 'day' END AS mode,
    CAST(CASE WHEN hour(lt) IN (2, 3) THEN 150 WHEN hour(lt) >= 22 OR hour(lt) < 6 THEN 15 ELSE 5 END AS INT) AS interval_s FROM arrivals""")
def time_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = C.local(F.timestamp_micros("us"))
    hour = F.hour(at)
    return arrivals(spark, sf_dir).select("event_id", C.time_bucket(at).alias("bucket"), C.band(hour).alias("band"), C.day_type(at).alias("day_type"), "data_date", hour.alias("hr"), C.poll_mode(hour)["mode"].alias("mode"), C.poll_mode(hour)["interval_s"].alias("interval_s"))


_HAVERSINE = "2 * 6371000.0 * asin(sqrt(pow(sin(radians(s.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - p.lon) / 2), 2)))"


@query(f"""WITH {POSITIONS}, {STOPS} SELECT obs_id, round(dist, 3) AS dist, seq, station_id FROM (
    SELECT obs_id, s.seq, s.station_id, {_HAVERSINE} AS dist, row_number() OVER (PARTITION BY obs_id ORDER BY {_HAVERSINE}, s.seq) AS k
    FROM positions p JOIN stops s ON p.sub_route_uid = s.sub_route_uid AND p.direction = s.direction WHERE p.lat IS NOT NULL) WHERE k = 1""")
def haversine_nearest_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.nearest_stops(O.with_coordinates(positions(spark, sf_dir)), stops(spark, sf_dir)).withColumn("dist", F.round("dist", 3))


@query(f"WITH {POSITIONS} SELECT obs_id, (CAST(kafka_partition AS BIGINT) << 48) | kafka_offset AS packed FROM positions")
def packed_kafka_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions(spark, sf_dir).select("obs_id", C.packed_offset(F.col("kafka_partition"), F.col("kafka_offset")).alias("packed"))


@query("""WITH e AS (SELECT event_id, epoch_us(ts) AS us, user_id FROM events), s AS (SELECT min(us) + 432000000000 AS start FROM e), live AS (SELECT event_id, us FROM e, s WHERE us >= start),
    history AS (SELECT event_id, CASE WHEN user_id % 7 = 0 THEN NULL ELSE us END AS us FROM e, s WHERE us < start + 3600000000)
    SELECT event_id, us FROM history WHERE us IS NULL OR us < (SELECT min(us) FROM live) UNION ALL SELECT * FROM live""")
def null_safe_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history that goes on for an hour into the live rows, the times of some users unknown."""
    e = table(spark, sf_dir, "events").select("event_id", micros("ts").alias("us"), "user_id")
    timed = e.crossJoin(F.broadcast(e.agg((F.min("us") + 5 * 86_400_000_000).alias("_from"))))  # one row
    live = timed.where("us >= _from").select("event_id", "us")
    history = timed.where("us < _from + 3600000000").select("event_id", F.when(F.col("user_id") % 7 != 0, F.col("us")).alias("us"))
    return O.merge_at_cutover(history, live, "us")


@query("""SELECT name, CAST(row_number() OVER (ORDER BY CASE WHEN regexp_matches(name, '^[0-9]') THEN 0 ELSE 1 END, TRY_CAST(nullif(regexp_extract(name, '^[0-9]+'), '') AS BIGINT) NULLS LAST, name) AS INT) AS place
    FROM (SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE (p_size || ' ' || p_brand) END AS name FROM part) ORDER BY place""")
def natural_route_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All names in natural order, numbered. Names go into ranges of that order, each
    numbered by itself from where the ranges before it end, so no task holds all."""
    part = table(spark, sf_dir, "part")
    names = part.select(F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(" "), "p_brand")).alias("name")).distinct()
    return numbered(names, C.natural_order(F.col("name")), "place").select("name", "place").orderBy("place")


@query(f"WITH {STOPS} SELECT DISTINCT sub_route_uid, city FROM stops")
def city_from_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stops(spark, sf_dir).select("sub_route_uid", C.city_of(F.col("sub_route_uid")).alias("city")).distinct()


@query("""SELECT n_nationkey, substr(sha256('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}'), 1, 12) AS content_hash FROM nation""")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", C.content_hash("n_regionkey", "n_name", "n_nationkey").alias("content_hash"))


_REPLAYED = f"""{POSITIONS}, replayed AS (SELECT *, 'first' AS consume_time FROM positions UNION ALL SELECT *, 'second' FROM positions WHERE obs_id % 7 = 0)"""


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = positions(spark, sf_dir)
    return p.withColumn("consume_time", F.lit("first")).unionByName(p.where("obs_id % 7 = 0").withColumn("consume_time", F.lit("second")))


@query(f"""WITH {POSITIONS} SELECT plate_numb, sub_route_uid, snapshot_us, obs_id FROM (SELECT *, row_number() OVER (PARTITION BY plate_numb, sub_route_uid, direction, snapshot_us ORDER BY us, kafka_partition, kafka_offset) AS k FROM positions) WHERE k = 1""")
def dedup_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first observation of each vehicle, route and snapshot."""
    rows = O.keep_first(positions(spark, sf_dir), ["plate_numb", "sub_route_uid", "direction", "snapshot_us"], ["us", "kafka_partition", "kafka_offset"])
    return rows.select("plate_numb", "sub_route_uid", "snapshot_us", "obs_id")


@query(f"WITH {_REPLAYED} SELECT kafka_partition, kafka_offset, min(obs_id) AS obs_id, min(consume_time) AS consume_time FROM replayed GROUP BY 1, 2")
def compact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each message of a log in which a part was sent twice."""
    return O.dedup_messages(_replayed(spark, sf_dir)).select("kafka_partition", "kafka_offset", "obs_id", "consume_time")


@query("""SELECT 'S' || (user_id % 50) AS station_id FROM events WHERE event_type IN ('click', 'view') INTERSECT SELECT 'S' || (user_id % 70) FROM events WHERE event_type = 'purchase'""")
def station_overlap_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    station = lambda n: F.concat(F.lit("S"), (F.col("user_id") % n).cast("string")).alias("station_id")
    return e.where("event_type in ('click', 'view')").select(station(50)).intersect(e.where("event_type = 'purchase'").select(station(70)))


@query("""SELECT * FROM (VALUES ('extra', 'props'), ('extra', 'ts'), ('missing', 'arrival_time'), ('missing', 'city')) t(kind, name)""")
def schema_drift_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the columns of events miss of an expected list, and have beyond it."""
    found = drift(table(spark, sf_dir, "events").columns, ["event_id", "user_id", "event_type", "value", "arrival_time", "city"])
    return spark.createDataFrame([(kind, name) for kind, names in found.items() for name in names], "kind string, name string")


@query("""SELECT event_id AS id, event_type AS kind, 'event' AS origin, CAST(NULL AS INT) AS direction FROM events
    UNION ALL SELECT n_nationkey, n_name, 'nation', CAST(NULL AS INT) FROM nation""")
def union_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables brought to one schema: constants win, missing columns are null."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("origin", T.StringType()), T.StructField("direction", T.IntegerType())])
    e = table(spark, sf_dir, "events").withColumnsRenamed({"event_id": "id", "event_type": "kind"})
    n = table(spark, sf_dir, "nation").withColumnsRenamed({"n_nationkey": "id", "n_name": "kind"})
    return conform(e, schema, {"origin": "event"}).unionByName(conform(n, schema, {"origin": "nation"}))


@query(f"""WITH {STOPS}, open_stops AS (SELECT 'stop' || idx AS stop_uid, 'St' || (idx % 9) AS station_id, sub_route_uid, city FROM stops),
    first AS (SELECT station_id, stop_uid, min(sub_route_uid) FILTER (city = 'Taipei') AS t, min(sub_route_uid) AS any_ FROM open_stops GROUP BY 1, 2)
    SELECT station_id, count(*) AS route_count, count(DISTINCT coalesce(t, any_)) AS unique_route_count, string_agg(DISTINCT coalesce(t, any_), ',' ORDER BY coalesce(t, any_)) AS unique_routes FROM first GROUP BY 1""")
def station_routes_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations united from what both cities report; of equal stops the first city's stays."""
    s = stops(spark, sf_dir).select(F.concat(F.lit("St"), (F.col("idx") % 9).cast("string")).alias("station_id"), F.concat(F.lit("stop"), F.col("idx").cast("string")).alias("stop_uid"), F.lit("0").alias("stop_id"), F.col("sub_route_uid").alias("route_uid"), F.lit("r").alias("route_name"), F.lit("n").alias("name"), F.lit(25.0).alias("lat"), F.lit(121.5).alias("lon"), F.col("city").alias("authority"))
    out = D.union_stations(s, F.lit("2024-01-01").cast("timestamp"))
    return out.select("station_id", F.col("route_count").cast("long").alias("route_count"), F.col("unique_route_count").cast("long").alias("unique_route_count"), F.array_join("unique_routes", ",").alias("unique_routes"))


@query("""SELECT a.k AS id_a, b.k AS id_b FROM (SELECT s_suppkey AS k, 25.0 + (s_suppkey * 37 % 1000) * 0.00002 AS lat, 121.5 + (s_suppkey * 53 % 1000) * 0.00002 AS lon FROM supplier) a
    JOIN (SELECT s_suppkey AS k, 25.0 + (s_suppkey * 37 % 1000) * 0.00002 AS lat, 121.5 + (s_suppkey * 53 % 1000) * 0.00002 AS lon FROM supplier) b ON a.k < b.k
    WHERE 2 * 6371000.0 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) BETWEEN 20 AND 400""")
def opposite_stop_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of stops within a band of distances, met by grid cell."""
    k = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").select(k.alias("id"), (25.0 + (k * 37 % 1000) * 0.00002).alias("lat"), (121.5 + (k * 53 % 1000) * 0.00002).alias("lon"))
    return D.near_pairs(s, 20, 400, 0.004).select("id_a", "id_b")


@query(f"""WITH {STOPS}, bent AS (SELECT sub_route_uid, direction, seq, 25.0 + abs(idx - 12) * 0.003 AS lat, 121.5 + CASE WHEN idx > 12 THEN 0.0005 ELSE 0 END AS lon FROM stops)
    SELECT a.sub_route_uid, a.seq AS seq_a, b.seq AS seq_b FROM bent a JOIN bent b ON a.sub_route_uid = b.sub_route_uid AND a.direction = b.direction AND b.seq - a.seq > 5
    WHERE 2 * 6371000.0 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) < 100""")
def ambiguous_stop_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops of a route that comes back beside itself: near, but far apart in sequence."""
    bent = stops(spark, sf_dir).withColumns({"lat": 25.0 + F.abs(F.col("idx") - 12) * 0.003, "lon": 121.5 + F.when(F.col("idx") > 12, 0.0005).otherwise(0.0)})
    return D.ambiguous_stops(bent).select("sub_route_uid", "seq_a", "seq_b")
