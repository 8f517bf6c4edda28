"""Queries of dimensions, trajectories, catalog tables and declarations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import arrivals as A
from ..operators import dimensions as D
from ..operators import observations as O
from ..operators.publish import violations
from ..schemas import RAW_ROUTE
from ..sources.lake import read_table, row_counts, table_metadata, write_clustered, write_table, written
from .fixtures import POSITIONS, STOPS, TRIP_STEPS, VOLUME_STEPS, micros, positions, stops, table, trip_steps, volume_steps
from .registry import query


@query(f"WITH {POSITIONS} SELECT obs_id, plate_numb, us FROM positions WHERE city = 'Taipei' AND plate_numb < 'P3'")
def partitioned_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions as a catalog table, partitioned by city and sorted by vehicle; one partition,
    some vehicles and three columns of it are read."""
    name = f"wayfare_{uuid.uuid4().hex}"
    write_table(positions(spark, sf_dir), name, ["city"], ["plate_numb", "us"])
    return read_table(spark, name, ["obs_id", "plate_numb", "us", "city"]).where("city = 'Taipei' and plate_numb < 'P3'").drop("city")


@query("""SELECT CAST(o_custkey AS BIGINT) AS k, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total, max(c_acctbal) AS balance FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def clustered_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables in buckets by one key, joined by it and grouped by it without a shuffle."""
    o, c = f"wayfare_{uuid.uuid4().hex}", f"wayfare_{uuid.uuid4().hex}"
    write_clustered(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), "o_totalprice", "o_orderdate"), o, ["k"], 8, ["o_orderdate"])
    write_clustered(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_acctbal"), c, ["k"], 8)
    joined = read_table(spark, o, ["k", "o_totalprice"]).hint("merge").join(read_table(spark, c, ["k", "c_acctbal"]), "k")
    return joined.groupBy("k").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.max("c_acctbal").alias("balance"))


_NOON = "timestamp '2024-01-04 04:00:00'"


@query(f"""WITH v AS (SELECT user_id AS k, 'a' AS version_id, timestamp '2024-01-02 00:00:00' AS valid_from, CASE WHEN user_id % 2 = 0 THEN {_NOON} END AS valid_to FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 5 > 0)
    UNION ALL SELECT user_id, 'b', {_NOON}, NULL FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 5 > 0 AND user_id % 2 = 0))
    SELECT event_id, user_id, CASE WHEN ts < timestamp '2024-01-02 00:00:00' AND user_id % 5 > 0 THEN 'a' ELSE (SELECT max(version_id) FROM v WHERE v.k = user_id AND ts >= valid_from AND (valid_to IS NULL OR ts < valid_to)) END AS version_id FROM events""")
def versions_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version that each event's user had at the time: half of them changed at local noon of
    one day, a fifth have none."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    users, time = e.where("user_id % 5 > 0").select("user_id").distinct(), lambda text: F.lit(text).cast("timestamp")
    first, noon = time("2024-01-02 00:00:00"), time("2024-01-04 04:00:00")
    version = lambda df, name, a, b: df.select("user_id", F.lit(name).alias("version_id"), a.alias("valid_from"), b.alias("valid_to"))
    versions = version(users, "a", first, F.when(F.col("user_id") % 2 == 0, noon)).union(version(users.where("user_id % 2 = 0"), "b", noon, F.lit(None).cast("timestamp")))
    return D.version_at(e, versions, ["user_id"], "ts", ["version_id"]).select("event_id", "user_id", "version_id")


@query(f"WITH {TRIP_STEPS} SELECT (SELECT count(*) FROM trip_steps) AS n_rows")
def file_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table's files, added up."""
    return row_counts(written(trip_steps(spark, sf_dir), "steps")).agg(F.sum("n_rows").alias("n_rows"))


@query("SELECT * FROM (VALUES ('city', 'string', true), ('n', 'bigint', false), ('station_id', 'string', false)) t(name, type, is_partition)")
def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the catalog knows of a table's columns."""
    name = f"wayfare_{uuid.uuid4().hex}"
    counts = stops(spark, sf_dir).groupBy("city", "station_id").agg(F.count("*").alias("n"))
    write_table(counts, name, ["city"], ["station_id"])
    return table_metadata(spark, name).select("name", "type", "is_partition")


@query("SELECT 'l_orderkey, l_linenumber not unique' AS rule, count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) HAVING count(*) > 0 UNION ALL SELECT 'l_returnflag has another value', count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') HAVING count(*) > 0")
def declared_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break a declaration of lineitem: its key, and the values of a flag."""
    return violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity"], {"l_returnflag": ["A", "N"]})


@query(f"""WITH {POSITIONS} SELECT obs_id, plate_numb, gps_us, lat, speed FROM (SELECT *, row_number() OVER (PARTITION BY plate_numb, gps_us ORDER BY obs_id) AS k FROM positions WHERE sub_route_uid = 'TPEclick' AND direction = 0) WHERE k = 1""")
def vehicle_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vehicles of one route and direction, each time once."""
    return O.trajectory(positions(spark, sf_dir), "TPEclick", 0).select("obs_id", "plate_numb", "gps_us", "lat", "speed")


_HAVERSINE = "2 * 6371000.0 * asin(sqrt(pow(sin(radians(s.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - p.lon) / 2), 2)))"


@query(f"""WITH {POSITIONS}, {STOPS}, track AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plate_numb, gps_us ORDER BY obs_id) AS k FROM positions WHERE sub_route_uid = 'TPEclick' AND direction = 0) WHERE k = 1 AND lat IS NOT NULL),
    near AS (SELECT * FROM (SELECT p.obs_id, p.plate_numb, p.us, p.speed, s.seq, s.station_id, {_HAVERSINE} AS dist, row_number() OVER (PARTITION BY p.obs_id ORDER BY {_HAVERSINE}, s.seq) AS k FROM track p JOIN stops s ON p.sub_route_uid = s.sub_route_uid AND p.direction = s.direction) WHERE k = 1 AND dist <= 30),
    f AS (SELECT *, CASE WHEN lag(us) OVER w IS NULL OR seq <> lag(seq) OVER w OR us - lag(us) OVER w > 120000000 THEN 1 ELSE 0 END AS new FROM near WINDOW w AS (PARTITION BY plate_numb ORDER BY us, obs_id)),
    e AS (SELECT *, CAST(sum(new) OVER (PARTITION BY plate_numb ORDER BY us, obs_id) AS BIGINT) AS event FROM f)
    SELECT plate_numb, event, min(seq) AS seq, min(station_id) AS station_id, min(us) AS first_us, max(us) AS last_us, count(*) AS n, round(min(dist), 3) AS min_dist, min(speed) AS min_speed, (max(us) - min(us)) / 1000000.0::DOUBLE AS dwell_s FROM e GROUP BY 1, 2""")
def candidate_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a route's observations within 30 m of one stop."""
    track = O.with_coordinates(O.trajectory(positions(spark, sf_dir), "TPEclick", 0))
    near = A.nearest_stops(track, stops(spark, sf_dir).where("sub_route_uid = 'TPEclick'"))
    return A.candidate_visits(track.select("obs_id", "plate_numb", "us", "speed").join(near, "obs_id")).withColumn("min_dist", F.round("min_dist", 3))


def _raw_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops as raw route documents, in no order of their numbers."""
    s = stops(spark, sf_dir)
    name = lambda c: F.struct(c.alias("Zh_tw"), c.alias("En"))
    stop = F.struct(F.col("seq").alias("StopSequence"), F.concat(F.lit("U"), "station_id").alias("StopUID"), F.col("station_id").alias("StopID"), F.col("station_id").alias("StationID"), F.lit(None).cast("string").alias("LocationCityCode"), name(F.col("stop_name")).alias("StopName"), F.col("boarding").alias("StopBoarding"), F.struct(F.col("lat").alias("PositionLat"), F.col("lon").alias("PositionLon"), F.lit(None).cast("string").alias("GeoHash")).alias("StopPosition"))
    docs = s.groupBy("sub_route_uid", "direction").agg(F.array_sort(F.collect_list(F.struct((-F.col("seq")).alias("k"), stop.alias("s")))).alias("x"))
    raw = docs.select(F.col("sub_route_uid").alias("SubRouteUID"), F.substring("sub_route_uid", 4, 99).alias("RouteUID"), F.lit("1").alias("VersionID"), F.lit("2024-01-01").alias("UpdateTime"), F.col("direction").cast("int").alias("Direction"), name(F.concat(F.lit("r "), "sub_route_uid")).alias("RouteName"), name(F.col("sub_route_uid")).alias("SubRouteName"), F.array().cast(RAW_ROUTE["Operators"].dataType).alias("Operators"), F.col("x.s").alias("Stops"))
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_ROUTE])


def _route_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.build_route_stops(_raw_routes(spark, sf_dir), F.lit("2024-01-01").cast("timestamp"), "Taipei")


@query(f"WITH {STOPS} SELECT sub_route_uid || '_0_1' AS _id, sub_route_uid, CAST(count(*) AS INT) AS stop_count, string_agg(station_id, ',' ORDER BY seq) AS stations, 'r ' || sub_route_uid AS route_name FROM stops GROUP BY sub_route_uid")
def route_stops_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw route documents as versions, with their stops in order."""
    return _route_stops(spark, sf_dir).select("_id", "sub_route_uid", "stop_count", F.array_join("stops.station_id", ",").alias("stations"), "route_name")


@query(f"WITH {STOPS} SELECT city, 'r ' || sub_route_uid AS route_name, sub_route_uid, seq, station_id, stop_name, boarding, version_id FROM stops")
def serving_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of routes flattened to one row for each stop."""
    return D.serving_rows(_route_stops(spark, sf_dir)).select("city", "route_name", "sub_route_uid", "seq", "station_id", "stop_name", "boarding", "version_id")


@query("""SELECT event_id, CASE WHEN h BETWEEN 2 AND 3 THEN 'deep_night' WHEN h >= 22 OR h < 6 THEN 'night' ELSE 'day' END AS mode, CASE WHEN h BETWEEN 2 AND 3 THEN 150 WHEN h >= 22 OR h < 6 THEN 15 ELSE 5 END AS interval_s
    FROM (SELECT event_id, hour(ts + INTERVAL 8 HOUR) AS h FROM events)""")
def polling_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collector's mode at the local hour of each event."""
    mode = C.poll_mode(F.hour(C.local(F.timestamp_micros(micros("ts")))))
    return table(spark, sf_dir, "events").select("event_id", mode.alias("m")).select("event_id", "m.*")


@query("SELECT count(*) AS n_rows, count(DISTINCT p_name) AS n_distinct, max(length(p_name)) AS longest_chars, max(strlen(p_name)) AS longest_bytes, max(length(p_name)) <= 12 AS fits FROM part")
def name_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether part names have room in 12 characters."""
    return D.length_checks(table(spark, sf_dir, "part"), "p_name", 12)


#: Stops in pairs, some 30 m apart: of every three pairs one has equal bearings, of every five
#: one has names that have nothing in common.
_SIDES = """SELECT s_suppkey AS id, 25.0 + (s_suppkey // 2) * 0.002 AS lat, 121.5 + (s_suppkey % 2) * 0.0003 AS lon,
    CASE WHEN s_suppkey % 2 = 0 OR s_suppkey // 2 % 3 = 2 THEN 'N' ELSE 'S' END AS bearing, CASE WHEN s_suppkey % 2 = 1 AND s_suppkey // 2 % 5 = 4 THEN 'Plaza' ELSE 'Stop ' || (s_suppkey // 2 % 37) || CASE WHEN s_suppkey % 2 = 1 AND s_suppkey % 7 = 0 THEN ' (E)' ELSE '' END END AS name FROM supplier"""


@query(f"""SELECT a.id AS id_a, b.id AS id_b, round(1 - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name))::DOUBLE, 6) AS name_likeness FROM ({_SIDES}) a JOIN ({_SIDES}) b ON a.id < b.id
    AND (a.bearing || b.bearing) IN ('NS', 'SN', 'EW', 'WE') AND 1 - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name))::DOUBLE >= 0.6
    WHERE 2 * 6371000.0 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) BETWEEN 20 AND 50""")
def opposite_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops across a road from one another: distance, bearing and name."""
    k, pair = F.col("s_suppkey"), F.floor(F.col("s_suppkey") / 2)
    bearing = F.when((k % 2 == 0) | (pair % 3 == 2), "N").otherwise("S")
    name = F.when((k % 2 == 1) & (pair % 5 == 4), "Plaza").otherwise(F.concat(F.lit("Stop "), (pair % 37).cast("string"), F.when((k % 2 == 1) & (k % 7 == 0), " (E)").otherwise("")))
    s = table(spark, sf_dir, "supplier").select(k.alias("id"), (25.0 + pair * 0.002).alias("lat"), (121.5 + (k % 2) * 0.0003).alias("lon"), bearing.alias("bearing"), name.alias("name"))
    return D.opposite_stops(s).select("id_a", "id_b", F.round("name_likeness", 6).alias("name_likeness"))


@query("""WITH e AS (SELECT event_id, epoch_us(ts) AS us FROM events), s AS (SELECT min(us) + 864000000000 AS start FROM e), live AS (SELECT e.* FROM e, s WHERE us >= start), history AS (SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN us END AS us FROM e, s WHERE us < start + 86400000000)
    SELECT event_id, us AS update_time FROM history WHERE us IS NULL OR us < (SELECT min(us) FROM live) UNION ALL SELECT event_id, us FROM live""")
def cutover_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History and live rows merged at the first of the time columns that both know: history
    has no snapshot times, so the update time decides."""
    e = table(spark, sf_dir, "events").select("event_id", micros("ts").alias("us"))
    start = e.agg((F.min("us") + 10 * 86_400_000_000).alias("_from"))
    timed = e.crossJoin(F.broadcast(start))  # one row
    live = timed.where("us >= _from").select("event_id", F.col("us").alias("update_time"), F.col("us").alias("snapshot_time"))
    # History goes on for a day after the first live row.
    history = timed.where("us < _from + 86400000000").select("event_id", F.when(F.col("event_id") % 13 != 0, F.col("us")).alias("update_time"), F.lit(None).cast("long").alias("snapshot_time"))
    return O.merge_at_cutover(history, live, O.boundary_column(history, live)).select("event_id", "update_time")
