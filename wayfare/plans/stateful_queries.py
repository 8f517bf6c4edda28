"""Queries of the sequence matcher."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import arrivals as A
from ..operators import observations as O
from .fixtures import POSITIONS, STOPS, positions, stop_lists
from .registry import query


def _matching(usable: str) -> str:
    """The matcher's state machine as a recursion over the observations of all vehicles at once;
    usable selects these."""
    return f"""usable AS ({usable}),
  obs AS MATERIALIZED (SELECT o.obs_id, o.sub_route_uid, o.direction, o.plate_numb, o.us, o.speed, row_number() OVER v AS rn, (o.us - min(o.us) OVER (PARTITION BY o.sub_route_uid, o.direction, o.plate_numb)) / 1000000.0::DOUBLE AS el, d.ds
    FROM usable o JOIN (SELECT u.obs_id, list(2 * 6371000.0 * asin(sqrt(pow(sin(radians(s.lat - u.lat) / 2), 2) + cos(radians(u.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - u.lon) / 2), 2))) ORDER BY s.idx) AS ds FROM usable u JOIN stops s ON u.sub_route_uid = s.sub_route_uid AND u.direction = s.direction GROUP BY 1) d ON o.obs_id = d.obs_id
    WINDOW v AS (PARTITION BY o.sub_route_uid, o.direction, o.plate_numb ORDER BY o.us)),
  st AS (
    SELECT sub_route_uid, direction, plate_numb, 0::BIGINT AS rn, 0::BIGINT AS obs_id, -1::BIGINT AS cur, -1::BIGINT AS trip, 0.0::DOUBLE AS last_hit, -1::BIGINT AS matched, 0 AS cause FROM (SELECT DISTINCT sub_route_uid, direction, plate_numb FROM obs)
    UNION ALL
    SELECT sub_route_uid, direction, plate_numb, rn, obs_id, CASE WHEN hit THEN j ELSE cur END, trip, CASE WHEN hit THEN el ELSE last_hit END, CASE WHEN hit THEN j ELSE -1 END, cause FROM (
      SELECT *, ds[j + 1] <= 100 AS hit FROM (
        SELECT *, greatest(0, cur - 1) + list_position(ds[greatest(0, cur - 1) + 1 : cur + 9], list_min(ds[greatest(0, cur - 1) + 1 : cur + 9])) - 1 AS j FROM (
          SELECT sub_route_uid, direction, plate_numb, rn, obs_id, el, ds, cause, CASE WHEN cause > 0 THEN trip + 1 ELSE trip END AS trip, CASE WHEN cause > 0 THEN list_position(ds, list_min(ds)) - 1 ELSE cur END AS cur, CASE WHEN cause > 0 THEN el ELSE last_hit END AS last_hit FROM (
            SELECT o.sub_route_uid, o.direction, o.plate_numb, o.rn, o.obs_id, o.el, o.ds, st.cur, st.trip, st.last_hit,
              CASE WHEN st.cur < 0 THEN 1 WHEN st.cur = len(o.ds) - 1 AND list_min(o.ds[greatest(0, st.cur - 1) + 1 : st.cur + 9]) > 100 THEN 2 WHEN o.el - st.last_hit > 1200 THEN 3 ELSE 0 END AS cause
            FROM st JOIN obs o ON o.sub_route_uid = st.sub_route_uid AND o.direction = st.direction AND o.plate_numb = st.plate_numb AND o.rn = st.rn + 1))))),
  matched AS (SELECT st.*, o.us, o.speed, CASE WHEN st.matched >= 0 THEN o.ds[st.matched + 1] END AS near_dist FROM st JOIN obs o ON st.obs_id = o.obs_id WHERE st.rn > 0)"""


_USABLE = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plate_numb, sub_route_uid, direction, us ORDER BY kafka_partition, kafka_offset) AS k FROM positions WHERE duty_status = 1 AND lat IS NOT NULL) WHERE k = 1"
_MATCH = f"{POSITIONS}, {STOPS}, {_matching(_USABLE)}"


#: Its matched observations collapsed to visits.
_VISITS = f"""{_MATCH},
    f AS (SELECT *, CASE WHEN lag(us) OVER w IS NULL OR matched <> lag(matched) OVER w OR trip <> lag(trip) OVER w OR us - lag(us) OVER w > 120000000 THEN 1 ELSE 0 END AS new FROM matched WHERE matched >= 0 WINDOW w AS (PARTITION BY sub_route_uid, direction, plate_numb ORDER BY us)),
    s AS (SELECT *, sum(new) OVER (PARTITION BY sub_route_uid, direction, plate_numb ORDER BY us) AS event FROM f),
    e AS (SELECT sub_route_uid, direction, plate_numb, event, min(matched) AS idx, min(trip) AS trip, min(us) AS arrival_us, count(*) AS n_obs, min(near_dist) AS min_dist, min(speed) AS min_speed, (max(us) - min(us)) / 1000000.0::DOUBLE AS dwell_s FROM s GROUP BY 1, 2, 3, 4)"""


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = O.with_keys(O.with_coordinates(O.in_service(positions(spark, sf_dir))), *A.VEHICLE)
    first = O.keep_first(usable, ["plate_numb", "sub_route_uid", "direction", "us"], ["kafka_partition", "kafka_offset"])
    return A.match_positions(first.select("obs_id", *A.VEHICLE, "us", "lat", "lon", "speed"), stop_lists(spark, sf_dir))


@query(f"WITH RECURSIVE {_MATCH} SELECT obs_id, CAST(matched AS INT) AS near_idx, CAST(trip AS INT) AS trip, CAST(cause AS INT) AS cause, round(near_dist, 3) AS near_dist FROM matched")
def sequential_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matched(spark, sf_dir).select("obs_id", "near_idx", "trip", F.col("cause").cast("int").alias("cause"), F.round("near_dist", 3).alias("near_dist"))


@query(f"""WITH RECURSIVE {_VISITS}
    SELECT e.sub_route_uid, e.plate_numb, t.seq, CAST(e.trip AS INT) AS trip, arrival_us, n_obs, round(min_dist, 3) AS min_dist, min_speed, dwell_s, t.station_id, t.stop_name, t.boarding, strftime(make_timestamp(arrival_us) + INTERVAL 8 HOUR, '%Y-%m-%d') AS data_date,
      e.plate_numb || '_' || e.sub_route_uid || '_0_' || strftime(make_timestamp(arrival_us) + INTERVAL 8 HOUR, '%Y-%m-%d') || '_' || e.trip AS trip_id
    FROM e JOIN stops t ON e.sub_route_uid = t.sub_route_uid AND e.direction = t.direction AND e.idx = t.idx""")
def arrival_events_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = A.arrival_events(_matched(spark, sf_dir), stop_lists(spark, sf_dir))
    return events.select("sub_route_uid", "plate_numb", "seq", "trip", "arrival_us", "n_obs", F.round("min_dist", 3).alias("min_dist"), "min_speed", "dwell_s", "station_id", "stop_name", "boarding", "data_date", "trip_id")


@query(f"""WITH RECURSIVE {_MATCH}, t AS (SELECT sub_route_uid, direction, plate_numb, trip, count(*) AS n, count(*) FILTER (matched >= 0) AS hit, count(*) FILTER (cause = 1) AS c1, count(*) FILTER (cause = 2) AS c2, count(*) FILTER (cause = 3) AS c3 FROM matched GROUP BY 1, 2, 3, 4)
    SELECT (SELECT count(*) FROM positions) AS n_read, (SELECT count(*) FROM positions WHERE duty_status = 1 AND lat IS NOT NULL) AS n_usable, CAST(sum(n) AS BIGINT) AS n_assigned, CAST(sum(hit) AS BIGINT) AS n_matched, count(*) AS n_segments, count(*) FILTER (hit = 0) AS n_empty,
      CAST(sum(c1) AS BIGINT) AS seed_init, CAST(sum(c2) AS BIGINT) AS seed_terminus, CAST(sum(c3) AS BIGINT) AS seed_timeout, round(100.0::DOUBLE * sum(hit) / sum(n), 2) AS matched_pct FROM t""")
def extraction_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = positions(spark, sf_dir)
    return A.funnel(read, O.with_coordinates(O.in_service(read)), _matched(spark, sf_dir))
