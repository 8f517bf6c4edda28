"""Queries of transfers and of the baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import arrivals as A
from ..operators import baseline as B
from ..operators import dimensions as D
from ..operators import mart_state as M
from ..operators import sketches as K
from ..operators import transfers as T
from ..operators.blocks import DAY_US
from ..operators.publish import delete, read_published
from ..sources.lake import scratch, write_partitioned, written
from .fixtures import ARRIVALS, POSITIONS, STOPS, TRIP_STEPS, VOLUME_STEPS, arrivals, positions, stop_lists, stops, table, trip_steps, volume_steps
from .registry import query

_PAIRS = f"""{ARRIVALS},
  qa AS (SELECT DISTINCT city, data_date, station_id, route AS route_a FROM arrivals WHERE boarding <= 0),
  qb AS (SELECT DISTINCT city, data_date, station_id, route AS route_b FROM arrivals WHERE boarding >= 0),
  a AS (SELECT x.city, x.data_date, x.station_id, x.route AS route_a, qb.route_b, x.us, x.lt FROM arrivals x
        JOIN qa ON x.city = qa.city AND x.data_date = qa.data_date AND x.station_id = qa.station_id AND x.route = qa.route_a
        JOIN qb ON x.city = qb.city AND x.data_date = qb.data_date AND x.station_id = qb.station_id AND x.route <> qb.route_b),
  pairs AS (SELECT a.*, b.us AS b_us FROM a ASOF JOIN arrivals b ON a.city = b.city AND a.data_date = b.data_date AND a.station_id = b.station_id AND a.route_b = b.route AND a.us < b.us)"""

_HIST = f"""{_PAIRS},
  binned AS (SELECT *, CASE WHEN hour(lt) < 6 OR hour(lt) >= 23 THEN 'night' WHEN isodow(lt) >= 6 THEN 'weekend' WHEN hour(lt) IN (7, 8, 17, 18) THEN 'weekday_peak' ELSE 'weekday_offpeak' END AS bucket,
             CASE WHEN b_us - us <= 3600000000 THEN CAST((b_us - us) // 1000000 // 30 AS INT) END AS wait_bin FROM pairs),
  total AS (SELECT city, data_date, station_id, route_a, route_b, bucket, count(*) AS n_total, count(*) - count(wait_bin) AS n_over FROM binned GROUP BY ALL),
  bins AS (SELECT city, data_date, station_id, route_a, route_b, bucket, wait_bin, count(*) AS cnt FROM binned WHERE wait_bin IS NOT NULL GROUP BY ALL),
  hist AS (SELECT t.*, b.wait_bin, coalesce(b.cnt, 0) AS cnt FROM total t LEFT JOIN bins b USING (city, data_date, station_id, route_a, route_b, bucket))"""

_MARTS = f"""{_HIST},
  tot AS (SELECT station_id, route_a, route_b, bucket, CAST(sum(n_total) AS BIGINT) AS n_total, CAST(sum(n_over) AS BIGINT) AS n_over, count(*) AS n_days FROM total GROUP BY ALL),
  m AS (SELECT station_id, route_a, route_b, bucket, wait_bin, sum(cnt) AS cnt FROM hist WHERE wait_bin IS NOT NULL GROUP BY ALL),
  c AS (SELECT *, sum(cnt) OVER (PARTITION BY station_id, route_a, route_b, bucket ORDER BY wait_bin) AS cum, sum(cnt) OVER (PARTITION BY station_id, route_a, route_b, bucket) AS tot FROM m),
  qs AS (SELECT station_id, route_a, route_b, bucket, min(wait_bin) FILTER (cum >= tot * 0.5::DOUBLE) * 30 + 15.0::DOUBLE AS wait_p50, min(wait_bin) FILTER (cum >= tot * 0.9::DOUBLE) * 30 + 15.0::DOUBLE AS wait_p90 FROM c GROUP BY ALL),
  marts AS (SELECT tot.*, wait_p50, wait_p90, n_total - n_over AS n_success, (n_total - n_over) / n_total::DOUBLE AS success_rate FROM tot JOIN qs USING (station_id, route_a, route_b, bucket))"""
_MART_COLUMNS = ["station_id", "route_a", "route_b", "bucket", "n_total", "n_over", "n_days", "wait_p50", "wait_p90", "n_success"]
#: The fixture is sparse; the default of 20 samples would leave next to nothing.
_LEAST = 2


def _hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.transfer_histogram(T.pair_transfers(arrivals(spark, sf_dir)))


def _marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.transfer_marts(_hist(spark, sf_dir), _LEAST)


@query(f"""WITH {ARRIVALS} SELECT a.event_id, b.us AS b_us FROM arrivals a ASOF JOIN (SELECT station_id, us FROM arrivals WHERE route = 'view') b ON a.station_id = b.station_id AND a.us < b.us WHERE a.route = 'click'""")
def next_departure_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each click the next view at the station, strictly later."""
    rows = arrivals(spark, sf_dir)
    found = T.next_departures(rows.where("route = 'click'").select("event_id", "station_id", "us"), rows.where("route = 'view'"), ["station_id"], span_us=DAY_US)
    return found.where("b_us is not null").select("event_id", "b_us")


@query(f"WITH {_PAIRS} SELECT city, data_date, station_id, route_a, route_b, us, b_us FROM pairs")
def transfer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.pair_transfers(arrivals(spark, sf_dir)).select(*T.SCOPE, "route_a", "route_b", "us", "b_us")


@query(f"WITH {_HIST} SELECT city, data_date, station_id, route_a, route_b, bucket, n_total, n_over, wait_bin, cnt AS \"count\" FROM hist")
def transfer_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hist(spark, sf_dir)


@query(f"WITH {_MARTS} SELECT {', '.join(_MART_COLUMNS)}, round(success_rate, 6) AS success_rate FROM marts WHERE n_success >= {_LEAST}")
def transfer_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marts(spark, sf_dir).select(*_MART_COLUMNS, F.round("success_rate", 6).alias("success_rate"))


@query(f"""WITH {_MARTS} SELECT station_id, route_a, route_b, bucket, CASE WHEN success_rate > 0.5 THEN wait_p50 END AS valid_p50, CASE WHEN success_rate > 0.9 THEN wait_p90 END AS valid_p90, success_rate > 0.5 AS estimable
    FROM marts WHERE n_success >= {_LEAST}""")
def transfer_marts_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.with_validity(_marts(spark, sf_dir)).select(*T.PAIR, "valid_p50", "valid_p90", "estimable")


@query(f"""WITH {_HIST}, inside AS (SELECT *, CASE WHEN wait_bin < 40 THEN wait_bin END AS b FROM hist),
    k AS (SELECT city, data_date, station_id, route_a, route_b, bucket, n_total, b, CAST(sum(CASE WHEN b IS NULL THEN 0 ELSE cnt END) AS BIGINT) AS cnt FROM inside GROUP BY ALL),
    w AS (SELECT *, n_total - CAST(sum(cnt) OVER (PARTITION BY city, data_date, station_id, route_a, route_b, bucket) AS BIGINT) AS n_over FROM k)
    SELECT city, data_date, station_id, route_a, route_b, bucket, n_total, n_over, b AS wait_bin, cnt AS "count" FROM w WHERE b IS NOT NULL OR n_over = n_total""")
def hist_recap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram as it had been with a wait of 20 minutes."""
    return T.recap(_hist(spark, sf_dir), 1200).select(*T.SCOPE, "route_a", "route_b", "bucket", "n_total", "n_over", "wait_bin", "count")


@query(f"""WITH {_MARTS}, exact AS (SELECT station_id, route_a, route_b, bucket, quantile_disc((b_us - us) / 1000000.0::DOUBLE, 0.5) AS exact_p50 FROM binned WHERE wait_bin IS NOT NULL GROUP BY ALL)
    SELECT bucket, count(*) AS n, round(max(abs(wait_p50 - exact_p50)), 6) AS worst_s FROM marts JOIN exact USING (station_id, route_a, route_b, bucket) WHERE n_success >= {_LEAST} GROUP BY bucket""")
def hist_vs_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far histogram medians are from those of the details."""
    pairs = T.pair_transfers(arrivals(spark, sf_dir)).withColumns({"bucket": C.time_bucket(C.local(F.timestamp_micros("us"))), "wait_s": (F.col("b_us") - F.col("us")) / 1_000_000}).where("wait_s <= 3600")
    exact = pairs.groupBy(*T.PAIR).agg(F.expr("percentile_disc(0.5) within group (order by wait_s)").alias("exact_p50"))
    return _marts(spark, sf_dir).join(exact, list(T.PAIR)).groupBy("bucket").agg(F.count("*").alias("n"), F.round(F.max(F.abs(F.col("wait_p50") - F.col("exact_p50"))), 6).alias("worst_s"))


@query(f"""WITH {ARRIVALS}, g AS (SELECT *, (us - lag(us) OVER (PARTITION BY city, data_date, station_id, route ORDER BY us)) / 1000000.0::DOUBLE AS gap_s FROM arrivals)
    SELECT city, data_date, station_id, route, count(*) AS n, round(avg(gap_s), 3) AS mean_s, round(coalesce(stddev_samp(gap_s), 0), 3) AS sd_s, count(*) FILTER (gap_s < 120) AS bunched FROM g WHERE gap_s IS NOT NULL GROUP BY 1, 2, 3, 4""")
def headway_regularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.headways(arrivals(spark, sf_dir)).withColumns({"mean_s": F.round("mean_s", 3), "sd_s": F.round(F.coalesce("sd_s", F.lit(0.0)), 3)})


@query(f"""WITH {POSITIONS}, {STOPS} SELECT sub_route_uid, count(*) AS n_obs FROM positions WHERE sub_route_uid NOT IN (SELECT sub_route_uid FROM stops WHERE sub_route_uid LIKE 'TPE%') GROUP BY 1""")
def route_stop_lookup_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = stop_lists(spark, sf_dir).where(F.col("sub_route_uid").startswith("TPE"))
    return A.missing_routes(positions(spark, sf_dir), known).select("sub_route_uid", "n_obs")


_LAG = "lag({}) OVER (PARTITION BY trip_id ORDER BY us, seq, station_id)"


@query(f"""WITH {TRIP_STEPS}, l AS (SELECT *, {_LAG.format("station_id")} AS from_station_id, seq - {_LAG.format("seq")} AS dseq, {_LAG.format("us")} AS from_us, {_LAG.format("min_speed")} AS from_min_speed FROM trip_steps),
    t AS (SELECT *, (us - from_us) // 1000000 AS sec, make_timestamp(from_us) + INTERVAL 8 HOUR AS lt FROM l WHERE dseq = 1)
    SELECT city, strftime(lt, '%Y-%m-%d') AS service_date, sub_route_uid, direction, from_station_id, station_id AS to_station_id, from_us, sec, from_min_speed, CAST(hour(lt) AS INT) AS hr, CASE WHEN isodow(lt) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_type,
    CASE WHEN hour(lt) BETWEEN 6 AND 9 THEN 'am_peak' WHEN hour(lt) BETWEEN 10 AND 15 THEN 'midday' WHEN hour(lt) BETWEEN 16 AND 19 THEN 'pm_peak' WHEN hour(lt) BETWEEN 20 AND 22 THEN 'evening' ELSE 'night' END AS band FROM t WHERE sec BETWEEN 1 AND 1800""")
def segment_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.segment_steps(trip_steps(spark, sf_dir)).withColumn("from_us", F.unix_micros("arrival_from")).drop("arrival_from")


@query(f"""WITH {STOPS} SELECT * FROM (SELECT sub_route_uid, direction, seq, station_id AS from_station_id, lead(station_id) OVER (PARTITION BY sub_route_uid, direction ORDER BY seq) AS to_station_id FROM stops) WHERE to_station_id IS NOT NULL""")
def segments_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.route_segments(stops(spark, sf_dir)).select("sub_route_uid", "direction", "seq", "from_station_id", "to_station_id")


@query(f"""WITH {STOPS} SELECT a.sub_route_uid, a.direction, a.seq, a.station_id AS from_station_id, b.station_id AS to_station_id FROM stops a JOIN stops b ON a.sub_route_uid = b.sub_route_uid AND a.direction = b.direction AND b.seq = a.seq + 1""")
def segment_selfjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.route_segments(stops(spark, sf_dir), by_lead=False).select("sub_route_uid", "direction", "seq", "from_station_id", "to_station_id")


_ROLLED = f"""{VOLUME_STEPS}, rolled AS (
  SELECT city, from_station_id, to_station_id, day_type, band, CASE grouping(city, from_station_id, to_station_id, day_type, band) WHEN 0 THEN 'band' WHEN 1 THEN 'daytype' WHEN 3 THEN 'pair' END AS level,
    count(*) AS n, count(DISTINCT sub_route_uid) AS n_route, quantile_disc(sec, 0.25) AS p25_sec, quantile_disc(sec, 0.5) AS p50_sec, quantile_disc(sec, 0.75) AS p75_sec, quantile_disc(sec, 0.9) AS p90_sec,
    avg(sec) AS mean_sec, stddev_samp(sec) AS sd_sec, min(service_date) AS date_from, max(service_date) AS date_to, count(DISTINCT service_date) AS n_days
  FROM steps GROUP BY ROLLUP (city, from_station_id, to_station_id, day_type, band) HAVING grouping(city, from_station_id, to_station_id, day_type, band) IN (0, 1, 3))"""

_S = ["n", "n_route", "p25_sec", "p50_sec", "p75_sec", "p90_sec", "mean_sec", "sd_sec", "date_from", "date_to", "n_days"]
_PICK = ", ".join(f"CASE WHEN l1.n >= 30 THEN l1.{c} WHEN l2.n >= 30 THEN l2.{c} ELSE l3.{c} END AS {c}" for c in ["level", *_S])
_BASELINE = f"""{_ROLLED}, picked AS (SELECT l1.city, l1.from_station_id, l1.to_station_id, l1.day_type, l1.band, {_PICK} FROM (SELECT * FROM rolled WHERE level = 'band') l1
    LEFT JOIN (SELECT * FROM rolled WHERE level = 'daytype') l2 ON l1.city = l2.city AND l1.from_station_id = l2.from_station_id AND l1.to_station_id = l2.to_station_id AND l1.day_type = l2.day_type
    LEFT JOIN (SELECT * FROM rolled WHERE level = 'pair') l3 ON l1.city = l3.city AND l1.from_station_id = l3.from_station_id AND l1.to_station_id = l3.to_station_id),
  baseline AS (SELECT * REPLACE (round(mean_sec, 2) AS mean_sec, round(coalesce(sd_sec, 0), 2) AS sd_sec), round(p90_sec / nullif(p50_sec, 0)::DOUBLE, 2) AS unreliability, n >= 100 AS p90_reliable, 'v2' AS rule_version, 'b1' AS baseline_version FROM picked)"""


def _rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.rollup(volume_steps(spark, sf_dir))


def _baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.baseline_segment(_rolled(spark, sf_dir))


@query(f"WITH {_ROLLED} SELECT * REPLACE (round(mean_sec, 2) AS mean_sec, round(coalesce(sd_sec, 0), 2) AS sd_sec) FROM rolled")
def baseline_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rolled(spark, sf_dir).withColumns({"mean_sec": F.round("mean_sec", 2), "sd_sec": F.round(F.coalesce("sd_sec", F.lit(0.0)), 2)})


@query(f"WITH {_BASELINE} SELECT * FROM baseline")
def baseline_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _baseline(spark, sf_dir)


@query(f"WITH {_BASELINE} SELECT day_type, level, count(*) AS n_cells, round(100 * sum(n) / sum(sum(n)) OVER (PARTITION BY day_type), 1) AS share FROM baseline GROUP BY day_type, level")
def ladder_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.ladder_share(_baseline(spark, sf_dir))


@query(f"""WITH {_BASELINE}, o AS (SELECT b.day_type, b.level, r.n FROM baseline b JOIN (SELECT * FROM rolled WHERE level = 'band') r USING (city, from_station_id, to_station_id, day_type, band))
    SELECT day_type, level, count(*) AS n_cells, CAST(sum(n) AS BIGINT) AS n, round(100 * sum(n) / sum(sum(n)) OVER (PARTITION BY day_type), 1) AS share FROM o GROUP BY day_type, level""")
def ladder_share_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = _rolled(spark, sf_dir)
    return B.ladder_share_weighted(B.baseline_segment(rolled), rolled)


@query("SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query(f"WITH {_BASELINE} SELECT day_type, level, quantile_disc(p50_sec, 0.5) AS p50_median, quantile_disc(unreliability, 0.5) AS unreliability_median, round(100.0::DOUBLE * count(*) FILTER (p90_reliable) / count(*), 1) AS p90_share FROM baseline GROUP BY 1, 2")
def baseline_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.baseline_sanity(_baseline(spark, sf_dir))


@query(f"""WITH {_BASELINE}, w AS (SELECT city, from_station_id, to_station_id, max(p50_sec) FILTER (band = 'am_peak') AS a, max(p50_sec) FILTER (band = 'midday') AS m FROM baseline WHERE day_type = 'weekday' AND level = 'band' GROUP BY 1, 2, 3),
    r AS (SELECT city, round(a / m::DOUBLE, 6) AS ratio FROM w WHERE a IS NOT NULL AND m > 0) SELECT city, count(*) AS n, quantile_disc(ratio, 0.1) AS p10, quantile_disc(ratio, 0.5) AS p50, quantile_disc(ratio, 0.9) AS p90 FROM r GROUP BY 1""")
def peak_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.peak_ratio(_baseline(spark, sf_dir))


_ROUTE = """line AS (SELECT r_name AS city, n_name AS from_station_id, 'R' || n_regionkey AS sub_route_uid, n_nationkey AS seq, seg AS to_station_id FROM nation JOIN region ON n_regionkey = r_regionkey, (SELECT DISTINCT c_mktsegment AS seg FROM customer)),
  journey AS (SELECT l.*, b.n, b.p50_sec, b.p90_sec, b.mean_sec, b.sd_sec, b.level, b.p90_reliable FROM line l LEFT JOIN (SELECT * FROM baseline WHERE day_type = 'weekend' AND band = 'am_peak') b USING (city, from_station_id, to_station_id))"""


def _journey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of a line for each region; those without steps have no statistics."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    segments = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("to_station_id")).distinct()
    line = n.select(F.col("r_name").alias("city"), F.col("n_name").alias("from_station_id"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("sub_route_uid"), F.col("n_nationkey").alias("seq")).crossJoin(F.broadcast(segments))  # a handful of segments
    return B.journey_segments(line, _baseline(spark, sf_dir), "weekend", "am_peak")


@query(f"WITH {_BASELINE}, {_ROUTE} SELECT city, from_station_id, to_station_id, sub_route_uid, seq, n, p50_sec, p90_sec, level, p90_reliable FROM journey")
def journey_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _journey(spark, sf_dir).select("city", "from_station_id", "to_station_id", "sub_route_uid", "seq", "n", "p50_sec", "p90_sec", "level", "p90_reliable")


@query(f"""WITH {_BASELINE}, {_ROUTE} SELECT sub_route_uid, count(p50_sec) AS n_segments, CAST(sum(p50_sec) AS BIGINT) AS p50_total, round(sum(mean_sec)) AS mean_total, round(sum(mean_sec) + 1.28::DOUBLE * sqrt(sum(pow(sd_sec, 2)))) AS p90_total,
    CAST(sum(CAST(level <> 'band' AS INT)) AS BIGINT) AS n_fallback, CAST(sum(CAST(NOT p90_reliable AS INT)) AS BIGINT) AS n_unreliable FROM journey GROUP BY 1""")
def journey_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.journey_total(_journey(spark, sf_dir), "sub_route_uid")


@query("""SELECT p_brand AS route_name, count(DISTINCT p_type || p_size) AS n_sub_routes, count(DISTINCT concat(p_type || p_size, '-', p_size % 2)) AS n_directions FROM part GROUP BY 1 HAVING count(DISTINCT p_type || p_size) > 1 ORDER BY n_sub_routes DESC, route_name LIMIT 10""")
def name_ambiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("route_name"), F.concat("p_type", F.col("p_size").cast("string")).alias("sub_route_uid"), (F.col("p_size") % 2).alias("direction"))
    return D.name_ambiguity(p)


@query(f"""WITH {STOPS} SELECT substr(sub_route_uid, 1, 3) AS prefix, count(*) AS n, count(DISTINCT sub_route_uid) AS n_routes, round(avg(seq), 2) AS mean_seq FROM stops GROUP BY 1""")
def serving_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stops(spark, sf_dir).groupBy(F.substring("sub_route_uid", 1, 3).alias("prefix")).agg(F.count("*").alias("n"), F.count_distinct("sub_route_uid").alias("n_routes"), F.round(F.avg("seq"), 2).alias("mean_seq"))


@query(f"""WITH {TRIP_STEPS}, l AS (SELECT city, seq - {_LAG.format("seq")} AS dseq, (us - {_LAG.format("us")}) // 1000000 AS sec FROM trip_steps)
    SELECT city, count(*) AS n, count(*) FILTER (dseq < 0) AS backwards, count(*) FILTER (dseq > 0 AND sec < 10 * dseq) AS too_fast FROM l WHERE dseq IS NOT NULL GROUP BY 1""")
def step_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.step_sanity(trip_steps(spark, sf_dir))


@query(f"WITH {ARRIVALS} SELECT city, station_id, count(DISTINCT route) AS n_routes FROM arrivals GROUP BY 1, 2 HAVING count(DISTINCT route) >= 3")
def shared_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations of three routes and more."""
    return T.shared_stations(arrivals(spark, sf_dir), 3)


@query(f"""WITH {_ROLLED} SELECT level, count(*) AS n_cells, count(*) AS p50_within, count(*) AS p90_within, count(*) AS routes_within, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n_days) AS BIGINT) AS n_days, min(date_from) AS date_from, max(date_to) AS date_to, round(max(mean_sec), 2) AS slowest_mean, round(max(coalesce(sd_sec, 0)), 2) AS widest_sd FROM rolled GROUP BY level""")
def baseline_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up from stored day states of sketches: how many cells have their medians, 90 %
    quantiles and numbers of routes within the bounds stated, and what is exact."""
    path = scratch(spark, "states")
    steps = volume_steps(spark, sf_dir)
    K.day_states(steps).write.parquet(path)
    rolled = K.rollup_states(spark.read.parquet(path))
    # Day types and bands are null at the upper levels, so cells meet by a name.
    named = lambda df, *others: df.select(F.to_json(F.struct(*B.CELL, "level")).alias("cell"), *others)
    errors = named(K.rank_errors(steps, rolled, {"p50_sec": 0.5, "p90_sec": 0.9}), "p50_sec_error", "p90_sec_error")
    routes = steps.withColumn("_level", F.explode(K.levels())).select(*B.CELL[:3], "_level.*", "sub_route_uid")
    routes = named(routes.groupBy(*B.CELL, "level").agg(F.count_distinct("sub_route_uid").alias("exact")), "exact")
    joined = named(rolled, "level", "n", "n_route", "n_days", "date_from", "date_to", "mean_sec", "sd_sec").join(errors, "cell").join(routes, "cell")
    within = lambda c: F.count_if(F.col(f"{c}_error") <= K.RANK_ERROR)
    return joined.groupBy("level").agg(F.count("*").alias("n_cells"), within("p50_sec").alias("p50_within"), within("p90_sec").alias("p90_within"), F.count_if(F.abs(F.col("n_route") - F.col("exact")) <= F.col("exact") * K.COUNT_ERROR).alias("routes_within"), F.sum("n").alias("n"), F.sum("n_days").alias("n_days"), F.min("date_from").alias("date_from"), F.max("date_to").alias("date_to"), F.round(F.max("mean_sec"), 2).alias("slowest_mean"), F.round(F.max(F.coalesce("sd_sec", F.lit(0.0))), 2).alias("widest_sd"))


_LATER = _MARTS.replace("FROM pairs)", "FROM pairs WHERE data_date > (SELECT min(data_date) FROM pairs))", 1)


@query(f"WITH {_LATER} SELECT {', '.join(_MART_COLUMNS)}, round(success_rate, 6) AS success_rate FROM marts WHERE n_success >= {_LEAST}")
def marts_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marts of a state that is brought up to date: all days but the last, the second
    as it was at first known, then the last day, the second again, and the first taken out."""
    base = scratch(spark, "mart-state")
    hist, path = written(_hist(spark, sf_dir), "hist").withColumn("dt", F.col("data_date")), f"{base}/hist"
    days = sorted(r["dt"] for r in hist.select("dt").distinct().collect())  # a row a day
    first, second, last = days[0], days[1], days[-1]
    write_partitioned(hist.where((F.col("dt") != second) | (F.col("wait_bin") % 2 == 0)), path, "dt")
    M.update(spark, base, path, days[:-1])
    write_partitioned(hist.where(F.col("dt") == second), path, "dt")
    M.update(spark, base, path, [second, last])
    delete(spark, f"{path}/dt={first}")
    M.update(spark, base, path, [first])
    return M.marts(read_published(spark, f"{base}/state"), _LEAST).select(*_MART_COLUMNS, F.round("success_rate", 6).alias("success_rate"))
