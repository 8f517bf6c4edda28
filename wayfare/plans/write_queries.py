"""Queries that write: versions, serving tables, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import arrivals as A
from ..operators import baseline as B
from ..operators import dimensions as D
from ..operators import observations as O
from ..operators.publish import read_published, swap
from ..sources.lake import scratch, written
from ..streaming.archive import archive, dedup_stream, to_messages
from ..streaming.delays import read_judged, watch
from ..streaming.matcher import arrivals_stream, match_stream
from ..streaming.ordering import few_states, late_counts, match_in_order, write_matched
from .fixtures import POSITIONS, STOPS, positions, stop_lists, stops, table
from .registry import query
from .stateful_queries import _MATCH, _VISITS, _matching


@query("""WITH c AS (SELECT n_nationkey AS k, n_nationkey || '_1' AS _id FROM nation WHERE n_nationkey < 20), i AS (SELECT n_nationkey AS k, n_nationkey || CASE WHEN n_nationkey % 3 = 0 THEN '_2' ELSE '_1' END AS _id FROM nation),
    f AS (SELECT * FROM i WHERE _id NOT IN (SELECT _id FROM c))
    SELECT k, _id, CASE WHEN k IN (SELECT k FROM f) THEN 'closed' ELSE 'kept' END AS change, k NOT IN (SELECT k FROM f) AS is_open FROM c UNION ALL SELECT k, _id, 'added', true FROM f""")
def scd2_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as versions: a third changes, five are new."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"))
    version = lambda df, v, at: df.select("k", F.concat(F.col("k").cast("string"), v).alias("_id"), F.lit(at).cast("timestamp").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    current = version(n.where("k < 20"), F.lit("_1"), "2024-01-01")
    incoming = version(n, F.when(F.col("k") % 3 == 0, "_2").otherwise("_1"), "2024-02-01")
    out = D.upsert_versions(current, incoming, ["k"], F.lit("2024-02-01").cast("timestamp"))
    return out.select("k", "_id", "change", F.col("valid_to").isNull().alias("is_open"))


@query(f"WITH {STOPS} SELECT sub_route_uid, direction, seq, station_id, stop_name, city FROM stops")
def serving_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stops published twice; what is read is the second table."""
    path = scratch(spark, "serving")
    rows = stops(spark, sf_dir).select("sub_route_uid", "direction", "seq", "station_id", "stop_name", "city")
    swap(spark, rows.where("seq < 3"), path, ["sub_route_uid", "direction", "seq"])
    swap(spark, rows, path, ["sub_route_uid", "direction", "seq"])
    return read_published(spark, path)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions as messages, a seventh of them sent twice, and some that are no record."""
    p = positions(spark, sf_dir)
    record = p.select(F.col("plate_numb").alias("PlateNumb"), F.col("sub_route_uid").alias("SubRouteUID"), F.col("direction").alias("Direction"), F.struct(F.col("lat").alias("PositionLat"), F.col("lon").alias("PositionLon")).alias("BusPosition"), "city", F.date_format(F.timestamp_micros("us"), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("fetch_time"), F.col("kafka_partition").alias("p"), F.col("kafka_offset").alias("o"), F.timestamp_micros("us").alias("t"))
    sent = to_messages(record.select("PlateNumb", "SubRouteUID", "Direction", "BusPosition", "city", "fetch_time", "p", "o", "t"))
    m = sent.select(F.when(F.get_json_object("value", "$.o").cast("long") % 50 == 1, "no record").otherwise(F.col("value")).alias("value"), F.get_json_object("value", "$.p").cast("int").alias("partition"), F.get_json_object("value", "$.o").cast("long").alias("offset"), F.to_timestamp(F.get_json_object("value", "$.t")).alias("timestamp"))
    return m.unionByName(m.where("offset % 7 = 0"))


@query(f"WITH {POSITIONS} SELECT city, strftime(make_timestamp(us) + INTERVAL 8 HOUR, '%Y-%m-%d') AS dt, count(*) AS n, CAST(sum(kafka_offset) AS BIGINT) AS offsets FROM positions WHERE kafka_offset % 50 <> 1 GROUP BY 1, 2")
def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages through the archiver, then compacted: records by city and day."""
    base = scratch(spark, "archive")
    messages = _messages(spark, sf_dir)
    messages.write.parquet(f"{base}/topic")
    stream = spark.readStream.schema(messages.schema).parquet(f"{base}/topic")
    archive(stream, f"{base}/staging", f"{base}/dead", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    once = O.dedup_messages(spark.read.parquet(f"{base}/staging"))
    return once.groupBy("city", F.col("dt").cast("string").alias("dt")).agg(F.count("*").alias("n"), F.sum("kafka_offset").alias("offsets"))


@query(f'WITH {POSITIONS} SELECT kafka_partition AS "partition", kafka_offset AS "offset" FROM positions')
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages once each, with copies dropped in the stream."""
    base = scratch(spark, "dedup")
    messages = _messages(spark, sf_dir)
    messages.write.parquet(f"{base}/topic")
    once = dedup_stream(spark.readStream.schema(messages.schema).parquet(f"{base}/topic"))
    once.select("partition", "offset").writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query(f"WITH RECURSIVE {_MATCH} SELECT m.sub_route_uid, m.plate_numb, m.us, CAST(matched AS INT) AS near_idx, CAST(trip AS INT) AS trip, CAST(cause AS INT) AS cause FROM matched m")
def stream_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence matcher on a stream."""
    base = scratch(spark, "match")
    usable = O.with_coordinates(O.in_service(positions(spark, sf_dir)))
    rows = O.keep_first(usable, ["plate_numb", "sub_route_uid", "direction", "us"], ["kafka_partition", "kafka_offset"]).select(*A.VEHICLE, "us", "lat", "lon")
    rows.write.parquet(f"{base}/in")
    found = match_stream(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), stop_lists(spark, sf_dir))
    found.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").select("sub_route_uid", "plate_numb", "us", "near_idx", "trip", F.col("cause").cast("int").alias("cause"))


def _usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = O.with_coordinates(O.in_service(positions(spark, sf_dir)))
    return O.keep_first(usable, ["plate_numb", "sub_route_uid", "direction", "us"], ["kafka_partition", "kafka_offset"])


#: Arrivals with the step that led to each, the steps' roll-up with its levels, and for each
#: arrival the finest level of its step that has three.
_DELAYS = f"""{_VISITS}, a AS (SELECT sub_route_uid, direction, plate_numb, arrival_us, trip, idx, lag(idx) OVER w AS from_idx, lag(arrival_us) OVER w AS before FROM e WINDOW w AS (PARTITION BY sub_route_uid, direction, plate_numb, trip ORDER BY arrival_us)),
    t AS (SELECT a.*, (arrival_us - before) // 1000000 AS sec, make_timestamp(arrival_us - (arrival_us - before) // 1000000 * 1000000) + INTERVAL 8 HOUR AS lt, s.city, f.station_id AS from_station_id, s.station_id AS to_station_id
      FROM a JOIN stops s ON a.sub_route_uid = s.sub_route_uid AND a.idx = s.idx LEFT JOIN stops f ON a.sub_route_uid = f.sub_route_uid AND a.from_idx = f.idx),
    d AS (SELECT *, CASE WHEN isodow(lt) >= 6 THEN 'weekend' WHEN lt IS NOT NULL THEN 'weekday' END AS day_type,
      CASE WHEN lt IS NULL THEN NULL WHEN hour(lt) BETWEEN 6 AND 9 THEN 'am_peak' WHEN hour(lt) BETWEEN 10 AND 15 THEN 'midday' WHEN hour(lt) BETWEEN 16 AND 19 THEN 'pm_peak' WHEN hour(lt) BETWEEN 20 AND 22 THEN 'evening' ELSE 'night' END AS band FROM t),
    rolled AS (SELECT city, from_station_id, to_station_id, day_type, band, CASE grouping(city, from_station_id, to_station_id, day_type, band) WHEN 0 THEN 'band' WHEN 1 THEN 'daytype' WHEN 3 THEN 'pair' END AS level, count(*) AS n, quantile_disc(sec, 0.5) AS p50_sec, quantile_disc(sec, 0.9) AS p90_sec
      FROM d WHERE sec IS NOT NULL GROUP BY ROLLUP (city, from_station_id, to_station_id, day_type, band) HAVING grouping(city, from_station_id, to_station_id, day_type, band) IN (0, 1, 3)),
    found AS (SELECT d.*, CASE WHEN l1.n >= 3 THEN l1 WHEN l2.n >= 3 THEN l2 ELSE l3 END AS l FROM d
      LEFT JOIN rolled l1 ON l1.level = 'band' AND d.city = l1.city AND d.from_station_id = l1.from_station_id AND d.to_station_id = l1.to_station_id AND d.day_type = l1.day_type AND d.band = l1.band
      LEFT JOIN rolled l2 ON l2.level = 'daytype' AND d.city = l2.city AND d.from_station_id = l2.from_station_id AND d.to_station_id = l2.to_station_id AND d.day_type = l2.day_type
      LEFT JOIN rolled l3 ON l3.level = 'pair' AND d.city = l3.city AND d.from_station_id = l3.from_station_id AND d.to_station_id = l3.to_station_id)"""


@query(f"""WITH RECURSIVE {_DELAYS} SELECT sub_route_uid, plate_numb, arrival_us, CAST(trip AS INT) AS trip, CAST(idx AS INT) AS near_idx, CAST(from_idx AS INT) AS from_idx, CAST(sec AS BIGINT) AS sec, l.level AS level, l.n AS n, CAST(l.p50_sec AS BIGINT) AS p50_sec, CAST(l.p90_sec AS BIGINT) AS p90_sec, coalesce(sec > l.p90_sec, false) AS slow FROM found""")
def stream_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals as they happen, judged by the baseline of the same steps, which is published as
    a ladder of levels: slow where a step is above the 90 % quantile of the finest level that
    holds."""
    base = scratch(spark, "delays")
    usable, lists = _usable(spark, sf_dir), stop_lists(spark, sf_dir)
    past = A.trip_steps(A.visit_steps(A.visits(A.match_positions(usable.select(*A.VEHICLE, "us", "lat", "lon", "speed"), lists))), lists).where("sec is not null")
    swap(spark, B.ladder(B.rollup(past)), f"{base}/ladder", B.CELL[:3])
    rows = usable.select(*A.VEHICLE, "us", "lat", "lon")
    rows.write.parquet(f"{base}/in")
    arrivals = arrivals_stream(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), lists)
    watch(arrivals, lists, f"{base}/ladder", f"{base}/out", f"{base}/checkpoint", 3).trigger(availableNow=True).start().awaitTermination()
    return read_judged(spark, f"{base}/out").select("sub_route_uid", "plate_numb", "arrival_us", "trip", "near_idx", "from_idx", "sec", *B.RUNG, "slow")


def _shuffled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Observations with the batch they come in, and (span_s, first_us), a row. Time is cut into
    four spans; two thirds of the rows come one or two spans late, and every 17th in a last
    batch, in which each vehicle also sends a time far ahead without a place."""
    rows = _usable(spark, sf_dir).select("obs_id", *A.VEHICLE, "us", "lat", "lon")
    spans = rows.agg((F.floor((F.max("us") - F.min("us")) / 4_000_000) + 1).cast("long").alias("span_s"), F.min("us").alias("first_us"))
    held = rows.crossJoin(F.broadcast(spans))  # one row
    batch = F.when(F.col("obs_id") % 17 == 0, 6).otherwise(F.floor((F.col("us") - F.col("first_us")) / (F.col("span_s") * 1_000_000)) + F.col("obs_id") % 3)
    clocks = held.groupBy(*A.VEHICLE).agg((F.max("us") + 9 * F.first("span_s") * 1_000_000).alias("us")).withColumns({"lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double"), "batch": F.lit(6)})
    sent = held.withColumn("batch", batch.cast("int")).select(*A.VEHICLE, "us", "lat", "lon", "batch").unionByName(clocks.select(*A.VEHICLE, "us", "lat", "lon", "batch"))
    return sent, spans


def _in_order(spark: SparkSession, sf_dir: str) -> str:
    """The folder of what the stream makes of _shuffled, a file a batch."""
    base = scratch(spark, "order")
    sent, spans = _shuffled(spark, sf_dir)
    sent = written(sent, "sent")
    span_s = spans.first()["span_s"]
    for batch in range(7):
        sent.where(F.col("batch") == batch).drop("batch").coalesce(1).write.mode("append").parquet(f"{base}/in")
    source = spark.readStream.schema(sent.drop("batch").schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    found = match_in_order(source, stop_lists(spark, sf_dir), 3 * span_s)
    with few_states(spark):
        stream = write_matched(found, f"{base}/matched", f"{base}/late", f"{base}/checkpoint").trigger(availableNow=True).start()
    stream.awaitTermination()
    return base


#: Which observations come too late: those of the last batch not after what their vehicle's clock
#: was before it, less three spans.
_LATE = f"""{POSITIONS}, {STOPS},
  once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plate_numb, sub_route_uid, direction, us ORDER BY kafka_partition, kafka_offset) AS k FROM positions WHERE duty_status = 1 AND lat IS NOT NULL) WHERE k = 1),
  span AS (SELECT (max(us) - min(us)) // 4000000 + 1 AS span_s FROM once),
  clocks AS (SELECT sub_route_uid, direction, plate_numb, max(us) FILTER (obs_id % 17 <> 0) AS clock FROM once GROUP BY 1, 2, 3),
  marked AS (SELECT o.*, coalesce(o.obs_id % 17 = 0 AND o.us <= c.clock - 3 * span_s * 1000000, false) AS late FROM once o JOIN clocks c ON o.sub_route_uid = c.sub_route_uid AND o.direction = c.direction AND o.plate_numb = c.plate_numb, span)"""


@query(f"WITH RECURSIVE {_LATE}, {_matching('SELECT * FROM marked WHERE NOT late')} SELECT sub_route_uid, plate_numb, us, CAST(matched AS INT) AS near_idx, CAST(trip AS INT) AS trip, CAST(cause AS INT) AS cause FROM matched")
def stream_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations in shuffled batches, matched in the order of time."""
    return spark.read.parquet(f"{_in_order(spark, sf_dir)}/matched").select("sub_route_uid", "plate_numb", "us", "near_idx", "trip", F.col("cause").cast("int").alias("cause"))


@query(f"WITH {_LATE} SELECT strftime(make_timestamp(us) + INTERVAL 8 HOUR, '%Y-%m-%d') AS dt, count(*) AS n_late, count(DISTINCT (sub_route_uid, direction, plate_numb)) AS n_vehicles FROM marked WHERE late GROUP BY 1")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those that came too late, counted by day."""
    return late_counts(spark, f"{_in_order(spark, sf_dir)}/late").select("dt", "n_late", "n_vehicles")


@query(f"""WITH RECURSIVE {_VISITS}, a AS (SELECT sub_route_uid, plate_numb, arrival_us, CAST(trip AS INT) AS trip, CAST(idx AS INT) AS near_idx, lag(idx) OVER w AS from_idx, lag(arrival_us) OVER w AS before FROM e WINDOW w AS (PARTITION BY sub_route_uid, direction, plate_numb, trip ORDER BY arrival_us))
    SELECT sub_route_uid, plate_numb, arrival_us, trip, near_idx, CAST(from_idx AS INT) AS from_idx, CAST((arrival_us - before) // 1000000 AS BIGINT) AS sec, coalesce((arrival_us - before) // 1000000 > 1200, false) AS slow FROM a""")
def stream_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals as they happen, with the time since the one before; slow where that is above
    what a table of usual times says."""
    base = scratch(spark, "arrivals")
    usable = O.with_coordinates(O.in_service(positions(spark, sf_dir)))
    rows = O.keep_first(usable, ["plate_numb", "sub_route_uid", "direction", "us"], ["kafka_partition", "kafka_offset"]).select(*A.VEHICLE, "us", "lat", "lon")
    rows.write.parquet(f"{base}/in")
    lists = stop_lists(spark, sf_dir)
    usual = lists.select("sub_route_uid", "direction", F.lit(1200).cast("long").alias("p90_sec"))
    found = arrivals_stream(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), lists).join(usual, ["sub_route_uid", "direction"])
    found = found.withColumn("slow", F.coalesce(F.col("sec") > F.col("p90_sec"), F.lit(False)))
    found.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out").select("sub_route_uid", "plate_numb", "arrival_us", "trip", "near_idx", "from_idx", "sec", "slow")
