"""The driver's tables in the roles of the transit model, in Spark and as SQL for the oracle.

Both forms use plain integer arithmetic on ids, so they agree row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import local_date


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _city(key: Column) -> Column:
    return F.when(key % 2 == 0, "Taipei").otherwise("NewTaipei")


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals at stations: event types are routes, users of one remainder a station."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.concat(F.lit("S"), (F.col("user_id") % 20).cast("string")).alias("station_id"), F.col("event_type").alias("route"), micros("ts").alias("us"), (F.col("event_id") % 3 - 1).cast("int").alias("boarding"), _city(F.col("user_id")).alias("city")).withColumn("data_date", local_date(F.timestamp_micros("us")))


ARRIVALS = """arrivals AS (
  SELECT event_id, 'S' || (user_id % 20) AS station_id, event_type AS route, epoch_us(ts) AS us,
         CAST(event_id % 3 - 1 AS INT) AS boarding, CASE WHEN user_id % 2 = 0 THEN 'Taipei' ELSE 'NewTaipei' END AS city,
         strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS data_date, ts + INTERVAL 8 HOUR AS lt
  FROM events)"""


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle positions along a line, in time compressed sixtyfold, with unknown and outlying
    coordinates and all kinds of status."""
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    us = (F.floor(micros("ts") / 60_000_000) * 1_000_000).cast("long")
    return e.select(
        i.alias("obs_id"),
        F.concat(F.lit("P"), (F.col("user_id") % 50).cast("string")).alias("plate_numb"),
        F.col("event_type").alias("route_uid"),
        F.concat(F.when(F.col("user_id") % 2 == 0, "TPE").otherwise("NWT"), F.col("event_type")).alias("sub_route_uid"),
        F.lit(0).cast("byte").alias("direction"),
        _city(F.col("user_id")).alias("city"),
        F.when(F.col("event_type") == "error", 2).otherwise(1).cast("byte").alias("duty_status"),
        F.when(i % 11 == 5, None).when(i % 11 == 4, 99).when(i % 11 < 4, i % 11).otherwise(0).cast("short").alias("bus_status"),
        F.when(i % 97 == 0, None).when(i % 101 == 0, 30.0).otherwise(25.00003 + (i * 7) % 600 * 0.000125).alias("lat"),
        F.lit(121.5).alias("lon"),
        (i % 110).cast("short").alias("speed"),
        us.alias("us"),
        us.alias("gps_us"),
        (us + i % 30 * 1_000_000).alias("update_us"),
        (F.floor(us / 600_000_000) * 600_000_000).cast("long").alias("snapshot_us"),
        (F.col("user_id") % 12).cast("int").alias("kafka_partition"),
        i.alias("kafka_offset"),
    )


POSITIONS = """positions AS (
  SELECT event_id AS obs_id, 'P' || (user_id % 50) AS plate_numb, event_type AS route_uid,
         (CASE WHEN user_id % 2 = 0 THEN 'TPE' ELSE 'NWT' END) || event_type AS sub_route_uid, CAST(0 AS TINYINT) AS direction,
         CASE WHEN user_id % 2 = 0 THEN 'Taipei' ELSE 'NewTaipei' END AS city,
         CAST(CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS TINYINT) AS duty_status,
         CAST(CASE WHEN event_id % 11 = 5 THEN NULL WHEN event_id % 11 = 4 THEN 99 WHEN event_id % 11 < 4 THEN event_id % 11 ELSE 0 END AS SMALLINT) AS bus_status,
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 30.0::DOUBLE ELSE 25.00003::DOUBLE + (event_id * 7) % 600 * 0.000125::DOUBLE END AS lat,
         121.5::DOUBLE AS lon, CAST(event_id % 110 AS SMALLINT) AS speed, us, us AS gps_us, us + event_id % 30 * 1000000 AS update_us,
         us // 600000000 * 600000000 AS snapshot_us, CAST(user_id % 12 AS INT) AS kafka_partition, event_id AS kafka_offset
  FROM (SELECT *, epoch_us(ts) // 60000000 * 1000000 AS us FROM events))"""


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each stop of ten routes: nations in a line, with gaps in the numbers."""
    n, key = table(spark, sf_dir, "nation"), F.col("n_nationkey")
    routes = table(spark, sf_dir, "events").select(F.concat(F.when(F.col("user_id") % 2 == 0, "TPE").otherwise("NWT"), F.col("event_type")).alias("sub_route_uid")).distinct()
    line = n.select(key.alias("idx"), (key + 1 + F.floor(key / 7)).cast("int").alias("seq"), F.concat(F.lit("N"), key.cast("string")).alias("station_id"), F.col("n_name").alias("stop_name"), (key % 3 - 1).cast("int").alias("boarding"), (25.0 + key * 0.003).alias("lat"), F.lit(121.5).alias("lon"))
    return routes.crossJoin(F.broadcast(line)).withColumns({"direction": F.lit(0).cast("byte"), "version_id": F.lit("1"), "city": F.when(F.col("sub_route_uid").startswith("TPE"), "Taipei").otherwise("NewTaipei")})  # 25 stops


STOPS = """stops AS (
  SELECT r.sub_route_uid, CAST(0 AS TINYINT) AS direction, '1' AS version_id, CASE WHEN r.sub_route_uid LIKE 'TPE%' THEN 'Taipei' ELSE 'NewTaipei' END AS city,
         n_nationkey AS idx, CAST(n_nationkey + 1 + n_nationkey // 7 AS INT) AS seq, 'N' || n_nationkey AS station_id, n_name AS stop_name,
         CAST(n_nationkey % 3 - 1 AS INT) AS boarding, 25.0::DOUBLE + n_nationkey * 0.003::DOUBLE AS lat, 121.5::DOUBLE AS lon
  FROM nation, (SELECT DISTINCT (CASE WHEN user_id % 2 = 0 THEN 'TPE' ELSE 'NWT' END) || event_type AS sub_route_uid FROM events) r)"""


def stop_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stops of each route as arrays in the order of the sequence."""
    fields = {"stop_seqs": "seq", "station_ids": "station_id", "stop_names": "stop_name", "boardings": "boarding", "stop_lats": "lat", "stop_lons": "lon"}
    listed = stops(spark, sf_dir).groupBy("sub_route_uid", "direction", "version_id").agg(F.array_sort(F.collect_list(F.struct("idx", *fields.values()))).alias("s"))
    return listed.select("sub_route_uid", "direction", "version_id", *[F.col(f"s.{f}").alias(name) for name, f in fields.items()])


def trip_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival events of five vehicles, a trip a day, with gaps in the sequence numbers."""
    e = table(spark, sf_dir, "events").withColumns({"vehicle": F.col("user_id") % 5, "us": micros("ts")})
    e = e.withColumn("data_date", local_date(F.timestamp_micros("us"))).withColumn("trip_id", F.concat(F.col("vehicle").cast("string"), F.lit("_"), "data_date"))
    n = F.row_number().over(Window.partitionBy("trip_id").orderBy("us", "event_id"))
    e = e.withColumn("seq", (n + F.floor(n / 7)).cast("int"))
    return e.select("event_id", "trip_id", "data_date", _city(F.col("vehicle")).alias("city"), F.concat(F.lit("R"), F.col("vehicle").cast("string")).alias("sub_route_uid"), F.lit(0).cast("byte").alias("direction"), F.concat(F.lit("V"), F.col("vehicle").cast("string")).alias("plate_numb"), "seq", F.concat(F.lit("S"), (F.col("seq") % 12).cast("string")).alias("station_id"), F.timestamp_micros("us").alias("arrival_time"), "us", (F.col("event_id") % 50).cast("short").alias("min_speed"))


TRIP_STEPS = """trip_steps AS (
  SELECT event_id, trip_id, data_date, CASE WHEN vehicle % 2 = 0 THEN 'Taipei' ELSE 'NewTaipei' END AS city, 'R' || vehicle AS sub_route_uid, CAST(0 AS TINYINT) AS direction,
         'V' || vehicle AS plate_numb, CAST(n + n // 7 AS INT) AS seq, 'S' || ((n + n // 7) % 12) AS station_id, ts AS arrival_time, epoch_us(ts) AS us, CAST(event_id % 50 AS SMALLINT) AS min_speed
  FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY ts, event_id) AS n FROM (
    SELECT *, user_id % 5 AS vehicle, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS data_date, (user_id % 5) || '_' || strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS trip_id FROM events)))"""


def volume_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment steps at volume from the star tables."""
    dims = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    orders = table(spark, sf_dir, "orders").join(dims.select("c_custkey", "c_mktsegment", "n_name", "r_name"), F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_returnflag", "l_partkey")
    rows = lines.join(orders.select("o_orderkey", "o_orderdate", "o_orderpriority", "c_mktsegment", "n_name", "r_name"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(F.col("r_name").alias("city"), F.col("n_name").alias("from_station_id"), F.col("c_mktsegment").alias("to_station_id"), F.when(F.col("l_returnflag") == "R", "weekend").otherwise("weekday").alias("day_type"), F.expr("CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'am_peak' WHEN '2' THEN 'midday' WHEN '3' THEN 'pm_peak' WHEN '4' THEN 'evening' ELSE 'night' END").alias("band"), ((F.col("l_partkey") * 37 + F.col("l_suppkey") * 11) % 1800 + 1).alias("sec"), F.concat(F.lit("R"), (F.col("l_suppkey") % 7).cast("string")).alias("sub_route_uid"), F.date_format(F.col("o_orderdate"), "yyyy-MM-dd").alias("service_date"))


VOLUME_STEPS = """steps AS (
  SELECT r_name AS city, n_name AS from_station_id, c_mktsegment AS to_station_id, CASE WHEN l_returnflag = 'R' THEN 'weekend' ELSE 'weekday' END AS day_type,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'am_peak' WHEN '2' THEN 'midday' WHEN '3' THEN 'pm_peak' WHEN '4' THEN 'evening' ELSE 'night' END AS band,
         (l_partkey * 37 + l_suppkey * 11) % 1800 + 1 AS sec, 'R' || (l_suppkey % 7) AS sub_route_uid, strftime(o_orderdate, '%Y-%m-%d') AS service_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
