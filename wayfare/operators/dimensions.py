"""Versioned stop and station dimensions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import city_of, content_hash, haversine_m
from ..sources.lake import written

# Bearings of stops and their opposites.
OPPOSITE = {"E": "W", "W": "E", "N": "S", "S": "N", "NE": "SW", "SW": "NE", "NW": "SE", "SE": "NW"}
#: Places of a grid cell, and stops of a place, that meet others in one place, about.
BLOCK = 512
#: Pairs of stops that a task makes, about.
PAIRS_A_TASK = 8 << 20


def build_route_stops(raw: DataFrame, now: Column, authority: str) -> DataFrame:
    """Raw route documents (schemas.RAW_ROUTE) of an authority as open versions; stops ordered
    by their sequence."""
    by_seq = F.array_sort("Stops", lambda a, b: F.when(a["StopSequence"] < b["StopSequence"], -1).when(a["StopSequence"] > b["StopSequence"], 1).otherwise(0))
    stop = lambda s: F.struct(s["StopSequence"].alias("seq"), s["StopUID"].alias("stop_uid"), s["StopID"].alias("stop_id"), s["StopName"]["Zh_tw"].alias("name"), s["StationID"].alias("station_id"), s["StopBoarding"].alias("boarding"), s["StopPosition"]["PositionLat"].alias("lat"), s["StopPosition"]["PositionLon"].alias("lon"), s["StopPosition"]["GeoHash"].alias("geohash"), s["LocationCityCode"].alias("location_city"))
    operator = lambda o: F.struct(o["OperatorID"].alias("id"), o["OperatorNo"].alias("no"), o["OperatorName"]["Zh_tw"].alias("name"), o["OperatorCode"].alias("code"))
    key = F.concat("SubRouteUID", F.lit("_"), F.col("Direction").cast("string"), F.lit("_"), F.col("VersionID").cast("string"))
    return raw.select(
        key.alias("_id"),
        F.col("SubRouteUID").alias("sub_route_uid"),
        F.col("Direction").cast("int").alias("direction"),
        F.col("VersionID").cast("string").alias("version_id"),
        F.col("RouteUID").alias("route_uid"),
        F.col("RouteName.Zh_tw").alias("route_name"),
        F.col("SubRouteName.Zh_tw").alias("sub_route_name"),
        F.lit(authority).alias("authority"),
        F.transform(F.coalesce("Operators", F.array()), operator).alias("operators"),
        F.transform(by_seq, stop).alias("stops"),
        F.size("Stops").alias("stop_count"),
        F.col("UpdateTime").alias("source_updated"),
        now.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def union_stations(rows: DataFrame, now: Column, authority_order: Sequence[str] = ("Taipei", "NewTaipei")) -> DataFrame:
    """Stations from the stops (station_id, name, lat, lon, stop_uid, stop_id, route_uid,
    route_name, authority) that each city reports. Of equal stop_uids the first authority's
    stays; the version is a hash of the business columns alone."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, authority_order)), F.col("authority")), F.lit(0))
    rank = F.when(rank == 0, len(authority_order) + 1).otherwise(rank)
    first = rows.groupBy("station_id", "stop_uid").agg(F.min(F.struct(rank.alias("rank"), "authority", "stop_id", "route_uid", "route_name", "name", "lat", "lon")).alias("s"))
    stations = first.groupBy("station_id").agg(
        F.min(F.struct("s.rank", "stop_uid", "s.name", "s.lat", "s.lon")).alias("head"),
        F.array_sort(F.collect_list(F.struct("stop_uid", "s.stop_id", "s.route_uid", "s.route_name", "s.authority"))).alias("routes"),
        F.array_sort(F.collect_set("s.route_uid")).alias("unique_routes"),
    )
    flat = stations.select("station_id", "head.name", "head.lat", "head.lon", "routes", F.size("routes").alias("route_count"), "unique_routes", F.size("unique_routes").alias("unique_route_count"))
    hashed = flat.withColumn("content_hash", content_hash("name", "lat", "lon", "routes"))
    return hashed.withColumns({"_id": F.concat("station_id", F.lit("_"), "content_hash"), "valid_from": now, "valid_to": F.lit(None).cast("timestamp")})


def upsert_versions(current: DataFrame, incoming: DataFrame, keys: Sequence[str], now: Column) -> DataFrame:
    """The next table of versions: rows of incoming whose _id is known change nothing; others
    are added as open and close the open version of their key. Both tables have the same
    columns. change says what became of each row: kept, closed or added."""
    fresh = incoming.join(current.select("_id"), "_id", "left_anti")
    renewed = fresh.select(*keys).distinct().withColumn("_renewed", F.lit(True))
    old = current.join(renewed, list(keys), "left")
    closing = F.col("_renewed") & F.col("valid_to").isNull()
    old = old.withColumns({"change": F.when(closing, "closed").otherwise("kept"), "valid_to": F.when(closing, now).otherwise(F.col("valid_to"))}).drop("_renewed")
    return old.unionByName(fresh.withColumn("change", F.lit("added")))


def version_at(events: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, fields: Sequence[str], before_first: bool = True) -> DataFrame:
    """events with fields of the version that was valid at the time in column at: the one from
    valid_from on, and before valid_to if it is closed; of several the latest. Times before the
    first version take it if before_first. Events without a version have nulls.

    The versions of a key are few and meet its events as one list in the order of time, by a
    join on the keys alone: no join by ranges, and no event is met twice."""
    listed = versions.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("valid_from", "valid_to", *fields))).alias("_versions"))
    rows = events.join(listed.withColumnsRenamed({k: f"_of_{k}" for k in keys}), [F.col(k) == F.col(f"_of_{k}") for k in keys], "left").drop(*[f"_of_{k}" for k in keys])
    valid = F.filter("_versions", lambda v: (v["valid_from"] <= F.col(at)) & (v["valid_to"].isNull() | (F.col(at) < v["valid_to"])))
    found = F.try_element_at(valid, F.lit(-1))
    if before_first:
        first = F.get("_versions", F.lit(0))
        found = F.when(F.col(at) < first["valid_from"], first).otherwise(found)
    rows = rows.withColumn("_version", found)
    return rows.withColumns({c: F.col(f"_version.{c}") for c in fields}).drop("_versions", "_version")


def serving_rows(route_stops: DataFrame) -> DataFrame:
    """One row for each stop of the open versions. A route without a name, or of an unknown
    city, raises."""
    route = F.when(F.col("route_name") != "", F.col("route_name")).otherwise(F.raise_error(F.concat(F.lit("route without a name: "), "sub_route_uid")).cast("string"))
    open_ = route_stops.where("valid_to is null").select(city_of(F.col("sub_route_uid")).alias("city"), route.alias("route_name"), "sub_route_uid", "direction", "version_id", F.explode("stops").alias("s"))
    return open_.select("city", "route_name", "sub_route_uid", "direction", F.col("s.seq").alias("seq"), F.col("s.station_id").alias("station_id"), F.col("s.name").alias("stop_name"), F.col("s.boarding").alias("boarding"), "version_id")


def length_checks(df: DataFrame, column: str, most: int) -> DataFrame:
    """Rows, distinct values, and the longest value of a column in characters and in bytes;
    fits says whether it has room in most characters. One row."""
    c = F.col(column)
    out = df.groupBy(c.alias("v")).agg(F.count("*").alias("n")).agg(F.sum("n").alias("n_rows"), F.count("v").alias("n_distinct"), F.max(F.char_length("v")).alias("longest_chars"), F.max(F.octet_length("v")).alias("longest_bytes"))
    return out.withColumn("fits", F.coalesce(F.col("longest_chars") <= most, F.lit(True)))


def name_ambiguity(stops: DataFrame, k: int = 10) -> DataFrame:
    """Route names that stand for several sub-routes, the k most ambiguous."""
    ways = F.count_distinct(F.concat("sub_route_uid", F.lit("-"), F.col("direction").cast("string")))
    return stops.groupBy("route_name").agg(F.count_distinct("sub_route_uid").alias("n_sub_routes"), ways.alias("n_directions")).where("n_sub_routes > 1").orderBy(F.desc("n_sub_routes"), "route_name").limit(k)


def near_pairs(stops: DataFrame, lowest_m: float, highest_m: float, cell_deg: float) -> DataFrame:
    """Pairs of stops (id, lat, lon, ...) from lowest_m to highest_m apart; cell_deg must span
    highest_m both ways.

    Stops of one place are compared as one. Places meet by grid cell: one side stands in its
    cell, the other in it and its eight neighbours, and a cell of many places is dealt to
    several tasks. Stops of two places that are near meet in blocks, each with each. Pairs may
    be many more than stops, as their number is the square of the stops of a place, so blocks
    go to as many tasks as the pairs need, before as after each of them has its stops."""
    cell = lambda c: F.floor(F.col(c) / cell_deg).cast("long")
    places = stops.groupBy("lat", "lon").agg(F.count("*").alias("n"))
    celled = places.withColumns({"_x": cell("lat"), "_y": cell("lon")})
    parts = celled.groupBy("_x", "_y").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_parts"))
    a = celled.join(parts, ["_x", "_y"]).select("_x", "_y", F.pmod(F.xxhash64("lat", "lon"), "_parts").cast("int").alias("_part"), *[F.col(c).alias(f"{c}_a") for c in places.columns])
    near = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    b = celled.withColumn("_d", F.explode(near)).withColumns({"_x": F.col("_x") + F.col("_d.dx"), "_y": F.col("_y") + F.col("_d.dy")})
    b = b.join(parts, ["_x", "_y"]).select("_x", "_y", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"), *[F.col(c).alias(f"{c}_b") for c in places.columns])
    met = a.join(b, ["_x", "_y", "_part"]).withColumn("dist_m", haversine_m(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b")))
    met = written(met.where(F.col("dist_m").between(lowest_m, highest_m)).drop("_x", "_y", "_part"), "places")
    n_pairs = met.agg(F.sum(F.col("n_a") * F.col("n_b"))).first()[0] or 0

    own = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK)).cast("int")
    others = [c for c in stops.columns if c not in ("lat", "lon")]
    blocks = stops.join(places, ["lat", "lon"]).groupBy("lat", "lon", own.alias("_block")).agg(F.collect_list(F.struct(*others)).alias("_stops"))
    of = lambda side: blocks.select(*[F.col(c).alias(f"{c}_{side}") for c in blocks.columns])
    tasks = math.ceil(n_pairs / PAIRS_A_TASK) or 1
    one = met.repartition(tasks, "lat_a", "lon_a").join(of("a"), ["lat_a", "lon_a"])
    both = one.repartition(tasks, "lat_b", "lon_b").join(of("b"), ["lat_b", "lon_b"])
    dealt = both.repartition(tasks, "lat_a", "lon_a", "_block_a", "lat_b", "lon_b", "_block_b")
    pairs = dealt.withColumn("_a", F.explode("_stops_a")).withColumn("_b", F.explode("_stops_b")).where("_a.id < _b.id")
    return pairs.select(*[F.col(f"{c}_{side}") if c in ("lat", "lon") else F.col(f"_{side}.{c}").alias(f"{c}_{side}") for side in "ab" for c in stops.columns], "dist_m")


def opposite_stops(stops: DataFrame, lowest_m: float = 20.0, highest_m: float = 50.0, cell_deg: float = 0.0006, least_like: float = 0.6) -> DataFrame:
    """Pairs of stops (id, lat, lon, bearing, name) across a road from one another: apart by a
    road's width, of opposite bearings, and of names that are alike (one less the edit distance
    by the longer length)."""
    opposite = F.create_map(*[F.lit(x) for pair in OPPOSITE.items() for x in pair])
    longer = F.greatest(F.char_length("name_a"), F.char_length("name_b"), F.lit(1))
    pairs = near_pairs(stops, lowest_m, highest_m, cell_deg).where(opposite[F.col("bearing_a")] == F.col("bearing_b"))
    return pairs.withColumn("name_likeness", 1 - F.levenshtein("name_a", "name_b") / longer).where(F.col("name_likeness") >= least_like)


def ambiguous_stops(stops: DataFrame, far_seq: int = 5, near_m: float = 100.0) -> DataFrame:
    """Pairs of stops of one route and direction that are near but far apart in sequence."""
    keys = ["sub_route_uid", "direction"]
    a = stops.select(*keys, F.col("seq").alias("seq_a"), F.col("lat").alias("lat_a"), F.col("lon").alias("lon_a"))
    b = stops.select(*keys, F.col("seq").alias("seq_b"), F.col("lat").alias("lat_b"), F.col("lon").alias("lon_b"))
    pairs = a.join(b, keys).where(F.col("seq_b") - F.col("seq_a") > far_seq)
    return pairs.withColumn("dist_m", haversine_m(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))).where(F.col("dist_m") < near_m)
