"""Daily chain and backfill: staged messages of a day to positions, events, transfers, steps, and
the tables over all days: stops, marts, baseline, serving.

    python -m wayfare.cli daily --lake DIR --date 2026-08-21 [--city Taipei --city NewTaipei]
    python -m wayfare.cli backfill --lake DIR --first 2026-08-01 --last 2026-08-20 [--history DIR] [--force]

A backfill with a history reads each city's raw snapshots of a day (DIR/city/date) as positions
first. Protected days are left alone and reported, and the others are done.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import traceback
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.columns import LOCAL_ZONE
from .operators import arrivals as A
from .operators import baseline as B
from .operators import dimensions as D
from .operators import mart_state as M
from .operators import observations as O
from .operators import quality as Q
from .operators import sketches as K
from .operators import transfers as T
from .operators.publish import backfill_positions, compact_day, current_version, dates_between, exists, is_protected, read_published, recompact, sized_files, swap
from .schemas import RAW_ROUTE
from .session import get_session
from .sources.lake import append_metrics, read_documents, read_snapshots, write_partitioned

CITIES = ("Taipei", "NewTaipei")


def stop_lists(spark: SparkSession, lake: str) -> DataFrame:
    """All versions of the stops as arrays, with the times from and to which they are valid."""
    versions = read_published(spark, f"{lake}/route_stops")
    fields = {"stop_seqs": "seq", "station_ids": "station_id", "stop_names": "name", "boardings": "boarding", "stop_lats": "lat", "stop_lons": "lon"}
    return versions.select("sub_route_uid", "direction", "version_id", "valid_from", "valid_to", *[F.col(f"stops.{f}").alias(name) for name, f in fields.items()])


def build_events(spark: SparkSession, lake: str, city: str, date: str) -> None:
    """Events by the stops that were valid at the time of each observation, so that a day that is
    done again later goes by the stops of that day."""
    p = spark.read.parquet(f"{lake}/silver").where((F.col("city") == city) & (F.col("dt") == date))
    usable = O.with_keys(O.with_coordinates(O.in_service(p)), *A.VEHICLE, "gps_time")
    order = [c for c in ("snapshot_time", "kafka_partition", "kafka_offset") if c in p.columns]
    first = O.keep_first(usable, O.OBSERVATION_KEY, order)
    stops = stop_lists(spark, lake)
    rows = first.select(*A.VEHICLE, F.unix_micros("gps_time").alias("us"), "gps_time", "lat", "lon", "speed")
    dated = D.version_at(rows, stops, ["sub_route_uid", "direction"], "gps_time", ["version_id"]).drop("gps_time")
    events = A.arrival_events(A.match_positions(dated, stops, by_version=True), stops, F.lit(date))
    write_partitioned(events.withColumns({"city": F.lit(city), "dt": F.col("data_date")}), f"{lake}/events", "city", "dt", order=("trip_id", "arrival_time"))


def build_transfers(spark: SparkSession, lake: str, city: str, date: str) -> None:
    e = spark.read.parquet(f"{lake}/events").where((F.col("city") == city) & (F.col("dt") == date))
    rows = e.select("city", "data_date", "station_id", F.col("sub_route_uid").alias("route"), F.unix_micros("arrival_time").alias("us"), "boarding")
    hist = T.transfer_histogram(T.pair_transfers(rows))
    write_partitioned(hist.withColumn("dt", F.col("data_date")), f"{lake}/transfers", "city", "dt")


def build_steps(spark: SparkSession, lake: str, city: str, date: str) -> None:
    e = spark.read.parquet(f"{lake}/events").where((F.col("city") == city) & (F.col("dt") == date))
    write_partitioned(B.segment_steps(e).withColumn("dt", F.lit(date)), f"{lake}/steps", "city", "dt")


def build_states(spark: SparkSession, lake: str, city: str, date: str) -> None:
    """The day's steps as mergeable states, for a baseline that reads no steps."""
    steps = spark.read.parquet(f"{lake}/steps").where((F.col("city") == city) & (F.col("dt") == date))
    write_partitioned(K.day_states(steps).withColumn("dt", F.lit(date)), f"{lake}/step_states", "city", "dt")


def tidy(spark: SparkSession, lake: str, city: str, date: str) -> None:
    """Small files of the day put together, in the tables that hold what has been derived."""
    for name in ("events", "transfers", "steps", "step_states"):
        if exists(spark, folder := f"{lake}/{name}/city={city}/dt={date}") and len(sized_files(spark, folder)) > 1:
            recompact(spark, folder)


def compact(spark: SparkSession, lake: str, city: str, date: str) -> None:
    """Staged messages of the day as a silver partition, where any are staged."""
    if exists(spark, f"{lake}/staging/city={city}/dt={date}"):
        compact_day(spark, f"{lake}/staging", f"{lake}/silver", city, date, dt.datetime.now(ZoneInfo(LOCAL_ZONE)).date().isoformat())


def health(spark: SparkSession, lake: str, city: str, date: str) -> None:
    p = spark.read.parquet(f"{lake}/silver").where((F.col("city") == city) & (F.col("dt") == date)).withColumns({"gps_us": F.unix_micros("gps_time"), "update_us": F.unix_micros("update_time")})
    append_metrics(Q.profile(p).withColumn("date", F.lit(date)), f"{lake}/metrics")


def refresh_stops(spark: SparkSession, lake: str) -> None:
    """Raw route documents of each city as versions of the stops, where any have come."""
    if not exists(spark, f"{lake}/raw_routes"):
        return
    now = F.current_timestamp()
    found = None
    for city in CITIES:
        if exists(spark, path := f"{lake}/raw_routes/{city}"):
            built = D.build_route_stops(read_documents(spark, path, RAW_ROUTE), now, city)
            found = built if found is None else found.unionByName(built)
    if found is None:  # documents of other cities only
        return
    there = exists(spark, f"{lake}/route_stops/_current")
    current = read_published(spark, f"{lake}/route_stops") if there else found.limit(0)
    swap(spark, D.upsert_versions(current, found, ["sub_route_uid", "direction"], now).drop("change"), f"{lake}/route_stops", ["_id"])


def build_marts(spark: SparkSession, lake: str, days: list[str]) -> None:
    """The marts with these days as they are now. The first time, all days there are."""
    if current_version(spark, f"{lake}/mart_state/state") is None:
        days = [r["dt"] for r in spark.read.parquet(f"{lake}/transfers").select("dt").distinct().collect()]  # a row a day
    M.publish_marts(spark, f"{lake}/transfers", f"{lake}/mart_state", f"{lake}/marts", days)


def build_baseline(spark: SparkSession, lake: str, sketches: bool = False) -> None:
    """The baseline, and its ladder for streams, of the steps, or of their states."""
    rolled = K.rollup_states(spark.read.parquet(f"{lake}/step_states").drop("dt")) if sketches else B.rollup(spark.read.parquet(f"{lake}/steps"))
    swap(spark, B.baseline_segment(rolled), f"{lake}/baseline", B.CELL)
    swap(spark, B.ladder(rolled), f"{lake}/ladder", B.CELL[:3])


def build_serving(spark: SparkSession, lake: str) -> None:
    swap(spark, D.serving_rows(read_published(spark, f"{lake}/route_stops")), f"{lake}/serving/route_stop", ["sub_route_uid", "direction", "seq"])


def run_day(spark: SparkSession, lake: str, cities: list[str], date: str) -> int:
    """All steps of each city; a failed one ends its city's chain, a failed health check or
    tidying none.
    Returns the number of failures."""
    failed = 0
    for city in cities:
        for step, must in ((compact, True), (health, False), (build_events, True), (build_transfers, True), (build_steps, True), (build_states, True), (tidy, False)):
            try:
                step(spark, lake, city, date)
            except Exception:
                traceback.print_exc()
                if must:
                    failed += 1
                    break
    return failed


def run_tables(spark: SparkSession, lake: str, days: list[str], sketches: bool = False) -> int:
    """The tables over all days, each whether or not the others succeed."""
    failed = 0
    for step in (lambda: build_marts(spark, lake, days), lambda: build_baseline(spark, lake, sketches), lambda: build_serving(spark, lake)):
        try:
            step()
        except Exception:
            traceback.print_exc()
            failed += 1
    return failed


def backfill_history(spark: SparkSession, lake: str, history: str, city: str, date: str, force: bool = False) -> str:
    """A day's raw snapshots as a silver partition; what became of it."""
    path = f"{history}/{city}/{date}"
    if not exists(spark, path):
        return "no snapshots"
    rows = O.normalize(read_snapshots(spark, path, date).drop("_corrupt_record"))
    done = backfill_positions(spark, rows, f"{lake}/silver", city, date, force)
    return "left alone" if done is None else f"{done.rows} rows" + (", known to be incomplete" if done.incomplete else "")


def backfill(spark: SparkSession, lake: str, cities: list[str], days: list[str], history: str | None, force: bool, sketches: bool = False) -> int:
    """The history and the chain of each day that isn't protected, then the tables. Returns the
    number of failures; a day that is left alone is none."""
    failed, done = 0, []
    for date in days:
        if is_protected(date, force):
            print(f"{date}: protected, left alone")
            continue
        for city in cities if history else []:
            try:
                print(f"{date} {city}: {backfill_history(spark, lake, history, city, date, force)}")
            except Exception:
                traceback.print_exc()
                failed += 1
        done.append(date)
        failed += run_day(spark, lake, cities, date)
    return failed + (run_tables(spark, lake, done, sketches) if done else 0)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="wayfare")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("daily", "backfill"):
        c = commands.add_parser(name)
        c.add_argument("--lake", required=True)
        c.add_argument("--city", action="append")
        c.add_argument("--sketches", action="store_true", help="baseline of day states instead of all steps")
    commands.choices["daily"].add_argument("--date", required=True)
    for option in ("--first", "--last"):
        commands.choices["backfill"].add_argument(option, required=True)
    commands.choices["backfill"].add_argument("--history")
    commands.choices["backfill"].add_argument("--force", action="store_true")
    args = parser.parse_args(argv)
    spark, cities = get_session(), args.city or list(CITIES)
    refresh_stops(spark, args.lake)
    if args.command == "daily":
        failed = run_day(spark, args.lake, cities, args.date)
        failed += run_tables(spark, args.lake, [args.date], args.sketches)
    else:
        failed = backfill(spark, args.lake, cities, dates_between(args.first, args.last), args.history, args.force, args.sketches)
    return min(failed, 1)


if __name__ == "__main__":
    sys.exit(main())
