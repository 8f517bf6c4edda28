"""Boundary cases of the operators on literal frames."""

import datetime as dt
import glob
import json
import os
import shutil
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.functions import columns as C
from wayfare.operators import arrivals as A
from wayfare.operators import baseline as B
from wayfare.operators import dimensions as D
from wayfare.operators import observations as O
from wayfare.operators import transfers as T
from wayfare import cli
from wayfare.streaming.archive import ProgressLog
from wayfare.operators.publish import PublishError, backfill_positions, compact_day, dates_between, files_for, is_protected, late_records, packed, read_published, recompact, swap, violations, write_jdbc
from wayfare.schemas import POSITIONS, RAW_POSITION, SchemaDriftError, conform, drift
from wayfare.sources.lake import read_snapshots, row_counts, write_raw, write_table
from wayfare.sources.paged import RunawaySource, paged_documents, register_paged

S = 1_000_000


def arrivals(spark, rows):
    return spark.createDataFrame([("c", "2024-01-01", "s", r, us, b) for r, us, b in rows], "city string, data_date string, station_id string, route string, us long, boarding int")


def test_next_departure_is_strictly_later(spark):
    rows = arrivals(spark, [("A", 0, 0), ("A", 10 * S, 0), ("A", 99 * S, 0), ("B", 10 * S, 0), ("B", 30 * S, 0)])
    got = {(r.route_a, r.us // S): r.b_us // S for r in T.pair_transfers(rows).collect()}
    assert got == {("A", 0): 10, ("A", 10): 30, ("B", 10): 99, ("B", 30): 99}


def test_boarding_is_judged_by_route(spark):
    rows = arrivals(spark, [("A", 0, 1), ("A", 5 * S, -1), ("B", 9 * S, -1), ("B", 20 * S, 1), (None, 1, 0)])
    got = {(r.route_a, r.us // S, r.b_us // S) for r in T.pair_transfers(rows).collect()}
    assert got == {("A", 0, 9), ("A", 5, 9)}


def test_waits_at_the_cap_and_without_success(spark):
    pairs = spark.createDataFrame([("c", "d", "s", "A", "B", 0, w * S) for w in (29, 30, 3600, 3601)] + [("c", "d", "s", "B", "A", 0, 4000 * S)], "city string, data_date string, station_id string, route_a string, route_b string, us long, b_us long")
    got = {(r.route_a, r.wait_bin): (r["count"], r.n_total, r.n_over) for r in T.transfer_histogram(pairs).collect()}
    assert got == {("A", 0): (1, 4, 1), ("A", 1): (1, 4, 1), ("A", 120): (1, 4, 1), ("B", None): (0, 1, 1)}
    assert {r.route_a for r in T.transfer_histogram(pairs, compat=True).collect()} == {"A"}
    short = {(r.route_a, r.wait_bin): r.n_over for r in T.recap(T.transfer_histogram(pairs), 1200).collect()}
    assert short == {("A", 0): 2, ("A", 1): 2, ("B", None): 1}


def test_quantile_at_a_bin_edge(spark):
    hist = spark.createDataFrame([("c", f"d{d}", "s", "A", "B", "night", b, n, 10, 0) for d, b, n in ((1, 0, 5), (1, 4, 5))], "city string, data_date string, station_id string, route_a string, route_b string, bucket string, wait_bin int, count long, n_total long, n_over long")
    row = T.transfer_marts(hist, 1).first()
    assert (row.wait_p50, row.wait_p90, row.success_rate, row.n_days) == (15.0, 135.0, 1.0, 1)
    assert T.transfer_marts(hist, 11).count() == 0


@pytest.mark.parametrize("at,bucket,band,kind", [("2024-01-06 23:00", "night", "night", "weekend"), ("2024-01-06 08:00", "weekend", "am_peak", "weekend"), ("2024-01-08 06:59", "weekday_offpeak", "am_peak", "weekday"), ("2024-01-08 07:00", "weekday_peak", "am_peak", "weekday"), ("2024-01-08 09:00", "weekday_offpeak", "am_peak", "weekday"), ("2024-01-08 19:00", "weekday_offpeak", "pm_peak", "weekday"), ("2024-01-08 22:00", "weekday_offpeak", "evening", "weekday"), ("2024-01-08 05:00", "night", "night", "weekday")])
def test_calendar(spark, at, bucket, band, kind):
    t = F.lit(at).cast("timestamp")
    assert tuple(spark.range(1).select(C.time_bucket(t), C.band(F.hour(t)), C.day_type(t)).first()) == (bucket, band, kind)


def test_sql_functions_agree(spark):
    C.register_sql(spark)
    row = spark.sql("SELECT time_bucket(TIMESTAMP '2024-01-08 08:30:00') a, hour_band(16) b, haversine_m(25, 121, 25, 121.001) c").first()
    assert (row.a, row.b) == ("weekday_peak", "pm_peak") and row.c == pytest.approx(100.77, abs=0.05)


def test_unknown_prefix_raises(spark):
    with pytest.raises(Exception, match="unknown prefix"):
        spark.range(1).select(C.city_of(F.lit("XXX1"))).collect()


def stop_row(*distances):
    return np.array([distances], float)


def test_matcher_boundaries():
    d = np.array([[100.0, 500.0], [100.0001, 500.0]])
    matched, trips, causes, _ = A.match_sequence(d, np.array([0.0, 10.0]))
    assert matched.tolist() == [0, -1] and causes.tolist() == [1, 0]
    far = np.full((3, 3), 900.0)
    far[0, 0] = 50
    assert A.match_sequence(far, np.array([0.0, 1200.0, 1200.5]))[2].tolist() == [1, 0, 3]
    assert A.match_sequence(np.array([[300.0, 300.0]]), np.array([0.0]))[3].stop == 0


def test_matcher_goes_on_from_its_state():
    rng = np.random.default_rng(0)
    d, t = rng.uniform(0, 400, (200, 30)), np.cumsum(rng.uniform(1, 900, 200))
    whole = A.match_sequence(d, t)
    first = A.match_sequence(d[:77], t[:77])
    second = A.match_sequence(d[77:], t[77:], first[3])
    for a, b, c in zip(whole[:3], first[:3], second[:3], strict=True):
        assert (a == np.concatenate([b, c])).all()
    assert (whole[2] > 0).sum() == whole[1].max() + 1


def test_loop_route_is_one_trip_a_lap():
    stops = np.array([[k * 300.0, 0.0] for k in range(17)] + [[k * 300.0, 30.0] for k in range(16, -1, -1)])
    path = np.concatenate([np.linspace(stops[i], stops[i + 1], 10, endpoint=False) for i in range(33)] + [stops[33:]])
    laps = np.concatenate([np.concatenate([path, [[-400.0, 15.0]]]) for _ in range(3)])
    d = np.sqrt(((laps[:, None] - stops[None]) ** 2).sum(2))
    matched, trips, causes, _ = A.match_sequence(d, np.arange(len(d)) * 5.0)
    assert trips.max() >= 2
    for trip in range(trips.max() + 1):
        inside = matched[(trips == trip) & (matched >= 0)]
        assert (np.diff(inside) >= -1).all()


def test_sessions_split_after_more_than_the_gap(spark):
    rows = [("v", 0, 1, 0), ("v", 120 * S, 1, 0), ("v", 241 * S, 1, 0), ("v", 242 * S, 2, 0), ("v", 243 * S, 1, 0), ("v", 244 * S, 1, 1)]
    got = A.sessions(spark.createDataFrame(rows, "v string, us long, stop int, trip int"), ["v"], "us", "stop", "trip").orderBy("us").collect()
    assert [r.event for r in got] == [1, 1, 2, 3, 4, 5]


def test_normalizing_awkward_records(spark):
    texts = ['{"PlateNumb": "A", "OperatorNo": "0303", "RouteID": 10132, "BusPosition": {"PositionLat": 25.1}, "GPSTime": "2024-01-01T08:00:00.987+08:00", "New": 1}', '{"PlateNumb": "B", "GPSTime": "soon"}', "{}"]
    raw = spark.createDataFrame([(t,) for t in texts], "t string").select(F.from_json("t", RAW_POSITION).alias("m")).select("m.*")
    a, b, c = O.normalize(raw, {"city": "X"}).collect()
    assert (a.operator_no, a.route_id, a.lat, a.lon, a.city, str(a.gps_time)[-8:]) == ("0303", "10132", 25.1, None, "X", "00:00:00")
    assert b.gps_time is None and c.plate_numb is None and O.normalize(raw).columns == POSITIONS.names


def test_drift_and_conform(spark):
    assert drift(["a", "b"], ["b", "c"]) == {"missing": ["c"], "extra": ["a"]}
    with pytest.raises(SchemaDriftError):
        drift(["a"], ["b"], strict=True)
    wide = spark.createDataFrame([(300,)], "direction int")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        conform(wide, POSITIONS).collect()


def test_coordinates_and_unknown_status(spark):
    rows = spark.createDataFrame([(1.0, 1.0, None, None), (float("nan"), 1.0, 0, 5), (None, 1.0, 99, 5), (30.0, 121.0, 3, 101)], "lat double, lon double, bus_status int, speed int")
    assert O.with_coordinates(rows).count() == 2
    got = O.outlier_flags(rows).collect()
    assert [r.status_other for r in got] == [True, False, False, True] and got[3].bad_coordinates and got[3].bad_speed


def test_cutover_keeps_rows_of_unknown_time(spark):
    old = spark.createDataFrame([(1, 5), (2, 10), (3, None)], "k int, t long")
    live = spark.createDataFrame([(4, 10)], "k int, t long")
    assert {r.k for r in O.merge_at_cutover(old, live, "t").collect()} == {1, 3, 4}


def test_ladder_takes_the_finest_level_that_holds(spark):
    def steps(n, kind, band):
        return [("c", "a", "b", kind, band, 60 + k, "r", "2024-01-01") for k in range(n)]

    rows = steps(30, "weekday", "midday") + steps(29, "weekday", "night") + steps(3, "weekend", "night")
    df = spark.createDataFrame(rows, "city string, from_station_id string, to_station_id string, day_type string, band string, sec long, sub_route_uid string, service_date string")
    got = {(r.day_type, r.band): (r.level, r.n) for r in B.baseline_segment(B.rollup(df)).collect()}
    assert got == {("weekday", "midday"): ("band", 30), ("weekday", "night"): ("daytype", 59), ("weekend", "night"): ("pair", 62)}


def test_lead_bridges_gaps_in_the_numbers(spark):
    stops = spark.createDataFrame([("c", "r", 0, n, f"s{n}", "x") for n in (1, 2, 4)], "city string, sub_route_uid string, direction int, seq int, station_id string, stop_name string")
    assert B.route_segments(stops).count() == 2 and B.route_segments(stops, by_lead=False).count() == 1


def test_versions(spark):
    at = lambda d: F.lit(f"2024-01-0{d}").cast("timestamp")
    schema = "_id string, sub_route_uid string, direction int, valid_from timestamp, valid_to timestamp"
    first = spark.createDataFrame([("a0v1", "a", 0), ("a1v1", "a", 1)], "_id string, sub_route_uid string, direction int").withColumns({"valid_from": at(1), "valid_to": F.lit(None).cast("timestamp")})
    second = spark.createDataFrame([("a0v2", "a", 0, None, None), ("a1v1", "a", 1, None, None)], schema)
    out = D.upsert_versions(first, second, ["sub_route_uid", "direction"], at(2))
    assert {(r._id, r.change, r.valid_to is None) for r in out.collect()} == {("a0v1", "closed", False), ("a1v1", "kept", True), ("a0v2", "added", True)}
    again = D.upsert_versions(out.drop("change"), second, ["sub_route_uid", "direction"], at(3))
    assert {r.change for r in again.collect()} == {"kept"}


def test_swap_keeps_the_old_table_when_checks_fail(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    assert swap(spark, df, path, ["id"]) == 3
    for bad in (df.where("id > 9"), df.union(df)):
        with pytest.raises(PublishError):
            swap(spark, bad, path, ["id"])
    assert read_published(spark, path).count() == 3
    swap(spark, spark.range(5), path, ["id"])
    assert read_published(spark, path).count() == 5
    assert len([x for x in os.listdir(path) if x.startswith("v-")]) == 2


def test_compaction(spark, tmp_path):
    staging, silver = str(tmp_path / "staging"), str(tmp_path / "silver")
    rows = spark.createDataFrame([(0, 1, "t1", "x"), (0, 1, "t2", "x"), (0, 2, "t1", "y")], "kafka_partition int, kafka_offset long, consume_time string, v string")
    part = f"{staging}/city=A/dt=2024-01-01"
    rows.repartition(2).write.parquet(part)
    with pytest.raises(PublishError, match="not over"):
        compact_day(spark, staging, silver, "A", "2024-01-01", "2024-01-01")
    done = compact_day(spark, staging, silver, "A", "2024-01-01", "2024-01-02")
    assert (done.read, done.written) == (3, 2)
    assert compact_day(spark, staging, silver, "A", "2024-01-01", "2024-01-02").written == 0
    # A run that broke off before it deleted what it had taken.
    taken = [r.file for r in spark.read.parquet(f"{silver}/_taken/city=A/dt=2024-01-01").collect()]
    left = taken[0].removeprefix("file:").replace("///", "/")
    os.makedirs(os.path.dirname(left), exist_ok=True)
    rows.coalesce(1).write.parquet(str(tmp_path / "copy"))
    shutil.copy(glob.glob(str(tmp_path / "copy" / "part-*"))[0], left)
    assert compact_day(spark, staging, silver, "A", "2024-01-01", "2024-01-02").written == 0 and not os.path.exists(left)
    with pytest.raises(PublishError, match="nothing is staged"):
        compact_day(spark, staging, silver, "B", "2024-01-01", "2024-01-02")
    rows.write.mode("append").parquet(part)
    with pytest.raises(PublishError, match="published"):
        compact_day(spark, staging, silver, "A", "2024-01-01", "2024-01-02")
    assert late_records(spark, staging, silver, "A", "2024-01-01").count() == 3
    assert late_records(spark, staging, silver, "B", "2024-01-01") is None
    assert dates_between("2024-02-28", "2024-03-01") == ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_raw_files_and_database(spark, tmp_path):
    df = spark.createDataFrame([("0303", 1), ("x", 2)], "id string, n int")
    write_raw(df, str(tmp_path / "raw"))
    write_raw(df, str(tmp_path / "raw"))
    assert spark.read.schema(df.schema).json(str(tmp_path / "raw")).where("id = '0303'").count() == 2
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    write_jdbc(df.repartition(2), url, "t", driver)
    assert sorted(map(tuple, spark.read.jdbc(url, "t", properties=driver).collect())) == [("0303", 1), ("x", 2)]


def test_backfill_is_guarded(spark, tmp_path):
    silver, rows = str(tmp_path), spark.range(4)
    assert backfill_positions(spark, rows, silver, "A", "2026-08-21") is None
    assert backfill_positions(spark, rows, silver, "A", "2026-08-16").incomplete
    assert backfill_positions(spark, spark.range(9), silver, "A", "2026-08-16") is None
    assert backfill_positions(spark, spark.range(9), silver, "A", "2026-08-16", force=True).rows == 9
    day = f"{silver}/city=A/dt=2026-08-20"
    at = lambda *xs: spark.createDataFrame([(x,) for x in xs], "update_time long")
    at(5, 6).write.parquet(day)
    assert backfill_positions(spark, at(1, 4, 5, None), silver, "A", "2026-08-20").rows == 5
    assert sorted(r.update_time or 0 for r in spark.read.parquet(day).collect()) == [0, 1, 4, 5, 6]


def test_violations(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 2.0), (None, "c", 3.0)], "k int, v string, x double")
    assert {(r.rule, r.n) for r in violations(df, ["k"], ["x"], {"v": ["a", "b"]}).collect()} == {("k is null", 1), ("x is null", 1), ("v has another value", 1)} | {("k not unique", 1)}
    assert violations(df.where("v = 'b'"), ["k"], ["x"]).collect() == []


def test_progress_log(spark, tmp_path):
    log = ProgressLog()
    spark.range(7).write.parquet(str(tmp_path / "in"))
    spark.streams.addListener(log)
    try:
        q = spark.readStream.schema("id long").parquet(str(tmp_path / "in")).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
        for _ in range(100):
            if log.queries.get(str(q.runId), {}).get("state") == "ended":
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    assert log.queries[str(q.runId)]["rows"] == 7 and log.queries[str(q.runId)]["error"] is None


def test_daily_chain(spark, tmp_path, monkeypatch):
    """A tiny lake from staged messages and raw routes to serving tables."""
    lake = str(tmp_path)
    stop = lambda k: {"StopSequence": k, "StopUID": f"u{k}", "StopID": f"s{k}", "StationID": f"S{k}", "LocationCityCode": None, "StopName": {"Zh_tw": f"n{k}", "En": None}, "StopBoarding": 0, "StopPosition": {"PositionLat": 25 + k * 0.01, "PositionLon": 121.5, "GeoHash": None}}
    for route in "12":
        doc = {"SubRouteUID": f"TPE{route}", "RouteUID": f"R{route}", "VersionID": "1", "UpdateTime": "t", "Direction": 0, "RouteName": {"Zh_tw": route, "En": None}, "SubRouteName": {"Zh_tw": route, "En": None}, "Operators": [], "Stops": [stop(k) for k in (3, 1, 2)]}
        os.makedirs(f"{lake}/raw_routes/Taipei", exist_ok=True)
        with open(f"{lake}/raw_routes/Taipei/{route}.json", "w") as f:
            json.dump([doc], f)
    rows = []
    for vehicle in range(60):
        for k in (1, 2, 3):
            t, route = dt.datetime(2024, 1, 8, 1) + dt.timedelta(seconds=k * 180 + vehicle * 30), f"TPE{1 + vehicle % 2}"
            rows.append((f"P{vehicle}", route, 0, 1, 25 + k * 0.01, 121.5, 10, 0, t, t, t, 0, len(rows), "c"))
    df = spark.createDataFrame(rows, "plate_numb string, sub_route_uid string, direction byte, duty_status byte, lat double, lon double, speed short, bus_status short, gps_time timestamp, update_time timestamp, snapshot_time timestamp, kafka_partition int, kafka_offset long, consume_time string").withColumn("route_uid", F.col("sub_route_uid"))
    df.union(df).write.parquet(f"{lake}/staging/city=Taipei/dt=2024-01-08")
    monkeypatch.setattr(cli, "get_session", lambda: spark)
    assert cli.main(["daily", "--lake", lake, "--city", "Taipei", "--date", "2024-01-08"]) == 0
    assert spark.read.parquet(f"{lake}/events").count() == 180 and spark.read.parquet(f"{lake}/steps").count() == 120
    assert read_published(spark, f"{lake}/marts").count() > 0
    assert read_published(spark, f"{lake}/baseline").count() == 2
    assert read_published(spark, f"{lake}/serving/route_stop").count() == 6
    assert spark.read.json(f"{lake}/metrics").first().raw_records == 180
    assert cli.main(["backfill", "--lake", lake, "--city", "Taipei", "--first", "2024-01-08", "--last", "2024-01-08"]) == 0
    assert spark.read.parquet(f"{lake}/events").count() == 180
    exact = sorted(map(tuple, read_published(spark, f"{lake}/baseline").collect()))
    assert cli.main(["daily", "--lake", lake, "--city", "Taipei", "--date", "2024-01-08", "--sketches"]) == 0
    assert sorted(map(tuple, read_published(spark, f"{lake}/baseline").collect())) == exact
    assert read_published(spark, f"{lake}/ladder").count() == 2


def test_backfill_of_a_history(spark, tmp_path, monkeypatch, capsys):
    """Raw snapshots of days become positions; a protected day in between is left alone and
    doesn't keep the days after it from being done."""
    lake, history = str(tmp_path / "lake"), str(tmp_path / "history")
    write_json = lambda path, rows: (os.makedirs(os.path.dirname(path), exist_ok=True), open(path, "w").write(json.dumps(rows)))
    doc = {"SubRouteUID": "TPE1", "RouteUID": "R1", "VersionID": "1", "UpdateTime": "t", "Direction": 0, "RouteName": {"Zh_tw": "1", "En": None}, "SubRouteName": {"Zh_tw": "1", "En": None}, "Operators": [], "Stops": [{"StopSequence": k, "StopUID": f"u{k}", "StopID": f"s{k}", "StationID": f"S{k}", "LocationCityCode": None, "StopName": {"Zh_tw": f"n{k}", "En": None}, "StopBoarding": 0, "StopPosition": {"PositionLat": 25 + k * 0.01, "PositionLon": 121.5, "GeoHash": None}} for k in (1, 2, 3)]}
    write_json(f"{lake}/raw_routes/Taipei/1.json", [doc])
    for day in ("2026-08-19", "2026-08-21", "2026-08-26"):
        for k in (1, 2, 3):
            at = f"{day}T09:0{k}:00+08:00"
            write_json(f"{history}/Taipei/{day}/090{k}00.json", [{"PlateNumb": f"P{v}", "SubRouteUID": "TPE1", "Direction": 0, "DutyStatus": 1, "BusStatus": 0, "BusPosition": {"PositionLat": 25 + k * 0.01, "PositionLon": 121.5}, "GPSTime": at, "UpdateTime": at} for v in range(4)])
    monkeypatch.setattr(cli, "get_session", lambda: spark)
    assert cli.main(["backfill", "--lake", lake, "--city", "Taipei", "--first", "2026-08-19", "--last", "2026-08-19", "--history", history]) == 1  # no transfers of one route: no marts
    failed = cli.backfill(spark, lake, ["Taipei"], ["2026-08-21", "2026-08-26"], history, False)
    said = capsys.readouterr().out
    assert "2026-08-21: protected" in said and "2026-08-26 Taipei: 12 rows" in said and failed == 1
    assert {str(r.dt) for r in spark.read.parquet(f"{lake}/silver").select("dt").distinct().collect()} == {"2026-08-19", "2026-08-26"}
    assert spark.read.parquet(f"{lake}/events").groupBy("dt").count().orderBy("dt").select("count").collect() == [(12,), (12,)]
    assert cli.backfill_history(spark, lake, history, "Taipei", "2026-08-26") == "left alone"
    assert cli.backfill_history(spark, lake, history, "Taipei", "2026-08-27") == "no snapshots"


def test_routes_of_other_cities_only(spark, tmp_path):
    os.makedirs(tmp_path / "raw_routes" / "Elsewhere")
    cli.refresh_stops(spark, str(tmp_path))
    assert not (tmp_path / "route_stops").exists()


def test_files_follow_the_bytes():
    assert [files_for(n, 100) for n in (0, 1, 149, 151, 1000)] == [1, 1, 1, 2, 10]
    assert packed({"a": 90, "b": 10, "c": 60, "d": 40, "e": 500}, 100) == [["e"], ["a", "b"], ["c", "d"]]
    bins = packed({f"f{k}": 1 for k in range(1000)}, 64)
    assert len(bins) == 16 and sorted(f for b in bins for f in b) == sorted(f"f{k}" for k in range(1000))


@pytest.mark.parametrize("files", [1, 40])
def test_compaction_by_size(spark, tmp_path, files):
    """One staged file or many: files near the target, rows unchanged."""
    rows = spark.range(4000).select((F.col("id") % 3).cast("int").alias("kafka_partition"), F.col("id").alias("kafka_offset"), F.sha2(F.col("id").cast("string"), 256).alias("plate_numb"), F.lit("t").alias("consume_time"))
    staging, silver = str(tmp_path / "staging"), str(tmp_path / "silver")
    rows.repartition(files).write.parquet(f"{staging}/city=A/dt=2024-01-01")
    staged = sum(os.path.getsize(f) for f in glob.glob(f"{staging}/city=A/dt=2024-01-01/*.parquet"))
    assert compact_day(spark, staging, silver, "A", "2024-01-01", "2024-01-02", staged // 4).written == 4000
    made = glob.glob(f"{silver}/city=A/dt=2024-01-01/*.parquet")
    assert 3 <= len(made) <= 4 and spark.read.parquet(silver).select("kafka_offset").distinct().count() == 4000


def test_recompaction(spark, tmp_path):
    folder = str(tmp_path / "t" / "dt=1")
    rows = spark.range(3000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
    rows.repartition(60).write.parquet(folder)
    size = sum(os.path.getsize(f) for f in glob.glob(f"{folder}/*.parquet"))
    assert recompact(spark, folder, ["id"], size // 3) in ((60, 3), (60, 4))
    made = [os.path.getsize(f) for f in glob.glob(f"{folder}/*.parquet")]
    assert max(made) <= size // 2 and sorted(map(tuple, spark.read.parquet(folder).collect())) == sorted(map(tuple, rows.collect()))
    assert recompact(spark, folder, ["id"], min(made)) == (len(made), len(made))  # no two fit into one
    assert sorted(os.listdir(tmp_path / "t")) == ["dt=1"]
    os.rename(folder, str(tmp_path / "t" / "_building-dt=1"))  # as if it ended between its two renames
    shutil.copytree(tmp_path / "t" / "_building-dt=1", tmp_path / "t" / "_old-dt=1")
    recompact(spark, folder, ["id"], size // 3)
    assert spark.read.parquet(folder).count() == 3000 and sorted(os.listdir(tmp_path / "t")) == ["dt=1"]


def test_snapshots_keep_ids_and_report_broken_files(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "101500.json.gz", "wt") as f:
        f.write('[{"PlateNumb": "0012", "Direction": 1}, {"PlateNumb": "B"}]')
    rows = read_snapshots(spark, str(tmp_path), "2024-01-01").collect()
    assert {r.PlateNumb for r in rows} == {"0012", "B"} and rows[0].SnapshotTime == "2024-01-01T02:15:00Z"


def _pages(url, parameters):
    skip, top = int(parameters["$skip"]), int(parameters["$top"])
    return [{"n": k} for k in range(skip, min(skip + top, 25))]


def test_paged_source(spark):
    assert paged_documents(spark, "u", _pages, readers=3, size=10).count() == 25
    with pytest.raises(Exception, match=RunawaySource.__name__):
        paged_documents(spark, "u", _pages, readers=1, size=1, guard=5).collect()


def test_paged_format(spark, tmp_path):
    """A service as a data source: offsets leave out pages, equalities reach the service."""
    log = str(tmp_path / "log")

    def serve(url, parameters):
        with open(log, "a") as f:
            f.write(f"{parameters['$skip']} {parameters.get('$filter', '')}\n")
        rows = [{"UID": f"r{k}", "City": "it's" if k % 3 == 0 else "B", "Seq": k} for k in range(95)]
        if asked := parameters.get("$filter"):
            assert asked in ("City eq 'it''s'", "City eq 'it''s' and Seq eq 9")
            rows = [r for r in rows if r["City"] == "it's" and ("Seq" not in asked or r["Seq"] == 9)]
        skip = int(parameters["$skip"])
        return rows[skip : skip + int(parameters["$top"])]

    def asked():
        lines = sorted(open(log).read().splitlines(), key=lambda x: int(x.split()[0]))
        os.remove(log)
        return lines

    register_paged(spark, "timetable", serve)
    read = spark.read.format("timetable").option("pageSize", 10).option("readers", 3)
    assert sorted(r.offset for r in read.load("u").collect()) == list(range(95)) and len(asked()) >= 10
    some = read.load("u").where("offset >= 25 and offset < 41")
    assert sorted((r.offset, json.loads(r.document)["Seq"]) for r in some.collect()) == [(k, k) for k in range(25, 41)]
    assert [x.split()[0] for x in asked()] == ["20", "30", "40"]
    assert read.load("u").where("offset = 94").count() == 1 and [x.split()[0] for x in asked()] == ["90"]
    assert read.load("u").where("offset < 0").count() == 0
    fields = read.schema("UID string, City string, Seq long").load("u")
    assert fields.where("City = \"it's\"").count() == 32 and all("eq" in x for x in asked())
    assert [r.UID for r in fields.where("City = \"it's\" and Seq = 9").collect()] == ["r9"]
    both = read.schema("offset long, City string").load("u").where("offset > 50 and City = \"it's\"")
    assert sorted(r.offset for r in both.collect()) == list(range(51, 95, 3))
    with pytest.raises(Exception, match=RunawaySource.__name__):
        read.option("guard", 20).load("u").collect()


def test_grid_pairs_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    pts = [(i, float(25 + x * 0.01), float(121 + y * 0.01)) for i, (x, y) in enumerate(rng.uniform(0, 1, (80, 2)))]
    df = spark.createDataFrame(pts, "id int, lat double, lon double")
    got = {(r.id_a, r.id_b) for r in D.near_pairs(df, 20, 300, 0.004).collect()}
    lat, lon = (np.array([p[k] for p in pts]) for k in (1, 2))
    d = A.haversine_matrix(lat, lon, lat, lon)
    assert got == {(i, j) for i in range(80) for j in range(i + 1, 80) if 20 <= d[i, j] <= 300}


def test_pairs_of_few_places_go_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 16)
    monkeypatch.setattr(D, "PAIRS_A_TASK", 2000)
    pts = [(i, 25.0 + i % 3 * 0.001, 121.5, f"s{i}") for i in range(300)] + [(None, 25.0, 121.5, "x"), (300, None, 121.5, "x"), (7, 25.0, 121.5, "x")]
    df = spark.createDataFrame(pts, "id int, lat double, lon double, name string").coalesce(1)
    pairs = D.near_pairs(df, 100, 120, 0.004)
    assert pairs.columns == ["id_a", "lat_a", "lon_a", "name_a", "id_b", "lat_b", "lon_b", "name_b", "dist_m"]
    rows = pairs.withColumn("task", F.spark_partition_id()).collect()
    near = {(0, 1), (1, 0), (1, 2), (2, 1)}
    place = lambda p: round((p[1] - 25) * 1000)
    want = sorted((p[0], p[3], q[0], q[3]) for p in pts for q in pts if None not in (*p, *q) and p[0] < q[0] and (place(p), place(q)) in near)
    assert sorted((r.id_a, r.name_a, r.id_b, r.name_b) for r in rows) == want
    tasks = [sum(r.task == t for r in rows) for t in {r.task for r in rows}]
    assert len(tasks) > 10 and max(tasks) < len(rows) / 4


def test_a_large_partition_is_several_sorted_files(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 100 == 0, "b").otherwise("a").alias("city"), (F.col("id") * 7919 % 40_000).alias("v"))
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_table(df, "ranged", ["city"], ["v"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    found = spark.table("ranged")
    assert sorted(map(tuple, found.select("city", "v").collect())) == sorted(map(tuple, df.collect()))
    assert max(r.n_rows for r in row_counts(found).collect()) < 20_000
    ranges = found.groupBy("city", F.col("_metadata.file_name").alias("file")).agg(F.min("v").alias("low"), F.max("v").alias("high")).orderBy("city", "low").collect()
    assert all(x.high < y.low for x, y in zip(ranges, ranges[1:]) if x.city == y.city)
    spark.sql("drop table ranged")


def test_version_at(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    versions = spark.createDataFrame([("r", "1", t(2), t(12)), ("r", "2", t(12), None), ("gap", "1", t(2), t(3)), ("gap", "2", t(5), None)], "k string, v string, valid_from timestamp, valid_to timestamp")
    events = spark.createDataFrame([("r", t(1)), ("r", t(2)), ("r", t(11)), ("r", t(12)), ("r", t(23)), ("gap", t(4)), ("none", t(4)), (None, t(4)), ("r", None)], "k string, at timestamp")
    got = {(r.k, r.at.hour if r.at else None): r.v for r in D.version_at(events, versions, ["k"], "at", ["v"]).collect()}
    assert got == {("r", 1): "1", ("r", 2): "1", ("r", 11): "1", ("r", 12): "2", ("r", 23): "2", ("gap", 4): None, ("none", 4): None, (None, 4): None, ("r", None): None}
    assert D.version_at(events, versions, ["k"], "at", ["v"], before_first=False).where("at < '2024-01-01 02:00:00'").first().v is None


def test_stops_change_at_noon(spark):
    """A vehicle goes by the old stops, then by the new ones, which lie elsewhere; its runs go on
    being numbered."""
    lists = lambda v, shift, a, b: ("TPE1", 0, v, a, b, [1, 2, 3], [f"S{v}{k}" for k in range(3)], ["n"] * 3, [0] * 3, [25.0 + shift + k * 0.01 for k in range(3)], [121.5] * 3)
    noon = dt.datetime(2024, 1, 1, 4)
    stops = spark.createDataFrame([lists("1", 0.0, dt.datetime(2023, 1, 1), noon), lists("2", 0.5, noon, None)], "sub_route_uid string, direction byte, version_id string, valid_from timestamp, valid_to timestamp, stop_seqs array<int>, station_ids array<string>, stop_names array<string>, boardings array<int>, stop_lats array<double>, stop_lons array<double>")
    rows = [("TPE1", 0, "P", noon + dt.timedelta(minutes=10 * k), 25.0 + (0.5 if k >= 0 else 0.0) + (k + 3) % 3 * 0.01, 121.5, 9) for k in range(-3, 3)]
    observed = spark.createDataFrame(rows, "sub_route_uid string, direction byte, plate_numb string, at timestamp, lat double, lon double, speed int").withColumn("us", F.unix_micros("at"))
    dated = D.version_at(observed, stops, ["sub_route_uid", "direction"], "at", ["version_id"]).drop("at")
    events = A.arrival_events(A.match_positions(dated, stops, by_version=True), stops).orderBy("arrival_us").collect()
    assert [(r.station_id, r.version_id, r.trip) for r in events] == [("S10", "1", 0), ("S11", "1", 0), ("S12", "1", 0), ("S20", "2", 1), ("S21", "2", 1), ("S22", "2", 1)]


def test_clustered_tables_shuffle_nothing(spark):
    from wayfare.sources.lake import read_table, write_clustered

    rows = spark.range(5000).select((F.col("id") % 97).alias("k"), F.col("id").alias("x"))
    for name, df in (("wayfare_left", rows), ("wayfare_right", rows.groupBy("k").agg(F.max("x").alias("y")))):
        write_clustered(df, name, ["k"], 4, [df.columns[1]])
    try:
        joined = read_table(spark, "wayfare_left", ["k", "x"]).hint("merge").join(read_table(spark, "wayfare_right", ["k", "y"]), "k").groupBy("k").agg(F.count("*").alias("n"), F.max("y").alias("y"))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert {(r.k, r.y) for r in joined.collect()} == {(k, max(range(k, 5000, 97))) for k in range(97)}
        assert spark.table("wayfare_left").inputFiles().__len__() == 4
    finally:
        for name in ("wayfare_left", "wayfare_right"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
