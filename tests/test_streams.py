"""Streams with state: arrivals against a published baseline, observations put in order."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from wayfare.operators import arrivals as A
from wayfare.operators import baseline as B
from wayfare.operators.publish import swap
from wayfare.plans import write_queries
from wayfare.streaming.delays import Published, judged, read_judged, watch
from wayfare.streaming.matcher import ARRIVALS
from wayfare.streaming.ordering import late_counts, match_in_order, write_matched

S = 1_000_000
MONDAY = 1_704_672_000 * S  # 2024-01-08 08:00 in Taipei


@pytest.fixture
def stops(spark):
    rows = [(f"TPE{r}", 0, [25.0 + k * 0.003 for k in range(6)], [121.5] * 6, [f"N{k}" for k in range(6)]) for r in range(2)]
    return spark.createDataFrame(rows, "sub_route_uid string, direction byte, stop_lats array<double>, stop_lons array<double>, station_ids array<string>")


def arrived(spark, *rows):
    """(from, to, sec) as the arrivals of one vehicle."""
    return spark.createDataFrame([("TPE0", 0, "P", MONDAY + k * 60 * S, 0, to, from_, sec) for k, (from_, to, sec) in enumerate(rows)], ARRIVALS)


def steps(spark, *rows):
    """(to, day_type, band, sec, times) from N0."""
    return spark.createDataFrame([("Taipei", "N0", to, d, b, sec, "R", "2024-01-08") for to, d, b, sec, n in rows for _ in range(n)], "city string, from_station_id string, to_station_id string, day_type string, band string, sec long, sub_route_uid string, service_date string")


def test_ladder_finds_the_level_that_holds(spark, stops):
    rolled = B.rollup(steps(spark, ("N1", "weekday", "am_peak", 100, 30), ("N2", "weekday", "midday", 200, 29), ("N2", "weekday", "night", 210, 1), ("N3", "weekend", "night", 300, 2), ("N3", "weekday", None, 9, 1)))
    rungs = B.ladder(rolled)
    assert rungs.count() == 3 and len(rungs.where("to_station_id = 'N1'").first().rungs) == 3
    found = judged(arrived(spark, (0, 1, 101), (0, 1, 100), (0, 2, 500), (0, 3, 10), (0, 4, 10), (None, 0, None)), stops, rungs, "v").orderBy("arrival_us").collect()
    assert [(r.to_station_id, r.level, r.n, r.p90_sec, r.slow) for r in found] == [("N1", "band", 30, 100, True), ("N1", "band", 30, 100, False), ("N2", "daytype", 30, 200, True), ("N3", "pair", 3, 300, False), ("N4", None, None, None, False), ("N0", None, None, None, False)]
    # The ladder says what the published cells say, wherever these have a row.
    cells = B.baseline_segment(rolled)
    same = B.expected(cells.select(*B.CELL, F.lit(0).alias("sec"), F.col("level").alias("want"), F.col("n").alias("want_n"), F.col("p90_sec").alias("want_p90")), rungs)
    assert same.where("not (level <=> want and n <=> want_n and p90_sec <=> want_p90)").count() == 0 and same.count() == cells.count()


def test_a_new_baseline_is_read_between_batches(spark, stops, tmp_path):
    source, ladder = str(tmp_path / "in"), str(tmp_path / "ladder")
    go = lambda: watch(spark.readStream.schema(ARRIVALS).parquet(source), stops, ladder, str(tmp_path / "out"), str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    arrived(spark, (0, 1, 150)).write.parquet(source)
    go()  # nothing is published yet
    for sec in (100, 200):
        swap(spark, B.ladder(B.rollup(steps(spark, ("N1", "weekday", "am_peak", sec, 40)))), ladder, B.CELL[:3])
        arrived(spark, (0, 1, 150)).write.mode("append").parquet(source)
        go()
    got = read_judged(spark, str(tmp_path / "out")).orderBy("baseline_version").collect()
    assert [(r.p90_sec, r.slow) for r in got] == [(None, False), (100, True), (200, False)]
    assert got[0].baseline_version is None and len({r.baseline_version for r in got}) == 3


def test_a_running_stream_follows_the_pointer(spark, stops, tmp_path):
    """Within one run of a query: the second batch goes by the version published meanwhile."""
    source, ladder = str(tmp_path / "in"), str(tmp_path / "ladder")
    swap(spark, B.ladder(B.rollup(steps(spark, ("N1", "weekday", "am_peak", 100, 40)))), ladder, B.CELL[:3])
    arrived(spark, (0, 1, 150)).write.parquet(source)
    query = watch(spark.readStream.schema(ARRIVALS).parquet(source), stops, ladder, str(tmp_path / "out"), str(tmp_path / "checkpoint")).trigger(processingTime="200 milliseconds").start()
    try:
        query.processAllAvailable()
        swap(spark, B.ladder(B.rollup(steps(spark, ("N1", "weekday", "am_peak", 200, 40)))), ladder, B.CELL[:3])
        arrived(spark, (0, 1, 150)).write.mode("append").parquet(source)
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted((r.p90_sec, r.slow) for r in read_judged(spark, str(tmp_path / "out")).collect()) == [(100, True), (200, False)]


def test_published_is_read_once_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    table = Published(spark, path)
    assert table.current() == (None, None)
    swap(spark, spark.range(3), path)
    first = table.current()
    assert first[1].count() == 3 and table.current()[1] is first[1]
    swap(spark, spark.range(4), path)
    assert table.current()[1].count() == 4 and first[1].count() == 3


def observed(vehicles=3, n=60):
    """Observations of vehicles that go along the stops and back to the first."""
    random.seed(8)
    rows = []
    for v in range(vehicles):
        for k in range(n):
            rows.append((f"TPE{v % 2}", 0, f"P{v}", k * 30 * S + v, 25.0 + (k % 24) * 0.00075 + random.random() * 0.0003, 121.5))
    return rows


OBSERVED = "sub_route_uid string, direction byte, plate_numb string, us long, lat double, lon double"
KEYS = ("sub_route_uid", "plate_numb", "us", "near_idx", "trip", "cause")


def ordered(spark, stops, tmp_path, delay_s):
    return write_matched(match_in_order(spark.readStream.schema(OBSERVED).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), stops, delay_s), str(tmp_path / "matched"), str(tmp_path / "late"), str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()


def test_shuffled_batches_give_the_rows_of_the_batch_form(spark, stops, tmp_path):
    """Rows up to ten minutes out of order, in batches, with a restart; a last row ends it all."""
    rows = observed()
    want = {tuple(r[c] for c in KEYS) for r in A.match_positions(spark.createDataFrame(rows, OBSERVED), stops).collect()}
    by = lambda r: r[3] // (300 * S) + random.randrange(3)
    batches = {}
    for r in rows:
        batches.setdefault(by(r), []).append(r)
    for k, b in enumerate(sorted(batches)):
        random.shuffle(batches[b])
        spark.createDataFrame(batches[b], OBSERVED).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if k == 2:
            ordered(spark, stops, tmp_path, 900)
    ends = [(*r[:3], 10_000 * S, None, None) for r in {r[:3]: r for r in rows}.values()]
    spark.createDataFrame(ends, OBSERVED).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    ordered(spark, stops, tmp_path, 900)
    got = spark.read.parquet(str(tmp_path / "matched")).collect()
    assert {tuple(r[c] for c in KEYS) for r in got} == want and len(got) == len(rows)
    assert spark.read.parquet(str(tmp_path / "late")).count() == 0


def test_late_rows_are_kept_and_counted(spark, stops, tmp_path):
    rows = observed(1, 40)
    on_time, late = [r for r in rows if r[3] % (13 * 30 * S)], [r for r in rows if not r[3] % (13 * 30 * S)]
    for some in (on_time, [*late, ("TPE0", 0, "P0", 10_000 * S, None, 121.5)]):
        spark.createDataFrame(some, OBSERVED).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    ordered(spark, stops, tmp_path, 60)
    horizon = max(r[3] for r in on_time) - 60 * S
    too_late = [r for r in late if r[3] <= horizon]
    assert len(too_late) < len(late)  # one is still in time
    want = A.match_positions(spark.createDataFrame([r for r in rows if r not in too_late], OBSERVED), stops)
    got = spark.read.parquet(str(tmp_path / "matched"))
    assert {tuple(r[c] for c in KEYS) for r in got.collect()} == {tuple(r[c] for c in KEYS) for r in want.collect()}
    kept = spark.read.parquet(str(tmp_path / "late")).drop("dt", "batch").collect()
    assert sorted(map(tuple, kept)) == sorted(too_late)
    assert [(r.n_late, r.n_vehicles, r.last_batch) for r in late_counts(spark, str(tmp_path / "late")).collect()] == [(len(too_late), 1, 1)]


def test_a_silent_vehicle_is_matched_after_a_while(spark, stops, tmp_path):
    rows = observed(2, 12)
    spark.createDataFrame(rows, OBSERVED).coalesce(1).write.parquet(str(tmp_path / "in"))
    found = match_in_order(spark.readStream.schema(OBSERVED).parquet(str(tmp_path / "in")), stops, 3600, idle_ms=500)
    query = write_matched(found, str(tmp_path / "matched"), str(tmp_path / "late"), str(tmp_path / "checkpoint")).trigger(processingTime="300 milliseconds").start()
    try:
        for _ in range(150):
            time.sleep(0.4)
            if list(tmp_path.glob("matched/batch=*/_SUCCESS")) and spark.read.parquet(str(tmp_path / "matched")).count() == len(rows):
                break
    finally:
        query.stop()
    want = A.match_positions(spark.createDataFrame(rows, OBSERVED), stops)
    assert {tuple(r[c] for c in KEYS) for r in spark.read.parquet(str(tmp_path / "matched")).collect()} == {tuple(r[c] for c in KEYS) for r in want.collect()}


def test_a_stream_has_a_few_states_for_each_core(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        base = write_queries._in_order(spark, "/root/testdata/sf0.001")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    states = [name for name in os.listdir(f"{base.removeprefix('file://')}/checkpoint/state/0") if name.isdigit()]
    assert len(states) == 4 * spark.sparkContext.defaultParallelism == 16
