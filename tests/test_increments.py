"""What is kept up to date from parts: marts by day, the baseline from sketches of days."""

import random

import pytest
from pyspark.sql import functions as F

from wayfare.operators import baseline as B
from wayfare.operators import mart_state as M
from wayfare.operators import sketches as K
from wayfare.operators import transfers as T
from wayfare.operators.publish import PublishError, delete, read_published
from wayfare.sources.lake import write_partitioned

HIST = "city string, data_date string, station_id string, route_a string, route_b string, bucket string, wait_bin int, count long, n_total long, n_over long"


def histograms(seed, days):
    """Random histograms of the right shape: totals alike within a pair and day."""
    random.seed(seed)
    rows = []
    for day in days:
        for pair in range(6):
            if random.random() < 0.8:
                bins = {b: random.randrange(1, 9) for b in random.sample(range(20), random.randrange(4))}
                over = random.randrange(5)
                total = sum(bins.values()) + over
                rows += [("c", day, f"s{pair % 2}", "A", f"B{pair}", "night", b, n, total, over) for b, n in bins.items()]
                if not bins and over:
                    rows.append(("c", day, f"s{pair % 2}", "A", f"B{pair}", "night", None, 0, over, over))
    return rows


def test_days_added_redone_and_taken_out(spark, tmp_path):
    days, base, path = [f"2024-01-0{k}" for k in range(1, 7)], str(tmp_path / "state"), str(tmp_path / "hist")
    now = {}

    def put(seed, some):
        for day in some:
            now[day] = histograms(seed, [day])
        rows = spark.createDataFrame([r for day in some for r in now[day]], HIST)
        write_partitioned(rows.withColumn("dt", F.col("data_date")), path, "dt")

    def same(min_samples):
        full = T.transfer_marts(spark.createDataFrame([r for d in now for r in now[d]], HIST), min_samples)
        got = M.marts(read_published(spark, f"{base}/state"), min_samples)
        assert got.columns == full.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect()))

    put(1, days[:3])
    assert set(M.update(spark, base, path, days[:3])) == set(days[:3])
    same(1)
    put(2, days[3:])
    put(3, days[1:2])
    M.update(spark, base, path, days[1:])  # a redone day, one that has not changed, new ones
    same(5)
    before = M.days_in(read_published(spark, f"{base}/state"))
    M.update(spark, base, path, days[:2])
    M.update(spark, base, path, days[:2])
    same(1)
    assert M.days_in(read_published(spark, f"{base}/state")).keys() == before.keys()
    delete(spark, f"{path}/dt={days[0]}")
    del now[days[0]]
    assert set(M.update(spark, base, path, days[:1])) == set(days[1:])
    same(1)
    assert M.update(spark, base, path, ["2030-01-01"]).keys() == now.keys()
    delete(spark, path)
    with pytest.raises(PublishError):
        M.update(spark, base, path, days)
    same(1)  # the state stays


def test_an_update_reads_its_days_alone(spark, tmp_path):
    """Other days' files may be gone or broken: nobody looks at them."""
    base, path, days = str(tmp_path / "state"), tmp_path / "hist", ["2024-01-01", "2024-01-02"]
    write_partitioned(spark.createDataFrame(histograms(1, days), HIST).withColumn("dt", F.col("data_date")), str(path), "dt")
    M.update(spark, base, str(path), days)
    for f in (path / f"dt={days[0]}").glob("*.parquet"):
        f.write_bytes(b"no parquet at all")
    M.update(spark, base, str(path), days[1:])
    assert M.days_in(read_published(spark, f"{base}/state")).keys() == set(days)


def test_a_share_that_was_not_in_raises(spark):
    share = M.shares(spark.createDataFrame([("c", "d", "s", "A", "B", "night", 1, 2, 2, 0)], HIST))
    assert M.merged(share, None, share).count() == 0
    with pytest.raises(Exception, match="doesn't hold"):
        M.merged(share, None, share.withColumn("count", F.col("count") + 1)).collect()


STEPS = "city string, from_station_id string, to_station_id string, day_type string, band string, sec long, sub_route_uid string, service_date string"


def test_small_cells_are_exact(spark):
    random.seed(5)
    rows = [("c", f"a{k % 3}", "b", random.choice(["weekday", "weekend"]), random.choice(["night", "midday"]), random.randrange(1, 1800), f"R{random.randrange(9)}", f"2024-01-{random.randrange(1, 20):02}") for k in range(700)]
    rows += [("c", "z", "b", "weekday", "night", None, None, "2024-01-01"), ("c", "z", "b", "weekday", "night", 5, "R", "2024-01-01")]
    steps = spark.createDataFrame(rows, STEPS)
    rounded = lambda df: sorted(repr([round(x, 6) if isinstance(x, float) else x for x in r]) for r in df.select(*B.CELL, *B.STATS, "level").collect())
    assert rounded(K.rollup_states(K.day_states(steps))) == rounded(B.rollup(steps))


def test_large_cells_keep_the_bound(spark):
    """A hundred thousand steps in one cell, over ten days."""
    steps = spark.range(100_000).select(F.lit("c").alias("city"), F.lit("a").alias("from_station_id"), F.lit("b").alias("to_station_id"), F.lit("weekday").alias("day_type"), F.lit("night").alias("band"), (F.pow(F.rand(3), F.lit(3.0)) * 100_000).cast("long").alias("sec"), (F.col("id") % 700).cast("string").alias("sub_route_uid"), (F.col("id") % 10).cast("string").alias("service_date"))
    rolled = K.rollup_states(K.day_states(steps))
    quantiles = {f"p{q}_sec": q / 100 for q in (25, 50, 75, 90)}
    for r in K.rank_errors(steps, rolled, quantiles).collect():
        assert all(r[f"{c}_error"] <= K.RANK_ERROR for c in quantiles), r
    row = rolled.where("level = 'pair'").first()
    assert (row.n, row.n_days, row.date_from, row.date_to) == (100_000, 10, "0", "9") and abs(row.n_route - 700) <= 700 * K.COUNT_ERROR
    one = K.merge_states(K.day_states(steps), "city").first()
    assert one.n == 100_000 and one.n_days == 10
