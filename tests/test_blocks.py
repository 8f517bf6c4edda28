"""Blocks of time give what windows over whole lines give, with many tasks for one key."""

import random

import pytest
from pyspark.sql import functions as F

from wayfare.operators import arrivals as A
from wayfare.operators import blocks
from wayfare.operators import quality as Q
from wayfare.operators import transfers as T

S = 1_000_000


def same(a, b):
    assert a.columns == b.columns or sorted(a.columns) == sorted(b.columns)
    columns = sorted(a.columns)
    got = [sorted(repr(tuple(r)) for r in df.select(*columns).collect()) for df in (a, b)]
    assert got[0] == got[1] and got[0]


@pytest.fixture(scope="module")
def line(spark):
    """Two keys, one of them null, with ties, gaps of many blocks, and values that are null."""
    random.seed(6)
    rows = [(random.choice(["a", None]), random.choice([random.randrange(4000), random.randrange(200)]) * S, k, random.choice([None, random.randrange(50)]), random.randrange(3)) for k in range(900)]
    rows += [("a", 90_000 * S, 1000, 1, 0), ("alone", 5 * S, 1001, 7, 1)]
    return spark.createDataFrame(rows, "k string, us long, id long, x int, stop int")


@pytest.mark.parametrize("span_s", [1, 37, 1000, 10**6])
def test_blocks_equal_windows(line, span_s):
    span = span_s * S
    names = {"us": "before", "x": "x_before"}
    same(blocks.lagged(line, ["k"], ["us", "id"], names), blocks.lagged(line, ["k"], ["us", "id"], names, span))
    same(blocks.running_sum(line, ["k"], ["us", "id"], "stop", "s"), blocks.running_sum(line, ["k"], ["us", "id"], "stop", "s", span))
    same(blocks.least_later(line, ["k"], "us", "x", "m"), blocks.least_later(line, ["k"], "us", "x", "m", span))


def test_all_that_use_them(spark, line):
    span = 100 * S
    same(A.sessions(line, ["k"], "us", "stop", ties=["id"]), A.sessions(line, ["k"], "us", "stop", ties=["id"], span_us=span))
    same(A.elapsed(line, ["k"], "us"), A.elapsed(line, ["k"], "us", span))
    same(Q.adaptive_gaps(line, ["k"], "us", span_us=None), Q.adaptive_gaps(line, ["k"], "us", span_us=span))
    a, b = line.where("stop = 0").select("k", "us", "id"), line.where("stop > 0").select("k", "us")
    same(T.next_departures(a, b, ["k"]), T.next_departures(a, b, ["k"], span_us=span))
    rows = line.select(F.lit("c").alias("city"), F.lit("d").alias("data_date"), F.coalesce("k", F.lit("n")).alias("station_id"), F.col("stop").cast("string").alias("route"), "us", (F.col("id") % 3 - 1).cast("int").alias("boarding"))
    same(T.pair_transfers(rows), T.pair_transfers(rows, span))
    same(T.headways(rows).select("station_id", "route", "n", "bunched"), T.headways(rows, span).select("station_id", "route", "n", "bunched"))


def test_one_key_uses_many_tasks(spark):
    """No task gets more than a few blocks of a line of one key."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        one = spark.range(20_000).select(F.lit("k").alias("k"), (F.col("id") * S).alias("us"), (F.col("id") % 5).alias("x"))
        for made in (blocks.lagged(one, ["k"], ["us"], {"x": "b"}, 100 * S), blocks.running_sum(one, ["k"], ["us"], "x", "s", 100 * S), blocks.least_later(one, ["k"], "us", "x", "m", 100 * S)):
            sizes = [r["n"] for r in made.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count("*").alias("n"), F.max(made.columns[-1])).collect()]
            assert len(sizes) == 16 and max(sizes) < 20_000 / 16 * 2.5
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
