"""Transfers between routes at a station: pairing, histograms, marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import local, time_bucket
from .blocks import lagged, least_later

MAX_WAIT_S = 3600
BIN_S = 30
MIN_SAMPLES = 20
PAIR = ("station_id", "route_a", "route_b", "bucket")
SCOPE = ("city", "data_date", "station_id")


def next_departures(a: DataFrame, b: DataFrame, keys: list[str], at: str = "us", out: str = "b_us", span_us: int | None = None) -> DataFrame:
    """For each row of a the first time of b that is strictly later within equal keys; null
    where there is none. Both are laid on one time line, of which a running minimum from
    the end is the next departure: one shuffle and one sort, no join on inequality. Where
    rows of a key may be very many, span_us cuts its line into blocks."""
    line = a.withColumns({"_a": F.lit(True), "_b_at": F.lit(None).cast("long")}).unionByName(b.select(*keys, at).withColumns({"_a": F.lit(False), "_b_at": F.col(at)}), allowMissingColumns=True)
    return least_later(line, keys, at, "_b_at", out, span_us).where("_a").drop("_a", "_b_at")


def pair_transfers(arrivals: DataFrame, span_us: int | None = None) -> DataFrame:
    """(scope, route_a, route_b, us, b_us) for each arrival (scope, route, us, boarding) of a
    route that lets passengers off and each other route of the station and day that takes
    passengers on: the next departure strictly after the arrival; none, no row.

    A route qualifies by any of its events there; all its events count then. Routes of a
    station are few, so the candidates are a distinct set joined by equality."""
    arrivals = arrivals.dropna(subset=[*SCOPE, "route", "us"])
    off = arrivals.where("boarding <= 0").select(*SCOPE, F.col("route").alias("route_a")).distinct()
    on = arrivals.where("boarding >= 0").select(*SCOPE, F.col("route").alias("route_b")).distinct()
    routes = off.join(on, list(SCOPE)).where("route_a <> route_b")
    a = arrivals.select(*SCOPE, F.col("route").alias("route_a"), "us").join(routes, [*SCOPE, "route_a"])
    b = arrivals.select(*SCOPE, F.col("route").alias("route_b"), "us")
    return next_departures(a, b, [*SCOPE, "route_b"], span_us=span_us).where("b_us is not null")


def shared_stations(arrivals: DataFrame, least: int = 2) -> DataFrame:
    """Stations that at least so many routes stop at, where a transfer is possible at all."""
    return arrivals.groupBy("city", "station_id").agg(F.count_distinct("route").alias("n_routes")).where(F.col("n_routes") >= least)


def transfer_histogram(pairs: DataFrame, max_wait_s: int = MAX_WAIT_S, bin_s: int = BIN_S, compat: bool = False) -> DataFrame:
    """One row for each (scope, route pair, bucket, wait_bin) with the count of successes, and
    n_total and n_over of the pair, bucket and day. A wait of exactly max_wait_s succeeds.

    A pair, bucket and day without success has one row of wait_bin null and count 0, so that
    its attempts are not forgotten; with compat it has none. Pairs are reduced to counts as
    they are made: one partial aggregation, totals from the counts."""
    wait = (F.col("b_us") - F.col("us")) / 1_000_000
    keyed = pairs.withColumns({"bucket": time_bucket(local(F.timestamp_micros("us"))), "wait_bin": F.when(wait <= max_wait_s, F.floor(wait.cast("long") / bin_s).cast("int"))})
    keys = [*SCOPE, "route_a", "route_b", "bucket"]
    counts = keyed.groupBy(*keys, "wait_bin").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys)
    over = F.sum(F.when(F.col("wait_bin").isNull(), F.col("n")).otherwise(0)).over(w)
    total = counts.withColumns({"n_total": F.sum("n").over(w), "n_over": over})
    hist = total.where(F.col("wait_bin").isNotNull() | ((F.col("n_over") == F.col("n_total")) & F.lit(not compat)))
    return hist.withColumn("count", F.when(F.col("wait_bin").isNull(), 0).otherwise(F.col("n")).cast("long")).drop("n")


def histogram_quantile(cumulative: Column, total: Column, q: float, bin_s: int = BIN_S) -> Column:
    """Midpoint of the first bin at which the running count reaches total * q; an aggregate."""
    return F.min(F.when(cumulative >= total * q, F.col("wait_bin"))) * bin_s + bin_s / 2


def transfer_marts(hist: DataFrame, min_samples: int = MIN_SAMPLES, bin_s: int = BIN_S) -> DataFrame:
    """Histograms of all days merged: one row for each station, pair and bucket with at least
    min_samples successes. Quantiles are of successes alone, so success_rate goes with them."""
    # By day for the totals and by bin for the quantiles, of one pass over the histograms.
    both = hist.groupingSets([[*PAIR, "data_date"], [*PAIR, "wait_bin"]], *PAIR, "data_date", "wait_bin").agg(F.grouping_id().alias("_set"), F.sum("count").alias("count"), F.first("n_total").alias("n_total"), F.first("n_over").alias("n_over"))
    by_day = F.col("_set") == 1  # a bit for each column, 0 where it is grouped by
    return marts_of_counts(both.withColumns({"kind": F.when(by_day, "total").otherwise("bin"), "n_days": F.lit(1)}), min_samples, bin_s)


def marts_of_counts(counts: DataFrame, min_samples: int = MIN_SAMPLES, bin_s: int = BIN_S) -> DataFrame:
    """The marts of counts (PAIR, kind, wait_bin, count, n_total, n_over, n_days): rows of kind
    'bin' have the successes of a bin, those of kind 'total' attempts, failures and days."""
    total, success = F.col("kind") == "total", (F.col("kind") == "bin") & F.col("wait_bin").isNotNull()
    rows = counts.repartition(*PAIR).withColumn("_n", F.when(success, F.col("count")))
    w = Window.partitionBy(*PAIR)
    so_far = F.when(F.col("_n").isNotNull(), F.sum("_n").over(w.orderBy(F.col("wait_bin").asc_nulls_first()).rangeBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumns({"cum": so_far, "tot": F.sum("_n").over(w)})
    quantiles = [histogram_quantile(F.col("cum"), F.col("tot"), q, bin_s).alias(f"wait_p{int(q * 100)}") for q in (0.5, 0.9)]
    sums = [F.sum(F.when(total, F.col(c))).alias(c) for c in ("n_total", "n_over", "n_days")]
    out = rows.groupBy(*PAIR).agg(*sums, *quantiles).where("wait_p50 is not null")
    out = out.withColumn("n_success", F.col("n_total") - F.col("n_over"))
    return out.withColumn("success_rate", F.col("n_success") / F.col("n_total")).where(F.col("n_success") >= min_samples)


def with_validity(marts: DataFrame) -> DataFrame:
    """Quantiles only where enough attempts succeed: the 90th above 0.9, the median above 0.5."""
    rate = F.col("success_rate")
    return marts.withColumns({"valid_p50": F.when(rate > 0.5, F.col("wait_p50")), "valid_p90": F.when(rate > 0.9, F.col("wait_p90")), "estimable": rate > 0.5})


def recap(hist: DataFrame, max_wait_s: int, bin_s: int = BIN_S) -> DataFrame:
    """The histogram as it had been with a shorter wait: bins from the cap on are over it."""
    keys = [*SCOPE, "route_a", "route_b", "bucket"]
    w = Window.partitionBy(*keys)
    inside = F.col("wait_bin") < max_wait_s // bin_s
    kept = F.coalesce(F.sum(F.when(inside, F.col("count"))).over(w), F.lit(0))
    cut = hist.withColumn("n_over", F.col("n_total") - kept)
    first = F.row_number().over(w.orderBy(F.col("wait_bin").asc_nulls_first()))
    none = (F.col("n_over") == F.col("n_total")) & (first == 1)
    cut = cut.withColumn("_none", none).where(inside | F.col("_none"))
    return cut.withColumns({"wait_bin": F.when(~F.col("_none"), F.col("wait_bin")), "count": F.when(F.col("_none"), F.lit(0).cast("long")).otherwise(F.col("count"))}).drop("_none")


def headways(arrivals: DataFrame, span_us: int | None = None) -> DataFrame:
    """Regularity of each route at each station and day: the gaps between its arrivals."""
    timed = lagged(arrivals, [*SCOPE, "route"], ["us"], {"us": "_before"}, span_us)
    gaps = timed.withColumn("gap_s", (F.col("us") - F.col("_before")) / 1_000_000).where("gap_s is not null")
    return gaps.groupBy(*SCOPE, "route").agg(F.count("*").alias("n"), F.avg("gap_s").alias("mean_s"), F.stddev_samp("gap_s").alias("sd_s"), F.count_if(F.col("gap_s") < 120).alias("bunched"))
