"""Travel times of segments: steps, roll-up with fallback ladder, journeys, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import band, day_type, local, local_date, seconds_between

MIN_N = 30
RELIABLE_N = 100
Z90 = 1.28
#: Up to this many pairs of stations a ladder is broadcast, some 1 kB each.
BROADCAST_PAIRS = 50_000
CELL = ("city", "from_station_id", "to_station_id", "day_type", "band")
STATS = ("n", "n_route", "p25_sec", "p50_sec", "p75_sec", "p90_sec", "mean_sec", "sd_sec", "date_from", "date_to", "n_days")


def segment_steps(events: DataFrame, lowest_s: int = 1, highest_s: int = 1800) -> DataFrame:
    """Steps between successive stops of a trip that are neighbours (seq + 1) and took from
    lowest_s to highest_s. Equal times are ordered by seq, then station."""
    w = Window.partitionBy("trip_id").orderBy("arrival_time", "seq", "station_id")
    lagged = events.withColumns({"from_station_id": F.lag("station_id").over(w), "dseq": F.col("seq") - F.lag("seq").over(w), "arrival_from": F.lag("arrival_time").over(w), "from_min_speed": F.lag("min_speed").over(w)})
    steps = lagged.withColumn("sec", seconds_between(F.col("arrival_from"), F.col("arrival_time"))).where((F.col("dseq") == 1) & F.col("sec").between(lowest_s, highest_s))
    at = local(F.col("arrival_from"))
    steps = steps.withColumns({"service_date": local_date(F.col("arrival_from")), "hr": F.hour(at), "day_type": day_type(at)})
    return steps.withColumn("band", band(F.col("hr"))).select("city", "service_date", "sub_route_uid", "direction", "from_station_id", F.col("station_id").alias("to_station_id"), "arrival_from", "sec", "from_min_speed", "hr", "day_type", "band")


def rollup(steps: DataFrame) -> DataFrame:
    """Statistics of all prefixes of the cell; level says which: band (all five), daytype, pair.
    Quantiles are elements of the data.

    Steps are first counted by (cell, seconds), (cell, route) and (cell, date), which combines
    before the shuffle. What is left of a pair is bounded by the seconds, routes and dates it
    has, whatever its steps, and makes all three levels without another shuffle."""
    values = ("sec", "sub_route_uid", "service_date")
    counted = steps.groupingSets([[*CELL, v] for v in values], *CELL, *values).agg(F.grouping_id().alias("_set"), F.count("*").alias("_n"))
    pair, null = CELL[:3], F.lit(None).cast("string")
    # grouping_id has a bit for each column, 0 where it is grouped by.
    kind = F.when(F.col("_set") == 3, "sec").when(F.col("_set") == 5, "route").otherwise("date")
    levels = F.array(F.struct(F.lit("band").alias("level"), F.col("day_type"), F.col("band")), F.struct(F.lit("daytype").alias("level"), F.col("day_type"), null.alias("band")), F.struct(F.lit("pair").alias("level"), null.alias("day_type"), null.alias("band")))
    rows = counted.repartition(*pair).withColumn("_kind", kind).select(*pair, "_kind", *values, "_n", F.explode(levels).alias("_level")).select(*pair, "_level.*", "_kind", *values, "_n")
    cell = [*CELL, "level"]
    rows = rows.groupBy(*cell, "_kind", *values).agg(F.sum("_n").alias("_n"))
    timed = F.when((F.col("_kind") == "sec") & F.col("sec").isNotNull(), F.col("_n"))
    whole = Window.partitionBy(*cell)
    so_far = F.sum(timed).over(whole.orderBy(F.col("sec").asc_nulls_first()).rangeBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns({"_timed": timed, "_so_far": so_far, "_all": F.sum(timed).over(whole)})
    total, squares = F.sum(F.col("_timed") * F.col("sec")), F.sum(F.col("_timed") * F.col("sec") * F.col("sec"))
    quantiles = [F.min(F.when(F.col("_timed").isNotNull() & (F.col("_so_far") * 100 >= F.col("_all") * q), F.col("sec"))).alias(f"p{q}_sec") for q in (25, 50, 75, 90)]
    out = rows.groupBy(*cell).agg(
        F.sum(F.when(F.col("_kind") == "sec", F.col("_n"))).alias("n"),
        F.count_if((F.col("_kind") == "route") & F.col("sub_route_uid").isNotNull()).alias("n_route"),
        *quantiles,
        total.alias("_total"),
        squares.alias("_squares"),
        F.sum("_timed").alias("_timed"),
        F.min("service_date").alias("date_from"),
        F.max("service_date").alias("date_to"),
        F.count_if((F.col("_kind") == "date") & F.col("service_date").isNotNull()).alias("n_days"),
    )
    n, wide = F.col("_timed"), lambda c: F.col(c).cast("decimal(19,0)")
    spread = (wide("_timed") * wide("_squares") - wide("_total") * wide("_total")).cast("double")
    out = out.withColumns({"mean_sec": F.try_divide(F.col("_total").cast("double"), n), "sd_sec": F.when(n > 1, F.sqrt(spread / (n.cast("double") * (n - 1))))})
    return out.select(*CELL, *STATS, "level")


def baseline_segment(rolled: DataFrame, min_n: int = MIN_N) -> DataFrame:
    """For each finest cell the statistics of the finest level with min_n steps, at last those
    of the pair. Levels of a pair meet in one window over its rows, not in two joins."""
    stats = F.struct("level", *STATS)
    at = lambda level, *keys: F.max(F.when(F.col("level") == level, stats)).over(Window.partitionBy(*keys))
    pair = CELL[:3]
    tagged = rolled.withColumns({"_pair": at("pair", *pair), "_day": at("daytype", *pair, "day_type")})
    chosen = F.when(F.col("n") >= min_n, stats).when(F.col("_day.n") >= min_n, F.col("_day")).otherwise(F.col("_pair"))
    cells = tagged.where("level = 'band'").select(*CELL, chosen.alias("s")).select(*CELL, "s.*")
    return cells.withColumns({"unreliability": F.round(F.try_divide(F.col("p90_sec"), F.col("p50_sec")), 2), "p90_reliable": F.col("n") >= RELIABLE_N, "mean_sec": F.round("mean_sec", 2), "sd_sec": F.round(F.coalesce("sd_sec", F.lit(0.0)), 2), "rule_version": F.lit("v2"), "baseline_version": F.lit("b1")})


#: What a rung of the ladder knows.
RUNG = ("level", "n", "p50_sec", "p90_sec")


def _rung(level: str, *keys: str) -> Column:
    """The name of a level's rung for a day type and band."""
    return F.concat_ws("/", F.lit(level), *[F.coalesce(F.col(k), F.lit("")) for k in keys])


def ladder(rolled: DataFrame) -> DataFrame:
    """(city, from_station_id, to_station_id, rungs) of a roll-up: a row for each pair, rungs a
    map from the name of a level, day type and band to its statistics. A pair has a rung for
    each of its day types and bands, each day type and itself, so that one join by the pair
    finds the level that holds for any step."""
    name = F.when(F.col("level") == "band", _rung("band", "day_type", "band")).when(F.col("level") == "daytype", _rung("daytype", "day_type")).otherwise("pair")
    return rolled.groupBy(*CELL[:3]).agg(F.map_from_entries(F.collect_list(F.struct(name, F.struct(*RUNG)))).alias("rungs"))


def expected(steps: DataFrame, rungs: DataFrame, min_n: int = MIN_N) -> DataFrame:
    """steps (city, from_station_id, to_station_id, day_type, band, sec, other columns) with
    RUNG of the finest level that has min_n steps, at last the pair's, and slow: whether sec is
    above its 90 % quantile. Steps that the ladder doesn't know have nulls and aren't slow.

    Up to BROADCAST_PAIRS pairs are broadcast; more are joined by shuffle."""
    few = rungs.limit(BROADCAST_PAIRS + 1).count() <= BROADCAST_PAIRS
    known = steps.join(F.broadcast(rungs) if few else rungs, list(CELL[:3]), "left")
    by_band, by_day, by_pair = (F.try_element_at("rungs", name) for name in (_rung("band", "day_type", "band"), _rung("daytype", "day_type"), F.lit("pair")))
    known = known.withColumn("_rung", F.when(by_band["n"] >= min_n, by_band).when(by_day["n"] >= min_n, by_day).otherwise(by_pair))
    out = known.withColumns({c: F.col(f"_rung.{c}") for c in RUNG}).drop("rungs", "_rung")
    return out.withColumn("slow", F.coalesce(F.col("sec") > F.col("p90_sec"), F.lit(False)))


def route_segments(stops: DataFrame, by_lead: bool = True) -> DataFrame:
    """Each stop of a route (sub_route_uid, direction, seq, station_id, stop_name, city) with
    the next one. By lead the next is the one that follows, whatever its number; else the
    one numbered seq + 1, and a gap in the numbers loses a segment."""
    here = stops.select("city", "sub_route_uid", "direction", "seq", "station_id", "stop_name")
    if by_lead:
        w = Window.partitionBy("sub_route_uid", "direction").orderBy("seq")
        out = here.withColumns({"to_station_id": F.lead("station_id").over(w), "to_name": F.lead("stop_name").over(w)}).where("to_station_id is not null")
    else:
        after = here.select("sub_route_uid", "direction", (F.col("seq") - 1).alias("seq"), F.col("station_id").alias("to_station_id"), F.col("stop_name").alias("to_name"))
        out = here.join(after, ["sub_route_uid", "direction", "seq"])
    return out.withColumnRenamed("station_id", "from_station_id")


def journey_segments(segments: DataFrame, baseline: DataFrame, day: str, hours: str) -> DataFrame:
    """Segments with their statistics of one day type and band; null where there are none."""
    cells = baseline.where((F.col("day_type") == day) & (F.col("band") == hours)).drop("day_type", "band")
    return segments.join(cells, ["city", "from_station_id", "to_station_id"], "left")


def journey_total(journey: DataFrame, *keys: str) -> DataFrame:
    """A journey's sums over its segments that have statistics; the 90th percentile from the
    means and the root of the summed variances."""
    return journey.groupBy(*keys).agg(
        F.count("p50_sec").alias("n_segments"),
        F.sum("p50_sec").alias("p50_total"),
        F.round(F.sum("mean_sec")).alias("mean_total"),
        F.round(F.sum("mean_sec") + Z90 * F.sqrt(F.sum(F.pow("sd_sec", F.lit(2.0))))).alias("p90_total"),
        F.sum((F.col("level") != "band").cast("int")).alias("n_fallback"),
        F.sum((~F.col("p90_reliable")).cast("int")).alias("n_unreliable"),
    )


def ladder_share(baseline: DataFrame) -> DataFrame:
    """Cells of each day type and level, and their share of steps. n of a fallback level counts
    steps of other cells again; ladder_share_weighted does not."""
    w = Window.partitionBy("day_type")
    out = baseline.groupBy("day_type", "level").agg(F.count("*").alias("n_cells"), F.sum("n").alias("n"))
    return out.withColumn("share", F.round(100 * F.col("n") / F.sum("n").over(w), 1)).drop("n")


def ladder_share_weighted(baseline: DataFrame, rolled: DataFrame) -> DataFrame:
    """The same with each cell weighed by its own steps."""
    own = rolled.where("level = 'band'").select(*CELL, F.col("n").alias("own_n"))
    w = Window.partitionBy("day_type")
    out = baseline.join(own, list(CELL)).groupBy("day_type", "level").agg(F.count("*").alias("n_cells"), F.sum("own_n").alias("n"))
    return out.withColumn("share", F.round(100 * F.col("n") / F.sum("n").over(w), 1))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("c")).where("c > 1")


def baseline_sanity(baseline: DataFrame) -> DataFrame:
    median = lambda c: F.expr(f"percentile_disc(0.5) within group (order by {c})")
    return baseline.groupBy("day_type", "level").agg(median("p50_sec").alias("p50_median"), median("unreliability").alias("unreliability_median"), F.round(100 * F.count_if("p90_reliable") / F.count("*"), 1).alias("p90_share"))


def peak_ratio(baseline: DataFrame) -> DataFrame:
    """Peak over midday median within one segment, as a distribution."""
    wide = baseline.where("day_type = 'weekday' and level = 'band'").groupBy("city", "from_station_id", "to_station_id").pivot("band", ["am_peak", "midday"]).agg(F.first("p50_sec")).where("am_peak is not null and midday > 0")
    ratio = wide.withColumn("ratio", F.round(F.col("am_peak") / F.col("midday"), 6))
    return ratio.groupBy("city").agg(F.count("*").alias("n"), *[F.expr(f"percentile_disc({q}) within group (order by ratio)").alias(f"p{int(q * 100)}") for q in (0.1, 0.5, 0.9)])


def step_sanity(events: DataFrame) -> DataFrame:
    """Steps backwards, and faster than 10 seconds a stop, of each city."""
    w = Window.partitionBy("trip_id").orderBy("arrival_time", "seq", "station_id")
    steps = events.withColumns({"dseq": F.col("seq") - F.lag("seq").over(w), "sec": seconds_between(F.lag("arrival_time").over(w), F.col("arrival_time"))}).where("dseq is not null")
    return steps.groupBy("city").agg(F.count("*").alias("n"), F.count_if(F.col("dseq") < 0).alias("backwards"), F.count_if((F.col("dseq") > 0) & (F.col("sec") < 10 * F.col("dseq"))).alias("too_fast"))
