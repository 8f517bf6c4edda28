"""The baseline from mergeable day states: quantile and distinct sketches instead of raw steps.

A state is a cell's steps of one day: their count and sums, a KLL sketch of their seconds and
an HLL sketch of their routes. States are small and merge, so the baseline over any days
is made of the days' states, and a day that is redone replaces its own. Counts, sums, dates and
days are exact; a quantile's rank and a number of routes lie within the bounds below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .baseline import CELL, STATS

#: Size of a KLL sketch: up to so many steps it holds them all and its quantiles are exact.
KLL_K = 800
#: Logarithm of an HLL sketch's registers.
HLL_LG_K = 12
#: Normalized rank error of one KLL quantile that 99 of 100 keep to.
KLL_ERROR = 2.296 / KLL_K**0.9723
#: The bound stated: twice that, which some 3 in 1e7 miss.
RANK_ERROR = 2 * KLL_ERROR
#: Relative error of a number of routes: five standard errors of an HLL sketch.
COUNT_ERROR = 5 * 1.04 / 2 ** (HLL_LG_K / 2)
STATE = ("n", "total", "squares", "secs", "routes")


def day_states(steps: DataFrame) -> DataFrame:
    """(CELL, service_date, STATE) of steps: one row for each cell and day. Steps without
    seconds count in n alone."""
    sec = F.col("sec").cast("long")
    return steps.groupBy(*CELL, "service_date").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(sec), F.lit(0)).alias("total"),
        F.coalesce(F.sum((sec * sec).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("squares"),
        F.kll_sketch_agg_bigint(sec, F.lit(KLL_K)).alias("secs"),
        F.hll_sketch_agg("sub_route_uid", F.lit(HLL_LG_K)).alias("routes"),
    )


def merge_states(states: DataFrame, *keys: str) -> DataFrame:
    """States merged to one row of each value of keys: STATE, date_from, date_to, n_days."""
    return states.groupBy(*keys).agg(*_merged())


def _merged() -> list[Column]:
    return [
        *[F.sum(c).alias(c) for c in STATE[:3]],
        F.kll_merge_agg_bigint("secs", F.lit(KLL_K)).alias("secs"),
        F.hll_union_agg("routes").alias("routes"),
        F.min("service_date").alias("date_from"),
        F.max("service_date").alias("date_to"),
        F.count_distinct("service_date").alias("n_days"),
    ]


def levels() -> Column:
    """The levels of a cell's row, each with the day type and band it has there."""
    null = F.lit(None).cast("string")
    of = {"band": ("day_type", "band"), "daytype": ("day_type", None), "pair": (None, None)}
    return F.array(*[F.struct(F.lit(level).alias("level"), *[(F.col(k) if k else null).alias(name) for k, name in zip(keys, ("day_type", "band"), strict=True)]) for level, keys in of.items()])


def rollup_states(states: DataFrame) -> DataFrame:
    """What baseline.rollup gives of the steps, from their states: statistics of all prefixes of
    the cell, level saying which. Days merge into their cell first, cells into their levels
    after. Dates of a level are bounded by the days there are, whatever the steps."""
    sums = _merged()[:-3]
    cells = states.groupBy(*CELL).agg(*sums, F.collect_set("service_date").alias("dates")).withColumn("_level", F.explode(levels()))
    rows = cells.select(*CELL[:3], "_level.*", *STATE, "dates")
    merged = rows.groupBy(*CELL, "level").agg(*sums, F.array_distinct(F.flatten(F.collect_list("dates"))).alias("dates"))
    return merged.select(*CELL, *_statistics(), "level")


def _statistics() -> list[Column]:
    at = F.kll_sketch_get_quantile_bigint("secs", F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75, 0.9)]))
    timed = F.kll_sketch_get_n_bigint("secs")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    spread = (timed.cast("decimal(19,0)") * wide("squares") - wide("total") * wide("total")).cast("double")
    found = {
        "n": F.col("n"),
        "n_route": F.hll_sketch_estimate("routes"),
        **{f"p{q}_sec": F.when(timed > 0, F.get(at, F.lit(k))) for k, q in enumerate((25, 50, 75, 90))},
        "mean_sec": F.try_divide(F.col("total").cast("double"), timed),
        "sd_sec": F.when(timed > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (timed.cast("double") * (timed - 1)))),
        "date_from": F.array_min("dates"),
        "date_to": F.array_max("dates"),
        "n_days": F.size(F.filter("dates", lambda d: d.isNotNull())).cast("long"),
    }
    return [found[c].alias(c) for c in STATS]


def rank_errors(steps: DataFrame, rolled: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """rolled (CELL, level, columns that quantiles names) with, for each of these, how far from
    its quantile the rank of its value is among the steps: 0 where the quantile lies between
    the shares of steps below the value and up to it."""
    cell = [*CELL, "level"]
    counted = steps.where("sec is not null").groupBy(*CELL, "sec").agg(F.count("*").alias("_n")).withColumn("_level", F.explode(levels()))
    counted = counted.select(*CELL[:3], "_level.*", "sec", "_n").groupBy(*cell, "sec").agg(F.sum("_n").alias("_n")).withColumnsRenamed({c: f"_{c}" for c in cell})
    joined = rolled.join(counted, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cell], "left")
    share = lambda c, low: F.sum(F.when(F.col("sec") < F.col(c) if low else F.col("sec") <= F.col(c), F.col("_n")).otherwise(0)) / F.sum("_n")
    error = lambda c, q: F.greatest(share(c, True) - q, q - share(c, False), F.lit(0.0))
    return joined.groupBy(*cell, *quantiles).agg(*[error(c, q).alias(f"{c}_error") for c, q in quantiles.items()])
