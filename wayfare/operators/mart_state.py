"""Transfer marts kept up to date day by day.

A mart's counts are sums over days, so a day can be added to them, taken out, or replaced
by what it is now less what it was. The state is a published table of the sums and of each
day's version; beside it lies, for every version of a day, the share that it added. An update
reads the shares of the days it is about, the state, and nothing of other days.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .publish import PublishError, current_version, delete, found_folders, read_published, swap
from .transfers import BIN_S, MIN_SAMPLES, PAIR, marts_of_counts, with_validity

COUNTS = ("count", "n_total", "n_over", "n_days")
#: A row of the state: of kind 'bin' the successes of a bin, 'total' the attempts, failures and
#: days of a pair and bucket, 'day' a day that is in and the version that its share is of.
STATE = (*PAIR, "kind", "wait_bin", *COUNTS, "day", "version")


def shares(hist: DataFrame) -> DataFrame:
    """What each day of the histograms adds (PAIR, kind, wait_bin, COUNTS, data_date). Attempts
    without success are in the totals."""
    both = hist.groupingSets([[*PAIR, "data_date"], [*PAIR, "data_date", "wait_bin"]], *PAIR, "data_date", "wait_bin").agg(F.grouping_id().alias("_set"), F.sum("count").alias("_n"), F.first("n_total").alias("_total"), F.first("n_over").alias("_over"))
    total = F.col("_set") == 1  # a bit for each column, 0 where it is grouped by
    count = lambda c, of: F.when(of, F.col(c)).otherwise(0).cast("long")
    rows = both.where(total | F.col("wait_bin").isNotNull())
    return rows.select(*PAIR, F.when(total, "total").otherwise("bin").alias("kind"), "wait_bin", count("_n", ~total).alias("count"), count("_total", total).alias("n_total"), count("_over", total).alias("n_over"), total.cast("long").alias("n_days"), "data_date")


def merged(state: DataFrame | None, added: DataFrame | None, removed: DataFrame | None) -> DataFrame:
    """The counts of a state with shares added and taken out. Rows of which nothing is left go;
    a share taken out that was never in leaves a count below 0 and raises."""
    columns = [*PAIR, "kind", "wait_bin"]
    signed = [(rows, sign) for rows, sign in ((state, 1), (added, 1), (removed, -1)) if rows is not None]
    rows = None
    for part, sign in signed:
        part = part.select(*columns, *[(sign * F.col(c)).alias(c) for c in COUNTS])
        rows = part if rows is None else rows.unionByName(part)
    out = rows.groupBy(*columns).agg(*[F.sum(c).alias(c) for c in COUNTS])
    counts = [F.col(c) for c in COUNTS]
    sound = F.when(F.least(*counts) < 0, F.raise_error(F.lit("a share was taken out that the state doesn't hold")).cast("boolean")).otherwise(True)
    return out.where(sound & (F.greatest(*counts) > 0))


def days_in(state: DataFrame | None) -> dict[str, str]:
    """The days in a state and the version that each one's share is of: a row a day."""
    return {} if state is None else {r["day"]: r["version"] for r in state.where("kind = 'day'").select("day", "version").collect()}


def update(spark: SparkSession, base: str, hist_path: str, days: Sequence[str]) -> dict[str, str]:
    """Bring the state at base up to date with some days of the histograms at hist_path, which
    are partitioned by dt, or by something and dt. Nothing of other days is listed or read. A day that is in already is replaced, one without histograms taken
    out, so a run that is repeated changes nothing. Returns the days that are in now, with
    the version of their shares.

    Shares are written first, in one job, under a version of their own, and the new state,
    which names it, is published in one step; a run that breaks off leaves the old state and
    shares that nothing names. Shares that the new state doesn't name are deleted after it."""
    state = read_published(spark, f"{base}/state") if current_version(spark, f"{base}/state") else None
    known, version = days_in(state), uuid.uuid4().hex
    replaced = {day: known[day] for day in days if day in known}
    added, now = None, {day: v for day, v in known.items() if day not in days}
    folders = [f for day in days for f in found_folders(spark, f"{hist_path}/dt={day}", f"{hist_path}/*/dt={day}")]
    if folders:
        hist = spark.read.option("basePath", hist_path).parquet(*folders)
        shares(hist).withColumn("dt", F.col("data_date")).write.partitionBy("dt").parquet(f"{base}/shares/{version}")
        written = [f.rsplit("dt=", 1)[1] for f in found_folders(spark, f"{base}/shares/{version}/dt=*")]
        if strange := sorted(set(written) - set(days)):
            raise PublishError(f"{hist_path}: a day's folder has histograms of {', '.join(strange)}")
        new = [day for day in days if day in written]
        added = spark.read.parquet(*[_share(base, version, day) for day in new]) if new else None
        now |= {day: version for day in new}
    if added is None and not replaced:
        return known
    if not now:
        raise PublishError(f"{base}: no day would be left")
    removed = spark.read.parquet(*[_share(base, v, day) for day, v in replaced.items()]) if replaced else None
    counts = merged(None if state is None else state.where("kind <> 'day'"), added, removed)
    named = spark.createDataFrame(sorted(now.items()), "day string, version string").withColumn("kind", F.lit("day"))
    swap(spark, counts.unionByName(named, allowMissingColumns=True).select(*STATE), f"{base}/state")
    for day, v in replaced.items():
        delete(spark, _share(base, v, day))
    return now


def _share(base: str, version: str, day: str) -> str:
    return f"{base}/shares/{version}/dt={day}"


def marts(state: DataFrame, min_samples: int = MIN_SAMPLES, bin_s: int = BIN_S) -> DataFrame:
    """What transfers.transfer_marts gives of the histograms of all days that are in a state."""
    return marts_of_counts(state.where("kind <> 'day'"), min_samples, bin_s)


def publish_marts(spark: SparkSession, hist_path: str, base: str, out: str, days: Sequence[str], min_samples: int = MIN_SAMPLES) -> int:
    """Bring the state at base up to date with days and publish the marts at out; their number."""
    update(spark, base, hist_path, days)
    return swap(spark, with_validity(marts(read_published(spark, f"{base}/state"), min_samples)), out)
