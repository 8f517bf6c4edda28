"""Observations put in time order before they are matched; late ones are kept aside.

Every vehicle has a clock of its own, the latest time it has sent, so that one of a wrong clock
makes no other late. What it sends waits until its clock is delay_s further, and is then
matched in the order of time, whatever batches it came in. What comes after that is late: it
changes nothing that was matched, and goes to a table of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.columns import local_date
from ..operators.arrivals import VEHICLE, Progress, coordinates, few_routes, match_rows
from .matcher import OUT, PROGRESS

#: Waiting rows, the stops they go by, the clock, up to where rows were matched, and how far the
#: vehicle has come.
WAITING = f"us array<long>, lat array<double>, lon array<double>, stop_lats array<double>, stop_lons array<double>, clock long, horizon long, {PROGRESS}"
_NEVER = -(1 << 62)
#: What comes out.
ORDERED = f"{OUT}, lat double, lon double, late boolean"


#: State partitions of a stream for each core.
STATES_A_CORE = 4


@contextmanager
def few_states(spark: SparkSession) -> Iterator[None]:
    """Streams started in it have STATES_A_CORE state partitions for each core, or as many as the
    session shuffles to if these are fewer. Each batch starts a task for each of them and commits
    it, however few rows there are; a stream keeps the number it was first started with."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), STATES_A_CORE * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def match_in_order(observations: DataFrame, stops: DataFrame, delay_s: int, idle_ms: int | None = None) -> DataFrame:
    """The matched rows of a stream of observations (VEHICLE, lat, lon, us), as match_stream gives
    them, with late. A row is late if it is not after the vehicle's horizon, which is its clock
    less delay_s before the row's batch; late rows have the row's lat and lon and no stop.

    A row without coordinates is no observation: it only moves the clock. A vehicle that sends
    nothing for idle_ms of processing time has its waiting rows matched then; without idle_ms
    they wait for its next row, as a stream that ends, or is halted, must have them do."""
    lists = coordinates(stops)
    joined = observations.join(F.broadcast(lists) if few_routes(stops) else lists, ["sub_route_uid", "direction"])
    delay = delay_s * 1_000_000

    def order(key: tuple, frames: Iterable[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        us, lat, lon, stop_lats, stop_lons, clock, horizon, *progress = group.get if group.exists else ([], [], [], [], [], _NEVER, _NEVER, -1, -1, 0.0)
        waiting = pd.DataFrame({"us": np.array(us, np.int64), "lat": np.array(lat, float), "lon": np.array(lon, float)})
        late = waiting.iloc[:0]
        if group.hasTimedOut:
            horizon = clock
        else:
            rows = pd.concat(list(frames))
            stop_lats, stop_lons = (list(map(float, rows[c].iloc[0])) for c in ("stop_lats", "stop_lons"))
            clock = max(clock, int(rows["us"].max()))
            rows = rows[["us", "lat", "lon"]].dropna()
            late, rows = rows[rows["us"] <= horizon], rows[rows["us"] > horizon]
            waiting = pd.concat([waiting, rows])
            horizon = max(horizon, clock - delay)
        ready = waiting[waiting["us"] <= horizon].sort_values(["us", "lat", "lon"], kind="stable")
        waiting = waiting[waiting["us"] > horizon]
        parts, progress = [], Progress(*progress)
        if len(ready):
            ready = ready.assign(stop_lats=[stop_lats] * len(ready), stop_lons=[stop_lons] * len(ready))
            found, progress = match_rows(ready, progress)
            near = [None if np.isnan(x) else float(x) for x in found["near_dist"]]
            parts.append(pd.DataFrame({"us": ready["us"].to_numpy(), **found, "near_dist": near, "lat": ready["lat"].to_numpy(), "lon": ready["lon"].to_numpy(), "late": False}))
        if len(late):
            parts.append(pd.DataFrame({"us": late["us"].to_numpy(), "near_idx": -1, "near_dist": None, "trip": -1, "cause": 0, "lat": late["lat"].to_numpy(), "lon": late["lon"].to_numpy(), "late": True}))
        group.update((waiting["us"].tolist(), waiting["lat"].tolist(), waiting["lon"].tolist(), stop_lats, stop_lons, clock, horizon, progress.stop, progress.run, progress.since))
        if idle_ms and len(waiting):
            group.setTimeoutDuration(idle_ms)
        for part in parts:
            yield part.assign(**dict(zip(VEHICLE, key, strict=True)))[[c.split()[0] for c in ORDERED.split(", ")]]

    return joined.groupBy(*VEHICLE).applyInPandasWithState(order, ORDERED, WAITING, "append", GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout)


def write_matched(found: DataFrame, matched: str, late: str, checkpoint: str) -> DataStreamWriter:
    """Write a stream of match_in_order: matched rows to one table, late ones with the batch
    that they came in, by the day they are of, to another. A batch that is run again replaces
    what it wrote."""

    def split(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            held.where("not late").drop("late", "lat", "lon").write.mode("overwrite").parquet(f"{matched}/batch={batch_id}")
            of = held.where("late").select(*VEHICLE, "us", "lat", "lon").withColumn("dt", local_date(F.timestamp_micros("us")))
            of.write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
        finally:
            held.unpersist()

    return found.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)


def late_counts(spark: SparkSession, late: str) -> DataFrame:
    """How many late rows there are of each day and when the last came: what a decision about
    opening a closed day goes by."""
    return spark.read.parquet(late).groupBy("dt").agg(F.count("*").alias("n_late"), F.count_distinct(*VEHICLE).alias("n_vehicles"), F.max(F.col("batch").cast("long")).alias("last_batch"))
