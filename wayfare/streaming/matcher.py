"""The sequence matcher on a stream: a vehicle's state goes on from batch to batch."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.arrivals import EVENT_GAP_S, VEHICLE, Progress, coordinates, few_routes, match_rows

OUT = "sub_route_uid string, direction byte, plate_numb string, us long, near_idx int, near_dist double, trip int, cause byte"
PROGRESS = "stop int, run int, since double"


def match_stream(observations: DataFrame, stops: DataFrame, idle_ms: int | None = None) -> DataFrame:
    """observations: a stream (VEHICLE, lat, lon, us); stops as match_positions takes them, a
    static table. Rows of one batch are put in time order; batches must come in it. A vehicle
    that is silent for idle_ms of processing time is forgotten and begins a new trip; without
    idle_ms none is (a stream that ends, as with availableNow, must have none: Spark goes on
    with empty batches while timeouts by processing time are on)."""
    lists = coordinates(stops)
    joined = observations.join(F.broadcast(lists) if few_routes(stops) else lists, ["sub_route_uid", "direction"])

    def match(key: tuple, frames: Iterable[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        if group.hasTimedOut:
            group.remove()
            return
        rows = pd.concat(list(frames)).sort_values(["us", "lat", "lon"], kind="stable")
        found, progress = match_rows(rows, Progress(*group.get) if group.exists else None)
        group.update((progress.stop, progress.run, progress.since))
        if idle_ms:
            group.setTimeoutDuration(idle_ms)
        near = [None if np.isnan(x) else float(x) for x in found["near_dist"]]
        yield pd.DataFrame({**dict(zip(VEHICLE, ([k] * len(rows) for k in key), strict=True)), "us": rows["us"].to_numpy(), **found, "near_dist": near})

    return joined.groupBy(*VEHICLE).applyInPandasWithState(match, OUT, PROGRESS, "append", GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout)


ARRIVALS = "sub_route_uid string, direction byte, plate_numb string, arrival_us long, trip int, near_idx int, from_idx int, sec long"
VISIT = f"{PROGRESS}, visit_stop int, visit_run int, visit_us long, seen_us long"


def arrivals_stream(observations: DataFrame, stops: DataFrame, gap_s: int = EVENT_GAP_S) -> DataFrame:
    """Arrivals on a stream of observations (as match_stream takes them): one for the first
    observation of each visit of a stop, with the stop before on the trip and the seconds since
    the arrival there. A visit ends as in the batch form: with another stop, another trip, or
    after gap_s."""
    lists = coordinates(stops)
    joined = observations.join(F.broadcast(lists) if few_routes(stops) else lists, ["sub_route_uid", "direction"])

    def arrive(key: tuple, frames: Iterable[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values(["us", "lat", "lon"], kind="stable")
        stop, run, since, *visit = group.get if group.exists else (-1, -1, 0.0, -1, -1, 0, 0)
        found, progress = match_rows(rows, Progress(stop, run, since))
        hit = np.flatnonzero(found["near_idx"] >= 0)
        # The visit of the batch before goes on in front of this one's.
        at = np.r_[visit[0], found["near_idx"][hit]]
        trip, us = np.r_[visit[1], found["trip"][hit]], np.r_[visit[3], rows["us"].to_numpy()[hit]]
        new = np.flatnonzero((at[1:] != at[:-1]) | (trip[1:] != trip[:-1]) | (us[1:] - us[:-1] > gap_s * 1_000_000)) + 1
        arrival = np.r_[visit[2], us[new]]
        stops_met, trips = np.r_[visit[0], at[new]], np.r_[visit[1], trip[new]]
        same = (trips[1:] == trips[:-1]) & (stops_met[:-1] >= 0)
        group.update((progress.stop, progress.run, progress.since, int(stops_met[-1]), int(trips[-1]), int(arrival[-1]), int(us[-1])))
        before = pd.array(np.where(same, stops_met[:-1], 0), "Int64").copy()
        sec = pd.array(np.where(same, (arrival[1:] - arrival[:-1]) // 1_000_000, 0), "Int64").copy()
        before[~same], sec[~same] = pd.NA, pd.NA
        yield pd.DataFrame({**dict(zip(VEHICLE, ([k] * len(new) for k in key), strict=True)), "arrival_us": arrival[1:], "trip": trips[1:], "near_idx": stops_met[1:], "from_idx": before, "sec": sec})

    return joined.groupBy(*VEHICLE).applyInPandasWithState(arrive, ARRIVALS, VISIT, "append", GroupStateTimeout.NoTimeout)
