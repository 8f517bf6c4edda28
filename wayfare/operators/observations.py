"""From raw records to clean observations: normalizing, filters, de-duplication, merging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import local_date
from ..schemas import POSITIONS, conform

# Fixed names: field of the feed, column of the engine.
FLAT = {
    "PlateNumb": "plate_numb", "OperatorID": "operator_id", "OperatorNo": "operator_no", "RouteUID": "route_uid", "RouteID": "route_id", "SubRouteUID": "sub_route_uid", "SubRouteID": "sub_route_id",
    "Direction": "direction", "Speed": "speed", "Azimuth": "azimuth", "DutyStatus": "duty_status", "BusStatus": "bus_status",
}
NESTED = {"RouteName.Zh_tw": "route_name", "SubRouteName.Zh_tw": "sub_route_name", "BusPosition.PositionLat": "lat", "BusPosition.PositionLon": "lon", "BusPosition.GeoHash": "geohash"}
TIMES = {"GPSTime": "gps_time", "SrcUpdateTime": "src_update_time", "UpdateTime": "update_time", "SnapshotTime": "snapshot_time"}
OBSERVATION_KEY = ("plate_numb", "sub_route_uid", "direction", "gps_time")


def to_second(ts: Column) -> Column:
    """ISO-8601 text as a UTC timestamp, floored to the second; what is no time is null."""
    return F.date_trunc("second", F.try_to_timestamp(ts))


def normalize(raw: DataFrame, constants: Mapping[str, object] | None = None, schema: StructType = POSITIONS) -> DataFrame:
    """Raw records (nested, read with a fixed schema) as canonical positions. Fields that
    are missing, or whose parent is, are null; columns that schema knows by name stay."""
    top = set(raw.columns)
    picked = [F.col(f).alias(c) for f, c in FLAT.items() if f in top]
    picked += [F.col(f).alias(c) for f, c in NESTED.items() if f.split(".")[0] in top]
    picked += [to_second(F.col(f)).alias(c) for f, c in TIMES.items() if f in top]
    extra = [F.col(c) for c in raw.columns if c not in FLAT and c not in TIMES and c not in {f.split(".")[0] for f in NESTED}]
    return conform(raw.select(*picked, *extra), schema, constants)


def in_service(df: DataFrame) -> DataFrame:
    return df.where(F.col("duty_status") == 1)


def with_coordinates(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows that have both coordinates; NaN is none."""
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon))


def with_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose grouping keys are all known."""
    return df.dropna(subset=list(keys))


def on_local_date(df: DataFrame, ts: str, date: str | None = None, date_col: str | None = None) -> DataFrame:
    """Rows whose local date is a given one, or that of a column."""
    return df.where(local_date(F.col(ts)) == (F.lit(date) if date is not None else F.col(date_col)))


def outlier_flags(df: DataFrame) -> DataFrame:
    """Flags for coordinates outside the region, speeds above 100, and status codes. An
    unknown status counts as another one than 0 and 99."""
    status = F.col("bus_status")
    return df.withColumns({
        "bad_coordinates": (F.col("lat") < 24) | (F.col("lat") > 26) | (F.col("lon") < 120) | (F.col("lon") > 123),
        "bad_speed": F.col("speed") > 100,
        "status_other": F.coalesce(~status.isin(0, 99), F.lit(True)),
        "status_abnormal": F.coalesce(status.isin(1, 2, 4, 98, 101), F.lit(False)),
        "status_traffic": F.coalesce(status.isin(3, 100), F.lit(False)),
    })


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in an order that should be total. Null keys are equal.
    Where the order is of sortable columns, a key's rows are reduced before the shuffle."""
    rank = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1").drop("_rank")


def dedup_messages(df: DataFrame) -> DataFrame:
    """One row for each message: copies differ in consume_time alone, the earliest stays.
    Partial aggregation drops copies before the shuffle."""
    others = [c for c in df.columns if c not in ("kafka_partition", "kafka_offset")]
    first = F.min(F.struct("consume_time", *[c for c in others if c != "consume_time"]) if "consume_time" in others else F.struct(*others)).alias("_first")
    return df.groupBy("kafka_partition", "kafka_offset").agg(first).select(*[F.col(c) if c in ("kafka_partition", "kafka_offset") else F.col(f"_first.{c}").alias(c) for c in df.columns])


def merge_at_cutover(history: DataFrame, live: DataFrame, ts: str) -> DataFrame:
    """All live rows, and of history those before the first live one or of unknown time."""
    boundary = live.agg(F.min(ts).alias("_boundary"))
    before = history.join(F.broadcast(boundary)).where(F.coalesce(F.col(ts) < F.col("_boundary"), F.lit(True))).drop("_boundary")  # one row
    return before.unionByName(live, allowMissingColumns=True)


#: Columns that a cutover may go by, the first one that both sides know.
BOUNDARY_CANDIDATES = ("snapshot_time", "update_time", "src_update_time", "gps_time")


def boundary_column(history: DataFrame, live: DataFrame, candidates: Sequence[str] = BOUNDARY_CANDIDATES) -> str:
    """The first candidate that both tables have and of which history has any value."""
    shared = [c for c in candidates if c in history.columns and c in live.columns]
    known = history.agg(*[F.count(c).alias(c) for c in shared]).first() if shared else {}
    for c in shared:
        if known[c]:
            return c
    raise ValueError(f"no time column in common among {', '.join(candidates)}")


def trajectory(df: DataFrame, sub_route_uid: str, direction: int, plate_numb: str | None = None) -> DataFrame:
    """The observations of one route and direction, or of one vehicle on it, once for each
    vehicle and time; of several the smallest row stays. The filter comes first, so that it
    reaches the files."""
    rows = df.where((F.col("sub_route_uid") == sub_route_uid) & (F.col("direction") == direction))
    rows = rows if plate_numb is None else rows.where(F.col("plate_numb") == plate_numb)
    others = [c for c in df.columns if c not in ("plate_numb", "gps_us")]
    once = rows.groupBy("plate_numb", "gps_us").agg(F.min(F.struct(*others)).alias("_first"))
    return once.select("plate_numb", "gps_us", "_first.*").select(*df.columns).sort("plate_numb", "gps_us")
