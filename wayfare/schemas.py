"""Canonical schemas, and bringing frames to them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NAME = T.StructType([T.StructField("Zh_tw", T.StringType()), T.StructField("En", T.StringType())])

#: One raw vehicle record as the feed gives it. Identifiers are strings, whatever they look like.
RAW_POSITION = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in ("PlateNumb", "OperatorID", "OperatorNo", "RouteUID", "RouteID", "SubRouteUID", "SubRouteID")],
        T.StructField("RouteName", _NAME),
        T.StructField("SubRouteName", _NAME),
        T.StructField("Direction", T.ByteType()),
        T.StructField("BusPosition", T.StructType([T.StructField("PositionLat", T.DoubleType()), T.StructField("PositionLon", T.DoubleType()), T.StructField("GeoHash", T.StringType())])),
        T.StructField("Speed", T.ShortType()),
        T.StructField("Azimuth", T.IntegerType()),
        T.StructField("DutyStatus", T.ByteType()),
        T.StructField("BusStatus", T.ShortType()),
        *[T.StructField(c, T.StringType()) for c in ("GPSTime", "SrcUpdateTime", "UpdateTime")],
    ]
)

POSITIONS = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in ("city", "data_date", "plate_numb", "operator_id", "operator_no", "route_uid", "route_id", "route_name", "sub_route_uid", "sub_route_id", "sub_route_name")],
        T.StructField("direction", T.ByteType()),
        T.StructField("duty_status", T.ByteType()),
        T.StructField("bus_status", T.ShortType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("geohash", T.StringType()),
        T.StructField("speed", T.ShortType()),
        T.StructField("azimuth", T.IntegerType()),
        *[T.StructField(c, T.TimestampType()) for c in ("gps_time", "src_update_time", "update_time", "snapshot_time")],
    ]
)

ARCHIVED_POSITIONS = T.StructType(
    [*POSITIONS.fields, T.StructField("kafka_partition", T.IntegerType()), T.StructField("kafka_offset", T.LongType()), T.StructField("consume_time", T.StringType()), T.StructField("pipeline_version", T.StringType())]
)

#: One raw route document, with the stops of one direction.
RAW_ROUTE = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in ("SubRouteUID", "RouteUID", "VersionID", "UpdateTime")],
        T.StructField("Direction", T.IntegerType()),
        T.StructField("RouteName", _NAME),
        T.StructField("SubRouteName", _NAME),
        T.StructField("Operators", T.ArrayType(T.StructType([T.StructField("OperatorID", T.StringType()), T.StructField("OperatorNo", T.StringType()), T.StructField("OperatorName", _NAME), T.StructField("OperatorCode", T.StringType())]))),
        T.StructField(
            "Stops",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("StopSequence", T.IntegerType()),
                        *[T.StructField(c, T.StringType()) for c in ("StopUID", "StopID", "StationID", "LocationCityCode")],
                        T.StructField("StopName", _NAME),
                        T.StructField("StopBoarding", T.IntegerType()),
                        T.StructField("StopPosition", T.StructType([T.StructField("PositionLat", T.DoubleType()), T.StructField("PositionLon", T.DoubleType()), T.StructField("GeoHash", T.StringType())])),
                    ]
                )
            ),
        ),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("seq", T.IntegerType()),
        T.StructField("trip", T.IntegerType()),
        T.StructField("arrival_time", T.TimestampType()),
        T.StructField("n_obs", T.LongType()),
        T.StructField("min_dist", T.DoubleType()),
        T.StructField("min_speed", T.ShortType()),
        T.StructField("plate_numb", T.StringType()),
        T.StructField("dwell_s", T.DoubleType()),
        T.StructField("station_id", T.StringType()),
        T.StructField("stop_name", T.StringType()),
        T.StructField("boarding", T.IntegerType()),
        T.StructField("sub_route_uid", T.StringType()),
        T.StructField("direction", T.ByteType()),
        T.StructField("version_id", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("data_date", T.StringType()),
        T.StructField("rule_version", T.StringType()),
        T.StructField("trip_id", T.StringType()),
    ]
)


class SchemaDriftError(ValueError):
    """A frame's columns differ from what is expected, and strictness was asked for."""


def drift(columns: list[str], expected: list[str], strict: bool = False) -> dict[str, list[str]]:
    """Missing and extra columns, each sorted. Raises if strict and there are any."""
    found = {"missing": sorted(set(expected) - set(columns)), "extra": sorted(set(columns) - set(expected))}
    if strict and (found["missing"] or found["extra"]):
        raise SchemaDriftError(str(found))
    return found


def conform(df: DataFrame, schema: T.StructType, constants: Mapping[str, object] | None = None) -> DataFrame:
    """df with exactly the columns of schema, in order and cast (in ANSI mode a value that
    doesn't fit raises): constants win, missing columns are null, others are dropped."""
    constants = constants or {}
    present = set(df.columns)

    def column(field: T.StructField):
        if field.name in constants:
            value = F.lit(constants[field.name])
        else:
            value = F.col(f"`{field.name}`") if field.name in present else F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*map(column, schema.fields))
