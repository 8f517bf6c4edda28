"""Windows over time lines of any length: blocks of time with what is carried across their edges.

A window over a key puts all of its rows into one task. Here a key's line is cut into blocks of
span_us, each a group of its own, and a small table of one row for each key and block says what
a block takes over from those before it (or after it): the last row, a sum, the least value.
Only that table is ordered by key, so a table of one key uses as many tasks as it has blocks.
Rows are ordered by time first; keys may be null, and null is a key like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


def _cut(df: DataFrame, at: str, span_us: int) -> DataFrame:
    return df.withColumn("_block", F.floor(F.col(at) / span_us))


def _carried(rows: DataFrame, keys: Sequence[str], block: Column, carried: Column) -> DataFrame:
    """rows with _carried, which is carried, a window over the blocks of a key, of what the
    aggregate block gives of each, _of."""
    edges = rows.groupBy(*keys, "_block").agg(block.alias("_of")).withColumn("_carried", carried).drop("_of")
    edges = edges.withColumnsRenamed({c: f"_edge_{k}" for k, c in enumerate((*keys, "_block"))})
    same = [F.col(c).eqNullSafe(F.col(f"_edge_{k}")) for k, c in enumerate((*keys, "_block"))]
    return rows.join(edges, same, "left").drop(*[f"_edge_{k}" for k in range(len(keys) + 1)])


def lagged(df: DataFrame, keys: Sequence[str], order: Sequence[str], names: Mapping[str, str], span_us: int | None = None) -> DataFrame:
    """df with columns of the row before within keys, in the order of columns of which the
    first is a time in microseconds. names maps columns to the names that they get."""
    if span_us is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({new: F.lag(c).over(w) for c, new in names.items()})
    value = F.struct(*names)
    around = Window.partitionBy(*keys).orderBy("_block")
    rows = _carried(_cut(df, order[0], span_us), keys, F.max_by(value, F.struct(*order)), F.lag("_of").over(around))
    own = Window.partitionBy(*keys, "_block").orderBy(*order)
    rows = rows.withColumn("_prior", F.coalesce(F.lag(value).over(own), "_carried"))
    return rows.withColumns({new: F.col(f"_prior.{c}") for c, new in names.items()}).drop("_prior", "_carried", "_block")


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, span_us: int | None = None) -> DataFrame:
    """df with the sum of value over the rows up to each, itself included."""
    up_to = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    if span_us is None:
        return df.withColumn(name, F.sum(value).over(up_to(Window.partitionBy(*keys).orderBy(*order))))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    rows = _carried(_cut(df, order[0], span_us), keys, F.sum(value), F.coalesce(F.sum("_of").over(before), F.lit(0)))
    own = F.sum(value).over(up_to(Window.partitionBy(*keys, "_block").orderBy(*order)))
    return rows.withColumn(name, F.col("_carried") + own).drop("_carried", "_block")


def least_later(df: DataFrame, keys: Sequence[str], at: str, value: str, name: str, span_us: int | None = None) -> DataFrame:
    """df with the least value among the rows that are strictly later, null where there is none."""
    later = lambda *by: F.min(value).over(Window.partitionBy(*by).orderBy(F.col(at).desc()).rangeBetween(Window.unboundedPreceding, -1))
    if span_us is None:
        return df.withColumn(name, later(*keys))
    after = Window.partitionBy(*keys).orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    rows = _carried(_cut(df, at, span_us), keys, F.min(value), F.min("_of").over(after))
    return rows.withColumn(name, F.least(later(*keys, "_block"), "_carried")).drop("_carried", "_block")
