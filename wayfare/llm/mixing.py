"""Mixing sources to target weights along a curriculum.

Each source has a share of the mix that varies over training time t in [0, 1] by a
linear schedule. The integral of the schedule is the source's cumulative demand for
words; its inverse gives for each document of the source, by where it stands in the
source's stream, the time at which it is due. Sorting by that time merges the sources.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, shielded, sqrt_blocks, word_count

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: (weight at t = 0, weight at t = 1) relative to the mean, repeating in that order.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def _cycle(values: Sequence[float], index: Column) -> Column:
    out = F.lit(float(values[-1]))
    for i in range(len(values) - 2, -1, -1):
        out = F.when(F.pmod(index, F.lit(len(values))) == i, F.lit(float(values[i]))).otherwise(out)
    return out


def due_time(offset: Column, demand: Column, first: Column, last: Column) -> Column:
    """Inverse of demand * W(t) / W(1) at offset, where W(t) = first * t +
    (last - first) * t * t / 2: the time at which a stream reaches offset."""
    area = F.when(demand > 0, F.least(offset / demand, F.lit(1.0))).otherwise(0.0) * (first + last) / 2
    slope = last - first
    return F.when(slope == 0, area / first).otherwise(2 * area / (first + F.sqrt(F.greatest(first * first + 2 * slope * area, F.lit(0.0)))))


def source_targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, weights: Sequence[float] = WEIGHTS, schedules: Sequence[tuple[float, float]] = SCHEDULES) -> DataFrame:
    """One row for each source of sizes (source, source_size): its target and schedule.

    Filling by weight until none exceeds cap times its size is water filling: in the
    order of cap per weight, sources are full while the level that the rest would
    reach is above theirs. The table has one row for each source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("_i", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumns({"_w": _cycle(weights, F.col("_i")), "_cap": F.col("source_size") * F.lit(cap), "_first": _cycle([x for x, _ in schedules], F.col("_i")), "_last": _cycle([x for _, x in schedules], F.col("_i"))})
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), "_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    t = ranked.withColumns({"_total": F.sum("source_size").over(everything) * F.lit(share), "_weight": F.sum("_w").over(everything), "_caps": F.sum("_cap").over(fill), "_used": F.sum("_w").over(fill)})
    # The level for those that are not full, were this row and all before it full.
    t = t.withColumn("_full", (F.col("_total") - F.col("_caps") + F.col("_cap")) * F.col("_w") >= F.col("_cap") * (F.col("_weight") - F.col("_used") + F.col("_w")))
    full = F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0.0)).over(everything)
    free = F.sum(F.when(F.col("_full"), F.lit(0.0)).otherwise(F.col("_w"))).over(everything)
    level = F.when(free > 0, (F.col("_total") - full) / free).otherwise(0.0)
    return t.withColumn("target", F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_w") * level)).select("source", "source_size", F.col("target").cast("double").alias("target"), "_first", "_last")


def mix(df: DataFrame, id_col: str = "doc_id", size_col: str = "size", share: float = 1.5, cap: float = 2.0, ties: Sequence[str] = ()) -> DataFrame:
    """df (id, source, size) with source_size, target, taken, position and passes.

    A source's documents in hashed order, repeated from the start when they end, are
    its stream; the mix takes the first floor(target) words. taken is what it takes of
    a document over all passes; position is when the first pass reaches it; passes has
    the words and the position of each pass that takes any. A null
    source is a source of its own, named last. Documents without words take 0. Equal
    rows are ordered next to one another and each counts; rows of equal id and size go by
    the columns ties.

    Positions in a stream are sums over hashed blocks plus a running sum in a block,
    so no task holds a source. Columns of df that have the names of new ones are replaced."""
    own = [id_col, "source", size_col, *ties]
    return shielded(df, own, lambda rows: _mix(rows, id_col, size_col, share, cap, ties))


def _mix(df: DataFrame, id_col: str, size_col: str, share: float, cap: float, ties: Sequence[str]) -> DataFrame:
    blocks = sqrt_blocks(df.count(), 1)
    key = F.xxhash64(F.col(id_col), F.col(size_col))
    rows = df.withColumn("_order", key).withColumn("_block", F.pmod(F.xxhash64("_order"), F.lit(blocks)).cast("int"))
    by_block = rows.groupBy("source", "_block").agg(F.sum(size_col).alias("_words"))
    before = Window.partitionBy("source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_block.withColumns({"_start": F.coalesce(F.sum("_words").over(before), F.lit(0)), "_named": F.col("source").isNotNull(), "_name": F.coalesce("source", F.lit(""))})
    targets = source_targets(by_block.groupBy("source").agg(F.sum("_words").alias("source_size")), share, cap)
    targets = targets.withColumns({"_named": F.col("source").isNotNull(), "_name": F.coalesce("source", F.lit(""))}).drop("source")
    offsets = offsets.drop("source", "_words").join(targets, ["_named", "_name"])
    own = Window.partitionBy("_named", "_name", "_block").orderBy("_order", id_col, size_col, *ties).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"_named": F.col("source").isNotNull(), "_name": F.coalesce("source", F.lit(""))})
    size = F.col(size_col)
    placed = rows.withColumn("_end", F.sum(size_col).over(own)).join(offsets, ["_named", "_name", "_block"])
    at = F.col("_start") + F.col("_end") - size
    demand = F.floor("target")
    rounds = [at + i * F.col("source_size") for i in range(math.ceil(cap))]
    takes = [F.least(F.greatest(demand - begin, F.lit(0)), size).cast("long") for begin in rounds]
    due = [due_time(begin.cast("double"), F.col("target"), F.col("_first"), F.col("_last")) for begin in rounds]
    passes = F.array(*[F.struct(words.alias("words"), when.alias("position")) for words, when in zip(takes, due, strict=True)])
    placed = placed.withColumns({"taken": sum(takes[1:], takes[0]), "position": due[0], "passes": F.filter(passes, lambda p: p["words"] > 0)})
    return placed.drop("_named", "_name", "_block", "_order", "_start", "_end", "_first", "_last")


def op5_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, range-sorted by their training position. Null text: size 0.
    Documents that the mix does not reach have taken 0 and come last."""
    rows = documents(spark, sf_dir).select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = mix(rows).select("doc_id", "size", "source_size", "target", "taken", "position")
    return mixed.orderBy(F.col("taken") == 0, "position", "doc_id")


