"""Sharding by a hierarchical weighted hash tree.

A cluster is a tree of regions, racks and shards. A row descends it: at each level
every child draws a number from the row's key and the child's name, scaled by the
weight of all shards below the child, and the largest draw wins. A child's draw does
not depend on its siblings, so a changed weight moves rows only into or out of the
subtree whose weight changed; a new region takes rows only into itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, sqrt_blocks

#: regions > racks > weights of shards, numbered left to right
Tree = Sequence[Sequence[Sequence[float]]]

TREE: Tree = (((1.0, 1.0), (1.0, 1.0)), ((1.0, 1.0), (1.0, 1.0)))
GROWN: Tree = (*TREE, ((1.0,),))


def _draw(key: Column, name: str, weight: float) -> Column:
    """log(u) / weight for u uniform in (0, 1) from key and name: the largest of
    these draws falls to a child with the probability of its share of weight."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11)
    return F.log((bits.cast("double") + 0.5) / float(1 << 53)) / weight


def _choose(key: Column, children: Sequence[tuple[str, float, Column]]) -> Column:
    """The value of the child with the largest draw; ties go to the first."""
    live = [(name, weight, value) for name, weight, value in children if weight > 0]
    if len(live) == 1:
        return live[0][2]
    draws = [_draw(key, name, weight) for name, weight, _ in live]
    best, out = F.greatest(*draws), live[-1][2]
    for draw, (_, _, value) in list(zip(draws, live, strict=True))[-2::-1]:
        out = F.when(draw == best, value).otherwise(out)
    return out


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard, as an int, that a key reaches in the tree. Weights of 0 take none;
    a null key descends like any other value."""
    if not any(w > 0 for region in tree for rack in region for w in rack):
        raise ValueError("the tree has no weight")
    number, regions = 0, []
    for i, region in enumerate(tree):
        racks = []
        for j, rack in enumerate(region):
            shards = []
            for k, weight in enumerate(rack):
                shards.append((f"{i}/{j}/{k}", weight, F.lit(number).cast("int")))
                number += 1
            if sum(rack) > 0:
                racks.append((f"{i}/{j}", sum(rack), _choose(key, shards)))
        if weight_of := sum(w for _, w, _ in racks):
            regions.append((f"{i}", weight_of, _choose(key, racks)))
    return _choose(key, regions)


def assign_shards(df: DataFrame, key: str, tree: Tree = TREE, grown: Tree | None = None) -> DataFrame:
    """df with columns shard and grown_shard (null without a grown tree); columns of
    these names are replaced. Narrow: no shuffle."""
    after = shard_of(F.col(key), grown) if grown is not None else F.lit(None).cast("int")
    return df.withColumns({"shard": shard_of(F.col(key), tree), "grown_shard": after})


def number_slots(df: DataFrame, group: str, order: Sequence[Column], slot: str = "slot") -> DataFrame:
    """Number the rows of each group from 0 without gaps. Rows go into hashed blocks,
    each numbered by itself from where the blocks before it end, so no task holds a
    group. Blocks and the rows of a block grow as the square root of the rows. A column of
    the slot's name is replaced."""
    block, row, start, n = (_free(df, name) for name in ("block", "row", "start", "n"))
    blocks = sqrt_blocks(df.count(), 4)
    rows = df.withColumn(block, F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    before = Window.partitionBy(group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(group, block).agg(F.count("*").alias(n)).select(F.col(group), block, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    own = Window.partitionBy(group, block).orderBy(*order)
    return rows.withColumn(row, F.row_number().over(own)).join(starts, [group, block]).withColumn(slot, (F.col(start) + F.col(row) - 1).cast("long")).drop(block, row, start)


def _free(df: DataFrame, name: str) -> str:
    """A name like that which no column of df has."""
    while name in df.columns:
        name += "_"
    return name


def op4_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7; the grown tree has a ninth in a region of its
    own. Null or empty text: size 1, crc32 of no bytes. A null doc_id is a key like
    any other. Repeated rows share a shard and take slots of their own."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(spark, sf_dir).select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = assign_shards(rows, "doc_id", TREE, GROWN).withColumn("law", F.lit("key"))
    numbered = number_slots(placed, "shard", [F.col("doc_id"), F.col("size"), F.col("text_crc32")])
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
