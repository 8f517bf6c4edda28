"""From raw documents to a tokenized training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; run()
writes each stage's result as Parquet to the shared folder and reads it for the next. All but
the last give the columns of docs, whatever they are called.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType

from wayfare.llm import bpe, jaccard, mixing, substring, toxicity
from wayfare.llm.common import NULL_ID, cut, documents, shielded, sweep, word_count
from wayfare.llm.packs import rereadable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The columns that stages know; others pass through without their names being seen.
KNOWN = ("doc_id", "text", "source", "n_chars")


def _stage(step: Stage) -> Stage:
    """A stage that first lets go of tables that no frame reads any more, and that sees of docs'
    columns those it knows by name, and the others under names that nothing else has."""

    @functools.wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        sweep(spark)
        known = [c for c in KNOWN if c in docs.columns]
        return shielded(docs, known, lambda rows: step(spark, rows, sf_dir)).select(*[F.col(f"`{c}`") for c in docs.columns])

    return run_step


def _named(df: DataFrame, but: tuple[str, ...] = ()) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns if c not in but]


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, by a chain trained on the labelled ones that are
    not held out. Texts without words score by the chain's constants alone."""
    chain = toxicity.trained_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, chain).filter("score < 0.5").drop("score")


def _has_map(kind: DataType) -> bool:
    inside = [f.dataType for f in getattr(kind, "fields", [])] + [getattr(kind, "elementType", None)]
    return isinstance(kind, MapType) or any(_has_map(k) for k in inside if k is not None)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by word 5-grams at a similarity of 0.8, the one of smallest id;
    where several texts have that id, the one of smallest hash. Of rows that share id and
    text one stays, that whose other columns come first. Documents without words link with
    nothing."""
    rows = jaccard.linked(docs, 5, 8, 10)
    alone = lambda c: F.when(F.col("node").isNull(), F.col(c))
    kept = rows.groupBy("node", alone("id"), alone("key")).agg(F.min(F.struct("id", "key")).alias("_kept")).select(F.col("_kept.id").alias("_id"), F.col("_kept.key").alias("_key"))
    rest = _named(docs, ("doc_id", "text"))
    ids = docs.withColumns({"_id": F.coalesce("doc_id", F.lit(NULL_ID)), "_key": F.xxhash64("text")})
    whole = F.struct(*rest)
    # Maps have no order, so rows with one go by what is written of them.
    order = F.to_json(whole) if _has_map(docs.select(*rest).schema) else whole
    of_rest = [F.min_by(whole, order).alias("_rest")] if rest else []
    one = ids.groupBy("_id", "_key").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), *of_rest)
    left = one.join(kept, ["_id", "_key"], "left_semi")
    return left.select("doc_id", "text", *(["_rest.*"] if rest else []))


@_stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that windows of 20 words cover which start earlier too; texts
    that lose none stay as they are. n_chars follows the text."""
    return _counted(substring.dedup(docs))


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.lit(0).cast("long"))) if "n_chars" in docs.columns else docs


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each pass that takes words of a document, each file in the order of
    training. A pass that takes a part takes the first words. Documents the mix doesn't reach,
    and those without words, are not in it. Each row is a document of its own, whatever its
    id: it is known by its place, and only places, sizes and checks of the text are mixed."""
    placed = rereadable(docs).withColumns({"_row": F.monotonically_increasing_id(), "_check": F.crc32(F.col("text").cast("binary"))})
    sizes = placed.select("doc_id", "source", word_count(F.col("text")).alias("size"), "_row", "_check")
    mixed = mixing.mix(sizes, ties=["_row"]).select(F.col("_row").alias("_of"), F.col("doc_id").alias("_id"), F.col("_check").alias("_was"), F.col("size").alias("_size"), "passes")
    rows = placed.join(mixed, F.col("_row") == F.col("_of"), "left")
    same = F.col("_of").isNotNull() & F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_check").eqNullSafe(F.col("_was"))
    passes = F.when(same, F.col("passes")).otherwise(F.raise_error(F.lit("documents came in another order when they were read again")).cast(mixed.schema["passes"].dataType))
    rows = rows.withColumn("_take", F.explode(passes))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.when(F.col("_take.words") < F.col("_size"), F.array_join(F.slice(words, F.lit(1), F.col("_take.words").cast("int")), " ")).otherwise(F.col("text"))
    rows = _counted(rows.withColumn("text", text))
    return rows.sortWithinPartitions("_take.position", "_row").select(*_named(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix, and what they decode to."""
    sweep(spark)
    return bpe.digest(docs.select("doc_id", "text"), bpe.default_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE", tokenize),
]

#: The stages learn, hash and tokenize. Tests compare what near copies, repeats, the mix and the
#: tokens leave with brute force, and what toxicity drops with the scores of its operator.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
