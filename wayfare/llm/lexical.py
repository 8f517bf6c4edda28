"""Ranked lexical search: impact-ordered, score at a time.

What a term adds to a document's score, its impact, is an exact integer. Documents are
indexed where they are read: a task holds, for one slice of them after another, the
postings of the items' terms, each term's in descending order of impact. For an item the
segments of all its terms are added up from the highest impact down, until what is left
of all terms together is below the k-th best so far; then the documents that can still be
among the first k have their scores completed from the postings by document. A task keeps k
documents an item from slice to slice, whose scores bound the next slices from the start,
and only these leave it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import NULL_ID, Texts, documents, slices, sqrt_blocks
from .terms import PART_BYTES, SLICE_BYTES, Vocabulary, lowered, parts, texts_of, totals

TOP = 10
#: A round goes down to this share of the highest impact left.
STEP = 0.5


class Items:
    """The distinct terms of each item of a part; rows of one item are one."""

    def __init__(self, rows: list[tuple]):
        self.names = sorted({item for item, _ in rows}, key=lambda v: (v is not None, v))
        self.vocabulary = Vocabulary(lowered(texts_of([text for _, text in rows])))
        number = {name: k for k, name in enumerate(self.names)}
        first, words = self.vocabulary.first, self.vocabulary.numbers
        terms: list[list[int]] = [[] for _ in self.names]
        for k, (item, _) in enumerate(rows):
            terms[number[item]] += words[first[k] : first[k + 1]].tolist()
        self.terms = [np.unique(np.array(t, np.int64)) for t in terms]

    def __len__(self) -> int:
        return len(self.names)

    def statistics(self, texts: Texts) -> np.ndarray:
        """Of a slice: documents with a term, all terms, and for each of the items' terms, at
        its number + 1, the documents that hold it."""
        numbers, first = self.vocabulary.of(lowered(texts))
        n, size = np.diff(first), len(self.vocabulary) + 1
        held = np.unique(np.repeat(np.arange(len(n)), n) * size + numbers)
        df = np.bincount(held % size, minlength=size)
        return np.r_[(n > 0).sum(), n.sum(), df[1:]]


class Index:
    """Postings of a slice's documents for the items' terms: each term's in descending order of
    impact, and all in the order of documents."""

    def __init__(self, items: Items, weights: np.ndarray, docs: int, words: int, texts: Texts):
        numbers, first = items.vocabulary.of(lowered(texts))
        n, self.size = np.diff(first), len(items.vocabulary) + 1
        doc = np.repeat(np.arange(len(n)), n)
        self.keys, tf = np.unique((doc * self.size + numbers)[numbers > 0], return_counts=True)
        doc, term = self.keys // self.size, self.keys % self.size
        m = 100 - 90 + (90 * n * docs) // max(1, words)
        self.impacts = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        order = np.lexsort((-self.impacts, term))
        self.docs, self.falling = doc[order], -self.impacts[order]
        self.at = np.searchsorted(term[order], np.arange(self.size + 1))
        self.n = len(n)

    def _left(self, term: int, at: int) -> int:
        """The highest impact of a term's postings from at on."""
        return -int(self.falling[at]) if at < self.at[term + 1] else 0

    def search(self, terms: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, exact scores) of all that may be among the first k of an item, ties
        included, if a score below least can't be; only scores above 0."""
        at = {t: int(self.at[t]) for t in terms.tolist() if self.at[t] < self.at[t + 1]}
        left = {t: self._left(t, a) for t, a in at.items()}
        score = np.zeros(self.n, np.int64)
        while (bound := sum(left.values())) >= least and bound > 0:
            down = int(max(left.values()) * STEP)
            for t, a in at.items():
                if left[t] >= max(down, 1):
                    end = a + int(np.searchsorted(self.falling[a : self.at[t + 1]], -down, side="right"))
                    score[self.docs[a:end]] -= self.falling[a:end]
                    at[t], left[t] = end, self._left(t, end)
            if self.n >= k:
                least = max(least, int(np.partition(score, -k)[-k]))
        # No document that was not met can reach least any more; those that can are completed.
        held = np.flatnonzero((score > 0) & (score + bound >= least))
        rest = np.array([t for t, x in left.items() if x], np.int64)
        if len(held) and len(rest):
            keys = held[:, None] * self.size + rest
            found = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            # A posting below the place its term has come to was not added yet.
            reached = np.array([left[t] for t in rest.tolist()])
            add = np.where((self.keys[found] == keys) & (self.impacts[found] <= reached), self.impacts[found], 0)
            score[held] += add.sum(axis=1)
        held = held[score[held] >= max(1, least)]
        return held, score[held]


def top_documents(df: DataFrame, items: DataFrame, k: int = TOP, part_bytes: int = PART_BYTES) -> DataFrame:
    """(item, rank, id, score): of each item (an id, a text) the k documents of df (an id, a
    text) with the highest scores above 0, equal scores by ascending id, a null id first.

    Documents that share an id are several; rows that share an item's id are one item with the
    terms of all. Null texts and texts without a term have none, and items without any no rows.
    Items above part_bytes go in parts, each of which reads the documents again."""
    spark, docs = df.sparkSession, df.select(*[F.col(f"`{c}`") for c in df.columns[:2]])
    id_col, item_col = df.columns[0], items.columns[0]
    item_type = items.schema[item_col].dataType
    buckets = sqrt_blocks(docs.rdd.getNumPartitions())
    found = None
    for rows in parts(items.select(*[F.col(f"`{c}`") for c in items.columns[:2]]), part_bytes):
        made = Items(rows)
        if found is not None and not made:
            continue
        one = _searched(spark, docs, made, k, buckets)
        names = spark.createDataFrame(list(enumerate(made.names)), StructType([StructField("item", LongType()), StructField("name", item_type)]))
        best = one.join(F.broadcast(names), "item").select(F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score")
        found = best if found is None else found.union(best)
    return found


def _searched(spark: SparkSession, docs: DataFrame, items: Items, k: int, buckets: int) -> DataFrame:
    shared = spark.sparkContext.broadcast(items)
    total = totals(docs, lambda texts: shared.value.statistics(texts), len(items.vocabulary) + 2)
    n, words = int(total[0]), int(total[1])
    weights = spark.sparkContext.broadcast(np.array([0, *[math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in total[2:].tolist()]], np.int64))
    kind = docs.schema[0].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in own.names]  # ids and scores
        nulls: set[int] = set()
        for batch, texts in slices(batches, SLICE_BYTES):
            index = Index(own, weights.value, n, words, texts)
            if batch.column(0).null_count:
                nulls.add(NULL_ID)
            for item, terms in enumerate(own.terms):
                ids, scores = best[item]
                held, new = index.search(terms, k, int(scores[-1]) if len(scores) == k else 0)
                if len(held):
                    ids, scores = np.r_[ids, texts.ids[held]], np.r_[scores, new]
                    order = np.lexsort((ids, -scores))[:k]
                    best[item] = ids[order], scores[order]
        item = np.repeat(np.arange(len(best)), [len(ids) for ids, _ in best])
        ids, scores = (np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*best, strict=True)) if best else (item, item)
        ids = pa.array(ids, mask=(ids == NULL_ID) & bool(nulls))
        bucket = np.full(len(item), TaskContext.get().partitionId() % buckets)
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(bucket, pa.int64()), ids.cast(pa.int64()), pa.array(scores, pa.int64())], ["item", "bucket", "id", "score"])

    rows = docs.mapInArrow(search, "item long, bucket long, id long, score long")
    order = [F.col("score").desc(), F.col("id").asc_nulls_first()]
    # The tasks' best meet in buckets first, so that no task sorts what all of them have found.
    for keys in (["item", "bucket"], ["item"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return rows.select("item", "rank", F.col("id").cast(kind), "score")


def op12_impact_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item. Null texts have no terms; an empty table
    or benchmark gives no rows. A null doc_id comes before all others of its score."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return top_documents(documents(spark, sf_dir).select("doc_id", "text"), items).select("item_id", "rank", "doc_id", "score")
