"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a longest run of anything but space, tab, LF, VT, FF and CR.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
NULL_ID = -(1 << 63)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def word_count(text: Column) -> Column:
    """Number of words as a long; null text counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def sqrt_blocks(n: int, factor: int = 1) -> int:
    """Number of blocks so that blocks and rows in a block both grow as the square root of n."""
    return max(1, factor * math.isqrt(max(0, n - 1)) + 1)


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which driver and executors share. Where it
    is unset, a local session, which is one process, gets a folder of its own; a cluster's
    raises."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("the session names no spark.checkpoint.dir")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


#: Tables cut, by application and path, each with a weak reference of the driver's JVM to the
#: index of its files, which the plans of all frames over the table hold.
_tables: dict[tuple[str, str], JavaObject] = {}


def cut(df: DataFrame) -> DataFrame:
    """df written as a table in the shared folder and read back: later uses do not compute
    it again and need no file of an executor's own. The table is deleted by a later cut or
    sweep once the JVM has collected every frame over it, this one and those made of it, and
    no sooner, so results that are still lazy keep it."""
    spark = df.sparkSession
    sweep(spark)
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    index = out._jdf.queryExecution().analyzed().relation().location()
    _tables[spark.sparkContext.applicationId, path] = spark._jvm.java.lang.ref.WeakReference(index)
    return out


def sweep(spark: SparkSession) -> int:
    """Delete the tables that were cut and that no frame reads any more; how many."""
    own, deleted = spark.sparkContext.applicationId, 0
    for (application, path), reference in list(_tables.items()):
        if application == own and reference.get() is not None:
            continue
        if _tables.pop((application, path), None) is not None and application == own:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            deleted += place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return deleted


def joined_apart(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """left and right joined by their long column on, both dealt anew even if one of them has been
    grouped by it: only then Spark can split the rows of a hot value. Rows of null join nothing."""
    other = right.withColumnRenamed(on, "_apart")
    return left.join(other, F.bitwise_not(F.col(on)) == F.bitwise_not(F.col("_apart"))).drop("_apart")


def shielded(df: DataFrame, own: Sequence[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What step makes of df, whose columns other than own it doesn't see by their names: they
    come through whatever they are called, unless step gives a column of that name, which
    replaces them."""
    others = [c for c in df.columns if c not in own]
    out = step(df.select(*[F.col(f"`{c}`") for c in own], *[F.col(f"`{c}`").alias(f"other {k}") for k, c in enumerate(others)]))
    new = [c for c in out.columns if not c.startswith("other ") and c not in own]
    back = [F.col(f"`other {k}`").alias(c) for k, c in enumerate(others) if c not in new]
    return out.select(*[F.col(f"`{c}`") for c in own if c in out.columns], *back, *[F.col(f"`{c}`") for c in new])


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Memory that is free in this process goes back to the system: Arrow's, and, where the C
    library can, what malloc keeps of NumPy's arrays."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(step: Step) -> Step:
    """step for mapInArrow, after which its worker, which waits beside those at work for a
    minute or longer, holds no free memory."""

    @functools.wraps(step)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        give_back()

    return run


class Texts(NamedTuple):
    """Documents of one slice: ids, UTF-8 bytes end to end, and where each begins."""

    ids: np.ndarray
    data: np.ndarray
    starts: np.ndarray  # one more than ids

    def of(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i + 1]].tobytes()


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut record batches (first column an id, second a text) into slices of at most
    max_bytes of text each, or one document where it alone is longer."""
    for batch in batches:
        texts = batch.column(1)
        n = len(texts)
        if n == 0:
            continue
        if pa.types.is_string(texts.type) or pa.types.is_binary(texts.type):
            kind, width = np.int32, 4
        else:
            kind, width = np.int64, 8
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, kind, n + 1, texts.offset * width).astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        ids = batch.column(0)
        ids = (ids.fill_null(NULL_ID) if ids.null_count else ids).to_numpy(zero_copy_only=False).astype(np.int64)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(at, at[i] + max_bytes, side="right")) - 1)
            j = min(j, n)
            yield batch.slice(i, j - i), Texts(ids[i:j], raw[at[i] : at[j]], at[i : j + 1] - at[i])
            i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash, elementwise on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Two ways to hash the same bytes, for 128 bits of them.
SEEDS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_LEFT = np.uint64(0xC2B2AE3D27D4EB4F)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each byte on as one number, and one more entry for the end; what is
    past the end counts as bytes 0."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, np.dtype("<u8"), padded, strides=(1,))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of sequences from those of their two parts. Mixing between the parts keeps
    texts built of repeated parts from meeting, as they do in a polynomial modulo 2 ** 64."""
    return mix64(left * _LEFT + right)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A hash of data[start : end] for each span, eight bytes a step for all spans at once."""
    size, from_here = ends - starts, eights(data)
    out = mix64(size.astype(np.uint64) ^ SEEDS[seed])
    left, step = np.flatnonzero(size > 0), 0
    while len(left):
        part = from_here[starts[left] + step] & _MASKS[np.minimum(size[left] - step, 8)]
        out[left] = joined(out[left], part)
        step += 8
        left = left[size[left] > step]
    return out


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all ranges of k successive codes; empty if there are fewer."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, level, span, done = None, codes, 1, 0
    while True:
        if k & span:
            part = level[done : done + n]
            out, done = (part if out is None else joined(out, part)), done + span
        if done == k:
            return mix64(out ^ np.uint64(k))
        level, span = joined(level[:-span], level[span:]), 2 * span


def word_spans(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words of a slice, and for each document the number of
    the first of its words (one more entry than documents)."""
    data = texts.data
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts.ids) + 1, np.int64)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = texts.starts[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, texts.starts)


def equal_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of one of each word among the spans data[start : end], which are in order and
    apart, and for each span its word's number among these. Words are told apart by their bytes."""
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = np.zeros(len(data) + 1, np.int8)
    edges[starts] += 1
    edges[ends] -= 1
    held = np.ascontiguousarray(data[np.cumsum(edges[:-1], dtype=np.int8) > 0])
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(held)]).dictionary_encode()
    number = np.asarray(coded.indices).astype(np.int64)
    first = np.empty(len(coded.dictionary), np.int64)
    first[number[::-1]] = np.arange(n - 1, -1, -1)
    return first, number


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w successive values, in log2(w) passes."""
    n = len(values) - w + 1
    out, span = values, 1
    while span * 2 <= w:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    return np.minimum(out[:n], out[w - span : w - span + n])


def two_smallest(values: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest of each w successive values, and the smallest other one among them (the
    largest possible value where all are equal)."""
    most = np.uint64(2**64 - 1)

    def both(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
        other = np.where(a[0] == b[0], most, np.maximum(a[0], b[0]))
        return np.minimum(a[0], b[0]), np.minimum(np.minimum(a[1], b[1]), other)

    n, span, out = len(values) - w + 1, 1, (values, np.full(len(values), most))
    while span * 2 <= w:
        out = both([x[: len(x) - span] for x in out], [x[span:] for x in out])
        span *= 2
    return both([x[:n] for x in out], [x[w - span : w - span + n] for x in out])


def byte_grams(data: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all ranges of k successive bytes, k at least 8; empty if there are fewer.
    Eight bytes a step, the last eight of the range at the end."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    here = eights(data)
    out = here[:n] * SEEDS[0]
    for at in [*range(8, k - 7, 8), *([k - 8] if k % 8 else [])]:
        out ^= out >> np.uint64(29)
        out += here[at : at + n]
        out *= _LEFT
    return mix64(out)


def pieces_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """data[start : start + size] of all pieces, end to end."""
    begins = np.cumsum(sizes) - sizes
    return data[np.repeat(starts - begins, sizes) + np.arange(int(sizes.sum()))]


def stretches_of(raw: bytes, starts: np.ndarray, sizes: np.ndarray) -> bytes:
    """raw[start : start + size] of all stretches, end to end; for long ones."""
    return b"".join([raw[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)])


def by_shard(sorted_shards: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, entries) for each shard that has any."""
    if len(order):
        edges = np.r_[0, np.flatnonzero(np.diff(sorted_shards)) + 1, len(order)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield int(sorted_shards[a]), order[a:b]
