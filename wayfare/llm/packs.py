"""Packs: documents that travel together, compressed, to meet what is found about them.

A task cuts its documents into packs and names each by its place (partition, number) and a
checksum. What other tasks find about a pack carries its name and meets it by one shuffle,
in which texts are compressed record batches. A document is a row of its pack, whatever its
id, so rows that share an id are never taken for one another.

The packs of a table are made anew wherever it is read. That gives the same packs if the
table gives its rows in the same order, as files do; where it does not, names differ and the
meeting raises instead of giving a wrong result. rereadable() writes what may be otherwise.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts, cut, slices, tidy

#: Partitions of a meeting, for each partition of the table.
MEETINGS_PER_PARTITION = 2
#: A table counts as having a partition for each so many bytes of its files at least.
PARTITION_BYTES = 16 << 20


def rereadable(df: DataFrame) -> DataFrame:
    """df, or, where its plan has a shuffle, whose rows may come in another order each time, df
    written as a table."""
    return cut(df) if "Exchange" in df._jdf.queryExecution().executedPlan().toString() else df


class Pack(NamedTuple):
    name: bytes
    batch: pa.RecordBatch
    texts: Texts


def packs(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[Pack]:
    """The packs of a task's record batches (first column an id, second a text)."""
    partition = TaskContext.get().partitionId()
    for number, (batch, texts) in enumerate(slices(batches, max_bytes)):
        check = xxhash.xxh3_64_intdigest(texts.data) ^ xxhash.xxh3_64_intdigest(np.ascontiguousarray(texts.ids), 1)
        yield Pack(struct.pack(">qqQ", partition, number, check), batch, texts)
    pa.default_memory_pool().release_unused()


def partitions(df: DataFrame, factor: int, least: int) -> int:
    """So many for each partition that df is read in, or for each PARTITION_BYTES of the files it is
    made of if those are more, and at least so many: what a task holds doesn't grow with the
    partitions that the session reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size())]
    files = sum(size for size in sizes if size < 1 << 60)  # above that: not known
    return max(least, factor * max(df.rdd.getNumPartitions(), -(-files // PARTITION_BYTES)))


def stored(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def zipped(data: bytes) -> bytes:
    return struct.pack("<q", len(data)) + pa.Codec("zstd").compress(data, asbytes=True)


def unzipped(data: bytes) -> np.ndarray:
    (size,) = struct.unpack_from("<q", data)
    return np.frombuffer(pa.Codec("zstd").decompress(data[8:], size, asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)


Task = Callable[[Pack, list[bytes]], Iterator[pa.RecordBatch]]


def meet(df: DataFrame, found: DataFrame, task: Task, schema, max_bytes: int, all_found: bool = False) -> DataFrame:
    """What task makes of each pack of df (an id, a text, other columns) and of the data of
    found's rows (pack, data) for it. A row of found without its pack raises; with all_found,
    a pack without a row of found too. One pack is held at a time."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in packs(batches, max_bytes):
            yield pa.RecordBatch.from_arrays([pa.array([pack.name], pa.binary()), pa.array([0], pa.int32()), pa.array([stored(pack.batch)], pa.binary())], ["pack", "kind", "data"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, body, parts = None, None, []

        def done() -> Iterator[pa.RecordBatch]:
            if name is None:
                return
            if body is None or (all_found and not parts):
                raise RuntimeError("the table gave other rows, or rows in another order, when it was read again")
            batch = pa.ipc.open_stream(body).read_next_batch()
            texts = next(slices(iter([batch]), 1 << 62))[1]
            yield from task(Pack(name, batch, texts), parts)

        for rows in batches:
            for key, kind, data in zip(*rows.columns, strict=True):
                key = key.as_py()
                if key != name:
                    yield from done()
                    name, body, parts = key, None, []
                if kind.as_py() == 0:
                    body = data.as_buffer()
                else:
                    parts.append(data.as_py())
        yield from done()

    bodies = df.mapInArrow(tidy(store), "pack binary, kind int, data binary")
    both = bodies.union(found.select("pack", F.lit(1).alias("kind"), "data"))
    ordered = both.repartition(partitions(df, MEETINGS_PER_PARTITION, 1), "pack").sortWithinPartitions("pack", "kind")
    return ordered.mapInArrow(tidy(gather), schema)
