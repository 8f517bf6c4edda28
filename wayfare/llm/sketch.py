"""Count-min prefilter over keys of documents.

Each pack of documents sketches its keys: of each key two cells of a wide sketch and how
often they were hit. A sketch is dealt by hash range, so that a range's task merges the
parts of all packs, folded to as many cells as its keys need, and gives back to each part
which of its keys are estimated to occur more than once, and which very often. Estimates are
never too low. Sketches grow with the keys and no task holds more than its range.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Texts, mix64, tidy
from .packs import packs, partitions

#: Cells of a range for each of its keys, at least; and the rows of a sketch.
CELLS_PER_KEY = 4
ROWS = 2
#: A key is heavy from so many occurrences on.
HEAVY = 1000
RANGES_PER_PARTITION = 4
_SALT = np.uint64(0x51ED270B7A2F3C15)


def ranges_of(df: DataFrame) -> int:
    return partitions(df, RANGES_PER_PARTITION, 32)


def _by_range(keys: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The range of each key, and the keys' places in the order of ranges."""
    of = ((mix64(keys ^ _SALT) >> np.uint64(32)) % np.uint64(ranges)).astype(np.int64)
    return of, np.argsort(of, kind="stable")


def _cells(keys: np.ndarray) -> np.ndarray:
    """For each row of the sketch the keys' cells among 2 ** 32."""
    return mix64(keys + _SALT).view(np.uint32).reshape(-1, ROWS).T


def _bytes(counts: np.ndarray) -> bytes:
    """Counts as four planes of bytes, of which the upper ones, nearly all 0, compress well."""
    return np.ascontiguousarray(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _counts(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def merged(parts: list[np.ndarray], hits: list[np.ndarray]) -> list[np.ndarray]:
    """Of each part's cells (a row for each row of the sketch) the estimated counts of its
    keys, by one sketch of all parts' hits."""
    total = sum(p.shape[1] for p in parts)
    mask = np.uint32((1 << max(8, (CELLS_PER_KEY * total - 1).bit_length())) - 1)
    out = None
    for row in range(ROWS):
        at = np.concatenate([p[row] for p in parts]) & mask
        counts = np.bincount(at, np.concatenate(hits), int(mask) + 1)[at]
        out = counts if out is None else np.minimum(out, counts)
    return np.split(out, np.cumsum([p.shape[1] for p in parts])[:-1])


def estimates(df: DataFrame, keys_of: Callable[[Texts], np.ndarray], max_bytes: int) -> DataFrame:
    """(pack, data): for each pack of df (id, text) and each range what is estimated of its
    keys; Estimates reads the data of a pack. Every pack has a row at least."""
    ranges = ranges_of(df)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, texts in packs(batches, max_bytes):
            keys, n = np.unique(keys_of(texts), return_counts=True)
            of, order = _by_range(keys, ranges)
            cells, n = _cells(keys[order]), n[order]
            edges = np.searchsorted(of[order], np.arange(ranges + 1))
            some = np.flatnonzero(np.diff(edges)) if len(keys) else np.array([struct.unpack_from(">q", name, 8)[0] % ranges])
            rows = [(int(r), name, np.ascontiguousarray(cells[:, edges[r] : edges[r + 1]]).tobytes(), _bytes(n[edges[r] : edges[r + 1]])) for r in some]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["range", "pack", "cells", "hits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, of, parts, hits = [], [], [], []
        for batch in batches:
            for r, name, cells, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                names.append(name)
                of.append(r)
                parts.append(np.frombuffer(cells, np.uint32).reshape(ROWS, -1))
                hits.append(_counts(n))
        if not names:
            return
        found = merged(parts, hits)
        for k in range(0, len(names), 1000):
            data = [struct.pack("<i", r) + np.packbits(n > 1).tobytes() + np.packbits(n >= HEAVY).tobytes() for r, n in zip(of[k : k + 1000], found[k : k + 1000], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(names[k : k + 1000], pa.binary()), pa.array(data, pa.binary())], ["pack", "data"])

    return df.mapInArrow(tidy(sketch), "range int, pack binary, cells binary, hits binary").repartition(ranges, "range").mapInArrow(tidy(merge), "pack binary, data binary")


class Estimates:
    """What is estimated of a pack's keys, given the ranges that estimates() deals to."""

    def __init__(self, keys: np.ndarray, data: list[bytes], ranges: int):
        self.keys = np.unique(keys)
        self.repeated, self.heavy = np.zeros(len(self.keys), bool), np.zeros(len(self.keys), bool)
        of, order = _by_range(self.keys, ranges)
        edges = np.searchsorted(of[order], np.arange(ranges + 1))
        for part in data:
            (r,) = struct.unpack_from("<i", part)
            at = order[edges[r] : edges[r + 1]]
            bits = np.frombuffer(part, np.uint8)[4:].reshape(2, -1)
            for out, row in zip((self.repeated, self.heavy), bits, strict=True):
                out[at] = np.unpackbits(row, count=len(at)).astype(bool)

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether keys, each one of the pack's, occur more than once, and whether very often."""
        at = np.searchsorted(self.keys, keys)
        return self.repeated[at], self.heavy[at]
