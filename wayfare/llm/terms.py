"""Words of letters, digits and characters beyond ASCII, and tables of items to look them up in.

Items (benchmark questions, queries) are few beside the documents. A part of them, bounded
in bytes, is broadcast to the tasks that read the documents; a table above the bound goes in
several parts, each with a pass over the documents of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts, equal_words, pieces_of, slices, word_spans

#: Bytes of items' texts in a part, about.
PART_BYTES = 8 << 20
SLICE_BYTES = 4 << 20


def _kept() -> np.ndarray:
    """For each byte what it is in a word, letters in lower case; a space for all others."""
    out = np.full(256, 32, np.uint8)
    for a, b in ((48, 58), (97, 123), (128, 256)):
        out[a:b] = np.arange(a, b)
    out[65:91] = np.arange(97, 123)
    return out


_KEPT = _kept()


def lowered(texts: Texts) -> Texts:
    """texts with A-Z in lower case and a space for each byte that no word has."""
    return Texts(texts.ids, _KEPT[texts.data], texts.starts)


def texts_of(values: list[str | None]) -> Texts:
    """Texts of a slice made of these; null counts as empty. Their ids are their places."""
    raw = [(v or "").encode() for v in values]
    return Texts(np.arange(len(raw)), np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw], dtype=np.int64)])


def parts(items: DataFrame, part_bytes: int = PART_BYTES) -> Iterator[list[tuple]]:
    """The rows (item, text) of items, which has these columns, in parts of about part_bytes.
    All rows of an item are in one part."""
    rows = items.toDF("item", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = 1 + 2 * size // part_bytes if size > part_bytes else 1
    for part in range(many):
        yield [tuple(r) for r in rows.filter(F.pmod(F.xxhash64("item"), F.lit(many)) == part).collect()]


class Vocabulary:
    """The distinct words of some texts, numbered from 1, told apart by their bytes."""

    def __init__(self, texts: Texts):
        starts, ends, self.first = word_spans(texts)
        one, number = equal_words(texts.data, starts, ends)
        self.words, self.numbers = _binary(texts.data, starts[one], ends[one]), number + 1

    def __len__(self) -> int:
        return len(self.words)

    def of(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The number of each word of texts, 0 for those that aren't among the words, and for
        each document the place of its first word (one more entry than documents)."""
        starts, ends, first = word_spans(texts)
        one, number = equal_words(texts.data, starts, ends)
        known = pc.index_in(_binary(texts.data, starts[one], ends[one]), value_set=self.words)
        return (known.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1)[number], first

    def __getstate__(self) -> tuple[pa.Array]:
        return (self.words,)

    def __setstate__(self, state: tuple[pa.Array]) -> None:
        (self.words,) = state


def _binary(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(pieces_of(data, starts, ends - starts))])


def totals(df: DataFrame, count: Callable[[Texts], np.ndarray], size: int) -> np.ndarray:
    """The sum, over all slices of df (id, text), of what count gives for each: size numbers.
    Every task adds up its own, so that it sends size numbers at most."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for _, texts in slices(batches, SLICE_BYTES):
            total += count(texts)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["at", "n"])

    out = np.zeros(size, np.int64)
    for at, n in df.mapInArrow(add, "at long, n long").groupBy("at").agg(F.sum("n")).collect():
        out[at] = n
    return out


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of all ranges, end to end."""
    begins = np.cumsum(sizes) - sizes
    return np.repeat(starts - begins, sizes) + np.arange(int(sizes.sum()))
