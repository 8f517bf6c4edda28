"""Periodic runs of words by bit-parallel lags.

The words of a slice of documents are numbered, and each bit of the numbers is one big
integer, a bit a word. For a lag q these planes, XORed with themselves shifted by q and ORed,
have a 0 wherever a word equals the one q further on; a run of period q is a stretch of
zeros. Stretches that are long enough are isolated by AND of the complement with itself
shifted by 1, 2, 4, ... places. A word that nothing equals stands between documents, so that
no stretch crosses from one to another and a lag is tried for all documents of a slice at once.

Small lags are all tried. Of larger ones, from s = 64, 128, ... to twice that, only those
can have a run at which a gram of 2 * s words at some multiple of s equals the gram q
further on: a run has at least 4 * q words, so such a multiple is among its first q, and
the grams are within it. Grams inside a run of a smaller period repeat at its multiples,
which are not the smallest period of anything as long, and don't count.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Texts, documents, equal_words, joined, mix64, slices, word_spans

#: A run has so many words at least, and so many periods.
WORDS, TIMES = 6, 4
#: All lags up to this one are tried (a power of two).
ALL_LAGS = 64
SLICE_BYTES = 1 << 20

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def _bits(flags: np.ndarray) -> int:
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _places(bits: int, n: int) -> np.ndarray:
    """The places of the bits that are set, of n."""
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits.to_bytes(-(-n // 8), "little"), np.uint8), count=n, bitorder="little"))


def stretches(planes: list[int], n: int, lag: int, words: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the longest ranges of n words in which words lag apart are equal, of
    at least words words and times lags."""
    need = max(words, times * lag) - lag
    if n - lag < need:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    other = 0
    for plane in planes:
        other |= plane ^ (plane >> lag)
    zeros = ~other & ((1 << (n - lag)) - 1)
    span = 1
    while span < need and zeros:
        by = min(span, need - span)
        zeros &= zeros >> by
        span += by
    if not zeros:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = _places(zeros, n - lag)
    new = np.r_[True, at[1:] > at[:-1] + 1]
    return at[new], at[np.r_[np.flatnonzero(new)[1:] - 1, len(at) - 1]] + need + lag


def _large_lags(grams: np.ndarray, s: int, reach: np.ndarray) -> np.ndarray:
    """Lags from s to 2 * s - 1 at which a gram at a multiple of s equals the one that far
    from it, but for those within runs found: reach has for each place how far these go that
    begin there or before."""
    rows = len(grams) // s
    found = np.zeros(0, np.int64)
    for k in range(0, rows - 1, max(1, (1 << 20) // s)):
        blocks = grams[k * s : min(rows, k + 1 + max(1, (1 << 20) // s)) * s].reshape(-1, s)
        row, over = np.nonzero(blocks[1:] == blocks[:-1, :1])
        at, lag = (row + k) * s, s + over
        found = np.union1d(found, lag[reach[at] < at + 2 * lag])
    return found


def runs(numbers: np.ndarray, longest: int, words: int = WORDS, times: int = TIMES) -> Runs:
    """(start, length, period) of all runs in numbers, of which no document has more than
    longest and which others than the documents' own words keep apart, by period and start."""
    n = len(numbers)
    planes = [_bits((numbers >> b) & 1) for b in range(int(numbers.max()).bit_length())] if n else []
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    out = []

    def smallest(lag: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which ranges aren't within one of a lag that divides theirs."""
        good = np.ones(len(start), bool)
        for d, (first, last) in found.items():
            if lag % d == 0:
                at = np.searchsorted(first, start, side="right") - 1
                good &= ~((at >= 0) & (last[at] >= end))
        return good

    def look(lag: int) -> None:
        start, end = stretches(planes, n, lag, words, times)
        good = smallest(lag, start, end) if len(start) else np.zeros(0, bool)
        if good.any():
            found[lag] = start[good], end[good]
            out.append((start[good], end[good] - start[good], np.full(int(good.sum()), lag)))

    most = longest // times
    for lag in range(1, min(most, ALL_LAGS - 1) + 1):
        look(lag)
    s, span, grams = ALL_LAGS, 1, mix64(numbers.astype(np.uint64))
    while s <= most:
        while span < 2 * s:
            grams, span = joined(grams[:-span], grams[span:]), 2 * span
        reach = np.zeros(n, np.int64)
        for first, last in found.values():
            np.maximum.at(reach, first, last)
        for lag in _large_lags(grams, s, np.maximum.accumulate(reach)):
            if lag <= most:
                look(int(lag))
        s *= 2
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *c]) for c in zip(*out, strict=True)) if out else (none, none, none)


class Words:
    """The words of a slice, each a number, with one of no other word after each document. at
    has the place of each document's first word, origin which word of the slice stands at a
    place (-1 between documents)."""

    def __init__(self, texts: Texts, ids: list[int | None] | None = None):
        """With ids, documents are made periodic as looped() says."""
        self.texts = texts
        self.starts, self.ends, first = word_spans(texts)
        self.sizes = np.diff(first)
        docs = len(self.sizes)
        self.at = np.r_[0, np.cumsum(self.sizes + 1)]
        self.origin = np.full(int(self.at[-1]), -1)
        own = np.ones(len(self.origin), bool)
        own[self.at[1:] - 1] = False
        self.origin[own] = np.arange(len(self.starts))
        self.changed = np.zeros(docs, bool)
        for k, i in enumerate(ids or []):
            n = int(self.sizes[k])
            if i is not None and n and (map_ := looped(i, n)) is not None:
                self.origin[self.at[k] : self.at[k] + n] = first[k] + map_
                self.changed[k] = True
        one, number = equal_words(texts.data, self.starts, self.ends)
        self.numbers = np.empty(len(self.origin), np.int64)
        self.numbers[own] = number[self.origin[own]]
        self.numbers[~own] = len(one) + np.arange(docs)

    def runs(self, words: int = WORDS, times: int = TIMES) -> tuple[np.ndarray, ...]:
        """(document, start in it, length, period), by document, start and period."""
        start, length, period = runs(self.numbers, int(self.sizes.max(initial=0)), words, times)
        doc = np.searchsorted(self.at, start, side="right") - 1
        order = np.lexsort((period, start))
        return doc[order], (start - self.at[doc])[order], length[order], period[order]

    def text(self, k: int, dropped: np.ndarray | None = None) -> bytes:
        """The words of document k, but those dropped, joined by one space."""
        if dropped is None and not self.changed[k]:
            return b" ".join(self.texts.of(k).split())  # bytes.split knows the same white space
        words = self.origin[self.at[k] : self.at[k] + self.sizes[k]]
        words = words if dropped is None else words[~dropped]
        data = self.texts.data
        if not self.changed[k] and len(words):  # cut where words are missing
            data, base = self.texts.of(k), int(self.texts.starts[k])
            return b" ".join([data[a - base : b - base] for a, b in zip(self.starts[words].tolist(), self.ends[words].tolist(), strict=True)])
        return b" ".join([data[a:b].tobytes() for a, b in zip(self.starts[words].tolist(), self.ends[words].tolist(), strict=True)])


def looped(doc_id: int, n: int) -> np.ndarray | None:
    """Which of its n words each word of a document becomes, if its id makes it periodic."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    a, g = h // 10 % n, h // 10
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def _dropped(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    edges = np.bincount(start + period, minlength=n + 1) - np.bincount(start + length, minlength=n + 1)
    return np.cumsum(edges[:n]) > 0


FOUND = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
_NAMES = [f.split()[0] for f in FOUND.split(", ")]
_TYPES = [pa.int64()] * 5 + [pa.string()] * 2


def _described(words: Words, found: tuple[np.ndarray, ...]) -> Iterator[tuple]:
    """What FOUND names of each document."""
    doc, *columns = found
    edges = np.searchsorted(doc, np.arange(len(words.sizes) + 1))
    empty = hashlib.sha256(b"").hexdigest()
    for k, n in enumerate(words.sizes.tolist()):
        a, b = edges[k], edges[k + 1]
        if a == b:
            yield 0, None, None, None, None, empty, hashlib.sha256(words.text(k)).hexdigest()
            continue
        start, length, period = (c[a:b] for c in columns)
        own = list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
        best = min(own, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        lines = "".join(f"{s},{m},{p}\n" for s, m, p in own)
        text = words.text(k, _dropped(n, start, length, period))
        yield len(own), *best, 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text).hexdigest()


def period_runs(df: DataFrame, words: int = WORDS, times: int = TIMES) -> DataFrame:
    """(id, start, length, period): every run of each row of df (an id, a text): a stretch of
    consecutive words that has that smallest period, is at least so many words and periods
    long, and can't be made longer. Null texts and texts without words have none; rows that
    share an id are documents of their own. Narrow: no shuffle."""
    id_col, text = df.columns[:2]
    kind = df.schema[0].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, SLICE_BYTES):
            doc, *columns = Words(texts).runs(words, times)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), *[pa.array(c, pa.int64()) for c in columns]], [id_col, "start", "length", "period"])

    return df.select(F.col(f"`{id_col}`"), F.col(f"`{text}`")).mapInArrow(find, f"`{id_col}` {kind}, start bigint, length bigint, period bigint")


def collapsed(df: DataFrame, words: int = WORDS, times: int = TIMES) -> DataFrame:
    """df (an id, a text, other columns) with each run cut down to its first period; texts that
    lose no word stay as they are, others are words joined by one space. Null texts stay null."""
    columns = df.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(df.columns)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, SLICE_BYTES):
            held = Words(texts)
            doc, start, length, period = held.runs(words, times)
            new = batch.column(1).to_pylist()
            edges = np.searchsorted(doc, np.arange(len(new) + 1))
            for k in np.flatnonzero(np.diff(edges)).tolist():
                a, b = edges[k], edges[k + 1]
                new[k] = held.text(k, _dropped(int(held.sizes[k]), start[a:b], length[a:b], period[a:b])).decode()
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if k == 1 else c for k, c in enumerate(batch.columns)], batch.schema.names)

    out = columns.mapInArrow(cut, columns.schema)
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(df.columns)])


def op13_bit_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of all documents, of which about one in ten is made periodic by its id
    first (looped). Null or empty texts have no words and no runs; a null doc_id makes nothing
    periodic. Of runs of equal exponent the first, then that of the smaller period, is shown."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, SLICE_BYTES):
            words = Words(texts, batch.column(0).to_pylist())
            columns = zip(*_described(words, words.runs()), strict=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)]], ["doc_id", *_NAMES])

    return documents(spark, sf_dir).select("doc_id", "text").mapInArrow(describe, f"doc_id bigint, {FOUND}")
