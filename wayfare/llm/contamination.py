"""Benchmark decontamination by a prefix-filtered set join.

An item's windows of words are sets of shingles. Shingles are put in the order of how rare
they are in all documents. A range of a document that holds at least num / den of a window's
m shingles holds one of its m - ceil(m * num / den) + 1 rarest, so only these are looked up
in the documents (at full containment the rarest alone). Where one is met, its place in the
window says where the range would begin; ranges that aren't within the document go, and the
others are verified over as many words as the window has.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Texts, documents
from .packs import Pack, meet, packs, partitions, rereadable
from .terms import PART_BYTES, Vocabulary, lowered, parts, ranges, texts_of, totals

WINDOW = 10
SHINGLE = 3
PACK_BYTES = 2 << 20
#: Bits of a word's number in a shingle's key: PART_BYTES of items have fewer words than 2 ** 21
#: as long as an item is no longer than twice that.
_BITS = 21
#: Candidates that are verified at a time.
_CHUNK = 50_000


def _keys(numbers: np.ndarray, width: int) -> np.ndarray:
    """The key of the width words from each word on, 0 where one of them has no number or the
    words end. Keys of other widths are other ones."""
    n = len(numbers) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out, known = numbers[:n].copy(), numbers[:n] > 0
    for k in range(1, SHINGLE):
        if k < width:
            known &= numbers[k : n + k] > 0
        out = (out << _BITS) | (numbers[k : n + k] if k < width else 0)
    return np.where(known, out, 0)


class Windows:
    """The distinct windows of a part of the items, with the items that have each."""

    def __init__(self, rows: list[tuple], window: int, num: int, den: int):
        self.names = sorted({"" if item is None else str(item) for item, _ in rows})
        number = {name: k for k, name in enumerate(self.names)}
        self.vocabulary = Vocabulary(lowered(texts_of([text for _, text in rows])))
        if len(self.vocabulary) >= 1 << _BITS:
            raise ValueError("an item has too many words for its part")
        words, first = self.vocabulary.numbers, self.vocabulary.first
        sizes = np.diff(first)
        many = np.where(sizes > window, sizes - window + 1, np.minimum(sizes, 1))
        at, owner = ranges(first[:-1], many), np.repeat(np.arange(len(rows)), many)
        size = np.minimum(sizes[owner], window)
        place = at[:, None] + np.arange(window)
        inside = np.arange(window) < size[:, None]
        held = np.where(inside, np.r_[words, 0][np.minimum(place, len(words))], 0)
        self.words, back = np.unique(held, axis=0, return_inverse=True) if len(held) else (held, np.zeros(0, np.int64))
        self.sizes = (self.words > 0).sum(axis=1)
        of = np.array([number["" if item is None else str(item)] for item, _ in rows], np.int64)
        pairs = np.unique(np.stack([back.ravel(), of[owner]], axis=1), axis=0) if len(held) else np.zeros((0, 2), np.int64)
        self.items, self.item_at = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.words) + 1))
        self.window, self.num, self.den = window, num, den
        # Of each window the keys of its shingles, by place; windows of fewer words are one.
        self.width = np.minimum(self.sizes, SHINGLE)
        self.widths = np.unique(self.width).tolist()
        self.keys = self._shingles(self.words, np.arange(len(self.words)))
        self.shingles = np.unique(self.keys[self.keys > 0])

    def _shingles(self, words: np.ndarray, window: np.ndarray) -> np.ndarray:
        """The keys of the shingles, by place, of each row of words, as wide as its window's."""
        out = np.zeros((len(words), max(1, self.window - SHINGLE + 1)), np.int64)
        for width in self.widths:
            of = np.flatnonzero(self.width[window] == width)
            for k in range(out.shape[1] if width == SHINGLE else 1):
                part = words[of, k : k + width]
                key = np.zeros(len(of), np.int64)
                for j in range(SHINGLE):
                    key = (key << _BITS) | (part[:, j] if j < width else 0)
                out[of, k] = np.where((part > 0).all(axis=1) & (k + width <= self.sizes[window[of]]), key, 0)
        return out

    def counts(self, texts: Texts) -> np.ndarray:
        """How often each shingle is met in a slice (at seams of documents too: the order of
        shingles decides what is looked up, not what is found)."""
        numbers, _ = self.vocabulary.of(lowered(texts))
        out = np.zeros(len(self.shingles), np.int64)
        for width in self.widths:
            keys = _keys(numbers, width)
            keys = keys[keys > 0]
            at = np.minimum(np.searchsorted(self.shingles, keys), len(self.shingles) - 1)
            out += np.bincount(at[self.shingles[at] == keys], minlength=len(out))
        return out

    def order_by(self, counts: np.ndarray) -> None:
        """Choose what is looked up of each window, given how often shingles are met. Of equally
        rare ones those of the smaller key come first."""
        rank = np.empty(len(counts) + 1, np.int64)
        rank[np.lexsort((self.shingles, counts))] = np.arange(len(counts))
        rank[-1] = none = len(counts)
        new = _distinct(self.keys)
        ranks = np.where(new, rank[np.minimum(np.searchsorted(self.shingles, self.keys), len(counts))], none)
        order, many = np.argsort(ranks, axis=1, kind="stable"), new.sum(axis=1)
        needed = many + (-many * self.num) // self.den + 1
        window, nth = np.nonzero(np.arange(ranks.shape[1]) < np.minimum(needed, many)[:, None])
        place = order[window, nth]
        found = np.stack([self.keys[window, place], window, place], axis=1)
        found = found[np.lexsort((found[:, 1], found[:, 0]))]
        self.prefixes, begin = np.unique(found[:, 0], return_index=True)
        self.entry_at, self.entries = np.r_[begin, len(found)], found[:, 1:]

    def spans(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, place, window): for each document the place of its first word, and the places
        of words at which the windows begin that are contained."""
        numbers, first = self.vocabulary.of(lowered(texts))
        begins, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(self.prefixes) and len(numbers):
            padded = np.r_[numbers, np.zeros(self.window, np.int64)]
            doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
            for width in self.widths:
                keys = _keys(numbers, width)
                at = np.minimum(np.searchsorted(self.prefixes, keys), len(self.prefixes) - 1)
                met = np.flatnonzero((self.prefixes[at] == keys) & (keys > 0))
                for k in range(0, len(met), _CHUNK):
                    some = met[k : k + _CHUNK]
                    many = self.entry_at[at[some] + 1] - self.entry_at[at[some]]
                    entry = self.entries[ranges(self.entry_at[at[some]], many)]
                    begin, window = self._bounded(np.repeat(some, many), entry, first, doc)
                    for j in range(0, len(begin), _CHUNK):
                        b, w = begin[j : j + _CHUNK], window[j : j + _CHUNK]
                        good = self._contained(padded, b, w)
                        begins.append(b[good])
                        windows.append(w[good])
        return first, np.concatenate(begins), np.concatenate(windows)

    def _bounded(self, met: np.ndarray, entry: np.ndarray, first: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where ranges may begin whose window has a shingle at met, within the document."""
        window, offset = entry[:, 0], entry[:, 1]
        if self.num == self.den:
            begin = met - offset
        else:  # sets have no order: the shingle may be anywhere in the range
            many = self.sizes[window] - self.width[window] + 1
            begin, window, met = ranges(met - many + 1, many), np.repeat(window, many), np.repeat(met, many)
            both = np.unique(np.stack([begin, window, met], axis=1)[begin >= 0], axis=0)
            begin, window, met = both.T
        own = doc[met]
        good = (begin >= first[own]) & (begin + self.sizes[window] <= first[own + 1])
        return begin[good], window[good]

    def _contained(self, padded: np.ndarray, begin: np.ndarray, window: np.ndarray) -> np.ndarray:
        place = np.arange(self.window)
        there = padded[begin[:, None] + place]
        inside = place < self.sizes[window][:, None]
        if self.num == self.den:
            return ((there == self.words[window]) | ~inside).all(axis=1)
        own, wanted = self._shingles(np.where(inside, there, 0), window), self.keys[window]
        new = _distinct(wanted)
        shared = ((wanted[:, :, None] == own[:, None, :]).any(axis=2) & new).sum(axis=1)
        return shared * self.den >= new.sum(axis=1) * self.num


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Which keys of each row, other than 0, are the first of their kind."""
    out = keys > 0
    for k in range(1, keys.shape[1]):
        out[:, k] &= ~(keys[:, :k] == keys[:, k : k + 1]).any(axis=1)
    return out


#: What is found about a document: its words, those that a window covers, the items.
FOUND = "n_words bigint, n_hit bigint, items array<string>"


def _found(windows: list[tuple[Windows, tuple]], n: int) -> Iterator[tuple[int, int, list[str]]]:
    """Of each of n documents what FOUND names, from the spans that parts of the items have."""
    first = windows[0][1][0]
    total = int(first[-1])
    edges, names = np.zeros(total + 1, np.int64), [[] for _ in range(n)]
    for part, (_, begin, window) in windows:
        edges += np.bincount(begin, minlength=total + 1) - np.bincount(begin + part.sizes[window], minlength=total + 1)
        doc = np.searchsorted(first, begin, side="right") - 1
        pairs = np.unique(np.stack([doc, window], axis=1), axis=0)
        many = part.item_at[pairs[:, 1] + 1] - part.item_at[pairs[:, 1]]
        own = np.unique(np.stack([np.repeat(pairs[:, 0], many), part.items[ranges(part.item_at[pairs[:, 1]], many)]], axis=1), axis=0)
        for d, item in own.tolist():
            names[d].append(part.names[item])
    hit = np.r_[0, np.cumsum(np.cumsum(edges[:total]) > 0)]
    for k in range(n):
        yield int(first[k + 1] - first[k]), int(hit[first[k + 1]] - hit[first[k]]), sorted(names[k])


_COLUMNS = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string()))]


def contaminated(df: DataFrame, items: DataFrame, window: int = WINDOW, num: int = 1, den: int = 1, part_bytes: int = PART_BYTES) -> DataFrame:
    """df (an id, a text, other columns) with n_words, n_hit (words in a contained window) and
    items, the sorted ids, as strings, of the items (an id, a text) that have such windows.
    Columns of these names are replaced, others come through whatever they are called.

    A window is contained in a range of as many words that has num / den of its distinct
    shingles; at 1 the range's words must be the window's. Items of fewer words than a window
    are one, items and documents without words have none; null texts have no words, a null
    item is named ''. Rows that share an item's id are one item; repeated documents each
    count. Items above part_bytes go in parts, and texts then travel once, to meet
    what the parts have found."""
    spark = df.sparkSession
    id_col, text = df.columns[:2]
    rest = [c for c in df.columns[2:] if c not in ("n_words", "n_hit", "items")]
    docs = df.select(*[F.col(f"`{c}`") for c in (id_col, text)], *[F.col(f"`{c}`").alias(f"other {k}") for k, c in enumerate(rest)])
    texts = docs.select(*docs.columns[:2])
    shared = []
    for rows in parts(items.select(*items.columns[:2]), part_bytes):
        made = Windows(rows, window, num, den)
        if shared and not len(made.words):
            continue
        held = spark.sparkContext.broadcast(made)
        made.order_by(totals(texts, lambda t, held=held: held.value.counts(t), len(made.shingles)) if len(made.shingles) else np.zeros(0, np.int64))
        held.unpersist()
        shared.append(spark.sparkContext.broadcast(made))

    def with_found(pack: Pack, found: list[tuple[Windows, tuple]]) -> pa.RecordBatch:
        columns = list(zip(*_found(found, pack.batch.num_rows), strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([*pack.batch.columns, *[pa.array(v, t) for v, (_, t) in zip(columns, _COLUMNS, strict=True)]], [*pack.batch.schema.names, *[n for n, _ in _COLUMNS]])

    schema = StructType([*docs.schema, *spark.createDataFrame([], FOUND).schema])
    if len(shared) == 1:
        one = shared[0]

        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for pack in packs(batches, PACK_BYTES):
                yield with_found(pack, [(one.value, one.value.spans(pack.texts))])

        out = docs.mapInArrow(match, schema)
    else:
        docs = rereadable(docs)

        def finds(k: int):
            def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for pack in packs(batches, PACK_BYTES):
                    _, begin, found = shared[k].value.spans(pack.texts)
                    yield pa.RecordBatch.from_arrays([pa.array([pack.name], pa.binary()), pa.array([np.r_[k, begin, found].astype(np.int64).tobytes()], pa.binary())], ["pack", "data"])

            return find

        # Each part's finds are dealt by their packs before they come together: in a union a
        # task's number, which names its packs, would be another one.
        alone = docs.select(*docs.columns[:2])
        many = partitions(alone, 1, 1)
        each = [alone.mapInArrow(finds(k), "pack binary, data binary").repartition(many, "pack") for k in range(len(shared))]
        found = reduce(DataFrame.union, each)

        def join(pack: Pack, data: list[bytes]) -> Iterator[pa.RecordBatch]:
            first, got = Vocabulary(lowered(pack.texts)).first, []
            for raw in data:
                k, *both = np.frombuffer(raw, np.int64)
                begin, at = np.array(both, np.int64).reshape(2, -1)
                got.append((shared[k].value, (first, begin, at)))
            yield with_found(pack, got)

        out = meet(docs, found, join, schema, PACK_BYTES, all_found=True)
    back = [F.col(f"`other {k}`").alias(c) for k, c in enumerate(rest)]
    return out.select(F.col(f"`{id_col}`"), F.col(f"`{text}`"), *back, "n_words", "n_hit", "items")


def op11_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all documents how many of their words lie in windows of ten words of benchmark items,
    and a digest of these items. Null texts have no words; an empty table gives no rows, an
    empty benchmark no hits."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = contaminated(documents(spark, sf_dir).select("doc_id", "text"), items)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
