"""Suffix-array dedup of byte strings.

The suffix array is built by two-stage sorting: suffixes smaller than their successors
are sorted directly; a scan of the buckets of first bytes, in order, induces the others,
each from its successor. Adjacent common prefixes then show which strings repeat.

In Spark each task builds the suffix array of one share of the corpus. A window of bytes
has an anchor (the smallest hash of the grams in it), which a sketch of all anchors says
to be repeated or not. Windows with a repeated anchor go, as the stretch of text that
holds a run of them, to the share of that anchor: equal windows meet in one array. Very
frequent anchors are split by the next smallest gram as well, after windows that repeat in
one pack were reduced to the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import Texts, by_shard, byte_grams, documents, joined, sliding_min, stretches_of, two_smallest
from .packs import Pack, meet, partitions
from .sketch import Estimates, estimates, ranges_of
from .substring import STRETCHES, Cuts, Stretches, anchor_places, earliest, equal_groups, grouped, runs, stretches

LENGTH = 100
#: Bytes of the grams among which a window's anchor is chosen.
GRAM = 24
PACK_BYTES = 1 << 20
SHARDS_PER_PARTITION = 4
#: Windows whose suffixes one array holds.
ARRAY_WINDOWS = 1_000_000


def smaller_than_successor(data: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than the one that starts a byte later. The
    suffix of one byte is larger than the empty one."""
    n = len(data)
    if n == 0:
        return np.zeros(0, bool)
    ends = np.r_[np.flatnonzero(data[1:] != data[:-1]), n - 1]  # of runs of one byte
    rises = np.r_[data[ends[:-1] + 1] > data[ends[:-1]], False]
    return np.repeat(rises, np.diff(np.r_[-1, ends]))


def _strings(data: np.ndarray, depth: int) -> np.ndarray:
    """The first depth bytes of each suffix as one item; an end counts as bytes 0."""
    padded = np.concatenate([data, np.zeros(depth, np.uint8)])
    return np.ndarray(len(data), f"V{depth}", padded, strides=(1,))


def two_stage_order(data: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Starts of the suffixes of data in the order of their first depth bytes (an end
    counts as byte 0). With wanted, a mask, of these suffixes and those that they are
    induced from alone."""
    n = len(data)
    small = smaller_than_successor(data)
    needed = np.ones(n, bool) if wanted is None else wanted.copy()
    chain = np.flatnonzero(needed & ~small) + 1
    while len(chain := chain[chain < n]):
        chain = chain[~needed[chain]]
        needed[chain] = True
        chain = chain[~small[chain]] + 1
    direct = np.flatnonzero(needed & small)
    direct = direct[np.argsort(_strings(data, depth)[direct].view(f"S{depth}"), kind="stable")]
    bounds = np.searchsorted(data[direct], np.arange(257))  # direct is sorted by first byte too
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and needed[n - 1]:
        induced[data[n - 1]].append(np.array([n - 1]))
    order = []
    for c in range(256):
        layer = np.concatenate(induced[c]) if induced[c] else direct[:0]
        bucket = []
        while len(layer):  # of c...cx with x below c, the shorter runs come first
            bucket.append(layer)
            before = layer - 1
            layer = before[(before >= 0) & (data[before] == c) & needed[before]]
        bucket.append(direct[bounds[c] : bounds[c + 1]])
        bucket = np.concatenate(bucket)
        order.append(bucket)
        before = bucket - 1
        before = before[before >= 0]
        before = before[needed[before] & (data[before] > c)]
        first = data[before]
        by_byte = np.argsort(first, kind="stable")
        for b, part in by_shard(first[by_byte], before[by_byte]):
            induced[b].append(part)
    return np.concatenate(order)


def adjacent_prefixes(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix in order and the one before, depth at most.
    Four bytes are compared at once where depth allows it."""
    strings, out = _strings(data, depth), np.zeros(len(order), np.int64)
    for a in range(1, len(order), 100_000):
        w = strings[order[a - 1 : a + 100_000]].view("<u4" if depth % 4 == 0 else np.uint8).reshape(-1, depth // 4 if depth % 4 == 0 else depth)
        same = w[1:] == w[:-1]
        full, unit = same.all(axis=1), same.argmin(axis=1)
        if depth % 4 == 0:
            row = np.arange(len(unit))
            differ = w[1:][row, unit] ^ w[:-1][row, unit]
            unit = 4 * unit + sum((differ & (256**k - 1) == 0).astype(np.int64) for k in (1, 2, 3))
        out[a : a + len(full)] = np.where(full, depth, unit)
    return np.minimum(out, np.minimum(len(data) - order, np.r_[0, len(data) - order[:-1]]))


class _Windows:
    """Windows of the documents of one pack: anchors, and where each begins."""

    def __init__(self, texts: Texts, length: int, gram: int):
        data, self.span = texts.data, length - gram + 1
        self.at = np.zeros(0, np.int64)
        self.anchors = self.grams = self.all = np.zeros(0, np.uint64)
        if len(data) >= length:
            self.grams = byte_grams(data, gram)
            self.all = sliding_min(self.grams, self.span)
            inside = np.zeros(len(data) + 1, np.int32)  # windows within one document
            sizes = np.diff(texts.starts)
            whole = sizes >= length
            np.add.at(inside, texts.starts[:-1][whole], 1)
            np.add.at(inside, texts.starts[1:][whole] - length + 1, -1)
            self.at = np.flatnonzero(np.cumsum(inside[: len(self.all)]) > 0)
            self.anchors = self.all[self.at]

    def keys(self) -> np.ndarray:
        """The anchor grams, each place of the text once."""
        return anchor_places(self.grams, self.all, self.span) if len(self.at) else self.anchors


def _repeats(text: np.ndarray, sizes: np.ndarray, counts: np.ndarray, ids: np.ndarray, places: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs (place, first, last) of windows that also start earlier, from the suffix array of
    stretches of text end to end; counts[k] windows start in stretch k, from at[k] on."""
    begins = np.cumsum(sizes) - sizes
    wanted = np.zeros(len(text) + 1, np.int32)
    np.add.at(wanted, begins, 1)
    np.add.at(wanted, begins + counts, -1)
    wanted = np.cumsum(wanted[:-1]) > 0
    order = two_stage_order(text, length, wanted)
    order = order[wanted[order]]
    same = adjacent_prefixes(text, order, length) >= length
    group = np.cumsum(~same)
    shared = same | np.r_[same[1:], False]
    order, group = order[shared], group[shared]
    stretch = np.searchsorted(begins, order, side="right") - 1
    place, start = places[stretch], at[stretch] + order - begins[stretch]
    late = earliest(group, ids[stretch], place, start)
    return runs(place[late], start[late])


def repeated_runs(df: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(pack, data): for the packs of df (id, text, ...) the runs (document, first, last) of
    strings of length bytes starting at bytes first to last which also start earlier (smaller
    id, then start in the document). They never cross documents; null texts have none. Of
    documents of equal ids none is earlier."""
    rows, ranges, shards = df.select(*df.columns[:2]), ranges_of(df), partitions(df, SHARDS_PER_PARTITION, 64)

    def find(pack: Pack, data: list[bytes]) -> Iterator[pa.RecordBatch]:
        texts = pack.texts
        w = _Windows(texts, length, gram)
        if not len(w.at):
            return
        change = np.r_[True, w.anchors[1:] != w.anchors[:-1]]
        again, often = (x[np.cumsum(change) - 1] for x in Estimates(w.keys(), data, ranges).of(w.anchors[change]))
        at, keys, often = w.at[again], w.anchors[again], often[again]
        doc = np.searchsorted(texts.starts, at, side="right") - 1
        settled = runs(at[:0], at[:0])
        if often.any():
            # Windows of a very frequent anchor are told apart by their next smallest gram too,
            # and those that repeat in the pack go on once.
            first, second = (x[at[often]] for x in two_smallest(w.grams, w.span))
            keys[often] = joined(first, second)
            hot = np.flatnonzero(often)
            views = np.lib.stride_tricks.sliding_window_view(texts.data, length)
            groups = equal_groups(views, at[hot], byte_grams(texts.data, length)[at[hot]])
            late = hot[earliest(groups, texts.ids[doc[hot]], doc[hot], at[hot])]
            settled = runs(doc[late], at[late] - texts.starts[doc[late]])
            kept = np.ones(len(at), bool)
            kept[late] = False
            at, keys, doc = at[kept], keys[kept], doc[kept]
        # A run of windows with one key is one stretch.
        new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])]) if len(at) else at
        begin, counts = at[new], np.diff(np.r_[new, len(at)])

        raw = texts.data.tobytes()

        def text(chosen: np.ndarray) -> tuple[bytes, np.ndarray]:
            sizes = counts[chosen] + length - 1
            return stretches_of(raw, begin[chosen], sizes), sizes

        yield from stretches(pack, shards, keys[new], doc[new], begin - texts.starts[doc[new]], counts, text, settled)

    def sort(met: Stretches) -> Iterator[pa.RecordBatch]:
        begins = np.cumsum(met.sizes) - met.sizes
        raw = met.text.tobytes()
        for o in met.parts(ARRAY_WINDOWS):
            text = np.frombuffer(stretches_of(raw, begins[o], met.sizes[o]), np.uint8)
            yield from met.found(*_repeats(text, met.sizes[o], met.counts[o], met.ids[o], met.places[o], met.at[o], length))

    marked = estimates(rows, lambda texts: _Windows(texts, length, gram).keys(), PACK_BYTES)
    return grouped(meet(rows, marked, find, STRETCHES, PACK_BYTES, all_found=True), shards, sort)


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all documents, how many bytes repeat, in how many spans, and a digest of those
    kept. Null text: empty. A null doc_id is smaller than all others, and equal to the smallest
    long. Of rows that share a doc_id none is earlier than another."""
    docs = documents(spark, sf_dir).select("doc_id", "text")

    def digest(pack: Pack, data: list[bytes]) -> Iterator[pa.RecordBatch]:
        texts = pack.texts
        cuts, removed, spans, kept = Cuts(len(texts.ids), data), [], [], []
        for i in range(len(texts.ids)):
            text = texts.data[texts.starts[i] : texts.starts[i + 1]]
            gone = cuts.covered(i, len(text), LENGTH) if cuts.sizes[i] else None
            removed.append(0 if gone is None else int(gone.sum()))
            spans.append(0 if gone is None else int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            kept.append(hashlib.sha256((text if gone is None else text[~gone]).tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays([pack.batch.column(0), pa.array(np.diff(texts.starts), pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return meet(docs, repeated_runs(docs), digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", PACK_BYTES)
