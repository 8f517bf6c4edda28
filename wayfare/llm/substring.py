"""Substring dedup over word windows with a count-min prefilter.

First pass: partition sketches of the windows' anchors are merged and overestimate how
often each window occurs. A window's anchor is the smallest gram hash in it, chosen by the
window's content alone, so a window is at most as frequent as its anchor. Second pass: only
windows estimated repeated are grouped, by their words; in each group all but the earliest
(smallest id, then start) are repeats. Words that a repeat covers are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Texts, by_shard, documents, equal_words, gram_hashes, joined, mix64, sliding_min, span_hashes, stretches_of, tidy, two_smallest, word_spans
from .packs import Pack, meet, partitions, rereadable, unzipped, zipped
from .sketch import Estimates, estimates, ranges_of

WINDOW = 20
#: Words of the grams among which a window's anchor is chosen.
GRAM = 8
PACK_BYTES = 2 << 20
#: Shards that the second pass groups windows in, for each partition of the input.
SHARDS_PER_PARTITION = 2
#: Windows that a shard compares at once, or those of one label where it alone has more.
GROUP_WINDOWS = 1 << 19


class _Windows:
    """Windows of the documents of one pack: anchors, and where each begins."""

    def __init__(self, texts: Texts, window: int, gram: int):
        starts, ends, first = word_spans(texts)
        self.starts, self.ends, self.first, self.window = starts, ends, first, window
        self.at = np.zeros(0, np.int64)
        self.anchors = np.zeros(0, np.uint64)
        if len(starts) < window:
            return
        self.codes = span_hashes(texts.data, starts, ends)
        self.doc = np.repeat(np.arange(len(texts.ids)), np.diff(first))
        self.at = np.flatnonzero(self.doc[: len(self.doc) - window + 1] == self.doc[window - 1 :])  # within one document
        self.grams, self.span = gram_hashes(self.codes, gram), window - gram + 1
        self.all = sliding_min(self.grams, self.span)
        self.anchors = self.all[self.at]

    def keys(self) -> np.ndarray:
        """The anchor grams, each place of the text once (those of windows that would cross
        documents too: estimates may be too high). A gram is at least the anchor of every
        window that holds it, so it is the anchor of one if the largest of these equals it."""
        return anchor_places(self.grams, self.all, self.span) if len(self.at) else self.anchors


def anchor_places(grams: np.ndarray, anchors: np.ndarray, span: int) -> np.ndarray:
    pad = np.zeros(span - 1, np.uint64)
    largest = ~sliding_min(~np.concatenate([pad, anchors, pad]), span)
    return grams[largest == grams]


def equal_groups(rows: np.ndarray, at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A number for each row of a matrix that at names, the same for equal rows alone. Hashes
    bring them together; they are compared themselves."""
    order = np.argsort(hashes, kind="stable")
    h, same = hashes[order], np.zeros(len(order), bool)
    near = np.flatnonzero(h[1:] == h[:-1]) + 1
    for k in range(0, len(near), 50_000):
        some = near[k : k + 50_000]
        same[some] = (rows[at[order[some]]] == rows[at[order[some - 1]]]).all(axis=1)
    if not same[near].all():
        return np.unique(rows[at], axis=0, return_inverse=True)[1].ravel()
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(~same)
    return out


def earliest(groups: np.ndarray, ids: np.ndarray, places: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which entries have another of their group of smaller id, or of smaller at in their own
    document (place)."""
    if not len(groups):
        return np.zeros(0, bool)
    order = np.lexsort((at, places, ids, groups))
    g, i, d, p = groups[order], ids[order], places[order], at[order]
    same = np.r_[False, g[1:] == g[:-1]]
    own = same & np.r_[False, d[1:] == d[:-1]]
    place = np.arange(len(g))
    head, first = (np.maximum.accumulate(np.where(x, 0, place)) for x in (same, own))
    out = np.zeros(len(g), bool)
    out[order] = (i > i[head]) | (p > p[first])  # other documents of an equal id are not earlier
    return out


def runs(docs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first, last) of runs of successive starts in one document."""
    if not len(docs):
        return docs, at, at
    order = np.lexsort((at, docs))
    d, p = docs[order], at[order]
    new = np.r_[True, (d[1:] != d[:-1]) | (p[1:] > p[:-1] + 1)]
    return d[new], p[new], p[np.r_[np.flatnonzero(new)[1:] - 1, len(p) - 1]]


#: Stretches of a pack's documents on their way to a shard: of each its document's number in
#: the pack and id, where it begins, how many windows begin in it, a label that stretches
#: which may have a window in common share, and its bytes; or, of shard -1, runs that the pack
#: has settled by itself.
STRETCHES = "shard int, pack binary, docs binary, ids binary, at binary, counts binary, labels binary, sizes binary, text binary"
_TYPES = (pa.int32(), *[pa.binary()] * 8)
_NAMES = [f.split()[0] for f in STRETCHES.split(", ")]


def packed_runs(docs: np.ndarray, first: np.ndarray, last: np.ndarray) -> bytes:
    return np.stack([docs, first, last]).astype(np.int64).tobytes()


def unpacked_runs(data: list[bytes]) -> np.ndarray:
    """A row each of documents, first and last starts."""
    return np.concatenate([np.zeros((3, 0), np.int64), *[np.frombuffer(x, np.int64).reshape(3, -1) for x in data]], axis=1)


def stretches(pack: Pack, shards: int, keys: np.ndarray, docs: np.ndarray, at: np.ndarray, counts: np.ndarray, text: Callable[[np.ndarray], tuple[bytes, np.ndarray]], settled: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    """Rows of STRETCHES: of each stretch its key, document, first start and number of starts;
    text gives the bytes of some of them end to end and their sizes. settled: runs."""
    out = [(-1, pack.name, *[b""] * 6, packed_runs(*settled))] if len(settled[0]) else []
    mixed = mix64(keys)
    shard = (mixed >> np.uint64(33)).astype(np.int64) % shards
    order = np.argsort(shard, kind="stable")
    for s, o in by_shard(shard[order], order):
        data, sizes = text(o)
        out.append((s, pack.name, docs[o].astype(np.int32).tobytes(), pack.texts.ids[docs[o]].tobytes(), at[o].astype(np.int64).tobytes(), counts[o].astype(np.int32).tobytes(), mixed[o].astype(np.uint32).tobytes(), sizes.astype(np.int32).tobytes(), zipped(data)))
    for k in range(0, len(out), 256):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[k : k + 256], strict=True), _TYPES, strict=True)], _NAMES)


class Stretches:
    """The stretches that have come to a task. packs has their packs' names; places tells
    documents apart."""

    def __init__(self, rows: list[tuple]):
        self.packs: list[bytes] = []
        number: dict[bytes, int] = {}
        columns = [[] for _ in range(7)]
        for name, docs, ids, at, counts, labels, sizes, text in rows:
            if name not in number:
                number[name] = len(self.packs)
                self.packs.append(name)
            own = (np.frombuffer(docs, np.int32).astype(np.int64) | number[name] << 32, np.frombuffer(ids, np.int64), np.frombuffer(at, np.int64), np.frombuffer(counts, np.int32), np.frombuffer(labels, np.uint32), np.frombuffer(sizes, np.int32).astype(np.int64), unzipped(text))
            for column, values in zip(columns, own, strict=True):
                column.append(values)
        self.places, self.ids, self.at, self.counts, self.labels, self.sizes, self.text = (np.concatenate(c) for c in columns)

    def parts(self, at_most: int) -> Iterator[np.ndarray]:
        """The numbers of the stretches in parts of at most so many windows. Stretches of one label
        are in one part, which may have more."""
        order = np.argsort(self.labels, kind="stable")
        label, total = self.labels[order], np.cumsum(self.counts[order], dtype=np.int64)
        ends = np.flatnonzero(np.r_[label[1:] != label[:-1], True]) + 1 if len(order) else order  # of labels
        a = 0
        while a < len(order):
            done = total[a - 1] if a else 0
            fit = ends[(ends > a) & (total[ends - 1] - done <= at_most)]
            b = int(fit[-1]) if len(fit) else int(ends[ends > a][0])
            yield order[a:b]
            a = b

    def found(self, places: np.ndarray, first: np.ndarray, last: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Runs as rows (pack, data)."""
        pack = places >> 32
        order = np.argsort(pack, kind="stable")
        rows = [(self.packs[p], packed_runs(places[o] & 0xFFFFFFFF, first[o], last[o])) for p, o in by_shard(pack[order], order)]
        for k in range(0, len(rows), 1000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows[k : k + 1000], strict=True)], ["pack", "data"])


def grouped(sent: DataFrame, shards: int, group: Callable[[Stretches], Iterator[pa.RecordBatch]]) -> DataFrame:
    """(pack, data): runs that group finds in the stretches of a shard, and those settled before."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for shard, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if shard < 0:
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (row[0], row[-1])], ["pack", "data"])
                else:
                    rows.append(tuple(row))
        if rows:
            met = Stretches(rows)
            rows.clear()
            yield from group(met)

    # What a pack has settled by itself has no group to meet.
    spread = F.when(F.col("shard") < 0, F.xxhash64("pack")).otherwise(F.col("shard"))
    return sent.repartition(shards, spread).mapInArrow(tidy(gather), "pack binary, data binary")


def repeated_runs(df: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(pack, data): for the packs of df (id, text, ...) the runs (document, first, last) of
    windows starting at words first to last which also start earlier. Windows never cross
    documents; null texts have none.

    Windows whose anchor is estimated repeated travel, as the words of the stretch that holds
    a run of them, to a shard of their anchor: equal windows meet in one. Windows of a very
    frequent anchor are told apart by their next smallest gram too. Those that repeat
    within a pack go on once, so that a frequent passage is met at most once from each pack.
    A shard compares its windows in parts of GROUP_WINDOWS. Words are numbered by their bytes and windows compared number by number."""
    rows, ranges, shards = df.select(*df.columns[:2]), ranges_of(df), partitions(df, SHARDS_PER_PARTITION, 12)

    def groups_of(words: np.ndarray, at: np.ndarray) -> np.ndarray:
        windows = np.lib.stride_tricks.sliding_window_view(words.astype(np.int32), window)
        return equal_groups(windows, at, gram_hashes(mix64(words.astype(np.uint64)), window)[at])

    def find(pack: Pack, data: list[bytes]) -> Iterator[pa.RecordBatch]:
        w = _Windows(pack.texts, window, gram)
        if not len(w.at):
            return
        # An anchor is looked up once for its run of windows.
        change = np.r_[True, w.anchors[1:] != w.anchors[:-1]]
        again, often = (x[np.cumsum(change) - 1] for x in Estimates(w.keys(), data, ranges).of(w.anchors[change]))
        at, keys, often = w.at[again], w.anchors[again], often[again]
        if not len(at):
            return
        if often.any():
            keys[often] = joined(*[x[at[often]] for x in two_smallest(w.grams, w.span)])
        _, words = equal_words(pack.texts.data, w.starts, w.ends)
        doc = w.doc[at]
        late = earliest(groups_of(words, at), pack.texts.ids[doc], doc, at)
        settled = runs(doc[late], at[late] - w.first[doc[late]])
        at, doc, keys = at[~late], doc[~late], keys[~late]
        new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])]) if len(at) else at
        begin, counts = at[new], np.diff(np.r_[new, len(at)])
        raw = pack.texts.data.tobytes()

        def text(chosen: np.ndarray) -> tuple[bytes, np.ndarray]:
            parts = [raw[w.starts[a] : w.ends[a + n + window - 2]] for a, n in zip(begin[chosen].tolist(), counts[chosen].tolist(), strict=True)]
            return b"".join(parts), np.array([len(p) for p in parts], np.int64)

        yield from stretches(pack, shards, keys[new], doc[new], begin - w.first[doc[new]], counts, text, settled)

    def group(met: Stretches) -> Iterator[pa.RecordBatch]:
        begins, raw = np.cumsum(met.sizes) - met.sizes, met.text.tobytes()
        for o in met.parts(GROUP_WINDOWS):
            text, counts = np.frombuffer(stretches_of(raw, begins[o], met.sizes[o]), np.uint8), met.counts[o]
            starts, ends, first = word_spans(Texts(met.places[o], text, np.r_[0, np.cumsum(met.sizes[o])]))
            _, words = equal_words(text, starts, ends)
            stretch = np.repeat(np.arange(len(counts)), counts)
            inside = np.arange(len(stretch)) - (np.cumsum(counts) - counts)[stretch]
            place, start = met.places[o][stretch], met.at[o][stretch] + inside
            late = earliest(groups_of(words, first[stretch] + inside), met.ids[o][stretch], place, start)
            yield from met.found(*runs(place[late], start[late]))

    marked = estimates(rows, lambda texts: _Windows(texts, window, gram).keys(), PACK_BYTES)
    return grouped(meet(rows, marked, find, STRETCHES, PACK_BYTES, all_found=True), shards, group)


class Cuts:
    """The runs of each of n documents of a pack."""

    def __init__(self, n: int, data: list[bytes]):
        doc, first, last = unpacked_runs(data)
        order = np.argsort(doc, kind="stable")
        self.first, self.last = first[order], last[order]
        self.at = np.searchsorted(doc[order], np.arange(n + 1))
        self.sizes = np.diff(self.at)

    def covered(self, i: int, n: int, length: int) -> np.ndarray:
        """Which of n units are covered by spans of that length starting at first to last."""
        a, b = self.at[i], self.at[i + 1]
        edges = np.bincount(np.minimum(self.first[a:b], n), minlength=n + 1) - np.bincount(np.minimum(self.last[a:b] + length, n), minlength=n + 1)
        return np.cumsum(edges[:n]) > 0


def _kept(texts: Texts, i: int, spans: tuple[np.ndarray, np.ndarray, np.ndarray], gone: np.ndarray) -> bytes:
    starts, ends, first = spans
    data = texts.data
    return b" ".join([data[starts[k] : ends[k]].tobytes() for k in range(first[i], first[i + 1]) if not gone[k - first[i]]])


def dedup(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """df (doc_id, text, other columns) with text cut down to the words kept, joined by one
    space; texts of which nothing is removed stay as they are. Null texts stay null."""
    rest = [c for c in df.columns if c not in ("doc_id", "text")]
    rows = rereadable(df.select("doc_id", "text", *[F.col(f"`{c}`") for c in rest]))

    def cut(pack: Pack, data: list[bytes]) -> Iterator[pa.RecordBatch]:
        texts, new = pack.texts, pack.batch.column(1).to_pylist()
        spans, cuts = word_spans(texts), Cuts(len(texts.ids), data)
        for i in np.flatnonzero(cuts.sizes):
            n = int(spans[2][i + 1] - spans[2][i])
            new[i] = _kept(texts, i, spans, cuts.covered(i, n, window)).decode()
        columns = [pa.array(new, pa.string()) if k == 1 else c for k, c in enumerate(pack.batch.columns)]
        yield pa.RecordBatch.from_arrays(columns, pack.batch.schema.names)

    return meet(rows, repeated_runs(rows, window), cut, rows.schema, PACK_BYTES).select(df.columns)


def op10_count_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all documents, how many words repeat and a digest of those kept. Null text: no
    words. A null doc_id is smaller than all others, and equal to the smallest long. Of rows
    that share a doc_id none is earlier than another."""
    docs = documents(spark, sf_dir).select("doc_id", "text")

    def digest(pack: Pack, data: list[bytes]) -> Iterator[pa.RecordBatch]:
        texts = pack.texts
        spans, cuts = word_spans(texts), Cuts(len(texts.ids), data)
        removed, kept = [], []
        for i in range(len(texts.ids)):
            if not cuts.sizes[i]:
                # Where nothing goes, one call normalizes the text; bytes.split knows the same white space.
                removed.append(0)
                kept.append(hashlib.sha256(b" ".join(texts.of(i).split())).hexdigest())
                continue
            gone = cuts.covered(i, int(spans[2][i + 1] - spans[2][i]), WINDOW)
            removed.append(int(gone.sum()))
            kept.append(hashlib.sha256(_kept(texts, i, spans, gone)).hexdigest())
        yield pa.RecordBatch.from_arrays([pack.batch.column(0), pa.array(np.diff(spans[2]), pa.int64()), pa.array(removed, pa.int64()), pa.array(kept)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return meet(docs, repeated_runs(docs), digest, "doc_id long, n_words long, n_removed long, kept_sha256 string", PACK_BYTES)
