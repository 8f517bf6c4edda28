"""Byte-level BPE encoding and decoding in Spark's higher-order functions.

A word's bytes are an array of ids; a fold merges the neighbouring pair of lowest rank,
leftmost first, until none has a rank. The ranks are a literal map from pairs of ids to
the id of the merged piece (its rank), laid out as a two-place hash table, as Spark scans
its own map type from the start at each lookup.

Each distinct word is folded once, in the shard of its hash; pieces that are words themselves
are known beforehand. Arrow stages around the fold number the words and put the ids
together. Decoding concatenates binary pieces.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_shard, documents, pieces_of, span_hashes, tidy
from .packs import partitions, rereadable, stored, unzipped, zipped

#: White space as the tokenizer's pattern means it (Unicode's White_Space).
_SPACE = r"\x09-\x0D\x20\x85\xA0  -     　"
#: Longest word, in bytes, of which a step of the fold merges one pair.
LONG_WORD = 48
#: Words after which a book is closed.
BOOK_WORDS = 2_000_000
#: Words of a text that one row brings to Python. Arrow batches are cut by rows, so this bounds
#: them however long the texts are.
PART_WORDS = 100
#: Words that one row brings to the fold.
FOLDED_AT_ONCE = 1000
SHARDS_PER_PARTITION = 4
#: Rows of a slice.
ROWS = 1000


def java_pattern(pattern: str) -> str:
    """A tokenizer's pattern with its classes of white space written out for Java."""
    return pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _places(h: int, size: int) -> tuple[int, int]:
    return h & (size - 1), (h >> 32) & (size - 1)


def _table(items: Iterable[tuple[object, bytes, object]], size: int) -> list[tuple[object, object] | None]:
    """Cuckoo hash table: (key, bytes that Spark hashes, value) in one of two places each."""
    while True:
        table: list[tuple | None] = [None] * size
        for key, raw, value in items:
            entry = (key, value, _places(xxhash.xxh64_intdigest(raw, 42), size))
            at = entry[2][0]
            for _ in range(500):
                table[at], entry = entry, table[at]
                if entry is None:
                    break
                a, b = entry[2]
                at = b if at == a else a
            else:
                break
        else:
            return table
        size *= 2


class Vocabulary:
    """Ranks as literal tables for Spark. The path is read on the driver alone."""

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.pattern = java_pattern(pattern)
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = rank
        self.pairs = _table([(k, k.to_bytes(8, "little"), v) for k, v in pairs.items()], 1 << (2 * len(pairs)).bit_length())
        self.pieces = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.pieces[rank] = token

    def literal(self, spark: SparkSession) -> Column:
        """The tables of bytes and pairs as a scalar subquery."""
        row = {
            "bytes": pa.array([[self.ranks[bytes([b])] for b in range(256)]], pa.list_(pa.int32())),
            "pair": pa.array([[x[0] if x else -1 for x in self.pairs]], pa.list_(pa.int64())),
            "rank": pa.array([[x[1] if x else -1 for x in self.pairs]], pa.list_(pa.int32())),
        }
        return spark.createDataFrame(pa.table(row)).select(F.struct("*").alias("tables")).scalar()

    def word_tokens(self) -> dict[str, list[int]]:
        """Pieces that are words of text by themselves: such a word is one token."""
        out = {}
        for token, rank in self.ranks.items():
            try:
                out[token.decode()] = [rank]
            except UnicodeDecodeError:
                continue
        return out


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _with_tables(df: DataFrame, tables: Column, name: str, body: Callable[[Column], Column]) -> DataFrame:
    """df with body of the tables. A subquery may not stand in a lambda, so it is a column,
    read in one place alone: the optimizer puts it there, and no row carries the tables."""
    value = _bind(F.col("_tables"), body)
    return df.withColumn("_tables", tables).select(*[c for c in df.columns if c != name], value.alias(name))


def _lookup(keys: Column, values: Column, size: int, key: Column) -> Column:
    h = F.xxhash64(key)
    a = h.bitwiseAND(size - 1).cast("int")
    b = F.shiftrightunsigned(h, 32).bitwiseAND(size - 1).cast("int")
    return F.when(F.get(keys, a) == key, F.get(values, a)).when(F.get(keys, b) == key, F.get(values, b))


def fold_merges(word: Column, tables: Column, pairs: int) -> Column:
    """The ids of one word: its bytes' ids with the pair of lowest rank merged, again and again.

    The state has the ids, the rank of each pair of neighbours (null where there is none, and
    a null at either end) and the lowest of these. Of a short word a step merges the leftmost
    pair of lowest rank and looks up the two pairs that it makes. Of a long word a step merges
    all pairs of that rank, so that there are as many steps as ranks met, not as bytes."""
    latin = F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), "")
    pieces = F.transform(latin, lambda c: F.get(tables["bytes"], F.ascii(c)))
    nothing = F.array(F.lit(None).cast("int"))

    def key(a: Column, b: Column) -> Column:
        return F.shiftleft(a.cast("long"), 20).bitwiseOR(b.cast("long"))

    def found(k: Column) -> Column:
        return _lookup(tables["pair"], tables["rank"], pairs, k)

    def rank(a: Column, b: Column) -> Column:
        return _bind(key(a, b), found)

    def state_of(ids: Column, ranks: Column) -> Column:
        return F.struct(ids.alias("ids"), ranks.alias("ranks"), F.array_min(ranks).alias("lowest"))

    def start(ids: Column) -> Column:
        n = F.size(ids)
        neighbours = F.zip_with(F.slice(ids, F.lit(1), n - 1), F.slice(ids, F.lit(2), n), key)
        return _bind(F.concat(nothing, F.transform(neighbours, found), nothing), lambda ranks: state_of(ids, ranks))

    def merge_one(state: Column) -> Column:
        ids, ranks, lowest = state["ids"], state["ranks"], state["lowest"]

        def merged(at: Column) -> Column:
            new = F.concat(F.slice(ids, F.lit(1), at - 2), F.array(lowest), F.slice(ids, at + 1, F.size(ids)))
            around = F.array(rank(F.get(ids, at - 3), lowest), rank(lowest, F.get(ids, at)))
            return _bind(F.concat(F.slice(ranks, F.lit(1), at - 2), around, F.slice(ranks, at + 2, F.size(ranks))), lambda r: state_of(new, r))

        return _bind(F.array_position(ranks, lowest).cast("int"), merged)

    def merge_all(state: Column) -> Column:
        """Of overlapping pairs the leftmost, as one by one. Should a merge make a pair of
        lower rank, which would then be next, only one is merged."""
        ids, ranks, lowest = state["ids"], state["ranks"], state["lowest"]
        marks = F.array_join(F.transform(ranks, lambda r: F.when(r == lowest, "1").otherwise("0")), "")
        # marks[i] is of the pair that ends at ids[i].
        chosen = F.split(F.regexp_replace(marks, "11", "12"), "")

        def merged(c: Column) -> Column:
            new = F.transform(ids, lambda x, i: F.when(F.get(c, i + 1) == "1", lowest).when(F.get(c, i) != "1", x))
            between = F.exists(F.transform(ids, lambda x, i: F.when(F.get(c, i - 1) == "1", rank(lowest, x))), lambda r: r < lowest)
            return _bind(start(F.filter(new, lambda x: x.isNotNull())), lambda s: F.when((s["lowest"] < lowest) | F.coalesce(between, F.lit(False)), merge_one(state)).otherwise(s))

        return _bind(chosen, merged)

    def step(merge: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
        return lambda state, _: F.when(state["lowest"].isNull(), state).otherwise(merge(state))

    size = F.octet_length(word)
    # Each step copies the state, so of a long word steps left over are skipped by rounds.
    rounds = F.sequence(F.lit(1), F.ceil(F.sqrt(size)).cast("int"))
    short = F.aggregate(F.sequence(F.lit(1), size), _bind(pieces, start), step(merge_one), lambda state: state["ids"])
    long = F.aggregate(rounds, _bind(pieces, start), step(lambda state: F.aggregate(rounds, state, step(merge_all))), lambda state: state["ids"])
    return F.when(size <= LONG_WORD, short).otherwise(long)


def words_of(text: Column, vocabulary: Vocabulary) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(vocabulary.pattern), F.lit(0))


def _in_parts(df: DataFrame, text: str, vocabulary: Vocabulary) -> DataFrame:
    """A row for each PART_WORDS words of a text, and one of a text without words: the other
    columns as c0, c1, ..., in the first of these rows alone, then the row's number in its text
    and its words."""
    rest = [c for c in df.columns if c != text]

    def cut_up(words: Column) -> Column:
        last = F.greatest(F.ceil(F.size(words) / PART_WORDS), F.lit(1)).cast("int") - 1
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(words, i * PART_WORDS + 1, F.lit(PART_WORDS)))

    # Bound, the words stay an object of which a slice copies its own part alone.
    parts = F.posexplode(_bind(words_of(F.col(f"`{text}`"), vocabulary), cut_up)).alias("part", "words")
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(rest)], parts)
    return rows.select(*[F.when(F.col("part") == 0, F.col(f"c{k}")).alias(f"c{k}") for k in range(len(rest))], "part", "words")


def _per_slice(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _flat(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Values of a column of lists end to end, and where each list begins."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    return column.flatten(), np.r_[0, np.cumsum(sizes)]


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers compressed, their lowest bytes first, then the next, and so on."""
    return zipped(np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(unzipped(data).reshape(4, -1).T).view("<i4").ravel()


def _text_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of words end to end, and where each begins."""
    words = words.cast(pa.large_string())
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64, len(words) + 1, 8 * words.offset)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8), at - at[0]


class _Book(NamedTuple):
    """Some of a task's texts one after another. Its distinct words are numbered, pieces first;
    name has the book's place, how many words are no pieces, and a checksum of them."""

    name: bytes
    batches: list[pa.RecordBatch]  # other columns of the texts, and how many words each has
    numbers: list[np.ndarray]  # of the words of each batch
    others: pa.Array  # the words that are no pieces


def _whole(parts: list[pa.RecordBatch]) -> tuple[pa.RecordBatch, pa.ChunkedArray]:
    """The texts that parts make up: their other columns and numbers of words, and the words."""
    width = parts[0].num_columns - 2
    begins = np.concatenate([np.asarray(p.column(width)) for p in parts]) == 0
    sizes = np.concatenate([np.asarray(pc.list_value_length(p.column(width + 1))) for p in parts])
    first, fields = pa.array(begins), parts[0].schema
    columns = [pa.chunked_array([p.column(k) for p in parts], fields.field(k).type).filter(first).combine_chunks() for k in range(width)]
    sizes = pa.array(np.add.reduceat(sizes, np.flatnonzero(begins)), pa.int64())
    return pa.RecordBatch.from_arrays([*columns, sizes], [*fields.names[:width], "sizes"]), pa.chunked_array([p.column(width + 1).flatten() for p in parts], pa.string())


def _books(batches: Iterator[pa.RecordBatch], pieces: pa.Array, rows: int, most: int) -> Iterator[_Book]:
    """The books of a task's batches, whose last columns are the number of a part in its text
    and its words. A book ends with the text that brings it over most words; its batches have
    at most so many rows."""
    partition, number = TaskContext.get().partitionId(), 0
    held: list[tuple[pa.RecordBatch, pa.ChunkedArray]] = []

    def closed() -> _Book:
        """The book of what is held, which is let go."""
        sizes = [len(words) for _, words in held]
        own = [batch for batch, _ in held]
        words = pa.chunked_array([c for _, words in held for c in words.chunks], pa.string())
        held.clear()
        words = words.combine_chunks()
        coded = words.dictionary_encode()
        del words
        piece = pc.index_in(coded.dictionary, value_set=pieces)
        known = np.asarray(pc.fill_null(piece, -1)).astype(np.int64)
        others = coded.dictionary.filter(pc.is_null(piece))
        number_of = np.where(known >= 0, known, len(pieces) + np.cumsum(known < 0) - 1).astype(np.int32)
        numbers = number_of[np.asarray(coded.indices)] if len(coded) else np.zeros(0, np.int32)
        check = xxhash.xxh3_64_intdigest(_text_of(others)[0])
        return _Book(struct.pack(">qqqQ", partition, number, len(others), check), own, np.split(numbers, np.cumsum(sizes)[:-1]), others)

    parts, texts, words = [], 0, 0  # of the slice, its texts, and the words of the book
    for batch in batches:
        at, width = 0, batch.num_columns
        before = np.r_[0, np.cumsum(np.asarray(pc.list_value_length(batch.column(width - 1))))]
        for begin in np.flatnonzero(np.asarray(batch.column(width - 2)) == 0).tolist():
            full = words + before[begin] - before[at] > most
            if full or texts == rows:
                held.append(_whole([*parts, batch.slice(at, begin - at)]))
                parts, texts, words, at = [], 0, words + before[begin] - before[at], begin
            if full:
                yield closed()
                words, number = 0, number + 1
            texts += 1
        parts.append(batch.slice(at))
        words += before[-1] - before[at]
    if parts:
        held.append(_whole(parts))
        yield closed()


Body = Callable[[pa.RecordBatch, pa.Array, np.ndarray], pa.RecordBatch]


def _encoded(df: DataFrame, text: str, vocabulary: Vocabulary, body: Body, schema: str) -> DataFrame:
    """What body makes of slices of df: their other columns, and the ids of all texts end to
    end with where each text's begin.

    A task numbers the distinct words of its rows, book by book, and sends each word once to
    the shard of its hash. A shard folds its distinct words, so each distinct word of df is
    folded once, and sends ids back by number. They meet the book's rows, which travel as
    compressed arrays of numbers. Books are made anew for that; if they differ then, because
    df gave its rows in another order, the meeting raises."""
    rest = [c for c in df.columns if c != text]
    df = rereadable(df)
    held = _in_parts(df, text, vocabulary)
    width, size = len(rest), len(vocabulary.pairs)
    single = vocabulary.word_tokens()
    shared = df.sparkSession.sparkContext.broadcast((pa.array(list(single), pa.string()), np.array([i for (i,) in single.values()], np.int32)))
    shards = partitions(df, SHARDS_PER_PARTITION, 16)

    def shard_of(book: _Book) -> np.ndarray:
        data, at = _text_of(book.others)
        return ((span_hashes(data, at[:-1], at[1:]) >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each shard the words of a book in the order of their numbers."""
        for book in _books(batches, shared.value[0], ROWS, BOOK_WORDS):
            (data, at), shard = _text_of(book.others), shard_of(book)
            order = np.argsort(shard, kind="stable")
            rows = []
            for s, o in by_shard(shard[order], order):
                sizes = np.diff(at)[o]
                rows.append((s, book.name, _planes(sizes), zipped(pieces_of(data, at[o], sizes).tobytes())))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 3), strict=True)], ["shard", "book", "sizes", "text"])

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The partition's distinct words, then for each book and shard which of them it asked for."""
        asked, sizes, text = [], [], []
        for batch in batches:
            for shard, book, n, t in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                asked.append((book, shard))
                sizes.append(_unplaned(n))
                text.append(unzipped(t))
        if not asked:
            return
        ends = np.cumsum(np.concatenate(sizes), dtype=np.int64)
        coded = pa.Array.from_buffers(pa.large_string(), len(ends), [None, pa.py_buffer(np.r_[0, ends]), pa.py_buffer(np.concatenate(text))]).dictionary_encode()
        words, which = coded.dictionary.cast(pa.string()), np.asarray(coded.indices).astype(np.int32)
        names, none = ["book", "shard", "which", "words"], pa.array([], pa.string())
        for k in range(0, len(words), FOLDED_AT_ONCE):
            some = words[k : k + FOLDED_AT_ONCE]
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([None], pa.int32()), pa.array([None], pa.binary()), _lists(np.array([0, len(some)]), some)], names)
        done = 0
        for (book, shard), n in zip(asked, sizes, strict=True):
            own = which[done : done + len(n)].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([book], pa.binary()), pa.array([shard], pa.int32()), pa.array([own], pa.binary()), _lists(np.array([0, 0]), none)], names)
            done += len(n)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ids of the words that a book asked a shard for, in their order."""
        sizes, ids, store = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], None
        for batch in batches:
            lists, _ = _flat(batch.column(3))
            values, edges = _flat(lists)
            if len(lists):
                sizes.append(np.diff(edges))
                ids.append(values.to_numpy(zero_copy_only=False))
            for book, shard, which in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                if which is None:
                    continue
                if store is None:  # all words of the partition have come
                    n = np.concatenate(sizes)
                    store = n, np.cumsum(n) - n, np.concatenate(ids)
                which = np.frombuffer(which, np.int32)
                n = store[0][which]
                parts = [_planes(n), _planes(pieces_of(store[2], store[1][which], n))]
                yield _row(book, 0, shard, struct.pack("<q", len(parts[0])) + b"".join(parts))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A book's shards by number, then its rows."""
        for book in _books(batches, shared.value[0], ROWS, BOOK_WORDS):
            yield _row(book.name, 1, 0, _planes(shard_of(book)))
            for part, (batch, numbers) in enumerate(zip(book.batches, book.numbers, strict=True)):
                rows = stored(batch)
                yield _row(book.name, 2, part, struct.pack("<q", len(rows)) + rows + _planes(numbers))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, answers, known = None, {}, None
        for batch in batches:
            for book, kind, part, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if book != name:
                    name, answers, known = book, {}, None
                if kind == 0:
                    answers[part] = data
                elif kind == 1:
                    known = _ids_by_number(shared.value[1], _unplaned(data), answers)
                else:
                    if known is None:
                        raise RuntimeError(CHANGED)
                    (n,) = struct.unpack_from("<q", data)
                    rows = pa.ipc.open_stream(data[8 : 8 + n]).read_next_batch()
                    numbers, at = _unplaned(data[8 + n :]), np.r_[0, np.cumsum(rows.column(width))]
                    n = known[0][numbers]
                    out = pieces_of(known[2], known[1][numbers], n)
                    yield body(pa.RecordBatch.from_arrays(rows.columns[:width], rest), pa.array(out.astype(np.int32)), np.r_[0, np.cumsum(n)][at])

    asked = held.select("part", "words").mapInArrow(tidy(ask), "shard int, book binary, sizes binary, text binary")
    met = asked.repartition(shards, "shard").mapInArrow(tidy(distinct), "book binary, shard int, which binary, words array<string>")
    folded = _with_tables(met, vocabulary.literal(df.sparkSession), "folded", lambda t: F.transform("words", lambda w: fold_merges(w, t, size))).drop("words")
    answers, bodies = folded.mapInArrow(tidy(answer), BOOK_ROWS), held.mapInArrow(tidy(write), BOOK_ROWS)
    ordered = bodies.union(answers).repartition(shards, "book").sortWithinPartitions("book", "kind", "part")
    return ordered.mapInArrow(tidy(assemble), schema)


#: What meets of a book: answers of shards (kind 0), the shards of its words (1), its rows (2).
BOOK_ROWS = "book binary, kind int, part int, data binary"
CHANGED = "the table gave other rows, or rows in another order, when it was read again"


def _row(book: bytes, kind: int, part: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([book], pa.binary()), pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([data], pa.binary())], ["book", "kind", "part", "data"])


def _ids_by_number(pieces: np.ndarray, shard: np.ndarray, answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many ids each number has, where they begin, and the ids: those of pieces, then
    those of other words as their shards answer."""
    k = len(pieces)
    sizes, begins = np.ones(k + len(shard), np.int64), np.arange(k + len(shard))
    ids, done = [pieces], k
    order = np.argsort(shard, kind="stable")
    for s, o in by_shard(shard[order], order):
        data = answers.get(s)
        if data is None:
            raise RuntimeError(CHANGED)
        (n,) = struct.unpack_from("<q", data)
        own, out = _unplaned(data[8 : 8 + n]), _unplaned(data[8 + n :])
        if len(own) != len(o):
            raise RuntimeError(CHANGED)
        sizes[k + o], begins[k + o] = own, done + np.cumsum(own) - own
        ids.append(out)
        done += len(out)
    return sizes, begins, np.concatenate(ids)


def encode(df: DataFrame, text: str, ids: str, vocabulary: Vocabulary, keep_text: bool = True) -> DataFrame:
    """df with the ids of the text, an array of ints; of a null or empty text, an empty array.
    A column of that name is replaced, all others keep their names."""
    rest = [c for c in df.columns if c != ids and (keep_text or c != text)]
    own = "text"
    while own in rest:
        own += "_"
    work = df.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias(own))
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in work.schema[:-1]], f"`{ids}` array<int>"])

    def body(rows: pa.RecordBatch, values: pa.Array, begins: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*rows.columns, _lists(begins, values)], [*rest, ids])

    return _encoded(work, own, vocabulary, body, schema)


def _decoded(ids: pa.Array, begins: np.ndarray, pieces: pa.Array) -> pa.Array:
    """The bytes of each list of ids: their pieces end to end."""
    return pc.binary_join(_lists(begins, pieces.take(ids)), b"")


def decode(df: DataFrame, ids: str, out: str, vocabulary: Vocabulary) -> DataFrame:
    """df with the bytes of the ids' pieces, end to end; empty for null ids. An id outside
    the vocabulary raises."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary.pieces)
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c != out])
    at, names = kept.columns.index(ids), [*kept.columns, out]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(shared.value, pa.binary())
        for batch in _per_slice(batches, ROWS):
            yield pa.RecordBatch.from_arrays([*batch.columns, _decoded(*_flat(batch.column(at)), pieces)], names)

    return kept.mapInArrow(tidy(join), kept.withColumn(out, F.lit(b"")).schema)


def default_vocabulary() -> Vocabulary:
    import public_tokenizers

    folder = os.environ.get("TOKENIZER_DIR")
    name = "byte_bpe_50k.tiktoken"
    return Vocabulary(os.path.join(folder, name) if folder else public_tokenizers.path(name), public_tokenizers.PATTERN)


def digest(df: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of df (doc_id, text): encoded, and the
    ids decoded again."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary.pieces)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def hashed(rows: pa.RecordBatch, ids: pa.Array, begins: np.ndarray) -> pa.RecordBatch:
        pieces = pa.array(shared.value, pa.binary())
        written = pc.binary_join(_lists(begins, pc.cast(ids, pa.string())), " ")
        columns = [pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in c], pa.string()) for c in (written, _decoded(ids, begins, pieces))]
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.diff(begins), pa.int64()), *columns], names)

    return _encoded(df.select("doc_id", "text"), "text", vocabulary, hashed, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to. Null text: empty."""
    return digest(documents(spark, sf_dir), default_vocabulary())
