"""Token counts by linear longest-match word pieces.

The vocabulary's pieces form a trie with two roots: of pieces that begin a word and of
those that continue one. A failure link leads from a node to where matching goes on after
the longest matches that its string starts with are taken; how many those are is known
beforehand. With the links resolved for every byte, a word's count is the sum of the
counts met while its bytes pass through one table: no piece is built.

Words of a slice advance together, one byte a step; equal words advance once.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .bpe import load_ranks
from .common import documents, equal_words, slices, word_spans

SLICE_BYTES = 4 << 20


class Automaton:
    """Transitions and popped-token counts over bytes.

    initial and rest are the pieces that begin and that continue a word; each must have
    all single bytes, so that every word has pieces. State 0 begins a word, state 1
    continues one."""

    def __init__(self, initial: set[bytes], rest: set[bytes]):
        children: list[dict[int, int]] = [{}, {}]
        ends = [False, False]
        for root, pieces in ((0, initial), (1, rest)):
            if any(bytes([b]) not in pieces for b in range(256)):
                raise ValueError("a single byte is no piece")
            for piece in sorted(pieces):
                node = root
                for byte in piece:
                    if byte not in children[node]:
                        children[node][byte] = len(children)
                        children.append({})
                        ends.append(False)
                    node = children[node][byte]
                ends[node] = True
        n = len(children)
        self.next = np.zeros((n, 256), np.int32)
        self.popped = np.zeros((n, 256), np.uint8)
        self.left = np.zeros(n, np.int64)  # tokens to pop where a word ends
        fail, pops = np.ones(n, np.int32), np.zeros(n, np.int64)
        layer, root = [0, 1], True
        while layer:
            below = []
            for u in layer:
                row, count = self.next[u], self.popped[u]
                if not root:
                    row[:] = self.next[fail[u]]
                    count[:] = np.minimum(self.popped[fail[u]] + pops[u], 255)
                    if pops[u] + int(self.popped[fail[u]].max()) > 255:
                        raise ValueError("a piece is too long")
                for byte, v in children[u].items():
                    if ends[v]:
                        fail[v], pops[v] = 1, 1
                    else:  # where the parent's link leads by this byte
                        fail[v], pops[v] = (self.next[fail[u], byte], pops[u] + self.popped[fail[u], byte])
                    self.left[v] = pops[v] + self.left[fail[v]]
                for byte, v in children[u].items():
                    row[byte], count[byte] = v, 0
                    below.append(v)
            layer, root = below, False

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word data[start : end]."""
        total, state = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int32)
        order = np.argsort(starts - ends, kind="stable")  # longest first
        starts, size = starts[order], (ends - starts)[order]
        for step in range(int(size[0]) if len(size) else 0):
            live = np.searchsorted(-size, -step, side="left")
            byte = data[starts[:live] + step]
            now = state[:live]
            total[:live] += self.popped[now, byte]
            state[:live] = self.next[now, byte]
        total += self.left[state]
        out = np.empty_like(total)
        out[order] = total
        return out


def pieces_of(ranks: dict[bytes, int]) -> tuple[set[bytes], set[bytes]]:
    """Pieces that begin and that continue words from a byte-level vocabulary: tokens with
    a leading space, without it, and tokens without one. Single bytes are pieces of both."""
    single = {bytes([b]) for b in range(256)}
    spaced = set(b" \t\n\v\f\r")
    plain = {t for t in ranks if t and not spaced & set(t)}
    return {t[1:] for t in ranks if t[:1] == b" " and len(t) > 1 and not spaced & set(t[1:])} | single, plain | single


def vocabulary_path() -> str:
    import public_tokenizers

    folder = os.environ.get("TOKENIZER_DIR")
    return os.path.join(folder, "byte_bpe_50k.tiktoken") if folder else public_tokenizers.path("byte_bpe_50k.tiktoken")


_built: dict[str, Automaton] = {}


def token_counts(df: DataFrame, pieces: tuple[set[bytes], set[bytes]], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_tokens) of each row of df. Null text: no words. The vocabulary is
    broadcast as it is; each Python worker builds its table once."""
    shared, name = df.sparkSession.sparkContext.broadcast(pieces), uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _built:
            _built.clear()
            _built[name] = Automaton(*shared.value)
        automaton = _built[name]
        for batch, texts in slices(batches, SLICE_BYTES):
            starts, ends, first = word_spans(texts)
            tokens = np.zeros(len(starts), np.int64)
            if len(starts):
                first_of, back = equal_words(texts.data, starts, ends)
                tokens = automaton.counts(texts.data, starts[first_of], ends[first_of])[back]
            sums = np.r_[0, np.cumsum(tokens)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(first), pa.int64()), pa.array(sums[first[1:]] - sums[first[:-1]], pa.int64())], [id_col, "n_words", "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text).mapInArrow(count, f"`{id_col}` {kind}, n_words bigint, n_tokens bigint")


def op6_longest_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece counts of all documents with the pieces of the byte-level vocabulary."""
    return token_counts(documents(spark, sf_dir), pieces_of(load_ranks(vocabulary_path())))
