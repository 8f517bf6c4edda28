"""Toxicity by a linear-chain conditional random field.

Labels are of documents. A feature (a word, or the first letters of one) that is far
more frequent in toxic documents than in clean ones marks tokens: in toxic documents the
tokens that have one are labelled toxic, all other tokens clean. From these labelled
tokens a two-state chain is trained: each token's score from its features, and a score
for each transition. The forward-backward pass gives each token's probability to be in a
toxic span; a document's score rises with the largest and the sum of these.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Texts, documents, mix64, slices, span_hashes, tidy, word_spans

#: Bound on the labelled documents that the chain is trained on, half of them toxic: those
#: of smallest hash. Features are counted over all labelled documents of the training fold.
TRAIN_DOCS = 1200
#: Bound on the features kept, by weight of evidence.
MOST_FEATURES = 20_000
#: Leading bytes of a word that are a feature beside the word itself.
PREFIXES = (4, 6)
#: A feature is evidence if it is in at least this share of the toxic documents, and in
#: this many of them: copies of one document must not make its words evidence.
LEAST_SHARE = 0.02
LEAST_DOCS = 4
SLICE_BYTES = 1 << 20
#: Labels of 16 bytes each that may be broadcast.
BROADCAST_LABELS = 2_000_000
#: Tokens that one step of the chain's recursion spans for all blocks at once.
BLOCK = 64


def _folded(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case, and all that is no letter or digit as the byte 0."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[np.r_[0:48, 58:65, 91:97, 123:128]] = 0
    return table[data]


def token_features(texts: Texts) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each word of a slice its features' hashes, one row a word, and the words' spans.
    Signs around a word are not part of it; features of a bare sign are those of the empty word."""
    spans = word_spans(texts)
    starts, ends, _ = spans
    folded = _folded(texts.data)
    if not len(starts):
        return np.zeros((0, 1 + len(PREFIXES)), np.uint64), spans
    letters = np.flatnonzero(folded)
    a = np.searchsorted(letters, starts)
    b = np.searchsorted(letters, ends) - 1
    bare = a > b
    last = len(letters) - 1
    first = np.where(bare, starts, letters[np.minimum(a, last)] if last >= 0 else starts)
    stop = np.where(bare, starts, letters[np.maximum(b, 0)] + 1 if last >= 0 else starts)
    out = np.empty((len(starts), 1 + len(PREFIXES)), np.uint64)
    out[:, 0] = span_hashes(folded, first, stop)
    for k, n in enumerate(PREFIXES):
        out[:, k + 1] = mix64(span_hashes(folded, first, np.minimum(first + n, stop)) + np.uint64(k + 1))
    return out, spans


@dataclass
class Chain:
    """features: sorted hashes; weights: what each adds to the score of the toxic state;
    bias: of every token; moves: score of going from state i to state j; document: weights
    of (1, log-odds of the largest marginal, log of one plus their sum)."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    moves: np.ndarray
    document: np.ndarray

    def emissions(self, features: np.ndarray) -> np.ndarray:
        if not len(self.features):
            return np.full(len(features), self.bias)
        at = np.minimum(np.searchsorted(self.features, features), len(self.features) - 1)
        return self.bias + np.where(self.features[at] == features, self.weights[at], 0.0).sum(axis=1)


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(emission: np.ndarray, first: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over documents end to end (first: where each begins, and the end).

    Returns each token's probability of the toxic state and, for each token but the first
    of a document, that of both states it and the one before it are in. Documents are cut
    into blocks; all blocks advance together, first to the matrix of each block, then,
    given what enters a block from either side, to its tokens."""
    n = len(emission)
    if n == 0:
        return np.zeros(0), np.zeros((0, 2, 2))
    move = np.exp(moves - moves.max())
    e = np.clip(emission, -30, 30)
    local = np.stack([1 / (1 + np.exp(e)), 1 / (1 + np.exp(-e))], axis=1)
    sizes = np.diff(first)
    docs = np.flatnonzero(sizes)
    blocks_of = -(-sizes[docs] // BLOCK)
    block_doc = np.repeat(np.arange(len(docs)), blocks_of)
    begin_block = np.cumsum(blocks_of) - blocks_of
    inner = np.arange(len(block_doc)) - begin_block[block_doc]
    start = first[docs][block_doc] + inner * BLOCK
    size = np.minimum(sizes[docs][block_doc] - inner * BLOCK, BLOCK)
    opening = np.zeros(n, bool)
    opening[first[docs]] = True

    def matrix(at: np.ndarray) -> np.ndarray:
        """From the state before token at to the state at it; a document's first token has none before."""
        m = move[None] * local[at][:, None, :]
        return np.where(opening[at][:, None, None], local[at][:, None, :] * np.full((1, 2, 1), 0.5), m)

    total = np.broadcast_to(np.eye(2), (len(start), 2, 2)).copy()
    for t in range(int(size.max())):
        live = np.flatnonzero(size > t)
        m = total[live] @ matrix(start[live] + t)
        total[live] = m / m.sum(axis=(1, 2), keepdims=True)
    enter = np.full((len(start), 2), 0.5)
    leave = np.full((len(start), 2), 0.5)
    longest = int(blocks_of.max())
    for k in range(1, longest):
        b = begin_block[blocks_of > k] + k
        enter[b] = _normal(np.einsum("bi,bij->bj", enter[b - 1], total[b - 1]))
    for k in range(longest - 1, 0, -1):
        b = begin_block[blocks_of > k] + k
        leave[b - 1] = _normal(np.einsum("bij,bj->bi", total[b], leave[b]))
    forward, backward = np.empty((n, 2)), np.empty((n, 2))
    state = enter
    for t in range(int(size.max())):
        live = np.flatnonzero(size > t)
        state[live] = _normal(np.einsum("bi,bij->bj", state[live], matrix(start[live] + t)))
        forward[start[live] + t] = state[live]
    state = leave
    for t in range(int(size.max()) - 1, -1, -1):
        live = np.flatnonzero(size > t)
        at = start[live] + t
        backward[at] = state[live]
        state[live] = _normal(np.einsum("bij,bj->bi", matrix(at), state[live]))
    toxic = _normal(forward * backward)[:, 1]
    inside = np.flatnonzero(~opening)
    pairs = forward[inside - 1][:, :, None] * move[None] * (local[inside] * backward[inside])[:, None, :]
    return toxic, pairs / pairs.sum(axis=(1, 2), keepdims=True)


def _summary(toxic: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each document (1, log-odds of the largest marginal, log of one plus their sum)."""
    n = len(first) - 1
    out = np.zeros((n, 3))
    out[:, 0], out[:, 1] = 1, -8
    full = np.flatnonzero(np.diff(first))
    if len(full):
        p = np.clip(np.maximum.reduceat(toxic, first[full]), 3.4e-4, 1 - 3.4e-4)
        out[full, 1] = np.log(p / (1 - p))
        out[full, 2] = np.log1p(np.add.reduceat(toxic, first[full]))
    return out


def _fit_document(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, each class weighted alike."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + 0.1 * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(hessian, gradient)
    return w


def _texts(table: pa.Table) -> Texts:
    batch = table.select(["doc_id", "text"]).combine_chunks().to_batches()
    return next(slices(iter(batch), 1 << 62))[1] if batch else Texts(np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(1, np.int64))


def _presence(rows: DataFrame, among: np.ndarray | None) -> DataFrame:
    """(feature, n): in how many documents of rows each feature is; with among, a sorted
    array, of these features alone."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, SLICE_BYTES):
            features, (_, _, first) = token_features(texts)
            doc = np.repeat(np.arange(len(texts.ids), dtype=np.uint64), np.diff(first))
            doc, flat = np.tile(doc, features.shape[1]), features.T.ravel()
            if among is not None:
                known = among[np.minimum(np.searchsorted(among, flat), max(0, len(among) - 1))] == flat if len(among) else np.zeros(len(flat), bool)
                doc, flat = doc[known], flat[known]
            order = np.lexsort((doc, flat))
            doc, flat = doc[order], flat[order]
            once = np.r_[True, (flat[1:] != flat[:-1]) | (doc[1:] != doc[:-1])] if len(flat) else np.zeros(0, bool)
            keys, n = np.unique(flat[once], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["feature", "n"])

    return rows.select("doc_id", "text").mapInArrow(tidy(count), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, docs_at_most: int = TRAIN_DOCS, steps: int = 40) -> Chain:
    """A chain from labelled documents (doc_id, text, toxic). Rows without a label are left
    out; without toxic documents the chain finds nothing toxic."""
    rows = labelled.filter(F.col("toxic").isNotNull()).select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))

    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    nothing = Chain(np.zeros(0, np.uint64), np.zeros(0), -8.0, np.zeros((2, 2)), np.array([-4.0, 0.0, 0.0]))
    if not n_toxic or not n_clean:
        return nothing
    least = max(LEAST_DOCS, LEAST_SHARE * n_toxic)
    # Of toxic documents every feature is counted; those in a fixed share of them are few
    # whatever the input, and only these are counted in clean documents.
    often = _presence(rows.filter("toxic = 1"), None).filter(F.col("n") >= least).toArrow()
    found_t = dict(zip(often["feature"].to_pylist(), often["n"].to_pylist(), strict=True))
    candidates = np.sort(np.fromiter(found_t, np.int64, len(found_t)).view(np.uint64))
    clean = _presence(rows.filter("toxic = 0"), candidates).toArrow()
    found_c = dict(zip(clean["feature"].to_pylist(), clean["n"].to_pylist(), strict=True))
    t = np.array([found_t[k] for k in candidates.view(np.int64).tolist()], float)
    c = np.array([found_c.get(k, 0) for k in candidates.view(np.int64).tolist()], float)
    odds = np.log((t + 0.5) / (n_toxic + 1.0)) - np.log((c + 0.5) / (n_clean + 1.0))
    kept = np.flatnonzero(odds > 2.0)
    kept = np.sort(kept[np.lexsort((candidates[kept], -odds[kept] * np.log1p(t[kept])))][:MOST_FEATURES])
    features, odds = candidates[kept], odds[kept]
    if not len(features):
        return nothing
    half = docs_at_most // 2
    by_hash = [rows.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(half).toArrow() for k in (1, 0)]
    sample = pa.concat_tables(by_hash)
    texts, y = _texts(sample), np.asarray(sample["toxic"])
    found, (_, _, first) = token_features(texts)
    doc = np.repeat(np.arange(len(y)), np.diff(first))
    at = np.minimum(np.searchsorted(features, found), len(features) - 1)
    has = features[at] == found
    # A toxic token is one that has a mark of good evidence, or its document's best mark.
    best = np.where(has, odds[at], 0.0).max(axis=1)
    top = np.zeros(len(y))
    np.maximum.at(top, doc, best)
    z = ((y[doc] == 1) & (best > 0) & ((best >= 4.0) | (best >= top[doc]))).astype(float)
    chain = Chain(features, np.zeros(len(features)), -2.0, np.zeros((2, 2)), np.zeros(3))
    inside = np.ones(len(z), bool)
    inside[first[:-1][np.diff(first) > 0]] = False
    inside = np.flatnonzero(inside)
    seen = np.zeros((2, 2))
    np.add.at(seen, (z[inside - 1].astype(int), z[inside].astype(int)), 1)
    # Gradient of the log-likelihood: what is labelled less what the chain expects. Adam steps.
    flat = np.zeros(len(features) + 5)
    flat[len(features)] = -2.0
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    rows_of, cols_of = np.nonzero(has)
    index = at[rows_of, cols_of]
    for step in range(1, steps + 1):
        chain.weights, chain.bias, chain.moves = flat[: len(features)], flat[len(features)], flat[len(features) + 1 :].reshape(2, 2)
        p, pairs = marginals(chain.emissions(found), first, chain.moves)
        gap = z - p
        gradient = np.r_[np.bincount(index, gap[rows_of], minlength=len(features)) - 0.02 * chain.weights, gap.sum(), (seen - pairs.sum(axis=0)).ravel() - 0.02 * chain.moves.ravel()]
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        flat = flat + 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    chain.weights, chain.bias, chain.moves = flat[: len(features)], flat[len(features)], flat[len(features) + 1 :].reshape(2, 2)
    p, _ = marginals(chain.emissions(found), first, chain.moves)
    chain.document = _fit_document(_summary(p, first), y.astype(float))
    return chain


def score(df: DataFrame, chain: Chain, spans: bool = False, threshold: float = 0.5) -> DataFrame:
    """df (doc_id, text, other columns) with score; with spans also toxic_spans, an array
    of (begin, end) in bytes of the text, of tokens that are likelier toxic than not.
    Texts without words, null ones included, get the score of a document without marks."""
    shared = df.sparkSession.sparkContext.broadcast(chain)
    ordered = df.select("doc_id", "text", *[F.col(f"`{c}`") for c in df.columns if c not in ("doc_id", "text", "score", "toxic_spans")])
    schema = ordered.withColumn("score", F.lit(0.0))
    if spans:
        schema = schema.withColumn("toxic_spans", F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.lit(0).cast("long").alias("end"))))
    schema = schema.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = shared.value
        for batch, texts in slices(batches, SLICE_BYTES):
            features, (starts, ends, first) = token_features(texts)
            toxic, _ = marginals(chain.emissions(features), first, chain.moves)
            scores = 1 / (1 + np.exp(-np.clip(_summary(toxic, first) @ chain.document, -30, 30)))
            columns, names = [*batch.columns, pa.array(scores)], [*batch.schema.names, "score"]
            if spans:
                hit = np.flatnonzero(toxic > threshold)
                doc = np.searchsorted(first, hit, side="right") - 1
                new = np.r_[True, (hit[1:] != hit[:-1] + 1) | (doc[1:] != doc[:-1])] if len(hit) else np.zeros(0, bool)
                head = np.flatnonzero(new)
                tail = np.r_[head[1:] - 1, len(hit) - 1] if len(head) else head
                owner = doc[head]
                values = pa.StructArray.from_arrays([pa.array(starts[hit[head]] - texts.starts[owner], pa.int64()), pa.array(ends[hit[tail]] - texts.starts[owner], pa.int64())], ["begin", "end"])
                offsets = np.searchsorted(owner, np.arange(len(texts.ids) + 1)).astype(np.int32)
                columns, names = [*columns, pa.ListArray.from_arrays(pa.array(offsets), values)], [*names, "toxic_spans"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return ordered.mapInArrow(tidy(run), schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is divisible by 5; a null id is in the training fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def trained_on(docs: DataFrame, labels: DataFrame) -> Chain:
    """The chain of those labelled documents that are not held out. Up to BROADCAST_LABELS
    labels are broadcast, so that texts stay where they are; more are joined by shuffle."""
    known = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    few = labels.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    return train(docs.filter(~held_out()).select("doc_id", "text").join(F.broadcast(known) if few else known, "doc_id"))


def op7_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, labelled or not."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    chain = trained_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, chain, spans=True)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "toxic_spans")
