"""N-gram Jaccard join: all links between documents whose sets of word n-grams are alike.

Documents of equal sets are one set. Small sets enumerate their subsets of the sizes that
an intersection with a linked set may have: sets that share one are linked or not by
their sizes alone. Large sets are looked up in inverted lists of the first tokens of each
set in an order of all tokens, among which linked sets must share one. The sizes that
count as small are those for which enumerating costs less than lists; both costs of a set are
bounded, so what is enumerated grows with the sets and not with the lengths of lists.

The order has tokens first that a sketch says occur in one document: those cannot be
shared and need no list. Others come by the number of sets that have them. Each set is compared
with the most central of those that head its lists; lists that this leaves in more than
one component are compared in full: short ones pair by pair, long ones block by block, by their
differences from a central set. So every pair of a list is linked, compared, or connected already, and a group of copies of
one text needs about as many comparisons as it has members.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NULL_ID, Texts, cut, documents, gram_hashes, joined_apart, mix64, span_hashes, tidy, word_spans
from .components import connected_components
from .packs import Pack, meet, rereadable
from .sketch import Estimates, estimates, ranges_of

PACK_BYTES = 2 << 20
#: No set of which more subsets would have to be enumerated is small.
SUBSETS_AT_MOST = 5000
#: What scanning an entry of an inverted list costs, in rows of an enumeration.
ENTRY_COST = 4
#: Entries of a list that a set counts as scanning at most: sets of a long list meet its head and
#: then blocks of others, not each other one by one.
ENTRIES_AT_MOST = 16
#: Sets that meet as many others at once where all of a cluster are compared.
BLOCK = 256
#: Pairs with one set on one side that meet in one place, and sets of a list that is compared pair
#: by pair: it makes at most half as many pairs a set.
STAR = 64
#: Buckets in which hashes of two sets are counted before the sets themselves are compared.
BUCKETS = 128
_SECOND = np.uint64(0x6A09E667F3BCC909)


def shingles(texts: Texts, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the distinct word n-grams of each document of a slice, sorted;
    of documents with fewer words, the whole sequence. A-Z count as a-z."""
    data = texts.data.copy()
    upper = (data >= 65) & (data <= 90)
    data[upper] += 32
    starts, ends, first = word_spans(texts)
    words = span_hashes(data, starts, ends)
    counts = np.diff(first)
    grams = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(counts)), grams)
    at = first[:-1][doc] + np.arange(len(doc)) - (np.cumsum(grams) - grams)[doc]
    length = np.minimum(counts, n)[doc]
    hashes = np.empty(len(doc), np.uint64)
    for k in np.unique(length).tolist():
        some = length == k
        hashes[some] = gram_hashes(words, k)[at[some]]
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])] if len(doc) else np.zeros(0, bool)
    return doc[new], hashes[new]


def prefix_size(size, num: int, den: int):
    """Tokens of which a set of that size must share one with any set linked to it."""
    return size - (num * size + den - 1) // den + 1


def subsets(values: np.ndarray, num: int, den: int) -> Iterator[tuple[int, int, int]]:
    """(size, two hashes) of the subsets that may be an intersection with a linked set."""
    a, b = mix64(values), mix64(values ^ _SECOND)
    whole = (int(a.sum(dtype=np.uint64)), int(b.sum(dtype=np.uint64)))
    a, b = a.tolist(), b.tolist()
    s, mask = len(a), (1 << 64) - 1
    for gone in range((den - num) * s // den + 1):
        for out in combinations(range(s), gone):
            yield s - gone, (whole[0] - sum(a[i] for i in out)) & mask, (whole[1] - sum(b[i] for i in out)) & mask


def subset_count(size: int, num: int, den: int) -> int:
    """How many subsets a set of that size enumerates."""
    return sum(math.comb(size, j) for j in range((den - num) * size // den + 1))


def most_enumerated(num: int, den: int) -> int:
    """The largest size of which one set enumerates SUBSETS_AT_MOST subsets."""
    size = 0
    while size < SUBSETS_AT_MOST and subset_count(size + 1, num, den) <= SUBSETS_AT_MOST:
        size += 1
    return size


def boundary(sizes: dict[int, tuple[int, int]], num: int, den: int) -> int:
    """The largest size that counts as small: of all boundaries the one of least cost. sizes
    has for each size the number of its sets and of the list entries that they would scan."""
    best, gain, at = 0, 0, 0
    for s in range(1, most_enumerated(num, den) + 1):
        count, entries = sizes.get(s, (0, 0))
        gain += entries * ENTRY_COST - count * subset_count(s, num, den)
        if gain > best:
            best, at = gain, s
    return at


def tested_below(num: int, den: int) -> int:
    """The largest hash, as a signed long, of tokens that are sketched and counted: a share of
    all that gives a set more of them than its prefix needs."""
    share = min(1.0, 2.5 * (den - num) / den)
    return int(np.array(min(int(share * 2**64), 2**64 - 1), np.uint64).view(np.int64))


def _sets(df: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """A row for each document of df (doc_id, text, key): id, key, size, h1 and h2 of its set, the
    tokens that may be looked up and how many of them need be, and the set itself where it
    may be asked for.

    The order of tokens: those below a hash that a sketch says are in one document, the
    others below it by how many sets have them, those above it by hash."""
    below, most = np.int64(tested_below(num, den)).view(np.uint64), most_enumerated(num, den)
    ranges = ranges_of(df)

    def tested(texts: Texts) -> np.ndarray:
        _, hashes = shingles(texts, n)
        return hashes[hashes <= below]

    def sets(pack: Pack, data: list[bytes]) -> Iterator[pa.RecordBatch]:
        texts = pack.texts
        doc, hashes = shingles(texts, n)
        size = np.bincount(doc, minlength=len(texts.ids))
        first = np.r_[0, np.cumsum(size)]
        kind = np.full(len(hashes), 2, np.int8)
        low = np.flatnonzero(hashes <= below)
        again, _ = Estimates(hashes[low], data, ranges).of(hashes[low])
        kind[low] = again
        order = np.lexsort((hashes, kind, doc))
        rank, kind = np.arange(len(order)) - first[:-1][doc], kind[order]
        prefix = prefix_size(size, num, den)
        need = np.maximum(0, prefix - np.bincount(doc[kind == 0], minlength=len(size)))
        chosen = order[(need > 0)[doc] & ((kind == 1) | ((kind == 2) & (rank < prefix[doc])))]
        tokens = np.bincount(doc[chosen], minlength=len(size))
        sums = [np.zeros(len(size), np.uint64) for _ in range(2)]
        full = np.flatnonzero(size)
        if len(full):
            for out, values in zip(sums, (mix64(hashes), mix64(hashes ^ _SECOND)), strict=True):
                out[full] = np.add.reduceat(values, first[full])
        held = [hashes[first[i] : first[i + 1]].tobytes() if tokens[i] or 0 < size[i] <= most else None for i in range(len(size))]
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(tokens)].astype(np.int32)), pa.array(hashes[chosen].view(np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(texts.ids), pack.batch.column(2), pa.array(size.astype(np.int64)), *[pa.array(x.view(np.int64)) for x in sums], pa.array(need.astype(np.int64)), lists, pa.array(held, pa.binary())], ["id", "key", "size", "h1", "h2", "need", "tokens", "held"])

    return meet(df, estimates(df, tested, PACK_BYTES), sets, "id long, key long, size long, h1 long, h2 long, need long, tokens array<long>, held binary", PACK_BYTES, all_found=True)


def _small_links(small: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) of small sets (id, size, held): of those that share a subset, each with
    the smallest, if subset and sizes make them alike. Where two are alike, both are alike
    to the smallest one, so no component is torn."""

    def enumerate_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, s, held in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                out += [(c, x, y, i, s) for c, x, y in subsets(np.frombuffer(held, np.uint64), num, den)]
            c, x, y, i, s = zip(*out, strict=True) if out else ((),) * 5
            signed = [np.array(v, np.uint64).view(np.int64) for v in (x, y)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), *map(pa.array, signed), pa.array(i, pa.int64()), pa.array(s, pa.int64())], ["c", "x", "y", "id", "size"])

    rows = small.select("id", "size", "held").mapInArrow(tidy(enumerate_all), "c long, x long, y long, id long, size long")
    groups = cut(rows.groupBy("c", "x", "y").agg(F.min(F.struct("size", "id")).alias("least"), F.count("*").alias("n")).filter("n > 1"))
    alike = F.col("c") * den >= (F.col("size") + F.col("least.size") - F.col("c")) * num
    return rows.join(groups, ["c", "x", "y"]).filter(alike & (F.col("id") != F.col("least.id"))).select(F.col("id").alias("a"), F.col("least.id").alias("b"))


def _compatible(a: str, b: str, num: int, den: int):
    return (F.col(a) * den >= F.col(b) * num) & (F.col(b) * den >= F.col(a) * num)


def _verified(pairs: DataFrame, held: DataFrame, num: int, den: int) -> DataFrame:
    """Those of pairs (a, b) whose sets (id, held) are alike. A set b of very many pairs is
    sent to as many places as STAR pairs each need."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both * den >= (len(x) + len(y) - both) * num)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    places = cut(pairs.groupBy("b").agg(F.ceil(F.count("*") / STAR).cast("int").alias("places")))
    dealt = pairs.join(places, "b").withColumn("place", F.pmod(F.xxhash64("a"), "places").cast("int")).select("a", "b", "place")
    one = held.toDF("a", "x")
    two = held.toDF("b", "y").join(places, "b").select("b", "y", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place"))
    return dealt.join(one, "a").join(two, ["b", "place"]).select("a", "b", "x", "y").mapInArrow(tidy(compare), "a long, b long")


def _from_centres(rows: DataFrame, centres: DataFrame) -> DataFrame:
    """rows (cluster, id, size, component, held) as they differ from their cluster's centre:
    added and missing, hashes the set has and the centre has not, and the other way round.
    centres: (cluster, centre, places), the centre's set and how many places its cluster is
    dealt to."""

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            added, missing = [], []
            for x, y in zip(batch.column("held"), batch.column("centre"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.int64) for v in (x, y))
                added.append(np.setdiff1d(x, y, assume_unique=True))
                missing.append(np.setdiff1d(y, x, assume_unique=True))
            lists = [pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(v) for v in c])].astype(np.int32)), pa.array(np.concatenate(c) if c else np.zeros(0, np.int64))) for c in (added, missing)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("cluster", "id", "size", "component")], *lists], ["cluster", "id", "size", "component", "added", "missing"])

    few = centres.select("cluster", "places").withColumnRenamed("cluster", "_c")
    dealt = rows.join(few, F.col("cluster") == F.col("_c")).withColumn("place", F.pmod(F.xxhash64("id"), "places").cast("int"))
    spread = centres.select("cluster", "centre", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place"))
    met = dealt.join(spread, ["cluster", "place"]).select("cluster", "id", "size", "component", "held", "centre")
    return met.mapInArrow(tidy(differ), "cluster long, id long, size long, component long, added array<long>, missing array<long>")


def _block_links(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between sets of different components in one cluster: rows (cluster, n,
    id, size, component, added, missing), the sets as they differ from a centre.

    Of two sets x and y, |x & y| = |x| - added(x) - missing(y) + what they have added alike and
    are missing alike. Members of a cluster are dealt to blocks of about BLOCK and every two
    blocks meet once, so a set travels once for each block, not for each pair, and of its
    hashes only those that differ. In a meeting only links that join components are given."""
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK).cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    dealt = rows.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
    met = dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).select("cluster", "i", "j", "id", "size", "component", "added", "missing")

    def meet(table: pa.Table) -> pa.Table:
        ids, component, sizes = (np.asarray(table[c]) for c in ("id", "component", "size"))
        added, missing = (table[c].combine_chunks() for c in ("added", "missing"))
        n_added, n_missing = (np.asarray(pc.list_value_length(c)) for c in (added, missing))
        # Which hash is missing and which added does not matter: the centre has it or not.
        owner = np.concatenate([np.repeat(np.arange(len(ids)), n) for n in (n_added, n_missing)])
        values, place = np.unique(np.concatenate([np.asarray(c.flatten()) for c in (added, missing)]), return_inverse=True)
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        both = np.zeros((len(ids), len(ids)), np.float32)
        for at in range(0, len(values), 2048):
            low, high = np.searchsorted(place, [at, at + 2048])
            has = np.zeros((len(ids), min(2048, len(values) - at)), np.float32)
            has[owner[low:high], place[low:high] - at] = 1
            both += has @ has.T
        root = {int(c): int(c) for c in component}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        out = []
        for x in range(len(ids) - 1):
            shared = both[x, x + 1 :].astype(np.int64) + sizes[x] - n_added[x] - n_missing[x + 1 :]
            alike = (shared * den >= (sizes[x] + sizes[x + 1 :] - shared) * num) & (component[x + 1 :] != component[x])
            for y in (np.flatnonzero(alike) + x + 1).tolist():
                u, v = find(int(component[x])), find(int(component[y]))
                if u != v:
                    root[max(u, v)] = min(u, v)
                    out.append((int(ids[x]), int(ids[y])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return met.groupBy("cluster", "i", "j").applyInArrow(meet, "a long, b long")


def _may_link(rows: DataFrame, num: int, den: int) -> DataFrame:
    """rows (cluster, id, size, added, ...) without sets that have too many hashes which no
    other set of their cluster has: they can be alike to none of it."""
    added = rows.select("cluster", "id", F.explode("added").alias("token"))
    alone = added.groupBy("cluster", "token").agg(F.min("id").alias("id"), F.count("*").alias("n")).filter("n = 1")
    own = alone.groupBy("cluster", "id").agg(F.count("*").alias("own"))
    kept = (F.col("size") - F.coalesce("own", F.lit(0))) * den >= F.col("size") * num
    return rows.join(own, ["cluster", "id"], "left").filter(kept).drop("own")


def _listed(rows: DataFrame, lengths: DataFrame, num: int, den: int) -> DataFrame:
    """The entries (token, id, size, n) of the lists that are looked up: of each set the first
    `need` tokens of its rows (id, size, need, place, token) in the order of tokens, of those
    that other sets have too. lengths: (token, n), the sets that have each."""
    # In a document's array tokens below the tested hash come first, each by hash.
    below = tested_below(num, den)
    tested = F.col("token").between(0, below) if below >= 0 else (F.col("token") >= 0) | (F.col("token") <= below)
    rank = F.row_number().over(Window.partitionBy("id").orderBy(~tested, F.when(tested, F.col("n")), "place"))
    return rows.join(lengths, "token").withColumn("rank", rank).filter("rank <= need and n > 1").select("token", "id", "size", "n")


def _short_pairs(rows: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b), a < b, of sets of different components and like sizes that share a list
    of rows (token, id, size, component); each once."""
    one = rows.select("token", F.col("id").alias("a"), F.col("size").alias("a_size"), F.col("component").alias("a_component"))
    two = rows.select("token", F.col("id").alias("b"), F.col("size").alias("b_size"), F.col("component").alias("b_component"))
    apart = (F.col("a") < F.col("b")) & (F.col("a_component") != F.col("b_component")) & _compatible("a_size", "b_size", num, den)
    return one.join(two.withColumnRenamed("token", "_token"), (F.col("token") == F.col("_token")) & apart).select("a", "b").distinct()


def _may_be_alike(pairs: DataFrame, held: DataFrame, num: int, den: int) -> DataFrame:
    """pairs (a, b) without those of which the numbers of hashes in each of BUCKETS buckets say that
    their sets (id, held) share too few. What is left is compared itself."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.bincount(np.frombuffer(v.as_buffer(), np.uint64) & np.uint64(BUCKETS - 1), minlength=BUCKETS).astype(np.uint32).tobytes() for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.binary())], ["id", "counts"])

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, BUCKETS) for k in (2, 3))
            both, sizes = np.minimum(x, y).sum(axis=1, dtype=np.int64), (x.sum(axis=1, dtype=np.int64) + y.sum(axis=1, dtype=np.int64))
            yield batch.select(["a", "b"]).filter(pa.array(both * den >= (sizes - both) * num))

    asked = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    counts = cut(held.join(asked, "id", "left_semi").mapInArrow(tidy(count), "id long, counts binary"))
    return pairs.join(counts.toDF("a", "x"), "a").join(counts.toDF("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(tidy(bound), "a long, b long")


def _list_links(listed: DataFrame, known: DataFrame, held: DataFrame, num: int, den: int) -> DataFrame:
    """All links (a, b) needed for the components of the sets in lists (token, id, size, n),
    given links known already; these are included.

    A set is first compared with one other: of those that head its lists the most central,
    whose lists are the longest. What a group of copies was made from is in more lists than
    any copy, so most of the group is joined by one comparison each. Of lists that are still in
    several components, those of up to STAR sets give their pairs, so sets that have a token in
    common by chance make pairs and no chain of lists. Longer ones put their members into
    clusters, in which all are compared by how they differ from one of them."""
    weight = listed.groupBy("id").agg(F.sum("n").alias("weight"))
    members = cut(listed.join(weight, "id").select("token", "id", "size", "weight"))
    heads = members.groupBy("token").agg(F.max(F.struct("weight", "id", "size")).alias("head"))
    tried = joined_apart(members, heads, "token").withColumns({"head_id": F.col("head.id"), "head_size": F.col("head.size")})
    best = tried.filter(_compatible("size", "head_size", num, den) & (F.col("id") != F.col("head_id"))).groupBy("id").agg(F.max("head").alias("head"))
    pairs = cut(best.select(F.col("id").alias("a"), F.col("head.id").alias("b")))
    links = cut(_verified(pairs, held, num, den).union(known))
    named = cut(members.join(connected_components(links).toDF("id", "component"), "id", "left").withColumn("component", F.coalesce("component", "id")))
    ends = named.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"))
    left = cut(joined_apart(named, ends.filter("low < high").select("token", "members", F.col("low").alias("first")), "token"))
    short, long = left.filter(F.col("members") <= STAR), left.filter(F.col("members") > STAR)
    torn = cut(held.join(left.select("id").distinct(), "id", "left_semi"))
    links = links.union(_verified(cut(_may_be_alike(cut(_short_pairs(short, num, den)), torn, num, den)), torn, num, den))
    if long.isEmpty():
        return links
    # Long lists that share a component are one cluster, and all of their members are in it.
    clusters = connected_components(long.select(F.col("component").alias("a"), F.col("first").alias("b"))).toDF("component", "cluster")
    inside = cut(long.select("id", "size", "weight", "component").distinct().join(clusters, "component"))
    found = cut(inside.groupBy("cluster").agg(F.max(F.struct("weight", "id")).alias("most"), F.count("*").alias("n")))
    central = found.select("cluster", F.col("most.id").alias("id"), F.ceil(F.col("n") / STAR).cast("int").alias("places")).join(torn, "id")
    sets = inside.join(torn, "id").select("cluster", "id", "size", "component", "held")
    differing = cut(_from_centres(sets, central.select("cluster", F.col("held").alias("centre"), "places")))
    ready = cut(_may_link(differing, num, den))
    counts = ready.groupBy("cluster").agg(F.count("*").alias("n")).filter("n > 1")
    return links.union(_block_links(joined_apart(ready, counts, "cluster"), num, den))


def _numbered(base: DataFrame) -> DataFrame:
    """base (h1, h2, size, ...) with node, a number of each set: a hash of the three, by the
    first seed for which no two sets have the same one. Rows without words have none."""
    three = F.struct("h1", "h2", "size")
    for seed in itertools.count():
        rows = base.withColumn("node", F.when(F.col("size") > 0, F.xxhash64("h1", "h2", "size", F.lit(seed))))
        shared = rows.filter("size > 0").groupBy("node").agg(F.min(three).alias("low"), F.max(three).alias("high")).filter("low <> high")
        if shared.isEmpty():
            return rows


def linked(df: DataFrame, n: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """(id, key, size, node) of each row of df (doc_id, text): NULL_ID for a null id, a hash
    of the text, the size of its set, and a number that rows have in common when their sets
    link, over any others. Rows without words have none.

    Sets are told apart by their hashes, never by ids, which different texts may share."""
    base = _numbered(cut(_sets(rereadable(df.select("doc_id", "text", F.xxhash64("text").alias("key"))), n, num, den)))
    most = most_enumerated(num, den)
    sets = cut(base.filter("size > 0").groupBy("node", "size").agg(F.first("tokens").alias("tokens"), F.first("need").alias("need"), F.first(F.when(F.col("size") <= most, F.col("held"))).alias("held")))
    reps = sets.withColumnRenamed("node", "id")
    rows = cut(reps.select("id", "size", "need", F.posexplode("tokens").alias("place", "token")))
    lengths = cut(rows.groupBy("token").agg(F.count("*").alias("n")))
    listed = cut(_listed(rows, lengths, num, den))
    sizes = reps.filter(F.col("size") <= most).groupBy("size").agg(F.count("*").alias("sets"))
    entries = listed.filter(F.col("size") <= most).groupBy("size").agg(F.sum(F.least("n", F.lit(ENTRIES_AT_MOST))).alias("entries"))
    measured = {r["size"]: (r["sets"], r["entries"] or 0) for r in sizes.join(entries, "size", "left").collect()}  # a row for each size
    small = boundary(measured, num, den)
    # A small set may link with one just above the boundary, so it is looked up as well.
    known = _small_links(reps.filter(F.col("size") <= small), num, den)
    held = base.filter("held is not null and size > 0").groupBy(F.col("node").alias("id")).agg(F.first("held").alias("held"))
    found = cut(connected_components(_list_links(listed.filter(F.col("size") * den >= (small + 1) * num), known, held, num, den)))
    rows = base.select("id", "key", "size", "node").join(found.toDF("node", "component"), "node", "left")
    return rows.select("id", "key", "size", F.coalesce("component", "node").alias("node"))


def components(df: DataFrame, n: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of df (doc_id, text): documents link
    when den * |intersection| >= num * |union| of their sets. Documents without words have
    an empty set and link with nothing, equal ones neither. A null id counts as smaller
    than all others, and equal to the smallest long. Equal rows are linked with each other. component_id is the smallest
    doc_id of the component; where components share that doc_id, they share the name."""
    rows = cut(linked(df, n, num, den))
    names = cut(rows.filter("size > 0").groupBy("node").agg(F.min("id").alias("component")))
    real = lambda c: F.when(c != NULL_ID, c)
    return rows.join(names, "node", "left").select(real(F.col("id")).alias("doc_id"), F.col("size").alias("n_shingles"), real(F.coalesce("component", "id")).alias("component_id"))


def op3_heavy_light(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by word trigrams at 90 in 100."""
    return components(documents(spark, sf_dir), 3, 90, 100)
