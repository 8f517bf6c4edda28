"""Operators on their own interfaces: properties, codecs, skew, nulls, clashing columns."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wayfare.llm import bpe, common, components, fingerprints, jaccard, mixing, packs, sharding, sketch, substring, suffixes, tiff, toxicity, wordpiece
from wayfare.llm.common import Texts, byte_grams, cut, gram_hashes, sliding_min, span_hashes, two_smallest
from wayfare.llm.packs import meet

from .test_queries import components as brute_components


@pytest.mark.parametrize("letters,size", [(1, 50), (2, 300), (3, 1000), (200, 700)])
def test_two_stage_order(letters, size):
    random.seed(letters)
    data = np.array([random.randrange(1, letters + 1) for _ in range(size)], np.uint8)
    raw = data.tobytes()
    order = suffixes.two_stage_order(data, size)
    assert order.tolist() == sorted(range(size), key=lambda i: raw[i:])
    prefixes = suffixes.adjacent_prefixes(data, order, size)
    for k in range(1, size):
        a, b = raw[order[k - 1] :], raw[order[k] :]
        n = next((j for j in range(min(len(a), len(b))) if a[j] != b[j]), min(len(a), len(b)))
        assert prefixes[k] == n


def starts_found(df, found):
    """(id, start) of all windows of found, which is of df's packs."""

    def task(pack, data):
        doc, first, last = substring.unpacked_runs(data)
        yield pa.RecordBatch.from_arrays([pa.array(pack.texts.ids[doc]), pa.array(first), pa.array(last)], ["id", "first", "last"])

    rows = meet(df, found, task, "id long, first long, last long", suffixes.PACK_BYTES).collect()
    return {(r.id, k) for r in rows for k in range(r["first"], r["last"] + 1)}


def test_shards_follow_bytes_not_partitions(spark, tmp_path, monkeypatch):
    """A table read as one partition is dealt to as many tasks as its bytes ask for."""
    spark.range(20_000).selectExpr("id AS doc_id", "sha2(string(id), 256) AS text").coalesce(1).write.parquet(str(tmp_path / "one"))
    df = spark.read.parquet(str(tmp_path / "one"))
    monkeypatch.setattr("wayfare.llm.packs.PARTITION_BYTES", 1 << 16)
    assert df.rdd.getNumPartitions() == 1
    assert packs.partitions(df, 2, 1) >= 2 * 10


@pytest.mark.parametrize("heavy,at_most", [(1000, 1), (5, 1), (5, 1 << 19)])
def test_word_windows_in_parts(spark, monkeypatch, heavy, at_most):
    """The same runs however many windows meet at once and whether an anchor is split."""
    monkeypatch.setattr("wayfare.llm.sketch.HEAVY", heavy)
    monkeypatch.setattr(substring, "GROUP_WINDOWS", at_most)
    monkeypatch.setattr(substring, "PACK_BYTES", 2000)
    monkeypatch.setattr(suffixes, "PACK_BYTES", 2000)  # of starts_found
    line = " ".join(f"line{k}" for k in range(12))
    texts = [f"{' '.join(f'a{i % 30}x{k}' for k in range(12))} {line} {' '.join(f'b{i % 20}x{k}' for k in range(12))}" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).cache()
    got, seen, want = starts_found(df, substring.repeated_runs(df)), set(), set()
    for i, t in enumerate(texts):
        words = t.split()
        for k in range(len(words) - 19):
            w = tuple(words[k : k + 20])
            if w in seen:
                want.add((i, k))
            seen.add(w)
    assert got == want and want


def test_parts_are_bounded():
    rng = np.random.default_rng(2)
    labels, counts = rng.integers(0, 40, 300).astype(np.uint32), rng.integers(1, 20, 300).astype(np.int32)
    row = (b"p", np.zeros(300, np.int32).tobytes(), np.zeros(300, np.int64).tobytes(), np.zeros(300, np.int64).tobytes(), counts.tobytes(), labels.tobytes(), np.zeros(300, np.int32).tobytes(), substring.zipped(b""))
    parts = list(substring.Stretches([row]).parts(200))
    assert sorted(np.concatenate(parts).tolist()) == list(range(300)) and len(parts) > 5
    assert all(counts[o].sum() <= 200 or len(set(labels[o])) == 1 for o in parts)
    assert sum(len(set(labels[o])) for o in parts) == len(set(labels))


@pytest.mark.parametrize("heavy,pack", [(5, 1 << 20), (5, 2000), (1000, 700)])
def test_heavy_anchors_are_split(spark, monkeypatch, heavy, pack):
    monkeypatch.setattr("wayfare.llm.sketch.HEAVY", heavy)
    monkeypatch.setattr(suffixes, "PACK_BYTES", pack)
    line = "".join(chr(97 + (k * k) % 26) for k in range(130))
    texts = [f"{i}" * 40 + line + f"{i + 1}" * 40 for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = starts_found(df, suffixes.repeated_runs(df))
    seen, want = set(), set()
    for i, t in enumerate(texts):
        for k in range(len(t) - 99):
            if t[k : k + 100] in seen:
                want.add((i, k))
            seen.add(t[k : k + 100])
    assert got == want and want


def test_packs_of_a_changed_table(spark):
    df = spark.createDataFrame([(1, "a b " * 30), (2, "c d " * 30)], "doc_id long, text string").coalesce(1)
    other = spark.createDataFrame([(1, "a b " * 30), (2, "c d " * 31)], "doc_id long, text string").coalesce(1)
    with pytest.raises(Exception, match="in another order"):
        meet(df, substring.repeated_runs(other), lambda pack, data: iter([pack.batch]), df.schema, 1 << 20).collect()


def thue_morse(n):
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_hashes_and_minima():
    words = [w.encode() for w in (*thue_morse(12), "a", "b", "ab", "ba", "a" * 8, "a" * 9, "", "12345678", "123456789", "1234567812345678")]
    data = np.frombuffer(b" ".join([*words, *words]), np.uint8)
    sizes = np.array([len(w) for w in [*words, *words]])
    ends = np.cumsum(sizes + 1) - 1
    for seed in (0, 1):
        h = span_hashes(data, ends - sizes, ends, seed)
        assert (h[: len(words)] == h[len(words) :]).all() and len(set(h.tolist())) == len(words)
    codes = np.random.default_rng(2).integers(0, 2, 400).astype(np.uint64)
    for k in (1, 2, 3, 5, 8, 20):
        found = {}
        for i, g in enumerate(gram_hashes(codes, k).tolist()):
            assert found.setdefault(tuple(codes[i : i + k].tolist()), g) == g
        assert len(set(found.values())) == len(found)
    raw = np.random.default_rng(3).integers(97, 99, 3000).astype(np.uint8)
    for k in (8, 12, 24, 100):
        found = {}
        for i, g in enumerate(byte_grams(raw, k).tolist()):
            assert found.setdefault(raw[i : i + k].tobytes(), g) == g
        assert len(set(found.values())) == len(found)
    x = np.random.default_rng(1).integers(0, 40, 300).astype(np.uint64)
    for w in (1, 2, 7, 64):
        assert (sliding_min(x, w) == [x[i : i + w].min() for i in range(300 - w + 1)]).all()
        for i, (a, b) in enumerate(zip(*two_smallest(x, w))):
            others = sorted(set(x[i : i + w].tolist()))
            assert a == others[0] and b == (others[1] if len(others) > 1 else 2**64 - 1)


def test_estimates_are_never_too_low():
    rng = np.random.default_rng(5)
    packs = [np.unique(rng.integers(0, 30_000, 5000).astype(np.uint64)) for _ in range(10)]
    keys, n = np.unique(np.concatenate(packs), return_counts=True)
    true = dict(zip(keys.tolist(), n.tolist()))
    found = sketch.merged([sketch._cells(k) for k in packs], [np.ones(len(k), np.uint8) for k in packs])
    got = {k: e for pack, part in zip(packs, found) for k, e in zip(pack.tolist(), part.tolist())}
    assert all(got[k] >= n for k, n in true.items())
    # At ten and more times the keys the share of unique ones that pass stays the same.
    for size in (20_000, 400_000):
        unique = np.arange(size).astype(np.uint64)
        assert (sketch.merged([sketch._cells(unique)], [np.ones(size, np.uint8)])[0] > 1).mean() < 0.06


def test_colliding_words_are_told_apart(spark):
    a, b = thue_morse(12)
    tail = " ".join(f"w{k}" for k in range(19))
    df = spark.createDataFrame([(1, f"{a} {tail}"), (2, f"{b} {tail}"), (3, f"{a} {tail}")], "doc_id long, text string").coalesce(2)
    assert [r.text for r in substring.dedup(df).orderBy("doc_id").collect()] == [f"{a} {tail}", f"{b} {tail}", ""]
    one, two = (spark.createDataFrame([(1, a), (2, b), (3, f"{a} {tail}"), (4, f"{b} {tail}")], "doc_id long, text string") for _ in range(2))
    assert sorted(r.component_id for r in jaccard.components(one, 3, 90, 100).collect()) == [1, 2, 3, 4]
    pieces = wordpiece.pieces_of(bpe.load_ranks(wordpiece.vocabulary_path()))
    counts = {r.doc_id: r.n_tokens for r in wordpiece.token_counts(two, pieces).collect()}
    alone = {r.doc_id: r.n_tokens for k in (1, 2) for r in wordpiece.token_counts(two.filter(f"doc_id = {k}"), pieces).collect()}
    assert counts[1] == alone[1] and counts[2] == alone[2]


def test_dedup_keeps_other_columns_and_nulls(spark, corpus):
    df = spark.createDataFrame([(i, t, f"c{i}", i) for i, t, *_ in corpus], "doc_id long, text string, cuts_of string, id long")
    out = {r.doc_id: r for r in substring.dedup(df.withColumnRenamed("cuts_of", "first")).collect()}
    assert len(out) == len(corpus) and out[1].text is None and out[0].text == corpus[0][1] and out[3].text == ""
    assert out[5].first == "c5" and out[5].id == 5


def test_jaccard_of_near_copies(spark):
    random.seed(5)
    base = [f"b{k}" for k in range(80)]
    texts = [" ".join(base)]
    for k in range(60):
        w = list(base)
        for _ in range(random.randrange(1, 4)):
            w[random.randrange(80)] = f"n{k}x{random.random()}"
        texts.append(" ".join(w))
    texts += [" ".join(f"s{k % 4}y{j}" for j in range(12 + k % 3)) for k in range(24)]
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)} for i, t in enumerate(texts)}
    for num, den in ((90, 100), (80, 100)):
        got = jaccard.components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3, num, den).collect()
        assert {r.doc_id: r.component_id for r in got} == brute_components(sets, num, den)


@pytest.mark.parametrize("star", [2, 64])
def test_lists_shared_by_chance_make_no_cluster(spark, monkeypatch, star):
    """Texts of one of 12 beginnings and one of 12 ends: all lists hang together, no two texts are
    alike but near copies, which long and short lists find."""
    clusters = []
    from_centres = jaccard._from_centres

    def counted(rows, centres):
        clusters.append(rows.count())
        return from_centres(rows, centres)

    monkeypatch.setattr(jaccard, "_from_centres", counted)
    monkeypatch.setattr(jaccard, "STAR", star)
    part = lambda name, k: " ".join(f"{name}{k}w{j}" for j in range(30))
    texts = [f"{part('a', i)} {part('b', j)}" for i in range(12) for j in range(12)]
    texts += [t.replace("w29 ", f"x{k} ", 1) for k, t in enumerate(texts[::9])]
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)} for i, t in enumerate(texts)}
    got = jaccard.components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3, 90, 100).collect()
    want = brute_components(sets, 90, 100)
    assert {r.doc_id: r.component_id for r in got} == want and len(set(want.values())) < len(texts)
    assert bool(clusters) == (star == 2)


def test_boundary_follows_cost():
    sizes = lambda count, entries: {s: (count, entries) for s in range(1, 41)}
    dear, cheap = 10**9, 0
    assert jaccard.boundary(sizes(10, cheap), 9, 10) == 0
    assert jaccard.boundary(sizes(10, dear), 9, 10) == jaccard.most_enumerated(9, 10)
    assert jaccard.boundary(sizes(10, dear), 8, 10) == jaccard.most_enumerated(8, 10)
    # Where lists cost more than subsets up to a size and less from there on, that is the boundary.
    cost = lambda s: jaccard.subset_count(s, 9, 10) / jaccard.ENTRY_COST
    assert jaccard.boundary({s: (1, math.ceil(cost(s)) + 1 if s <= 12 else 0) for s in range(1, 41)}, 9, 10) == 12


def test_costs_of_a_group_of_copies_grow_with_its_sets(spark, monkeypatch):
    class Measured(Exception):
        pass

    def measure(sizes, num, den):
        raise Measured(sizes)

    monkeypatch.setattr(jaccard, "boundary", measure)
    rng, entries = np.random.default_rng(5), []
    for n in (50, 200):
        rows = []
        for k in range(n):
            words = [f"w{i}" for i in range(24)]
            words[rng.integers(24)] = f"only{k}"
            rows.append((k, " ".join(words)))
        with pytest.raises(Measured) as found:
            jaccard.linked(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100)
        sets, scanned = found.value.args[0][22]
        assert sets == n and scanned > n
        entries.append(scanned)
    assert entries[1] <= 5 * entries[0]


@pytest.mark.parametrize("small", [0, 8, 19])
def test_both_sides_of_the_boundary(spark, monkeypatch, small):
    """The same links whether sets are enumerated, listed, or dealt to both."""
    monkeypatch.setattr(jaccard, "boundary", lambda *_: small)
    random.seed(small)
    texts = [" ".join(f"s{k % 7}y{j + (k % 3 == j % 11)}" for j in range(4 + k % 23)) for k in range(120)]
    texts += [" ".join(random.choice("ab") for _ in range(14)) for _ in range(60)]
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)} for i, t in enumerate(texts)}
    got = jaccard.components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 3, 90, 100).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(sets, 90, 100)


def test_counts_of_a_frequent_key_are_not_cut():
    """A key hit often by few parts is heavy, and estimates are never too low."""
    hits = [np.array([5000, 1]), np.array([1, 70_000])]
    assert [sketch._counts(sketch._bytes(n)).tolist() for n in hits] == [n.tolist() for n in hits]
    keys = np.arange(4, dtype=np.uint64)
    found = sketch.merged([sketch._cells(keys[:2]), sketch._cells(keys[2:])], [sketch._counts(sketch._bytes(n)) for n in hits])
    assert found[0][0] >= 5000 and found[1][1] >= 70_000


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (501, 500)], "a long, b long")
    got = dict(components.connected_components(edges).collect())
    assert got == {**{k: 0 for k in range(201)}, 500: 500, 501: 500}


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    """As a union of sets says, with a node of very many links, repeated links, loops and nulls."""
    rng = np.random.default_rng(seed)
    links = [*map(tuple, rng.integers(-60, 60, (90, 2)).tolist()), *[(1000 - k, 950) for k in range(60)], (950, 950)]
    low = {x: x for link in links for x in link}
    for _ in low:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    linked = {x for a, b in links if a != b for x in (a, b)}
    rows = [*links, *links[:20], (None, 7), (8, None), (None, None)]
    got = components.connected_components(spark.createDataFrame(rows, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((x, low[x]) for x in linked)


def test_joined_apart_deals_both_sides_anew(spark):
    rows = spark.range(40).select((F.col("id") % 4).alias("k"), "id")
    joined = common.joined_apart(rows, rows.groupBy("k").agg(F.max("id").alias("most")), "k")
    assert {(r.k, r.most) for r in joined.collect()} == {(k, 36 + k) for k in range(4)} and joined.count() == 40
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = common.joined_apart(rows, rows.groupBy("k").agg(F.max("id").alias("most")), "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(~") == 2


def test_weights_move_rows_only_into_what_grew(spark):
    keys = spark.range(3000)
    heavier = ((sharding.TREE[0][0], (1.0, 3.0)), sharding.TREE[1])
    rows = keys.select(sharding.shard_of(F.col("id"), sharding.TREE).alias("a"), sharding.shard_of(F.col("id"), heavier).alias("b")).collect()
    assert {r.b // 4 for r in rows if r.a // 4 != r.b // 4} == {0}
    assert {r.b for r in rows if r.a in (2, 3) and r.a != r.b} == {3}
    share = sum(r.b == 3 for r in rows) / 3000
    assert abs(share - 3 / 10) < 0.04
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("id"), (((0.0,),),))


def test_slots_with_equal_rows(spark):
    df = spark.createDataFrame([(1, None)] * 7 + [(None, "x")] * 3, "doc_id long, t string").withColumn("g", F.lit(0))
    assert sorted(r.slot for r in sharding.number_slots(df, "g", [F.col("doc_id")]).collect()) == list(range(10))


def test_due_time_inverts_demand(spark):
    row = spark.range(1).select(*[mixing.due_time(F.lit(float(x)), F.lit(10.0), F.lit(a), F.lit(b)).alias(f"c{k}") for k, (x, a, b) in enumerate([(0, 1.5, 0.5), (10, 1.5, 0.5), (5, 1.0, 1.0), (2.5, 0.0001, 2.0)])]).first()
    assert row[0] == 0 and row[1] == pytest.approx(1) and row[2] == 0.5 and row[3] == pytest.approx(0.5, abs=0.01)


def test_longest_match_equals_greedy():
    random.seed(3)
    single = {bytes([b]) for b in range(256)}
    for _ in range(30):
        initial, rest = ({bytes(random.choice(b"ab") for _ in range(random.randrange(1, 6))) for _ in range(12)} | single for _ in range(2))
        machine = wordpiece.Automaton(initial, rest)
        words = [bytes(random.choice(b"abc") for _ in range(random.randrange(1, 20))) for _ in range(40)]
        data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
        starts = ends - [len(w) for w in words]

        def greedy(w):
            n = at = 0
            while at < len(w):
                end = len(w)
                while w[at:end] not in (rest if at else initial):
                    end -= 1
                n, at = n + 1, end
            return n

        assert machine.counts(data, starts, ends).tolist() == [greedy(w) for w in words]


@pytest.mark.parametrize("compression", [tiff.NONE, tiff.PACKBITS, tiff.LZW, tiff.DEFLATE])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tile", [None, (16, 16)])
def test_tiff_round_trip(compression, predictor, tile):
    random = np.random.default_rng(7)
    pages = [random.integers(0, 4, (70, 33), np.uint8), random.integers(0, 60000, (5, 9, 3)).astype(np.uint16), np.zeros((40, 300), np.uint8)]
    got = list(tiff.read_pages(tiff.write_tiff(pages, compression, predictor, 16, tile)))
    assert [p.compression for p in got] == [compression] * 3
    for page, want in zip(got, pages, strict=True):
        assert (page.pixels.reshape(want.shape) == want).all() and page.pixels.dtype == want.dtype


def test_tiff_codecs():
    rng = random.Random(2)
    for _ in range(150):
        raw = bytes(rng.randrange(rng.choice([1, 2, 256])) for _ in range(rng.choice([0, 1, 3, 200, 6000])))
        assert tiff.packbits_decode(tiff.packbits_encode(raw)) == raw and tiff.lzw_decode(tiff.lzw_encode(raw)) == raw
    assert tiff.packbits_decode(bytes.fromhex("feaa0280002afdaa0380002a22f7aa")) == bytes.fromhex("aaaaaa80002aaaaaaaaa80002a22aaaaaaaaaaaaaaaaaaaa")


def test_tiff_pages_of_broken_files(spark):
    good = tiff.write_tiff([np.ones((4, 4), np.uint8)] * 2)
    rows = [(1, good), (2, None), (3, b"no"), (4, good[:-30]), (5, b"II*\0\x08\0\0\0\0\0\x08\0\0\0")]
    got = tiff.tiff_pages(spark.createDataFrame(rows, "page int, media binary").withColumnRenamed("page", "k")).collect()
    assert [(r.k, r.page) for r in got if r.error is None][:2] == [(1, 0), (1, 1)]
    assert {r.k for r in got if r.error} == {2, 3, 4, 5}


def test_fingerprints_estimate_similarity(spark):
    random.seed(8)
    words = [f"w{k}" for k in range(2000)]
    a = [random.choice(words) for _ in range(600)]
    b = a[:450] + [random.choice(words) for _ in range(150)]
    sets = [{tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in (a, b)]
    true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    df = spark.createDataFrame([(" ".join(a), " ".join(b)), (None, " "), ("one two", "one two"), ("one", None)], "a string, b string")
    df = fingerprints.add_fingerprint(fingerprints.add_fingerprint(df, "a", "fa"), "b", "fb")
    got = [r.s for r in df.select(fingerprints.likeness(F.col("fa"), F.col("fb")).alias("s")).collect()]
    assert abs(got[0] - true) < 0.12 and got[1:] == [1.0, 1.0, 0.0]


def test_next_rows_with_ties_and_nulls(spark):
    df = spark.createDataFrame([(5, "a"), (3, "b"), (3, "c"), (None, "d"), (90, "e")], "k long, v string")
    got = {r.v: r.n for r in fingerprints.with_next(df, "k", ["v"], {"v": "n"}).collect()}
    assert got == {"e": "a", "a": "b", "b": "c", "c": "d", "d": "e"}
    one = spark.createDataFrame([(7, "x")], "k long, v string")
    assert fingerprints.with_next(one, "k", ["v"], {"v": "n"}).first().n == "x"


def _as_tiktoken(texts):
    import public_tokenizers
    import tiktoken

    encoding = tiktoken.Encoding("b", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    return [encoding.encode_ordinary(t or "") for t in texts]


def _bpe_ids(spark, texts, partitions=2):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(partitions)
    return [r.ids for r in bpe.encode(df, "text", "ids", bpe.default_vocabulary()).orderBy("doc_id").collect()]


def test_bpe_as_tiktoken(spark, monkeypatch):
    """Several books a task, and words above and below LONG_WORD."""
    monkeypatch.setattr(bpe, "BOOK_WORDS", 40)
    monkeypatch.setattr(bpe, "ROWS", 3)
    random.seed(6)
    word = lambda n, letters: "".join(random.choice(letters) for _ in range(n))
    texts = [" ".join(word(random.choice([3, 9, 30, 47, 48, 49, 90, 300]), "abcdefghijklmnopqrstuvwxyz" if k % 2 else "aeinrst") for _ in range(8)) for k in range(30)]
    texts += [None, "", "a" * 400, "ab" * 150, "漢字かな交じり文" * 40, "naïve " * 30, "\u00a0\u2003x \r\n\n  y"] + texts[:5]
    assert _bpe_ids(spark, texts) == _as_tiktoken(texts)


def test_bpe_long_words(spark):
    """As tiktoken; the work of a word grows far less than with the square of its bytes."""
    random.seed(7)
    texts = ["".join(random.choice("etaoinshrdlu") for _ in range(4_000)), "ha" * 50_000, "z" * 100_000]
    assert _bpe_ids(spark, texts, 3) == _as_tiktoken(texts)


def test_bpe_batches_are_bounded(spark, monkeypatch):
    """Python gets a bounded number of words at a time, however long the texts of a task are."""
    books, most = bpe._books, 10_000 * 100

    def checked(batches, *rest):
        def seen():
            for batch in batches:
                n = len(batch.column(batch.num_columns - 1).flatten())
                if n > most:
                    raise ValueError(f"{n} words at once")
                yield batch

        return books(seen(), *rest)

    monkeypatch.setattr(bpe, "_books", checked)
    df = spark.range(0, 300, 1, 1).selectExpr("id AS doc_id", "concat(id, repeat(' one two three four five', 1000)) AS text")
    want = {f"{i}": len(ids) for i, ids in enumerate(_as_tiktoken([f"{i}" + " one two three four five" * 1000 for i in range(300)]))}
    got = {f"{r.doc_id}": r.n_tokens for r in bpe.digest(df, bpe.default_vocabulary()).collect()}
    assert got == want


def test_tidy_worker_gives_memory_back():
    """What a step has freed is not kept by its worker, though something lies above it."""
    from pathlib import Path

    def private():
        return sum(int(line.split()[1]) for line in Path("/proc/self/smaps_rollup").read_text().splitlines() if line.startswith("Pss_Anon")) / 1024

    kept = []

    def step(batches):
        arrays = [np.ones(10_000) for _ in range(3_000)]
        kept.append(arrays[-1])
        yield from batches

    before = private()
    assert list(common.tidy(step)(iter([1, 2]))) == [1, 2]
    assert private() - before < 60


def test_bpe_texts_in_parts(spark, monkeypatch):
    """Texts whose parts come in several batches, slices and books, beside columns of any type."""
    monkeypatch.setattr(bpe, "PART_WORDS", 2)
    monkeypatch.setattr(bpe, "BOOK_WORDS", 40)
    monkeypatch.setattr(bpe, "ROWS", 3)
    texts = [" ".join(["word"] * n) + " end" * (n % 2) for n in [*range(9), 50, 1, 0, 0, 0, 0, 2, 100, 3, 4]] + [None, "", "  "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    df = df.selectExpr("*", "map(doc_id, text) AS m", "struct(doc_id AS x, array(text) AS y) AS s", "CASE WHEN doc_id % 2 = 0 THEN doc_id END AS e", "NULL AS v")
    key, default = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, "4")
    try:
        got = bpe.encode(df, "text", "ids", bpe.default_vocabulary()).orderBy("doc_id").collect()
    finally:
        spark.conf.set(key, default)
    assert [r.ids for r in got] == _as_tiktoken(texts)
    assert [(r.text, r.m, r.s.y, r.e, r.v) for r in got] == [(t, {i: t}, [t], i if i % 2 == 0 else None, None) for i, t in enumerate(texts)]


def test_bpe_keeps_other_columns(spark):
    rows = [(1, "unfathomable zzzzqqqq zzzzqqqq", "keep", 5), (2, None, None, 6), (3, "x" * 400, "", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, words string, places int")
    out = bpe.decode(bpe.encode(df, "text", "ids", bpe.default_vocabulary()), "ids", "raw", bpe.default_vocabulary())
    assert out.columns == ["doc_id", "text", "words", "places", "ids", "raw"]
    got = {r.doc_id: r for r in out.collect()}
    assert {k: bytes(r.raw).decode() for k, r in got.items()} == {1: rows[0][1], 2: "", 3: rows[2][1]}
    assert got[1].words == "keep" and got[2].places == 6 and got[2].ids == []


def test_toxicity_learns_words_and_stems(spark):
    random.seed(4)
    plain = [f"word{k}" for k in range(300)]
    rows = []
    for i in range(400):
        w, toxic = [random.choice(plain) for _ in range(40)], i % 4 == 0
        if toxic:
            for _ in range(3):
                w[random.randrange(40)] = random.choice(["scoundrel", f"vile{random.randrange(90)}", "rotter,"])
        rows.append((i, " ".join(w), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    chain = toxicity.train(df.where("doc_id < 300"), steps=20)
    held = df.where("doc_id >= 300").unionByName(spark.createDataFrame([(1000, None, 0), (1001, " ", 0)], df.schema))
    out = toxicity.score(held, chain, spans=True).collect()
    assert all((r.score >= 0.5) == bool(r.toxic) for r in out)
    for r in out:
        for s in r.toxic_spans:
            assert any(x in r.text[s.begin : s.end] for x in ("scoundrel", "vile", "rotter"))


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    sizes, moves = [3, 0, 1, 5], rng.normal(size=(2, 2))
    first = np.r_[0, np.cumsum(sizes)]
    emission = rng.normal(size=first[-1])
    p, _ = toxicity.marginals(emission, first, moves)
    for a, b in zip(first[:-1], first[1:], strict=True):
        n, total, hit = b - a, 0.0, np.zeros(b - a)
        for code in range(1 << n if n else 0):
            z = [(code >> k) & 1 for k in range(n)]
            w = np.exp(sum(emission[a + k] * z[k] for k in range(n)) + sum(moves[z[k], z[k + 1]] for k in range(n - 1)))
            total, hit = total + w, hit + w * np.array(z)
        if n:
            assert np.allclose(p[a:b], hit / total)


def test_marginals_of_long_documents_do_not_depend_on_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    emission, first, moves = rng.normal(size=700), np.array([0, 500, 700]), rng.normal(size=(2, 2))
    want = toxicity.marginals(emission, first, moves)[0]
    monkeypatch.setattr(toxicity, "BLOCK", 1000)
    assert np.allclose(want, toxicity.marginals(emission, first, moves)[0])


def test_cut_reads_what_was_written(spark):
    df = cut(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.agg(F.sum("x")).first()[0] == 90 and "parquet" in df._jdf.queryExecution().toString().lower()


def test_slices_of_one_document():
    t = Texts(np.array([1]), np.frombuffer(b"ab", np.uint8), np.array([0, 2]))
    assert t.of(0) == b"ab"


def test_clashing_columns(spark):
    """Columns that are called like those an operator works with, or gives."""
    names = "_words _sorted _bins _filled _block _order _key _named _name _start _end position passes row block n".split()
    df = spark.createDataFrame([(k, f"a b c{k}", "s", 3, *[f"{c}{k}" for c in names]) for k in range(5)], ["doc_id", "text", "source", "size", *names])
    kept = [c for c in names if c not in ("position", "passes")]
    printed = fingerprints.add_fingerprint(df, "text", "_key")
    assert printed.columns == [c for c in df.columns if c != "_key"] + ["_key"]
    assert all(r["_words"] == f"_words{r.doc_id}" and len(r["_key"]) == 256 for r in printed.collect())
    mixed = mixing.mix(df)
    assert all(r[c] == f"{c}{r.doc_id}" for r in mixed.collect() for c in kept) and dict(mixed.dtypes)["position"] == "double"
    slots = sharding.number_slots(df, "source", [F.col("doc_id")])
    assert sorted(r.slot for r in slots.collect()) == [0, 1, 2, 3, 4] and all(r[c] == f"{c}{r.doc_id}" for r in slots.collect() for c in names)
