"""Decontamination, ranked search and periodic runs against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from wayfare.llm import contamination, lexical, periods, terms
from wayfare.llm.common import Texts
from wayfare.llm.queries import QUERIES

TERM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def low(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def texts(*values):
    return terms.texts_of(list(values))


# Decontamination


def brute_spans(words, items, window, num=1, den=1, shingle=3):
    """(hit words, items) of a document."""
    hit, names = set(), set()
    for name, text in items:
        own = low(text)
        for k in range(max(1, len(own) - window + 1) if own else 0):
            want = own[k : k + window]
            s = min(shingle, len(want))
            sets = lambda w: {tuple(w[j : j + s]) for j in range(len(w) - s + 1)}
            for p in range(len(words) - len(want) + 1):
                there = words[p : p + len(want)]
                if there == want if num == den else len(sets(want) & sets(there)) * den >= len(sets(want)) * num:
                    hit |= set(range(p, p + len(want)))
                    names.add("" if name is None else str(name))
    return len(hit), sorted(names)


def test_prefix_join(spark, tables, corpus, benchmark):
    got = {r.doc_id: r for r in QUERIES["op11_prefix_join"](spark, tables).collect()}
    assert len(got) == len(corpus)
    for i, text, *_ in corpus:
        words = low(text)
        n, names = brute_spans(words, benchmark, 10)
        assert tuple(got[i]) == (i, len(words), n, len(names), sha(",".join(names)), n > 0), i
    assert any(r.contaminated for r in got.values()) and not all(r.contaminated for r in got.values())


@pytest.mark.parametrize("num, den", [(1, 1), (3, 4), (1, 2)])
def test_containment(spark, num, den):
    random.seed(7)
    some = lambda n, k: " ".join(random.choice("abcdefgh"[:k]) for _ in range(n))
    docs = [(k, some(random.randrange(0, 60), 2 + k % 6)) for k in range(40)] + [(None, None), (3, "a b"), (41, "a " * 50)]
    items = [(k, some(random.randrange(0, 15), 2 + k % 5)) for k in range(25)] + [(3, "b A,a"), (90, None), (91, "a"), (92, " a a a a a a a a a a a ")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id int, text string")
    for part_bytes in (1 << 20, 60):  # in one part and in several
        got = contamination.contaminated(df, bench, 6, num, den, part_bytes).collect()
        want = [(i, t, len(low(t)), *brute_spans(low(t), items, 6, num, den)) for i, t in docs]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_contaminated_keeps_columns(spark):
    """Columns of awkward names come through; those of the results' names are replaced."""
    df = spark.createDataFrame([(1, "one two three", 5, {"a": 1}, 7, 8)], "doc_id long, text string, n_hit int, `a.b` map<string,int>, other int, `other 0` int")
    out = contamination.contaminated(df, spark.createDataFrame([("x", "two three")], "item_id string, text string"))
    assert out.columns == ["doc_id", "text", "a.b", "other", "other 0", "n_words", "n_hit", "items"]
    assert tuple(out.first()) == (1, "one two three", {"a": 1}, 7, 8, 3, 2, ["x"])
    nothing = contamination.contaminated(df, spark.createDataFrame([], "item_id string, text string")).first()
    assert (nothing.n_words, nothing.n_hit, nothing["items"]) == (3, 0, [])


def test_rarest_shingles_are_looked_up():
    """The order goes by counts, and each window has as few of its shingles as are needed."""
    w = contamination.Windows([("i", "a b c d e f")], 6, 3, 4)
    counts = w.counts(terms.texts_of(["a b c a b c b c d", "c d e"]))
    assert counts.sum() == 4
    w.order_by(counts)
    assert len(w.prefixes) == 2  # of 4 shingles, 3 must be shared
    w = contamination.Windows([("i", "a b c d e f")], 6, 1, 1)
    w.order_by(counts)
    assert w.prefixes.tolist() == [w.keys[0, 3]]


def test_long_text_and_seams(spark):
    """A text above a pack, and items that would be met only across two documents."""
    long = "x y " * 700_000 + "needle in the stack " + "z " * 10
    docs = [(1, "needle in"), (2, "the stack"), (3, long), (4, "Needle-in the STACK")]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = contamination.contaminated(df, spark.createDataFrame([("n", "needle in the stack")], "item_id string, text string"))
    assert [tuple(r) for r in got.select("doc_id", "n_words", "n_hit").orderBy("doc_id").collect()] == [(1, 2, 0), (2, 2, 0), (3, 1_400_014, 4), (4, 4, 4)]


# Ranked search


def brute_ranks(docs, items, k=10):
    counts = [(i, Counter(low(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(low(text))
    out = []
    for item, own in asked.items():
        scores = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // length
            s = 0
            for t in own & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in d for _, d in counts) + 1)))
                s += w * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
            if s:
                scores.append((-s, i is not None, i or 0))
        out += [(item, r + 1, i if known else None, -s) for r, (s, known, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def test_impact_ordered(spark, tables, corpus, benchmark):
    got = QUERIES["op12_impact_ordered"](spark, tables)
    assert got.schema["rank"].dataType.simpleString() == "int"
    assert sorted(map(tuple, got.collect()), key=repr) == brute_ranks([c[:2] for c in corpus], benchmark)


def test_ranks_of_random_documents(spark):
    """Ties, repeated ids and rows, null ids, and items in several parts."""
    random.seed(3)
    some = lambda n: " ".join(f"t{min(random.randrange(40), random.randrange(40))}" for _ in range(n))
    docs = [(random.randrange(60), some(random.randrange(12))) for _ in range(150)] + [(None, "t1 t2"), (5, None)]
    docs += docs[:30] + [(7, "t39 same"), (7, "same t39")] * 8
    items = [(f"i{k % 20}", some(4)) for k in range(30)] + [(None, "t39 T39"), ("none", "nowhere"), ("null", None)]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id string, text string")
    for part_bytes in (1 << 20, 100):
        assert sorted(map(tuple, lexical.top_documents(df, bench, 10, part_bytes).collect()), key=repr) == brute_ranks(docs, items)


def test_search_stops_early_and_is_exact():
    """Slices one after another with the scores carried, as a task does."""
    random.seed(11)
    zipf = [f"w{int(random.paretovariate(0.7)) % 3000}" for _ in range(60_000)]
    docs = [(k, " ".join(zipf[a : a + random.randrange(5, 40)])) for k, a in enumerate(range(0, 59_900, 30))]
    items = lexical.Items([(k, " ".join(zipf[a : a + 12])) for k, a in enumerate(range(0, 4000, 100))])
    weights = np.array([0, *[math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df + 1))) for df in items.statistics(texts(*[t for _, t in docs]))[2:].tolist()]])
    index = lexical.Index(items, weights, len(docs), sum(len(t.split()) for _, t in docs), texts(*[t for _, t in docs]))
    full = np.zeros((len(items), len(docs)), np.int64)
    for i, own in enumerate(items.terms):
        for t in own:
            a, b = index.at[t], index.at[t + 1]
            full[i, index.docs[a:b]] -= index.falling[a:b]
    early = 0
    for i, own in enumerate(items.terms):
        want = sorted(zip(-full[i], range(len(docs))))[:10]
        for least in (0, int(-want[9][0]), int(-want[0][0])):
            held, score = index.search(own, 10, least)
            assert (full[i, held] == score).all()
            assert {d for s, d in want if -s >= max(1, least)} <= set(held.tolist())
            early += len(held) < (full[i] > 0).sum()
    assert early > len(items)  # most documents were left out by the bounds


# Periodic runs


def brute_runs(words):
    """Runs by the definition, each period by itself."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q) and not any(all(words[x] == words[x + d] for x in range(i, j + q - d)) for d in range(1, q)):
                out.append((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def awkward_words(k):
    random.seed(k)
    kind = k % 6
    if kind == 0:
        return [random.choice("ab") for _ in range(random.randrange(90))]
    if kind == 1:
        return ["a"] * random.randrange(40) + ["b"] * random.randrange(40)
    if kind == 2:
        root = [str(random.randrange(30)) for _ in range(random.randrange(1, 90))]
        return ["x"] + root * random.randrange(3, 7) + root[: random.randrange(len(root))] + ["y"]
    if kind == 3:  # a run of runs
        root = (["a"] * 7 + ["b"]) * 2 + ["c"] * random.randrange(1, 70)
        return root * 5
    if kind == 4:
        return [bin(j).count("1") % 2 * "b" + "a" for j in range(random.randrange(300))]
    return ["ab" if random.random() < 0.98 else "c" for _ in range(300)]


def test_runs_of_awkward_texts():
    docs = [awkward_words(k) for k in range(90)] + [[], ["a"], ["a"] * 5, ["a"] * 6, (["a"] * 5 + ["b"]) * 4]
    root = [str(j * j % 71) for j in range(150)]
    docs += [root * 5, root * 3, (root + ["z"] * 9) * 4, [*(root * 2), "q"] * 6]
    held = periods.Words(texts(*[" ".join(d) for d in docs]))
    got = [[] for _ in docs]
    for d, *r in zip(*[x.tolist() for x in held.runs()], strict=True):
        got[d].append(tuple(r))
    assert got == [brute_runs(d) for d in docs]
    assert any(q > 64 for g in got for *_, q in g) and any(len({r[2] for r in g}) > 1 for g in got)


def looped(i, words):
    h, n = zlib.crc32(str(i).encode()), len(words)
    g = h // 10
    if i is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]


def described(i, text):
    words = looped(i, WORD.findall(text or ""))
    found = brute_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    gone = {x for s, n, q in found for x in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (i, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(lines), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_bit_lags(spark, tables, corpus, tmp_path):
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_bit_lags"](spark, tables).collect()}
    assert got == {i: described(i, t) for i, t, *_ in corpus}
    docs = [(k, " \n".join(awkward_words(k))) for k in range(120)] + [(None, "a " * 9), (5, "b " * 9), (5, "b " * 9)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(repr, map(tuple, QUERIES["op13_bit_lags"](spark, str(tmp_path)).collect())))
    assert got == sorted(repr(described(i, t)) for i, t in docs)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs)


def test_period_of_a_long_text(spark):
    """A text above the slice size, one run of a period above 100 000 words."""
    root = " ".join(str(j) for j in range(120_000))
    df = spark.createDataFrame([(1, "a b"), (2, f"start {root} {root} {root} {root} end"), (3, "c " * 300_000)], "doc_id long, text string").coalesce(1)
    assert [tuple(r) for r in periods.period_runs(df).orderBy("doc_id").collect()] == [(2, 1, 480_000, 120_000), (3, 0, 300_000, 1)]


def test_collapsed(spark):
    df = spark.createDataFrame([(1, "x  a b a b a b a b y", {"k": 1}), (2, "x  y", None), (3, None, None)], "doc_id long, text string, `a.b` map<string,int>")
    out = periods.collapsed(df)
    assert out.columns == df.columns
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, "x a b y", {"k": 1}), (2, "x  y", None), (3, None, None)]
    assert periods.period_runs(df, 2, 2).orderBy("doc_id").first() == (1, 1, 8, 2)


def test_lowered_keeps_places():
    t = texts("Ab-C é", "ZZ")
    assert terms.lowered(t).data.tobytes() == "ab c ézz".encode() and isinstance(terms.lowered(t), Texts)
