"""Different documents that share a doc_id, null ids and repeated rows, against brute force."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from wayfare.llm import mixing, substring
from wayfare.llm.queries import QUERIES

from .conftest import SCHEMA, SOME
from .test_queries import WORD, components, sha, shingle_sets


def smallest_first(i):
    return (i is not None, i or 0)


@pytest.fixture(scope="module")
def shared(spark, tmp_path_factory):
    """(rows, folder): a null id and id 7 have several texts; a row is there three times."""
    own = [" ".join(f"v{(k * 11 + j * j) % 89}y{j}" for j in range(70)) for k in range(9)]
    near = [own[6].rsplit(" ", 1)[0] + f" tail{k}" for k in range(3)]
    found = [(None, own[0] + " " + own[0]), (None, own[1]), (None, SOME), (None, None), (None, ""), (7, own[2]), (7, own[3] + " " + SOME + " " + own[3]), (7, SOME), (3, own[4]), (3, own[4]), (3, own[4])]
    found += [(5, own[2] + " end"), (9, own[1]), (1, own[5] + " " + own[4]), (None, near[0]), (7, near[1]), (11, near[2]), (7, own[7]), (11, own[7] + " x"), (None, own[8] + " q"), (2, own[8])]
    rows = [(i, t, "en", f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(found)]
    folder = tmp_path_factory.mktemp("shared")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    return rows, str(folder)


def gone(rows, units, length):
    """For each row which of its units are covered by windows that start earlier too: in a
    document of smaller id, or before in its own text."""
    smaller = {}
    for i, text, *_ in rows:
        u = units(text)
        for k in range(len(u) - length + 1):
            w = u[k : k + length]
            smaller[w] = min(smaller.get(w, smallest_first(i)), smallest_first(i))
    for i, text, *_ in rows:
        u, seen = units(text), set()
        out = bytearray(len(u))
        for k in range(len(u) - length + 1):
            w = u[k : k + length]
            if w in seen or smaller[w] < smallest_first(i):
                out[k : k + length] = b"\1" * length
            seen.add(w)
        yield i, u, out


def test_suffix_array(spark, shared):
    rows, folder = shared
    want = Counter()
    for i, raw, cut in gone(rows, lambda t: (t or "").encode(), 100):
        want[i, len(raw), sum(cut), len(re.findall(b"\1+", cut)), sha(bytes(b for b, g in zip(raw, cut) if not g))] += 1
    assert Counter(map(tuple, QUERIES["op1_suffix_array"](spark, folder).collect())) == want


def words(text):
    return tuple(WORD.findall(text or ""))


def test_count_min(spark, shared):
    rows, folder = shared
    want = Counter()
    for i, u, cut in gone(rows, words, 20):
        want[i, len(u), sum(cut), sha(" ".join(w for w, g in zip(u, cut) if not g).encode())] += 1
    assert Counter(map(tuple, QUERIES["op10_count_min"](spark, folder).collect())) == want


def test_dedup(spark, shared):
    rows, _ = shared
    got = Counter((r.doc_id, words(r.text)) for r in substring.dedup(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == Counter((i, tuple(w for w, g in zip(u, cut) if not g)) for i, u, cut in gone(rows, words, 20))


def test_jaccard(spark, shared):
    rows, folder = shared
    sets = shingle_sets([(k, r[1]) for k, r in enumerate(rows)], 3)
    root = components(sets, 90, 100)
    want = Counter()
    for k in sets:
        of = [rows[x][0] for x in sets if root[x] == root[k]]
        want[rows[k][0], len(sets[k]), min(of, key=smallest_first)] += 1
    assert Counter(map(tuple, QUERIES["op3_heavy_light"](spark, folder).collect())) == want


def test_near_copies(spark, shared):
    rows, folder = shared
    sets = shingle_sets([(k, r[1]) for k, r in enumerate(rows)], 5)
    root, want = components(sets, 8, 10), set()
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA), folder).collect()]
    for k in sets:
        of = [rows[x][:2] for x in sets if root[x] == root[k]] if sets[k] else [r[:2] for r in rows if r[:2] == rows[k][:2]]
        least = min((i for i, _ in of), key=smallest_first)
        want.add(frozenset(x for x in of if x[0] == least))
    # One row of each component, of its smallest id.
    assert len(got) == len({root[k] for k in sets if sets[k]} | {rows[k][:2] for k in sets if not sets[k]})
    assert all(sum(row in group for row in got) == 1 for group in want)


def test_mix(spark, shared):
    """Each row is a document of its own: passes are whole but for one of each source."""
    rows, folder = shared
    got = Counter((r.doc_id, r.source, words(r.text)) for r in corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, SCHEMA), folder).collect())
    sizes, by = Counter(), {}
    for i, text, _, source, _ in rows:
        sizes[source] += len(words(text))
        if words(text):
            by.setdefault(source, []).append((i, words(text)))
    target = {r.source: int(r.target) for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    for source, docs in by.items():
        mixed = Counter({(i, u): n for (i, s, u), n in got.items() if s == source})
        assert sum(len(u) * n for (_, u), n in mixed.items()) == target[source]
        whole, have, parts = Counter(docs), Counter(), 0
        for (i, u), n in mixed.items():
            if (i, u) in whole:
                have[i, u] += n
            else:
                parts += n
                assert any(j == i and v[: len(u)] == u for j, v in docs)
        times = target[source] // sizes[source]
        assert parts <= 1 and all(times * n <= have[d] <= (times + 1) * n for d, n in whole.items())


def test_run(spark, shared):
    """run() gives the token ids of the stages' mix, row for row."""
    rows, folder = shared
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    want = Counter((r.doc_id, sha(r.text.encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect()) == want
