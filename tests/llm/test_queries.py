"""The registered queries against brute force on a small table, and on an empty one."""

import hashlib
import os
import re
import struct
import zlib
from collections import defaultdict

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from wayfare.llm import fingerprints, tiff
from wayfare.llm.queries import ORACLE_SQL, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def run(spark, name, folder):
    return {r["doc_id"]: r for r in QUERIES[name](spark, folder).collect()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_table(spark, empty_tables, name):
    assert QUERIES[name](spark, empty_tables).collect() == []


def test_suffix_array(spark, tables, corpus):
    got, seen = run(spark, "op1_suffix_array", tables), set()
    for i, text, *_ in corpus:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(raw[k : k + 100])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        assert tuple(got[i])[1:5] == (len(raw), sum(gone), len(re.findall(b"\1+", gone)), sha(kept)), i


def plain_lzw(data):
    bits, at, out = "".join(f"{b:08b}" for b in data), 0, b""
    table, before = [], None
    while True:
        width = next(w for w in (9, 10, 11, 12) if w == 12 or len(table) + (before is not None) + 258 < 1 << w)
        code, at = int(bits[at : at + width], 2), at + width
        if code == 257:
            return out
        if code == 256:
            table, before = [], None
            continue
        entry = bytes([code]) if code < 256 else table[code - 258] if code - 258 < len(table) else before + before[:1]
        if before is not None:
            table.append(before + entry[:1])
        out, before = out + entry, entry


def plain_packbits(data):
    out, at = b"", 0
    while at < len(data):
        n, at = data[at], at + 1
        out += data[at : at + n + 1] if n < 128 else data[at : at + 1] * (257 - n)
        at += n + 1 if n < 128 else 1
    return out


def plain_page(media):
    """The samples of a TIFF file's one page, and what its directory says."""
    (at,) = struct.unpack_from("<I", media, 4)
    fields = {}
    for k in range(struct.unpack_from("<H", media, at)[0]):
        tag, kind, count, _ = struct.unpack_from("<HHII", media, at + 2 + 12 * k)
        form, place = {3: "H", 4: "I"}[kind], at + 10 + 12 * k
        if count * struct.calcsize(form) > 4:
            (place,) = struct.unpack_from("<I", media, place)
        fields[tag] = struct.unpack_from(f"<{count}{form}", media, place)
    width, height = fields[256][0], fields[257][0]
    tiled = 324 in fields
    w, h = (fields[322][0], fields[323][0]) if tiled else (width, fields[278][0])
    rows = [bytearray(width) for _ in range(height)]
    across = -(-width // w)
    for k, (begin, size) in enumerate(zip(fields[324 if tiled else 273], fields[325 if tiled else 279])):
        part = {8: zlib.decompress, 5: plain_lzw, 32773: plain_packbits}[fields[259][0]](media[begin : begin + size])
        for y in range(len(part) // w):
            line, total = bytearray(part[y * w : (y + 1) * w]), 0
            if fields[317][0] == 2:
                for x in range(w):
                    total = (total + line[x]) % 256
                    line[x] = total
            if k // across * h + y < height:
                left = k % across * w
                rows[k // across * h + y][left : left + w] = line[: width - left]
    return b"".join(rows), width, height, fields[259][0], fields[317][0], tiled


def test_tiff(spark, tables, corpus):
    """The stored files by a plain reader of their own; each form is met, with long texts too."""
    more = [(100 + k, "".join(chr(97 + (k * j + j * j) % (2 + k)) for j in range(7000 + k))) for k in range(24)]
    forms = set()
    df = spark.createDataFrame([(i, t) for i, t, *_ in corpus] + more, "doc_id long, text string")
    for r in tiff.text_to_tiff(df).join(df, "doc_id").collect():
        raw = (r.text or "").encode()
        page, *form = plain_page(bytes(r.media))
        assert page == raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0") and form[:2] == [64, len(page) // 64]
        forms.add((*form[2:], len(raw) > 5000))
    assert {f[:3] for f in forms if f[3]} == {(c, p, t) for c, p, t in [(32773, 1, False), (32773, 1, True), *[(c, p, t) for c in (5, 8) for p in (1, 2) for t in (False, True)]]}
    got, stored = run(spark, "op2_tiff", tables), {r.doc_id: bytes(r.media) for r in tiff.text_to_tiff(spark.read.parquet(f"{tables}/documents.parquet")).collect()}
    for i, text, *_ in corpus:
        raw = (text or "").encode()
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), sha(payload), zlib.crc32(payload[-64:]))
        _, width, height, compression, *_ = plain_page(stored[i])
        assert (r.media_bytes, r.media_sha256) == (len(stored[i]), sha(stored[i]))
        assert r.feature == f"page=0;size={width}x{height};compression={compression};low={min(payload)};high={max(payload)};mean={sum(payload) / len(payload):.6f}"
    assert got[0].media_sha256 == got[3].media_sha256 and got[0].feature == got[3].feature


def components(sets, num, den):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}


def shingle_sets(corpus, n):
    out, lower = {}, {c: c + 32 for c in range(65, 91)}
    for i, text, *_ in corpus:
        w = WORD.findall((text or "").translate(lower))
        out[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    return out


def test_jaccard(spark, tables, corpus):
    got, sets = run(spark, "op3_heavy_light", tables), shingle_sets(corpus, 3)
    want = components(sets, 90, 100)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(sets[i]), want[i]) for i in sets}


def test_sharding(spark, tables, corpus):
    got, slots = run(spark, "op4_hash_tree", tables), defaultdict(list)
    for i, text, *_ in corpus:
        r, raw = got[i], (text or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r.grown_shard in (r.shard, 8) and 0 <= r.shard < 8
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_mixing(spark, tables, corpus):
    rows = QUERIES["op5_curriculum"](spark, tables).collect()
    got, by = {r.doc_id: r for r in rows}, defaultdict(list)
    for i, text, _, source, _ in corpus:
        assert got[i]["size"] == len(WORD.findall(text or "")) and got[i].taken <= 2 * got[i]["size"]
        by[source].append(i)
    weights = dict(zip(sorted(by, key=lambda s: (s is None, s)), (5, 2, 1, 5)))
    sizes = {s: sum(got[i]["size"] for i in by[s]) for s in by}
    target, rest, free = {}, 1.5 * sum(sizes.values()), set(by)
    while free:
        share = {s: rest * weights[s] / sum(weights[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 2 * sizes[s]}
        target.update({s: 2 * sizes[s] for s in full} if full else share)
        rest -= sum(2 * sizes[s] for s in full)
        free = free - full if full else set()
    for s, ids in by.items():
        assert got[ids[0]].source_size == sizes[s] and got[ids[0]].target == pytest.approx(target[s])
        assert abs(sum(got[i].taken for i in ids) - target[s]) <= 1
    reached = [r.position for r in rows if r.taken]
    assert reached == sorted(reached)
    assert rows == QUERIES["op5_curriculum"](spark, tables).collect()


def test_longest_match(spark, tables, corpus):
    from wayfare.llm.bpe import load_ranks
    from wayfare.llm.wordpiece import pieces_of, vocabulary_path

    initial, rest = pieces_of(load_ranks(vocabulary_path()))

    def count(word):
        n = at = 0
        while at < len(word):
            end = len(word)
            while word[at:end] not in (rest if at else initial):
                end -= 1
            n, at = n + 1, end
        return n

    got = run(spark, "op6_longest_match", tables)
    for i, text, *_ in corpus:
        words = [w.encode() for w in WORD.findall(text or "")]
        assert (got[i].n_words, got[i].n_tokens) == (len(words), sum(map(count, words)))


def test_toxicity_without_evidence(spark, tables, corpus):
    got = run(spark, "op7_crf", tables)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no tables here")
def test_toxicity_held_out(spark):
    """On the documents that no label was learnt from."""
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").where("toxic is not null").collect()}
    rows = [(r.score, r.predicted, labels[r.doc_id]) for r in QUERIES["op7_crf"](spark, folder).where("held_out").collect() if r.doc_id in labels]
    toxic, clean = ([s for s, _, y in rows if y == k] for k in (1, 0))
    assert len(toxic) > 20 and len(clean) > 400
    assert sum(p == y for _, p, y in rows) / len(rows) >= 0.97
    assert sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean)) >= 0.93
    assert sum(s >= 0.5 for s in clean) / len(clean) <= 0.01


def plain_fingerprint(text):
    w, bins = re.split(r"[\x20\x09-\x0D]+", text), [None] * 256
    w = [x for x in w if x]
    if not w:
        return ""
    for k in range(max(1, len(w) - 4)):
        h = 42
        for x in w[k : k + 5]:
            h = xxhash.xxh64_intdigest(x.encode(), h)
        h >>= 1
        bins[h >> 55] = min(h, bins[h >> 55] if bins[h >> 55] is not None else h)
    start, step, _ = fingerprints._probe_tables(256)
    value = lambda i: next(bins[(start[i] + t * step[i]) % 256] for t in range(256) if bins[(start[i] + t * step[i]) % 256] is not None)
    return "".join(f"{(value(i) if h is None else h) & 15:x}" for i, h in enumerate(bins))


def plain_likeness(a, b):
    if a == b or not a or not b:
        return float(a == b)
    return min(1.0, max(0.0, (sum(x == y for x, y in zip(a, b)) / 256 - 1 / 16) / (15 / 16)))


def test_fingerprints(spark, tables, corpus):
    got, texts = run(spark, "op8_one_permutation", tables), {i: t or "" for i, t, *_ in corpus}
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        after, half = texts[order[(k + 1) % len(order)]], len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + after[:half]
        prints = [plain_fingerprint(t) for t in (texts[i], edited, after)]
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(texts[i]), sha(edited.encode()), *prints[:2])
        assert r.near_edited == pytest.approx(plain_likeness(*prints[:2])) and r.near_next == pytest.approx(plain_likeness(prints[0], prints[2]))
    assert got[0].fingerprint == got[3].fingerprint != got[5].fingerprint


@pytest.mark.parametrize("ids", [[*range(300), 10**15], [None] * 90 + [5] * 200 + [-(2**63), 2**63 - 1, -5 * 10**18, 5 * 10**18, 7, 7], [3], [None, None], [4] * 9])
def test_next_of_any_ids(spark, ids):
    df = spark.createDataFrame([(i, f"t{k % 150}") for k, i in enumerate(ids)], "k long, t string").repartition(3)
    got = fingerprints.with_next(df, "k", ["t"], {"t": "next_t", "k": "next_k"}).withColumn("h", F.xxhash64("t")).collect()
    order = sorted(got, key=lambda r: (r.k is None, -(r.k or 0), r.h, r.t))
    assert len(got) == len(ids)
    assert all((a.next_k, a.next_t) == (b.k, b.t) for a, b in zip(order, order[1:] + order[:1]))


def test_bpe(spark, tables, corpus):
    import public_tokenizers
    import tiktoken

    from wayfare.llm.bpe import load_ranks

    ranks = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = run(spark, "op9_byte_bpe", tables)
    for i, text, *_ in corpus:
        ids = library.encode_ordinary(text or "")
        assert tuple(got[i]) == (i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode()))


def test_count_min(spark, tables, corpus):
    got, seen = run(spark, "op10_count_min", tables), set()
    for i, text, *_ in corpus:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        assert tuple(got[i]) == (i, len(words), sum(gone), sha(kept.encode())), i


SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no tables here")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df, want = QUERIES[name](spark, SMALL), duck.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert sorted(want.columns) == columns
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want.select(", ".join(columns)).fetchall())
