"""The pipeline's stages on a small table."""

import gc
import hashlib
import random
import time
from collections import Counter

import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from tiktoken.load import load_tiktoken_bpe
from wayfare.llm import common, toxicity


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tables)
        assert docs.columns == columns, name
    kept = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(f"{tables}/documents.parquet"), tables)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert 0 in ids and 3 not in ids and {1, 2, 7} <= ids
    mixed = corpus_pipeline.mix_sources(spark, spark.read.parquet(f"{tables}/documents.parquet"), tables)
    assert mixed.where(F.length(F.trim("text")) == 0).count() == 0


def test_run(spark, tables):
    rows = corpus_pipeline.run(spark, tables).collect()
    assert rows and all(r.n_tokens > 0 for r in rows)


def test_lazy_stages_keep_their_tables(spark, tables):
    """Results that are still lazy are right whatever runs in between, two pipelines included."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    want = corpus_pipeline.drop_near_copies(spark, docs, tables).count()
    a = corpus_pipeline.drop_near_copies(spark, docs, tables)
    b = corpus_pipeline.cut_repeats(spark, docs, tables)
    first, second = corpus_pipeline.run(spark, tables), corpus_pipeline.run(spark, tables)
    derived = a.filter("doc_id >= 0 or doc_id is null").withColumn("x", F.lit(1))
    del a
    gc.collect()
    spark._jvm.System.gc()
    corpus_pipeline.cut_repeats(spark, docs, tables)
    assert derived.count() == want and b.count() == docs.count()
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))


def test_tables_go_with_their_frames(spark):
    df = common.cut(spark.range(5))
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    exists = lambda: spark._jvm.java.io.File(path.removeprefix("file://").removeprefix("file:")).exists()
    on_it = df.selectExpr("id + 1 as id").filter("id > 2")
    del df
    for _ in range(3):
        gc.collect()
        spark._jvm.System.gc()
        common.sweep(spark)
    assert exists() and on_it.count() == 3
    del on_it
    for _ in range(30):
        gc.collect()
        spark._jvm.System.gc()
        common.sweep(spark)
        if not exists():
            return
        time.sleep(0.2)
    raise AssertionError("the table stayed")


AWKWARD = "`_id` string, `_key` int, `_of` int, `_take` string, `_row` int, `_check` int, passes int, position int, size int, score double, toxic_spans int, `a.b` string, m map<string,int>, `other 0` int, row int, `_rest` int, `_kept` int"


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_extra_columns(spark, corpus, tables, name, stage):
    """Columns of any name come through with their values."""
    extra = ("i", 1, 2, "t", 3, 4, 5, 6, 7, 42.0, 8, "dot", {"k": 1}, 9, 10, 11, 12)
    df = spark.createDataFrame([(*r, *extra) for r in corpus], "doc_id long, text string, lang string, source string, n_chars long, " + AWKWARD)
    plain = stage(spark, spark.read.parquet(f"{tables}/documents.parquet"), tables).select("doc_id", "text", "lang", "source", "n_chars")
    out = stage(spark, df, tables)
    assert out.dtypes == df.dtypes
    got = out.collect()
    assert got and all(tuple(r)[5:] == extra for r in got)
    assert Counter(tuple(r)[:5] for r in got) == Counter(map(tuple, plain.collect()))


def test_toxic_documents_go(spark, tmp_path):
    """What stays is what the operator scores below 0.5, each row unchanged."""
    random.seed(4)
    some = lambda n: " ".join(f"w{random.randrange(200)}" for _ in range(n))
    rows = [(k, f"{some(15)} zorg you blatted {some(15)} snarf" if k % 4 == 0 else some(35), "en", f"s{k % 3}", k) for k in range(400)] + [(400, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(300)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    chain = toxicity.trained_on(docs, spark.read.parquet(str(tmp_path / "labels.parquet")))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, chain).collect()}
    kept = corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect()
    assert sorted(map(tuple, kept)) == sorted(r for r in rows if scores[r[0]] < 0.5)
    assert {r.doc_id for r in kept} == {r[0] for r in rows if r[0] % 4 or r[0] == 400}


def test_tokens_of_the_mix(spark, tables):
    """Ids and what they decode to, by the tiktoken library over the mix that the stages make."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tables)
    coder = tiktoken.Encoding("b", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter()
    for r in docs.collect():
        ids = coder.encode_ordinary(r.text)
        want[r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(r.text)] += 1
    assert Counter(map(tuple, corpus_pipeline.run(spark, tables).collect())) == want


def test_empty(spark, empty_tables):
    docs = spark.read.parquet(f"{empty_tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, empty_tables).collect() == []
