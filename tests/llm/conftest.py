import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SOME = "the quick brown fox jumps over the lazy dog and runs far away from all the other animals of the wood while rain falls on green hills near an old mill by the river where nobody lives any more"


def rows(*texts):
    return [(i, t, "en", f"s{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def corpus():
    """Copies, near copies, shared passages, and every awkward text."""
    other = SOME.replace("fox", "cat").replace("mill", "barn")
    own = [" ".join(f"w{(k * 7 + j * j) % 97}x{j}" for j in range(60)) for k in range(6)]
    return rows(SOME, None, "", SOME, other, own[0], own[1] + " " + SOME, "x", "  \t\n ", own[2], own[2] + " end", "Ünïcödé 漢字 — naïve café 🙂 " * 8, own[3], "a" * 300, "one two three four", own[4] + "\n\n" + own[4], own[5].upper(), own[5])


@pytest.fixture(scope="session")
def benchmark():
    """Items that documents hold in whole or part, short ones, one in two rows, and none."""
    return [(1, SOME[:90].upper()), (2, "not here at all"), (10, "one two, three"), (4, None), (5, " - "), (6, SOME[60:] + " but this is of no document"), (6, "naïve café"), (7, "漢字 — NAÏVE")]


@pytest.fixture(scope="session")
def tables(spark, corpus, benchmark, tmp_path_factory):
    """A folder with tables as the queries read them, documents in several files."""
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    spark.createDataFrame(corpus, SCHEMA).repartition(3).write.parquet(str(folder / "documents.parquet"))
    labels = [(i, 1, int(i in (4, 10))) for i in range(len(corpus)) if i % 2 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    return str(folder)


@pytest.fixture(scope="session")
def empty_tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    spark.createDataFrame([], SCHEMA).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder)
