"""The driver's contract, and every query with SQL against the SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from wayfare.plans.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


def canonical(rows):
    def one(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        return repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(one(v) for v in r) for r in rows)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(QUERIES) > 50


@needs_tables
def test_entry(spark):
    assert entry.entry(spark).columns[:4] == ["station_id", "route_a", "route_b", "bucket"]


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df, want = QUERIES[name](spark, FOLDER), duck.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    got = df.select(*columns).collect()
    assert got, "an empty result shows nothing"
    assert canonical(got) == canonical(want.select(quoted).fetchall())
