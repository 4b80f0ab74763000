"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF01
from tools.oracle_check import digest

TABLES = ["events", "conversations", "embeddings"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    exp = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(exp)
    assert digest(df.columns, got) == digest(rel.columns, exp)


def test_every_query_has_oracle_or_is_listed():
    rows_only = set(E.queries()) - set(E.oracle_sql())
    assert {n for n in rows_only if not n.startswith("op") and n != "pipeline"} == set()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "score" in df.columns


def test_tools_importable():
    assert os.path.exists(os.path.join(os.path.dirname(E.__file__), "bench.py"))
