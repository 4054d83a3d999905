"""Every query with SQL against DuckDB on the same files."""

import math

import duckdb
import pytest

from skyloom.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def same(df, rel):
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    got = sorted((tuple(plain(x) for x in r) for r in df.select(cols).collect()), key=repr)
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, con, name):
    same(registry.QUERIES[name](spark, sf_dir), con.sql(registry.ORACLE_SQL[name]))


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_runs(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0
