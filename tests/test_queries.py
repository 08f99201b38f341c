"""Every registered query with SQL against DuckDB on the same tables."""

import math
import os

import duckdb
import pytest

from gridweave.plans import all_queries as registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return None if math.isnan(v) else repr(round(v, 9))
        return v if v is None or isinstance(v, bool) else str(v)

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_oracle(spark, duck, name):
    ours = registry.QUERIES[name](spark, SF_DIR)
    got = rows_of(ours.columns, [tuple(r) for r in ours.collect()])
    cursor = duck.execute(registry.ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(ours.columns)
    want = rows_of(columns, cursor.fetchall())
    assert len(got) == len(want) > 0
    assert got == want


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF_DIR).count() > 0
