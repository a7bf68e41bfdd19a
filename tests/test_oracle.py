"""Every registered query against its DuckDB SQL text on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from kinnear.plans.queries import QUERIES

TABLES = ["lineitem", "orders", "customer", "events", "embeddings"]
SQL = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def _rows(df_cols, rows):
    order = sorted(range(len(df_cols)), key=lambda j: df_cols[j])
    return sorted((tuple(r[j] for j in order) for r in rows), key=repr)


def test_every_query_registered_has_sql_or_is_nested():
    q = QUERIES
    missing = set(q) - set(SQL)
    assert missing == {"neighbour_lists"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF_SMALL)
    got = _rows(sp.columns, [tuple(r) for r in sp.collect()])
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    want = _rows(cols, res.fetchall())
    assert sorted(sp.columns) == sorted(cols)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["u", "i", "rating", "prediction"]
    assert df.count() > 0
