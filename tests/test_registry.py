"""Every registered query against its DuckDB oracle on the smallest test tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry
from __spark_entry__ import queries as all_queries
from ledgerloom.plans.registry import ORACLE_SQL, QUERIES

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = lambda v: "NaN" if isinstance(v, float) and math.isnan(v) else v
    return [columns[i] for i in order], sorted(
        (tuple(norm(r[i]) for i in order) for r in rows), key=repr
    )


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["o_orderpriority", "avg_totalprice"]
    assert df.count() == 4


def queries():
    return QUERIES


def oracle_sql():
    return ORACLE_SQL


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(all_queries())


def test_every_query_has_an_oracle():
    missing = set(queries()) - set(oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(oracle_sql()[name])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]

