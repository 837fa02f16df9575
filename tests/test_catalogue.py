"""Registered queries against their SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__
from lacuna.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    fix = lambda x: None if x is None or (isinstance(x, float) and math.isnan(x)) else round(float(x), 5) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    return sorted((tuple(fix(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equal_to_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(cursor.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert {r.event_type: (r.nbins, r.n_zero_bins, r.n_uncovered) for r in rows}["click"] == (14, 4, 1)
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
