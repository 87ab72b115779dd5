"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest
from conftest import DATA

from checkset.oracles import ORACLES
from checkset.queries import QUERIES

TABLES = ["events", "customer", "part"]
ROWS_ONLY = {"train_logistic", "train_mlp", "train_gbt"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return None if math.isnan(value) else round(float(value), 6)
    return str(value)


def table(columns, data):
    order = sorted(columns)
    return order, sorted((tuple(plain(r[columns.index(c)]) for c in order) for r in data), key=repr)


def test_all_but_training_have_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert got == table(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(ROWS_ONLY - {"train_gbt"}))
def test_training_queries_give_rows(spark, name):
    assert QUERIES[name](spark, str(DATA)).count() > 0
