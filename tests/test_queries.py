"""Every registered query against the SQL registered with it."""

from __future__ import annotations

import math

import duckdb
import pytest

from weftgraph.plans.queries import QUERIES, SQL, TABLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.execute(SQL[name])
    names = [c[0] for c in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    expected = _rows(names, theirs.fetchall())
    assert expected
    assert _rows(ours.columns, ours.collect()) == expected
