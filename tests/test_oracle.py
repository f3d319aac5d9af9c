"""Every registered query against its SQL in DuckDB, on whole tables."""

import os
from decimal import Decimal

import duckdb
import pytest

from bundlescope.plans import oracle, registry
from bundlescope.plans.inputs import TABLES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registry.registered()
ORACLE = oracle.statements()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')"
        )
    return connection


def _plain(value):
    return float(value) if isinstance(value, Decimal) else value


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    names = [columns[n] for n in order]
    return names, sorted((tuple(_plain(row[n]) for n in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    got = _canonical(frame.columns, [tuple(row) for row in frame.collect()])
    cursor = duck.execute(ORACLE[name])
    want = _canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    for mine, theirs in zip(got[1], want[1]):
        assert mine == theirs
    assert want[1], "the query should return rows"
