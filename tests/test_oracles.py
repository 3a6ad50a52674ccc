"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from vitrine.workload import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def _normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return round(value, 9)
    return value


def _bag(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_normal(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    expected = duck.execute(entry_points.oracle_sql()[name])
    names = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(names)
    got = _bag((tuple(row) for row in result.collect()), result.columns)
    want = _bag(expected.fetchall(), names)
    assert got == want, f"extra {list((got - want).items())[:3]}, missing {list((want - got).items())[:3]}"
    assert sum(got.values()) > 0


def test_every_query_of_the_workload_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(entry_points.queries())


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0


def test_no_data_in_repository():
    root = Path(__file__).resolve().parent.parent
    assert not list(root.glob("**/*.parquet"))
