"""Every registered query against its SQL, run by another engine."""

from __future__ import annotations

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from conftest import physical_plan

import __spark_entry__ as entry_points
from lotwise.plans.checks import ORACLES
from lotwise.plans.registry import QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLES.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, database, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    result = database.execute(ORACLES[name])
    assert sorted(column[0] for column in result.description) == columns
    order = [[c[0] for c in result.description].index(column) for column in columns]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    found = Counter(tuple(row) for row in frame.select(*columns).collect())
    assert found == expected

    # No cross join, no window (a window cannot split a hot segment), no Python.
    plan = physical_plan(frame)
    for word in ["CartesianProduct", "BroadcastNestedLoopJoin", "Window", "Python", "Pandas"]:
        assert word not in plan


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns[0] == "id" and frame.columns[-1] == "processed_at"
    assert frame.count() > 0
