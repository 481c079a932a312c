"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from oracle_check import TESTDATA, connect, difference
from tidemark.plans.catalog import registered
from tidemark.plans.oracle import ORACLE_SQL

FOLDER = f"{TESTDATA}/sf0.01"
KEYS = sorted(registered())


@pytest.fixture(scope="module")
def con():
    with connect(FOLDER) as connection:
        yield connection


def test_every_query_has_sql():
    assert sorted(ORACLE_SQL) == KEYS
    assert set(KEYS) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_sql(spark, con, key):
    query = entry_points.queries()[key](spark, FOLDER)
    assert difference(query, con, entry_points.oracle_sql()[key]) is None


def test_entry(spark):
    assert [tuple(row) for row in entry_points.entry(spark).select("step", "sessions").collect()] == [
        (1, 153),
        (2, 53),
        (3, 19),
    ]
