"""Every query with a SQL form gives the same rows and types in DuckDB; the others give rows."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_same_as_sql(spark, duck, name):
    assert compare(entry.queries()[name](spark, SF_DIR), duck, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_flagship(spark):
    assert entry.entry(spark).count() == 87


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())
