"""Every registered query against its SQL."""

from __future__ import annotations

import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry_points
from gridlake.plans import oracle_sql, queries

ROOT = "/root/testdata/sf0.001"
QUERIES, SQL = queries.registered(), oracle_sql.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    return connect(ROOT)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_repair_windows_with_and_without_a_cap(spark):
    capped, every = (QUERIES[name](spark, ROOT).toPandas() for name in ("repair_windows", "repair_windows_all"))
    assert len(capped) <= 48 < len(every)
    hours = sorted(every["hour_start_utc"])
    assert sorted(capped["hour_start_utc"]) == hours[: len(capped)]


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, tables, name):
    expected = tables.execute(SQL[name]).df()
    assert difference(QUERIES[name](spark, ROOT).toPandas(), expected) is None
