"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert len(set(df.columns)) == len(df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        df.count()
    else:
        result = compare(df, con, sql)
        assert result.startswith("ok") and "TYPES" not in result, result


def test_entry_is_the_dashboard(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
