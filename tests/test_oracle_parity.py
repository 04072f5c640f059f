"""Every registered query equals its SQL oracle (DuckDB) exactly, at sf0.001."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import compare
from quitanda.catalog import ORACLES, QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "sales_month"
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, name):
    ok, info = compare(spark, duck_small, name, SF_SMALL, QUERIES[name], ORACLES[name])
    assert ok, info
