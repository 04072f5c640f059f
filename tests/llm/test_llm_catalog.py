"""The registered queries: one for each operator, with SQL where there is one."""

from __future__ import annotations

import re

import pytest

from quitanda.llm.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    from oracle_check import compare, duck
    ok, info = compare(spark, duck(SF), name, SF, QUERIES[name], ORACLES[name])
    assert ok, info


def test_registered_by_the_entry():
    import __spark_entry__ as entry
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
