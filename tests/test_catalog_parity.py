"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

from tools.oracle_check import compare

SF = os.environ.get("ROLLBOOK_TEST_SF", "/root/testdata/sf0.001")


def _names():
    from rollbook.catalog import QUERIES
    return list(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res[0] == "ok" and res[1] > 0, res  # an oracle, and rows


def test_entry_contract(spark):
    import __spark_entry__ as e
    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(_names()) <= set(e.oracle_sql())
