"""Every registered query against its SQL twin on DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks import QUERIES
from checks.compare import difference, duck
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(name, spark, con):
    diff, count = difference(name, spark, con, SF)
    assert diff is None, diff
    assert count > 0 or name in {"flt_01_on_day", "flt_02_named_locations"}


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns[:3] == ["shop", "day", "total_sales"]


def test_versions_cover_all_lines(spark, con):
    """The load of line versions has every line of an order and product that is known, also those that share order and number."""
    _, count = difference("ds_13_pos_line_versions", spark, con, SF)
    assert count == con.execute("""
        SELECT count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey
        WHERE l_linenumber <> 7 AND o_orderstatus <> 'F'""").fetchone()[0]
