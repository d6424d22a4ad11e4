"""Every registered query against DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import compare

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_query_has_its_sql():
    assert set(entry._post_queries()) == set(entry._post_sql())
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names, rows = compare.rows_of_spark(df)
    wanted = compare.rows_of_duck(duck, ORACLES[name])
    assert (names, rows) == wanted
    assert compare.negative_zeros(rows) == compare.negative_zeros(wanted[1]) == 0
    assert rows or name == "kmeans_converged"


def test_entry(spark):
    assert entry.entry(spark).columns == ["tag", "experts"]
