"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import differences, duck

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(spark):
    return duck("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf, name):
    found = differences(spark, con, name, QUERIES[name], ORACLES.get(name), sf)
    # the smallest tables are shorter than some frames and filters
    assert [p for p in found if p != "no rows"] == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 5


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
