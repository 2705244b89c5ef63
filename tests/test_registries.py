"""Registries of pages whose urls repeat, against their SQL."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

# two pages of one url in one run, in both runs, in the registry; a page that comes twice or three times
PAGES = [(3, "a"), (9, "a"), (4, "b"), (15, "b"), (2, "c"), (8, "c"), (6, "d"), (6, "d"), (21, "e"), (21, "e"), (21, "e"), (10, "f"),
         (10, "f"), (5, "g"), (7, "g"), (1, "h")]


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame(PAGES, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def same_as_sql(spark, folder, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    got = Counter(tuple(r) for r in entry.queries()[name](spark, folder).collect())
    return got and got == Counter(con.sql(entry.oracle_sql()[name]).fetchall())


def test_pages_of_one_url_are_entries_of_their_own(spark, folder):
    assert same_as_sql(spark, folder, "K08_registry_append")


def test_pages_of_one_url_are_fetched_one_by_one(spark, folder):
    assert same_as_sql(spark, folder, "R07_delta_crawl_registry")
