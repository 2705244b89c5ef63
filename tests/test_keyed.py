"""Merge, dedup and date-join properties."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import keyed, news
from tidegauge.sources import sinks


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, 10.0, "x"), (2, 20.0, "y"), (None, 30.0, "z")], "k long, v double, w string")


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(2, None, "n"), (3, 33.0, "m"), (None, 99.0, "q")], "k long, v double, w string")


def test_upsert_overwrites_with_null_and_null_keys_never_match(target, source):
    got = set(rows(keyed.upsert(target, source, ["k"]), "k", "v"))
    assert got == {(1, 10.0, "x"), (2, None, "n"), (3, 33.0, "m"), (None, 30.0, "z"), (None, 99.0, "q")}


def test_upsert_twice_is_upsert_once(target, source):
    source = source.dropna(subset=["k"])
    once = keyed.upsert(target, source, ["k"])
    assert rows(once, "k") == rows(keyed.upsert(once, source, ["k"]), "k")


def test_upsert_refuses_duplicate_source_keys(target, source):
    with pytest.raises(ValueError):
        keyed.upsert(target, source.unionByName(source), ["k"])


def test_partial_upsert_keeps_other_columns(target, source):
    got = dict((r.k, (r.v, r.w)) for r in keyed.upsert(target, source, ["k"], update=["v"]).collect() if r.k)
    assert got == {1: (10.0, "x"), 2: (None, "y"), 3: (33.0, None)}


def test_insert_only_keeps_stored_rows(target, source):
    got = dict((r.k, r.v) for r in keyed.insert_new(target, source, ["k"]).collect() if r.k)
    assert got == {1: 10.0, 2: 20.0, 3: 33.0}


def test_latest_per_key_reduces_before_the_shuffle(spark):
    hot = spark.range(10_000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("v"))
    latest = keyed.latest_per_key(hot, ["k"], [F.col("v")])
    assert rows(latest, "k") == [(0, 9998), (1, 9999)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_wide_join_drops_dates_off_the_spine(spark):
    frame = lambda data: spark.createDataFrame(data, "date string, unix_ts long, value double")
    series = {"a": frame([("d1", 1, 1.0)]), "b": frame([("d1", 2, 2.0), ("d2", 3, 3.0)])}
    assert rows(keyed.wide_by_date(series, ["a"]), "date") == [("d1", 1, 1.0, 2.0)]
    full = rows(keyed.wide_by_date(series, ["a"], full_spine=True), "date")
    assert full == [("d1", 1, 1.0, 2.0), ("d2", 3, None, 3.0)]
    plan = keyed.wide_by_date(series, ["a"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_wide_join_keeps_values_without_a_time(spark):
    series = {"a": spark.createDataFrame([("d1", None, 1.0), ("d2", None, 9.0), ("d2", 5, 2.0)], "date string, unix_ts long, value double")}
    assert rows(keyed.wide_by_date(series, ["a"]), "date") == [("d1", None, 1.0), ("d2", 5, 2.0)]


def test_later_duplicate_wins_when_aligned(spark):
    df = spark.createDataFrame([("d", 1.0, 0), ("d", 2.0, 1)], "date string, value double, ord int")
    assert rows(keyed.align_by_date({"a": df}), "date") == [("d", 2.0)]


def test_first_feed_wins_per_lower_cased_address(spark):
    feed = lambda urls, name: spark.createDataFrame(
        [(u, name) for u in urls], "url string, api_source string"
    )
    feeds = [feed(["http://A ", ""], "one"), feed(["http://a", "http://b"], "two")]
    got = rows(news.union_by_priority(feeds, [F.col("url")]), "url")
    assert got == [("http://A ", "one"), ("http://b", "two")]


def test_hour_grid_and_missing_rows(spark):
    bounds = spark.createDataFrame([("a", 3600 * 22, 3600 * 26)], "symbol string, first_ts long, last_ts long")
    grid = keyed.hour_grid(bounds)
    assert [r[1] // 3600 for r in rows(grid, "unix_timestamp")] == [22, 23, 24, 25, 26]
    have = grid.filter("unix_timestamp != 3600 * 24")
    assert rows(keyed.missing_rows(grid, have, ["symbol", "unix_timestamp"]), "symbol") == [("a", 86_400)]


def test_status_decides_what_to_do(spark):
    schema = "unix_timestamp long, s long"
    decide = lambda data: keyed.table_status(
        spark.createDataFrame(data, schema), "unix_timestamp", "s"
    ).first()["action"]
    assert decide([(None, 5)]) == "initialize"
    assert decide([(4, None), (None, 5)]) == "delta"
    assert decide([(5, None), (None, 5)]) == "skip"


def test_csv_export_is_ordered_and_fixed(spark, tmp_path):
    df = spark.createDataFrame([(i, 1 / (i + 1)) for i in range(50)], "k long, v double")
    sinks.export_csv(df, str(tmp_path / "out"), "k", single_file=True)
    lines = next((tmp_path / "out").glob("part-*.csv")).read_text().splitlines()
    assert lines[0] == "k,v" and lines[1] == "0,1.00000000" and lines[3] == "2,0.33333333"


def test_snapshot_never_overwrites(spark, tmp_path):
    base = str(tmp_path / "t")
    first = sinks.write_snapshot(spark.range(3), base)
    second = sinks.write_snapshot(spark.read.parquet(first).filter("id > 0"), base)
    assert spark.read.parquet(first).count() == 3 and spark.read.parquet(second).count() == 2


def test_backup_quotes_and_strips_commas(spark, tmp_path):
    df = spark.createDataFrame([('say "hi"', "a, b")], "title string, source string")
    sinks.backup_csv(df, str(tmp_path / "b"), "2024-01-31T05:00:00", ["source"])
    text = next((tmp_path / "b" / "folder=2024-01-31").glob("part-*.csv")).read_text()
    assert '"say ""hi""","a b"' in text


def test_filtered_delta_equals_the_anti_join(spark, monkeypatch):
    registry = spark.range(0, 200_000, 3).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"))
    arrived = spark.range(0, 400, 1).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), "id").unionByName(
        spark.createDataFrame([(None, -1), (None, -2), ("u1", 1)], "url string, id long"))
    want = rows(keyed.missing_rows(arrived, registry, ["url"]), "id", "url")
    found = keyed.delta(arrived, registry, "url")
    assert rows(found, "id", "url") == want and len(want) == 269
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan
    # what reaches the anti join: the registry's 134 keys that arrived and the few that share their bits
    assert 134 <= keyed.possibly_held(registry, arrived.select("url").distinct(), "url").count() < 150
    monkeypatch.setattr(keyed, "FILTER_KEYS", 10)
    assert rows(keyed.delta(arrived, registry, "url"), "id", "url") == want
    assert keyed.delta(arrived.limit(0), registry, "url").count() == 0
    assert rows(keyed.delta(arrived, registry.limit(0), "url"), "id", "url") == rows(arrived, "id", "url")
