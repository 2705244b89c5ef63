"""Readers on small self-written files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidegauge.functions.topics import SEEDS
from tidegauge.operators.news import compact_timestamp, from_guardian, price_in_text
from tidegauge.sources import feeds


def test_registry():
    assert len(feeds.FEEDS) == 33 and len(feeds.feed("stocks").columns) == 10
    with pytest.raises(ValueError):
        feeds.feed("nothing")


def test_json_feed_with_alternative_date_field(spark, tmp_path):
    path = tmp_path / "f.json"
    path.write_text('[{"theDay": "2024-01-02 00:00:00", "unixTs": 5, "supplyCurrent": 1.5},\n {"theDay": null}]')
    spec = feeds.feed("supply_current")
    got = feeds.load_feed(feeds.read_json_feed(spark, str(path), spec.schema), spec).collect()
    assert [(str(r.date), r.unix_ts, r.supply_current) for r in got] == [("2024-01-02", 5, 1.5)]


def test_price_csv_skips_bad_and_short_rows(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("Open,Date,Close\n1,2024-01-01,10.5\n1,2024-01-02,n/a\n1\n1,2024-01-04,12\n")
    history = feeds.read_price_csv(spark, str(path))
    assert sorted(r.close for r in history.collect()) == [10.5, 12.0]
    assert feeds.latest_price(history).first()["close"] == 12.0


def test_price_csv_without_rows_is_an_error(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("Date,Close\n")
    with pytest.raises(ValueError):
        feeds.read_price_csv(spark, str(path))


def test_sitemap_trims_and_drops_malformed_files(spark, tmp_path):
    head = '<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
    (tmp_path / "ok.xml").write_text(head + "<url><loc>\n  http://a/\nb?x=1&amp;y=2 \n</loc></url><url><loc>http://c</loc></url></urlset>")
    got = feeds.read_sitemap(spark, str(tmp_path / "ok.xml"), "svc").collect()
    assert sorted(r.url for r in got) == ["http://a/b?x=1&y=2", "http://c"]
    (tmp_path / "bad.xml").write_text("not xml at all")
    assert feeds.read_sitemap(spark, str(tmp_path / "bad.xml"), "svc").count() == 0


def test_seeds_only_for_silent_services(spark):
    scanned = spark.createDataFrame([("u", "dbt-core", "dbt")], "url string, service string, type string")
    seeds = spark.createDataFrame([(u, s, "x") for s, us in SEEDS.items() for u in us], scanned.schema)
    got = feeds.with_seeds(scanned, seeds)
    assert got.filter("service = 'dbt-core'").count() == 1 and got.count() == 1 + 17 + 1


def test_kline_rows(spark, tmp_path):
    path = tmp_path / "k.txt"
    path.write_text('[1704070800123, "1.5", "2", "1", "1.75", "10", 1704074399999, "17.5", 3]\n')
    r = feeds.read_klines(spark, str(path)).first()
    assert (r.unix_timestamp, str(r.date), r.hour_of_day) == (1704070800, "2024-01-01", 1)
    assert (r.open, r.high, r.low, r.close, r.volume_btc, r.volume_usd) == (1.5, 2.0, 1.0, 1.75, 10.0, 17.5)


def test_timestamps_and_whole_numbers(spark):
    df = spark.createDataFrame([("2023-07-16 02:00:00.001", "5.9"), ("2023-07-09 18:00:00", "7")], "t string, n string")
    got = df.select(feeds.timestamp_text(F.col("t")).cast("string"), feeds.whole_number(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [("2023-07-16 02:00:00", 5), ("2023-07-09 18:00:00", 7)]


def test_compact_timestamps(spark):
    df = spark.createDataFrame([("20240102T030405",), ("20240102T0304",), ("soon",)], "t string")
    got = [r[0] for r in df.select(compact_timestamp(F.col("t")).cast("string")).collect()]
    assert got == ["2024-01-02 03:04:05", "2024-01-02 03:04:00", None]


def test_guardian_falls_back_to_the_web_title(spark):
    schema = ("webPublicationDate string, webTitle string, webUrl string, sectionName string, "
              "fields struct<headline:string,trailText:string>")
    df = spark.createDataFrame([("2024-01-02T03:04:05Z", "web", "u", "s", ("", None))], schema)
    r = from_guardian(df).first()
    assert r.headline == "web" and str(r.datetime) == "2024-01-02 03:04:05"


def test_price_in_text(spark):
    texts = ["Realized Price: $31,234.5 now", "about 12,000 dollars", "only 17", "none"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(price_in_text(F.col("t"), F.lit(100_000.0))).collect()]
    assert got == [31234.5, 12000.0, 60000.0, 60000.0]
