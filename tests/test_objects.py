"""The data source for JSON arrays of objects, against one parser that sees the whole file."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from tidegauge.operators.keyed import wide_from_long
from tidegauge.sources import feeds
from tidegauge.sources.objects import read_objects, records

TEXTS = ['plain', 'brace { in', '},{"a": 1}', 'quote " and \\ back', '["x", {"a": 2}]', 'é日本', '{', '}', '\\"{', '", "a": 3}', '']


def some(rng, n):
    return [{"a": rng.choice([i, None, i / 2]), "t": rng.choice(TEXTS) * rng.randint(0, 3), "b": rng.choice([True, False])} for i in range(n)]


def test_every_cut_finds_each_record_once():
    rng = random.Random(5)
    for layout in ({}, {"indent": 1}, {"separators": (",", ":")}):
        rows = some(rng, 30)
        data = json.dumps(rows, ensure_ascii=rng.random() < 0.5, **layout).encode()
        read = lambda at, n: data[at:at + n]
        for width in (1, 7, 64, 1000, len(data) + 5):
            got = [r for at in range(0, len(data), width) for r in records(read, at, min(at + width, len(data)), len(data))]
            assert got == rows, (layout, width)


def test_broken_and_empty_files():
    def found(text):
        data = text.encode()
        return list(records(lambda at, n: data[at:at + n], 0, len(data), len(data)))

    assert found("") == [] and found("[]") == [] and found("[{}]") == [] and found("not json {") == []
    assert found('[{"a": 1}, {"a": }, {"a": 2}') == [{"a": 1}, {"a": 2}]
    assert found('[{"a": 1}]\n[{"a": 2}]') == [{"a": 1}, {"a": 2}]


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    rows = [{"d": f"2020-01-{1 + i % 28:02d}", "unixTs": i, "btcPrice": i / 7, "note": TEXTS[i % len(TEXTS)]} for i in range(100_000)]
    (tmp_path / "feed.json").write_text(json.dumps(rows))
    spec = feeds.feed("market_price")
    df = read_objects(spark, str(tmp_path / "feed.json"), spec.schema.add("note", "string"), 1 << 20)
    assert df.rdd.getNumPartitions() >= 8
    assert df.select(F.spark_partition_id().alias("p")).distinct().count() >= 8
    assert [tuple(r) for r in df.orderBy("unixTs").collect()] == [(r["d"], r["unixTs"], r["btcPrice"], r["note"]) for r in rows]


def test_types_folders_and_missing_fields(spark, tmp_path):
    (tmp_path / "feed=x").mkdir()
    (tmp_path / "feed=x" / "a.json").write_text('[{"n": 1, "v": "text"}, {"n": 2.5, "v": 3}, {"v": true, "s": 4}]')
    (tmp_path / "feed=x" / "_done").write_text("[{}]")
    got = read_objects(spark, f"file://{tmp_path}", feeds.T.StructType.fromDDL("feed string, n long, v double, s string")).collect()
    assert [tuple(r) for r in got] == [("x", 1, None, None), ("x", None, 3.0, None), ("x", None, None, "4")]
    (tmp_path / "none").mkdir()
    assert read_objects(spark, str(tmp_path / "none"), feeds.T.StructType.fromDDL("n long")).count() == 0


def test_all_feeds_in_one_scan_and_one_exchange(spark, tmp_path):
    for name, spec in feeds.FEEDS.items():
        (tmp_path / f"feed={name}").mkdir()
        rows = [{spec.date_field: f"2024-01-0{d} 00:00:00", "unixTs": d, **{f: d * 1.0 for f, _ in spec.columns}} for d in (1, 2)]
        if name == "stocks":
            rows.append({"d": "2024-01-02", "unixTs": 9, "gold": 5.0})
        if name == "mvocdd":
            rows.append({"d": "2024-01-03", "unixTs": 3, "mvocdd": 3.0})  # a date off the spine
        (tmp_path / f"feed={name}" / "x.json").write_text(json.dumps(rows))
    long = feeds.read_registry(spark, str(tmp_path))
    columns = [c for spec in feeds.FEEDS.values() for _, c in spec.columns]
    assert long.select("feed").distinct().count() == 33 and len(columns) == 42
    wide = wide_from_long(long, columns, list(feeds.SPINE), list(feeds.STAMPS))
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("BatchScan") == 1
    one, two = wide.orderBy("date").collect()
    assert one["unix_ts"] == 1 and {one[c] for c in columns} == {1.0}
    # the stocks' newest record has one price only, and its missing ones count
    assert (two["gold"], two["sp500"], two["nvidia"], two["mvrv"]) == (5.0, None, None, 2.0)
