"""Loads from file to merged table, and prices from stored pages, on small self-written files."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidegauge.operators.prices import element_price, page_prices, realized_price
from tidegauge.sources import loads


def early():
    return F.to_timestamp(F.lit("2024-01-01 00:00:00"))


def late():
    return F.to_timestamp(F.lit("2024-06-01 00:00:00"))


def written(path, records):
    path.write_text(json.dumps(records, indent=2))
    return str(path)


def test_open_interest_sums_what_is_there_and_keeps_other_dates(spark, tmp_path):
    first = written(tmp_path / "a.json", [
        {"d": "2024-01-02", "unixTs": 5, "binance": 1.5, "gateIo": "2", "unknown": 9}, {"d": "2024-01-03", "okx": 4.0}, {"d": None, "okx": 1.0}])
    stored = loads.open_interest_table(spark, str(tmp_path / "t"))
    stored.create(loads.audited(loads.open_interest_rows(spark, first), early()))
    second = written(tmp_path / "b.json", [{"d": "2024-01-03 10:00:00", "unixTs": 7.9, "okx": None, "deltaExchange": 3}, {"d": "2025-01-01"}])
    assert loads.load_open_interest(stored, second, late()) == 2
    got = {r.date: r for r in stored.read().collect()}
    assert sorted(got) == [date(2024, 1, 2), date(2024, 1, 3), date(2025, 1, 1)]
    kept, changed, new = (got[d] for d in sorted(got))
    assert (kept.binance, kept.gate_io, kept.okx, kept.total_open_interest, kept.updated_at.month) == (1.5, 2.0, None, 3.5, 1)
    # a missing value overwrites a stored one
    assert (changed.unix_ts, changed.okx, changed.delta_exchange, changed.total_open_interest) == (7, None, 3.0, 3.0)
    assert (changed.created_at.month, changed.updated_at.month) == (1, 6)
    assert (new.total_open_interest, new.created_at.month) == (0.0, 6)
    assert stored.read(1).count() == 2


def test_a_delivery_that_fails_leaves_the_table(spark, tmp_path):
    stored = loads.open_interest_table(spark, str(tmp_path / "t"))
    stored.create(loads.audited(loads.open_interest_rows(spark, written(tmp_path / "a.json", [{"d": "2024-01-02", "okx": 1}])), early()))
    for records in ([{"d": "2024-01-02", "okx": "many"}], [{"d": "2024-01-05", "okx": 1}, {"d": "2024-01-05", "okx": 2}]):
        with pytest.raises(Exception):
            loads.load_open_interest(stored, written(tmp_path / "b.json", records), late())
        assert [(r.okx, r.updated_at.month) for r in stored.read().collect()] == [(1.0, 1)]
    assert loads.load_open_interest(stored, written(tmp_path / "c.json", []), late()) == 1


def test_funding_cuts_fractions_and_needs_time_and_rate(spark, tmp_path):
    path = written(tmp_path / "a.json", [
        {"d": "2023-07-16 02:00:00.001", "unixTs": "1689472800.7", "fundingRate": 0.01}, {"d": "2023-07-09 18:00:00", "unixTs": 1688925600, "fundingRate": "1e-4"},
        {"d": None, "unixTs": 1, "fundingRate": 1.0}, {"d": "2023-07-09 19:00:00", "unixTs": 1}])
    stored = loads.funding_table(spark, str(tmp_path / "t"))
    stored.create(loads.audited(loads.funding_rows(spark, path).limit(0), early()))
    loads.load_funding(stored, path, late())
    got = sorted((r.datetime, r.unix_ts, r.funding_rate) for r in stored.read().collect())
    assert got == [(datetime(2023, 7, 9, 18), 1688925600, 1e-4), (datetime(2023, 7, 16, 2), 1689472800, 0.01)]


def market_files(folder):
    texts = {
        "nasdaq": "Date,Open,High,Low,Close,Volume\n2024-01-02,1,1,1,10,5\n2024-01-03,1,1,1,11,\n2024-01-02,1,1,1,12,5\n2024-01-04,1,1,1,n/a,1\n",
        "vix": "Close, Date\n20,2024-01-05\n",
        "gold": "nothing here\n1\n",
    }
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text)
    return {name: str(folder / f"{name}.csv") for name in loads.MARKETS}


def test_market_history_by_each_files_own_header(spark, tmp_path):
    got = sorted(tuple(r) for r in loads.market_history(spark, market_files(tmp_path)).collect())
    # the later line of a date wins; no file for dxy, no header for gold
    assert got == [(date(2024, 1, 2), 12.0, None, None, None), (date(2024, 1, 3), 11.0, None, None, None), (date(2024, 1, 5), None, 20.0, None, None)]
    assert tuple(loads.market_latest(spark, market_files(tmp_path)).first()) == (date(2024, 1, 3), 11.0, 20.0, None, None)
    with pytest.raises(ValueError):
        loads.market_history(spark, {"nasdaq": str(tmp_path / "none.csv")})


def test_market_load_takes_the_history_only_into_a_short_table(spark, tmp_path):
    paths = market_files(tmp_path)
    stored = loads.market_table(spark, str(tmp_path / "t"))
    stored.create(loads.audited(loads.market_history(spark, paths).filter("date = '2024-01-02'").withColumn("dxy", F.lit(7.0)), early()))
    loads.load_market(stored, paths, late(), fewest=1)
    assert sorted((str(r.date), r.nasdaq, r.vix, r.dxy) for r in stored.read().collect()) == [("2024-01-02", 12.0, None, 7.0), ("2024-01-03", 11.0, 20.0, None)]
    loads.load_market(stored, paths, late())
    assert sorted((str(r.date), r.nasdaq, r.vix, r.dxy) for r in stored.read().collect()) == [
        ("2024-01-02", 12.0, None, None), ("2024-01-03", 11.0, None, None), ("2024-01-05", None, 20.0, None)]


@pytest.mark.parametrize("html, price", [
    ('<p class="price">9</p><b class="x realized-price-selector">$1,234.5 now</b>', 1234.5),
    # every rule finds the same first element here
    ('<b class="realized-price-selector">soon</b><i class="price">$ 7</i>', None),
    ('<b class="realized">soon</b><i class="price">$ 7</i>', 7.0),
    ('<b class="unrealized">5.</b><i class="price">7</i>', 5.0),
    ('<i class="Price">7</i>', None),
    ('<div class="the-price"><script>3</script><span>a 4 b 5</span></div>', 4.0),
    ("", None), ("<p>12", None),
])
def test_price_of_an_element(html, price):
    assert element_price(html) == price


def test_realized_price_falls_back_to_text_and_estimate(spark):
    rows = [(1, '<b class="price">3</b>', "Realized Price: 6,000", 100.0), (2, "<p>", "Realized Price: 6,000", 100.0), (3, "<p>", "only 12", 100.0),
            (4, None, "Realized Price: 6,000", 100.0), (5, "<p>", None, None)]
    pages = spark.createDataFrame(rows, "id int, html string, markdown string, close double")
    got = {r.id: (r.realized_price, r.found) for r in realized_price(page_prices(pages), "close").collect()}
    assert got == {1: (3.0, "element"), 2: (6000.0, "text"), 3: (60.0, "estimate"), 4: (60.0, "estimate"), 5: (None, "estimate")}
