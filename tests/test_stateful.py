"""The stateful indicator stream against the batch table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_indicators import make_bars
from tidegauge.plans.indicators import indicators
from tidegauge.streaming.stateful import BARS_SCHEMA, bar_stream, keep_indicators

COLUMNS = ["ema_50", "tema_20", "rsi_14", "obv", "adx_14", "sar", "ht_trendmode", "mama"]


def rows(df):
    return {(r["symbol"], r["unix_timestamp"]): [r[c] for c in COLUMNS] for r in df.collect()}


def test_drops_with_restarts_between_them_equal_the_batch(spark, tmp_path):
    landed, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    bars = make_bars(spark, 1500, ("a",)).unionByName(make_bars(spark, 40, ("b",), 2)).select(*BARS_SCHEMA.names).cache()
    at = [1_700_000_000 + 3600 * n for n in (0, 20, 1000, 1010, 1500)]
    for begin, end in zip(at, at[1:]):
        bars.filter(f"unix_timestamp >= {begin} AND unix_timestamp < {end}").write.mode("append").parquet(landed)
        keep_indicators(bar_stream(spark, landed), COLUMNS, out, state).awaitTermination()
    bars.filter(f"unix_timestamp = {at[2]}").write.mode("append").parquet(landed)  # late
    keep_indicators(bar_stream(spark, landed), COLUMNS, out, state).awaitTermination()
    found = spark.read.parquet(out)
    late = found.filter("late").collect()
    assert [(r["symbol"], r["unix_timestamp"], r["ema_50"], r["ht_trendmode"]) for r in late] == [("a", at[2], None, None)]
    got, want = rows(found.filter("NOT late")), rows(indicators(bars, COLUMNS))
    assert got.keys() == want.keys() and found.filter("NOT late").count() == len(want)
    for key, values in want.items():
        for c, a, b in zip(COLUMNS, got[key], values):
            assert (a is None) == (b is None) and (b is None or a == pytest.approx(b, rel=1e-9, abs=1e-9)), (key, c)
