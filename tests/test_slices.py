"""Scans over slices against runs over whole series."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge.operators.slices import cut, exponential_scan, interpolated, missing_ranges
from tidegauge.plans import strategy as st

HOUR = 3600


def walks(rng, symbols=("a", "b"), n=500, holes=0.3):
    out = []
    for s in symbols:
        steps = np.exp(np.cumsum(rng.normal(0, 0.05, (3, n)), axis=1))
        for i in range(n):
            known = [float(steps[k, i]) if rng.random() > holes else None for k in range(3)]
            out.append((s, HOUR * (i + (i > 200) * 7), *known))
    return out


SCHEMA = "symbol string, unix_timestamp long, close double, mvrv double, nupl double"


@pytest.mark.parametrize("rows", [1, 7, 100, 5000])
def test_exponential_mean_of_slices_equals_pandas(spark, rows):
    data = walks(np.random.default_rng(2)) + [("c", HOUR, None, None, None), ("c", 2 * HOUR, 4.0, None, None)]
    data = [r for r in data if r[0] != "b" or not 40 * HOUR < r[1] < 90 * HOUR] + [("b", i * HOUR, None, None, None) for i in range(41, 90)]
    df = exponential_scan(cut(spark.createDataFrame(data, SCHEMA), rows), ["symbol"], "unix_timestamp", "close", 12, "e")
    got = {(r["symbol"], r["unix_timestamp"]): r["e"] for r in df.collect()}
    for symbol, pdf in pd.DataFrame(data, columns=["symbol", "t", "close", "m", "n"]).sort_values("t").groupby("symbol"):
        want = pdf["close"].astype(float).ewm(span=12, adjust=False).mean()
        for t, w in zip(pdf["t"], want):
            assert (got[symbol, t] is None) == bool(np.isnan(w)) and (np.isnan(w) or got[symbol, t] == pytest.approx(w)), (symbol, t)


@pytest.mark.parametrize("rows", [1, 10, 5000])
def test_gaps_over_several_slices_are_interpolated(spark, rows):
    data = walks(np.random.default_rng(3), n=120, holes=0.9)
    df = interpolated(cut(spark.createDataFrame(data, SCHEMA), rows), ["symbol"], "unix_timestamp", ["close", "mvrv"])
    got = {(r["symbol"], r["unix_timestamp"]): (r["close"], r["mvrv"]) for r in df.collect()}
    for symbol, pdf in pd.DataFrame(data, columns=["symbol", "t", "close", "mvrv", "n"]).groupby("symbol"):
        for k, c in enumerate(("close", "mvrv")):
            want = pd.Series(pdf[c].astype(float).to_numpy(), index=pdf["t"]).interpolate(method="index")
            for t, w in want.items():
                assert (got[symbol, t][k] is None) == bool(np.isnan(w)) and (np.isnan(w) or got[symbol, t][k] == pytest.approx(w))


@pytest.mark.parametrize("kind", ["WMA", "SMA", "EMA", "DEMA"])
def test_strategy_of_slices_equals_the_whole_run(spark, kind):
    data = walks(np.random.default_rng(4), n=900, holes=0.1)
    bars = spark.createDataFrame(data, SCHEMA).cache()
    s = st.Settings(ma_type=kind, ma_length=30, lookback=20, by=["symbol"])
    whole = bars.withColumn("date", F.date_add(F.lit("2000-01-01").cast("date"), (F.col("unix_timestamp") / HOUR).cast("int")))
    want = {(r["symbol"], r["unix_timestamp"]): r for r in st.run(whole, s).collect()}
    cutted = st.run_sliced(bars, s, 64)
    got = cutted.collect()
    assert len(got) == len(want) and sum(r["signal"] != 0 for r in got) > 10
    for r in got:
        w = want[r["symbol"], r["unix_timestamp"]]
        for c in ("position", "signal", "portfolio_value", "buy_hold_value", "strategy_returns", "buy_hold_returns",
                  "strategy_cum_returns", "buy_hold_cum_returns", "combined_zscore"):
            assert (r[c] is None) == (w[c] is None) and (w[c] is None or r[c] == pytest.approx(w[c], rel=1e-6, abs=1e-6)), (c, r, w)


def test_missing_ranges_cross_slices(spark):
    df = spark.createDataFrame([("a", t) for t in (0, 1, 4, 5, 39, 40)] + [("b", 7)], "symbol string, unix_timestamp long")
    for width in (1, 10, 1000):
        got = sorted(tuple(r) for r in missing_ranges(df, ["symbol"], "unix_timestamp", 1, width).collect())
        assert got == [("a", 2, 3, 2), ("a", 6, 38, 33)]
    assert missing_ranges(df.limit(0), ["symbol"], "unix_timestamp", 1, 10).count() == 0
