"""Hand-computed values, independent formulations and properties of the series operators."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import recursive as rec
from tidegauge.plans.indicators import INDICATORS, indicators
from tidegauge.streaming.incremental import IndicatorStore, first_run, next_run, restart_points


def make_bars(spark, rows: int, symbols=("a", "b"), seed=1):
    """Random walks with zero-range bars, ties and a flat stretch."""
    rng, frames = np.random.default_rng(seed), []
    for k, symbol in enumerate(symbols):
        close = 100 + k + np.cumsum(rng.normal(0, 1, rows)).round(2)
        close[20:30] = close[20]
        open_ = np.concatenate([[close[0]], close[:-1]])
        high = np.maximum(open_, close) + rng.integers(0, 3, rows) * 0.25
        low = np.minimum(open_, close) - rng.integers(0, 3, rows) * 0.25
        frames.append(pd.DataFrame({
            "symbol": symbol, "unix_timestamp": 1_700_000_000 + 3600 * np.arange(rows),
            "open": open_, "high": high, "low": low, "close": close,
            "volume_btc": rng.integers(1, 50, rows).astype(float), "volume_usd": 1.0,
        }))
    return spark.createDataFrame(pd.concat(frames))


def table(df, symbol=None) -> pd.DataFrame:
    out = df.toPandas().sort_values(["symbol", "unix_timestamp"]).reset_index(drop=True)
    return out if symbol is None else out[out.symbol == symbol].reset_index(drop=True)


def assert_same(left: pd.DataFrame, right: pd.DataFrame, columns, rel=1e-9):
    assert len(left) == len(right)
    for c in columns:
        a, b = left[c].astype(float).to_numpy(), right[c].astype(float).to_numpy()
        assert (np.isnan(a) == np.isnan(b)).all(), c
        np.testing.assert_allclose(a, b, rtol=rel, atol=1e-9, err_msg=c)


def simple(spark, closes, **other):
    n = len(closes)
    closes = [float(c) for c in closes]
    data = {
        "symbol": "s", "unix_timestamp": [3600 * i for i in range(n)], "open": closes, "high": closes,
        "low": closes, "close": closes, "volume_btc": [10.0] * n, "volume_usd": [1.0] * n, **other,
    }
    return spark.createDataFrame(pd.DataFrame(data))


def test_there_are_110_columns():
    assert len(INDICATORS) == len(set(INDICATORS)) == 110


def test_first_values_of_averages(spark):
    got = table(indicators(simple(spark, range(1, 41)), ["sma_5", "ema_5", "wma_10", "trima_20", "mom_10"]))
    assert got.sma_5.isna().sum() == 4 and got.sma_5[4] == 3.0
    assert got.ema_5.isna().sum() == 4 and got.ema_5[4] == 3.0
    assert got.ema_5[5] == pytest.approx(3 + (6 - 3) / 3)
    assert got.wma_10[9] == pytest.approx(sum(i * i for i in range(1, 11)) / 55)
    assert got.trima_20[19] == pytest.approx(10.5) and got.trima_20.isna().sum() == 19
    assert got.mom_10[10] == 10.0


@pytest.mark.parametrize("column,first", [
    ("dema_10", 18), ("tema_10", 27), ("t3_5", 24), ("kama_20", 20), ("rsi_14", 14), ("macd", 33),
    ("macd_signal", 33), ("slowk", 8), ("fastk", 6), ("stochrsi_fastk", 20), ("ultosc", 28), ("adosc", 9),
    ("mfi_14", 14), ("atr_14", 14), ("adx_14", 27), ("adxr_14", 40), ("dx_14", 14), ("plus_dm", 13),
    ("aroon_up", 14), ("sar", 1), ("beta", 5), ("correl", 29), ("ht_dcperiod", 32), ("ht_dcphase", 63),
    ("mama", 32), ("cci_14", 13), ("volatility_30d", 720), ("price_volatility_30d", 719),
    ("hl_volatility_30d", 719),
])
def test_warm_up_length(spark, column, first, walk):
    assert walk[column].first_valid_index() == first


@pytest.fixture(scope="module")
def walk(spark):
    return table(indicators(make_bars(spark, 900)), "a")


def test_rsi_by_hand(spark):
    closes = [44, 44.5, 44, 43.5, 44, 44.5, 45, 45.5, 45, 44]
    got = table(indicators(simple(spark, closes), ["rsi_7"]))
    gains, losses = [0.5, 0, 0, 0.5, 0.5, 0.5, 0.5], [0, 0.5, 0.5, 0, 0, 0, 0]
    g, l = sum(gains) / 7, sum(losses) / 7
    assert got.rsi_7[7] == pytest.approx(100 * g / (g + l))
    g, l = g * 6 / 7, (l * 6 + 0.5) / 7
    assert got.rsi_7[8] == pytest.approx(100 * g / (g + l))


def test_flat_series(spark):
    """No change and no range: ratios are 0, not NULL or NaN."""
    got = table(indicators(simple(spark, [5] * 80), [
        "rsi_14", "cci_14", "willr_14", "bop", "correl", "beta", "dx_14", "stochrsi_fastk", "ad", "stddev",
        "kama_20", "ultosc", "cmo_14",
    ]))
    last = got.iloc[-1]
    for c in ("rsi_14", "cci_14", "bop", "correl", "beta", "dx_14", "stochrsi_fastk", "ad", "stddev", "ultosc", "cmo_14"):
        assert last[c] == 0, c
    assert last.willr_14 == 0 and last.kama_20 == 5


def test_sar_by_hand(spark):
    high, low = [10.0, 11, 12, 11.5, 9], [9.0, 10, 11, 10.5, 8]
    got = table(indicators(simple(spark, [9.5, 10.5, 11.5, 11, 8.5], high=high, low=low), ["sar"]))
    # long: stop 9, extreme 11, then 9 + 0.02*2 capped by the lows 10 and 10
    assert math.isnan(got.sar[0]) and got.sar[1] == 9.0
    assert got.sar[2] == pytest.approx(9.04)
    third = 9.04 + 0.04 * (12 - 9.04)
    assert got.sar[3] == pytest.approx(third)
    # low 8 touches the stop: turn at the extreme point 12
    assert got.sar[4] == pytest.approx(12.0)


def candle(spark, bars, column):
    """Ten plain bars (body 1, range 2) before the given (o, h, l, c)."""
    plain = [(10.0, 11.5, 9.5, 11.0), (11.0, 11.5, 9.5, 10.0)] * 6
    rows = plain + bars
    cols = dict(zip(("open", "high", "low", "close"), map(list, zip(*rows))))
    df = simple(spark, cols["close"], open=cols["open"], high=cols["high"], low=cols["low"])
    return table(indicators(df, [column]))[column].tolist()


@pytest.mark.parametrize("column,bars,value", [
    ("cdl_doji", [(10, 11, 9, 10.1)], 100),
    ("cdl_hammer", [(9.6, 10.05, 8.0, 10.0)], 100),
    ("cdl_hanging_man", [(11.5, 11.85, 10.0, 11.8)], -100),
    ("cdl_inverted_hammer", [(9.7, 11.0, 9.65, 9.8)], 100),
    ("cdl_shooting_star", [(11.2, 13.0, 11.15, 11.4)], -100),
    ("cdl_engulfing", [(9.9, 11.6, 9.5, 11.5)], 100),
    ("cdl_morning_star", [(11, 11.1, 7.9, 8), (7.5, 7.7, 7.2, 7.4), (7.8, 10.6, 7.7, 10.5)], 100),
    ("cdl_evening_star", [(8, 12.1, 7.9, 12), (12.5, 12.9, 12.4, 12.7), (12.0, 12.1, 8.9, 9)], -100),
    ("cdl_three_white_soldiers", [(10, 12.05, 9.9, 12), (11, 13.55, 10.9, 13.5), (12.5, 15.55, 12.4, 15.5)], 100),
    ("cdl_three_black_crows", [(10, 12, 9.9, 11.9), (11.5, 11.6, 9.95, 10), (11, 11.1, 8.95, 9), (9.5, 9.6, 7.95, 8)], -100),
    ("cdl_harami", [(13, 13.2, 9.8, 10), (11, 11.6, 10.9, 11.5)], 100),
    ("cdl_dark_cloud_cover", [(10, 13.1, 9.9, 13), (13.5, 13.6, 10.9, 11)], -100),
    ("cdl_piercing", [(13, 13.1, 9.9, 10), (9.5, 12.3, 9.4, 12.2)], 100),
    ("cdl_marubozu", [(10, 13.05, 9.95, 13)], 100),
    ("cdl_spinning_top", [(10, 11.5, 8.9, 10.5)], 100),
])
def test_candle_patterns(spark, column, bars, value):
    bars = [tuple(map(float, b)) for b in bars]
    assert candle(spark, bars, column)[-1] == value


def reference_cycle(close, start):
    """The dominant cycle, written row by row with full histories."""
    n = len(close)
    s, det, q1, i1, ji, jq = (np.zeros(n + 8) for _ in range(6))
    i2 = q2 = re = im = period = smooth = 0.0
    out, phasor = np.full(n, np.nan), np.full((n, 2), np.nan)
    fir = lambda h, t, k: (0.0962 * h[t] + 0.5769 * h[t - 2] - 0.5769 * h[t - 4] - 0.0962 * h[t - 6]) * k
    for t in range(start, n):
        k = 0.075 * period + 0.54
        s[t] = (4 * close[t] + 3 * close[t - 1] + 2 * close[t - 2] + close[t - 3]) / 10
        det[t] = fir(s, t, k)
        q1[t], i1[t] = fir(det, t, k), det[t - 3]
        ji[t], jq[t] = fir(i1, t, k), fir(q1, t, k)
        ni2, nq2 = 0.2 * (i1[t] - jq[t]) + 0.8 * i2, 0.2 * (q1[t] + ji[t]) + 0.8 * q2
        re, im = 0.2 * (ni2 * i2 + nq2 * q2) + 0.8 * re, 0.2 * (ni2 * q2 - nq2 * i2) + 0.8 * im
        i2, q2, old = ni2, nq2, period
        if re and im:
            period = 360 / math.degrees(math.atan(im / re))
        period = min(period, 1.5 * old)
        period = max(period, 0.67 * old)
        period = 0.2 * min(max(period, 6), 50) + 0.8 * old
        smooth = 0.33 * period + 0.67 * smooth
        out[t], phasor[t] = smooth, (i1[t], q1[t])
    return s, out, phasor


def test_cycle_against_row_by_row_form(walk):
    close = walk.close.to_numpy()
    _, period, phasor = reference_cycle(close, 12)
    np.testing.assert_allclose(walk.ht_dcperiod[32:], period[32:], rtol=1e-9)
    np.testing.assert_allclose(walk.ht_inphase[32:], phasor[32:, 0], rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(walk.ht_quadrature[32:], phasor[32:, 1], rtol=1e-9, atol=1e-12)

    s, period, _ = reference_cycle(close, 37)
    trend, phase = [], 0.0
    for t in range(37, len(close)):
        n = int(period[t] + 0.5)
        values = [s[t - j] if t - j >= 0 else 0.0 for j in range(n)]
        re = sum(math.sin(2 * math.pi * j / n) * v for j, v in enumerate(values)) if n else 0.0
        im = sum(math.cos(2 * math.pi * j / n) * v for j, v in enumerate(values)) if n else 0.0
        phase = math.degrees(math.atan(re / im)) if im else phase + 90 * np.sign(re)
        phase += 90 + 360 / period[t] + (180 if im < 0 else 0)
        phase -= 360 if phase > 315 else 0
        trend.append(np.mean(close[t - n + 1:t + 1]) if n else 0.0)
        if t >= 63:
            assert walk.ht_dcphase[t] == pytest.approx(phase, rel=1e-7)
            assert walk.ht_sine[t] == pytest.approx(math.sin(math.radians(phase)), abs=1e-9)
            line = (4 * trend[-1] + 3 * trend[-2] + 2 * trend[-3] + trend[-4]) / 10
            assert walk.ht_trendline[t] == pytest.approx(line, rel=1e-9)
    assert set(walk.ht_trendmode) <= {0, 1} and (walk.ht_trendmode[:63] == 0).all()
    assert walk.ht_trendmode[63:].nunique() == 2


def test_adaptive_averages_against_row_by_row_form(walk):
    close = walk.close.to_numpy()
    _, _, phasor = reference_cycle(close, 12)
    mama = fama = before = 0.0
    for t in range(12, len(close)):
        i, q = phasor[t]
        phase = math.degrees(math.atan(q / i)) if i else 0.0
        alpha = max(0.5 / max(before - phase, 1.0), 0.05)
        before = phase
        mama = alpha * close[t] + (1 - alpha) * mama
        fama = 0.5 * alpha * mama + (1 - 0.5 * alpha) * fama
        if t >= 32:
            assert walk.mama[t] == pytest.approx(mama) and walk.fama[t] == pytest.approx(fama)


def test_segments_do_not_change_results(spark):
    bars = make_bars(spark, 2500)
    whole = table(indicators(bars))
    cut = table(indicators(bars, rows_per_segment=800))
    assert_same(whole, cut, INDICATORS)


def test_symbols_do_not_influence_each_other(spark):
    columns = ["ema_50", "obv", "sar", "mama", "sma_20", "adx_14"]
    both = table(indicators(make_bars(spark, 300), columns), "a")
    alone = table(indicators(make_bars(spark, 300, symbols=("a",)), columns), "a")
    assert_same(both, alone, columns)


def test_delta_runs_equal_a_full_run(spark):
    """Three symbols: long, short, and one that only appears in the last run."""
    bars = make_bars(spark, 1500, ("a",)).unionByName(make_bars(spark, 400, ("b",), 2)).unionByName(
        make_bars(spark, 1500, ("c",), 3).filter("unix_timestamp >= 1700000000 + 3600 * 1300")
    ).cache()
    columns = [c for c in INDICATORS]
    full = table(indicators(bars, columns))
    at = [1_700_000_000 + 3600 * n for n in (1000, 1300)]
    rows, progress = first_run(bars.filter(f"unix_timestamp < {at[0]}"), columns)
    second, progress = next_run(progress, bars.filter(f"unix_timestamp >= {at[0]} AND unix_timestamp < {at[1]}"), columns)
    third, _ = next_run(progress, bars.filter(f"unix_timestamp >= {at[1]}"), columns)
    assert_same(full, table(rows.unionByName(second).unionByName(third)), columns)


def test_state_size_is_declared_right():
    rng = np.random.default_rng(0)
    close = 50 + np.cumsum(rng.normal(0, 1, 400))
    pdf = pd.DataFrame({"high": close + 1, "low": close - 1, "close": close, "open": close, "volume_btc": 1.0})
    x = rec.price_inputs(pdf)
    x.update(rec.run_network(rec.NETWORK, x, None))
    for run, size, _ in rec.SYSTEMS.values():
        assert len(run(x, 0, None)[1]) == size


def test_affine_blocks_equal_a_loop():
    b = np.random.default_rng(0).normal(size=1000)
    for decay in (0.0, 0.5, 0.96, 1.0):
        x, want = 3.0, []
        for v in b:
            x = decay * x + v
            want.append(x)
        np.testing.assert_allclose(rec.affine(decay, b, 3.0), want, rtol=1e-10, atol=1e-10)


def test_skip_and_wrap(spark):
    bars = make_bars(spark, 730)
    skipped = table(indicators(bars, ["price_change"], skip_rows=720))
    assert len(skipped) == 20
    wrapped = table(indicators(bars, ["price_change"], wrap_first=True), "a")
    assert wrapped.price_change[0] == pytest.approx(wrapped.close[0] / wrapped.close.iloc[-1] - 1)


def test_states_forget_where_a_series_started():
    """Otherwise every segment would wait for the one before it."""
    rng = np.random.default_rng(5)
    close = 500 + np.cumsum(rng.normal(0, 1, 2500))
    pdf = pd.DataFrame({
        "high": close + rng.random(2500), "low": close - rng.random(2500), "close": close, "open": close,
        "volume_btc": 1.0,
    })
    ends = []
    for begin in (0, 200):
        x = rec.price_inputs(pdf.iloc[begin:].reset_index(drop=True))
        x.update(rec.run_network(rec.NETWORK, x, None))
        ends.append([v for run, _, _ in rec.SYSTEMS.values() for v in run(x, 0, None)[1]])
    np.testing.assert_allclose(ends[0], ends[1], rtol=1e-9, atol=1e-9)


def test_many_new_bars_are_cut_into_segments(spark):
    bars = make_bars(spark, 3000, ("a",)).cache()
    columns = ["ema_50", "kama_20", "sar", "adx_14", "mama", "sma_200"]
    full = table(indicators(bars, columns))
    at = 1_700_000_000 + 3600 * 1000
    rows, progress = first_run(bars.filter(f"unix_timestamp < {at}"), columns)
    second, _ = next_run(progress, bars.filter(f"unix_timestamp >= {at}"), columns, rows_per_segment=832)
    assert_same(full, table(rows.unionByName(second)), columns)


def test_late_bars_at_any_depth_equal_a_full_run(spark, tmp_path):
    """Bars 5,000 rows back, corrected ones, new ones, and a symbol that only comes with the delivery."""
    bars = make_bars(spark, 7000, ("a",)).unionByName(make_bars(spark, 1200, ("b",), 2)).unionByName(
        make_bars(spark, 900, ("c",), 3).withColumn("unix_timestamp", F.col("unix_timestamp") + 3600 * 3000)).cache()
    columns = ["ema_50", "kama_20", "sar", "adx_14", "ht_dcperiod", "obv", "sma_200", "volatility_30d"]
    at = lambda n: 1_700_000_000 + 3600 * n
    late = f"(symbol = 'a' AND (unix_timestamp BETWEEN {at(1900)} AND {at(1905)} OR unix_timestamp >= {at(6990)})) OR symbol = 'c'"
    store = IndicatorStore(spark, str(tmp_path / "store"), tuple(columns), 1000)
    store.create(bars.filter(f"NOT ({late})"))
    assert store.log(1).filter("symbol = 'a'").count() >= 6
    got = store.deliver(bars.filter(late))
    assert_same(table(indicators(bars, columns)), table(got), columns)
    points = restart_points(store.log(1), bars.filter(late)).collect()
    assert {r["symbol"]: r["until"] is not None and r["until"] < at(1900) for r in points} == {"a": True, "c": False}
    # only the months from the late bars on were written again
    (old, _), (new, _) = store.rows._list(1), store.rows.holders()
    assert old["2023-11"] == 1 == new["2023-11"] and new[max(new)] == 2
    again = store.deliver(bars.filter(late))
    assert_same(table(indicators(bars, columns)), table(again), columns)
