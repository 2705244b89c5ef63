"""Indicators whose value depends on all earlier rows of the series.

Linear averages (EMA, Wilder, accumulation, ...) form one network
``x_t = decay * x_(t-1) + gain * input_t``.  Over a segment such a network is an
affine map of its starting state, and affine maps compose, so the starting state
of every segment follows from one pass over the segments and a tiny pass over
their summaries.  The remaining systems (parabolic stop, directional index with
its hold, dominant cycle) are not affine: each segment starts from a state
warmed up on the rows before it, the end states are compared with the assumed
start states, and segments whose assumption was off are run again until all
agree.  Symbols that fit one segment need none of this and take a single pass.

Tasks receive one segment (a bounded number of rows); numpy does the arithmetic.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.segments import (
    FRAME_ROWS, HALO, INPUT_LAGS, STATE_LAG, TAIL, Segmented,
)
from tidegauge.session import cut_lineage

KEY = ["symbol", "_seg"]
PASSED = [
    "symbol", "unix_timestamp", "open", "high", "low", "close", "volume_btc", "volume_usd",
    "_seg", "_li", "_halo",
]
PASSED_SCHEMA = (
    "symbol string, unix_timestamp long, open double, high double, low double, close double, "
    "volume_btc double, volume_usd double, _seg long, _li long, _halo boolean"
)
STATE_AT = HALO - STATE_LAG     # slice row where a later segment's non-linear output starts


# -- linear network ----------------------------------------------------------
@dataclass(frozen=True)
class Node:
    """One recursive average; seeded by the mean or sum of ``n`` inputs after ``skip``."""

    name: str
    decay: float
    gain: float
    source: str | tuple[tuple[str, float], ...]
    n: int
    skip: int = 0
    total: bool = False


def ema(name: str, n: int, source, seed_rows: int | None = None, skip: int = 0) -> Node:
    k = 2.0 / (n + 1)
    return Node(name, 1 - k, k, source, n if seed_rows is None else seed_rows, skip)


def wilder(name: str, n: int, source: str) -> Node:
    return Node(name, (n - 1) / n, 1 / n, source, n)


def _network() -> tuple[Node, ...]:
    nodes = [ema(f"e{n}", n, "close") for n in (5, 10, 12, 20, 26, 50)]
    for n, depth in ((5, 6), (10, 3), (20, 3)):
        inner = f"e{n}"
        for level in range(2, depth + 1):
            nodes.append(ema(f"e{n}x{level}", n, ((inner, 1.0),)))
            inner = f"e{n}x{level}"
    nodes += [
        ema("macd_fast", 12, "close", skip=14),
        ema("macd_slow", 26, "close"),
        ema("macd_sig", 9, (("macd_fast", 1.0), ("macd_slow", -1.0))),
    ]
    for n in (7, 14, 21):
        nodes += [wilder(f"gain{n}", n, "gain"), wilder(f"loss{n}", n, "loss")]
    nodes.append(wilder("atr", 14, "tr"))
    nodes += [
        Node(f"w_{src}", 13 / 14, 1.0, src, 13, total=True) for src in ("pdm", "mdm", "tr")
    ]
    nodes += [
        Node("ad", 1.0, 1.0, "ad_step", 1, total=True),
        ema("ad_fast", 3, (("ad", 1.0),), seed_rows=1),
        ema("ad_slow", 10, (("ad", 1.0),), seed_rows=1),
        Node("obv", 1.0, 1.0, "obv_step", 1, total=True),
    ]
    return tuple(nodes)


NETWORK = _network()
FIRST_INPUT = {"gain": 1, "loss": 1, "tr": 1, "pdm": 1, "mdm": 1}


def nodes_for(names: set[str]) -> tuple[Node, ...]:
    """The requested nodes and the nodes they read, in network order."""
    need = set(names)
    for node in reversed(NETWORK):
        if node.name in need and not isinstance(node.source, str):
            need.update(src for src, _ in node.source)
    return tuple(n for n in NETWORK if n.name in need)


def affine(decay: float, b: np.ndarray, x0: float, block: int = 128) -> np.ndarray:
    """x_t = decay*x_(t-1) + b_t, as blocks of matrix products instead of a row loop."""
    n = len(b)
    if n == 0:
        return b
    if decay == 1.0:
        return x0 + np.cumsum(b)
    width = min(block, n)
    powers = decay ** np.arange(width)
    lower = np.tril(powers[np.subtract.outer(np.arange(width), np.arange(width))])
    blocks = -(-n // width)
    padded = np.zeros(blocks * width)
    padded[:n] = b
    out = padded.reshape(blocks, width) @ lower.T
    tail = powers * decay
    carry = x0
    for row in out:
        row += carry * tail
        carry = row[-1]
    return out.reshape(-1)[:n]


def price_inputs(pdf: pd.DataFrame) -> dict[str, np.ndarray]:
    high, low, close, volume = (
        pdf[x].to_numpy(dtype=float) for x in ("high", "low", "close", "volume_btc")
    )
    previous = np.concatenate([[np.nan], close[:-1]])
    change = close - previous
    up = np.concatenate([[np.nan], high[1:] - high[:-1]])
    down = np.concatenate([[np.nan], low[:-1] - low[1:]])
    spread = high - low
    with np.errstate(divide="ignore", invalid="ignore"):
        place = np.where(spread > 0, ((close - low) - (high - close)) / spread, 0.0)
    return {
        "open": pdf["open"].to_numpy(dtype=float), "high": high, "low": low, "close": close,
        "gain": np.maximum(change, 0.0), "loss": np.maximum(-change, 0.0),
        "tr": np.maximum(spread, np.maximum(np.abs(high - previous), np.abs(low - previous))),
        "pdm": np.where((up > down) & (up > 0), up, 0.0),
        "mdm": np.where((down > up) & (down > 0), down, 0.0),
        "ad_step": place * volume,
        "obv_step": np.where(np.isnan(change), volume, np.sign(change) * volume),
    }


def run_network(
    nodes: tuple[Node, ...], inputs: dict[str, np.ndarray], carry: np.ndarray | None
) -> dict[str, np.ndarray]:
    """Outputs of every node; ``carry`` is the state before row ``INPUT_LAGS``."""
    out: dict[str, np.ndarray] = {}
    first: dict[str, int] = {}
    size = len(inputs["close"])
    for i, node in enumerate(nodes):
        if isinstance(node.source, str):
            u, begin = inputs[node.source], FIRST_INPUT.get(node.source, 0)
        else:
            u = sum(weight * out[src] for src, weight in node.source)
            begin = max(first[src] for src, _ in node.source)
        x = np.full(size, np.nan)
        if carry is not None:
            x[INPUT_LAGS:] = affine(node.decay, node.gain * u[INPUT_LAGS:], carry[i])
            first[node.name] = INPUT_LAGS
        else:
            seed_row = begin + node.skip + node.n - 1
            first[node.name] = seed_row
            if seed_row < size:
                seed = u[begin + node.skip: seed_row + 1].sum()
                x[seed_row] = seed if node.total else seed / node.n
                x[seed_row + 1:] = affine(node.decay, node.gain * u[seed_row + 1:], x[seed_row])
        out[node.name] = x
    return out


def transfer_matrix(nodes: tuple[Node, ...], rows: int) -> np.ndarray:
    """State change of the network over ``rows`` rows with zero input."""
    at = {node.name: i for i, node in enumerate(nodes)}
    step = np.zeros((len(nodes), len(nodes)))
    for i, node in enumerate(nodes):
        step[i, i] = node.decay
        if not isinstance(node.source, str):
            for src, weight in node.source:
                step[i] += node.gain * weight * step[at[src]]
    return np.linalg.matrix_power(step, rows)


# -- adaptive average: affine with a coefficient per row -----------------------
KAMA_ROWS = 20


def kama_speed(close: np.ndarray, n: int = KAMA_ROWS) -> np.ndarray:
    moves = np.abs(np.diff(close, prepend=np.nan))
    speed = np.full(len(close), np.nan)
    if len(close) <= n:
        return speed
    path = np.lib.stride_tricks.sliding_window_view(moves[1:], n).sum(axis=1)
    change = close[n:] - close[:-n]
    with np.errstate(divide="ignore", invalid="ignore"):
        efficiency = np.where((path == 0) | (path <= change), 1.0, np.abs(change) / path)
    speed[n:] = (efficiency * (2 / 3 - 2 / 31) + 2 / 31) ** 2
    return speed


def run_kama(close: np.ndarray, carry: float | None) -> np.ndarray:
    out = np.full(len(close), np.nan)
    start = KAMA_ROWS if carry is None else INPUT_LAGS
    if len(close) <= start:
        return out
    speed = kama_speed(close)[start:].tolist()
    x = close[start - 1] if carry is None else carry
    values = []
    for rate, price in zip(speed, close[start:].tolist()):
        x += rate * (price - x)
        values.append(x)
    out[start:] = values
    return out


# -- non-linear systems --------------------------------------------------------
# Each system is run(inputs, begin, state) -> (columns, end state).  ``state`` is
# None for a series that starts at row 0; otherwise it is the state before row
# ``begin`` and earlier rows are only read as inputs.
Run = Callable[[dict[str, np.ndarray], int, list[float] | None], tuple[dict[str, np.ndarray], list[float]]]


def run_directional(x, begin, state):
    """Held directional index and its Wilder average, from the smoothed sums."""
    size = len(x["close"])
    dx_out, adx_out = np.full(size, np.nan), np.full(size, np.nan)
    with np.errstate(divide="ignore", invalid="ignore"):
        plus, minus = x["w_pdm"] / x["w_tr"], x["w_mdm"] / x["w_tr"]
        raw = np.where(
            (x["w_tr"] != 0) & (plus + minus != 0),
            100 * np.abs(plus - minus) / (plus + minus), np.nan,
        )
    if state is None:
        begin, dx, adx, seen, seed = 14, 0.0, 0.0, 0, 0.0
    else:
        dx, adx, seen, seed = state[0], state[1], int(state[2]), state[3]
    for t, now in enumerate(raw[begin:].tolist(), begin):
        if now == now:
            dx = now
        dx_out[t] = dx
        if seen < 14:
            seed += dx
            seen += 1
            if seen == 14:
                adx = seed / 14
        else:
            adx = (adx * 13 + dx) / 14
        if seen == 14:
            adx_out[t] = adx
    # a used seed is cleared: states of one series must agree wherever it was started
    return {"dx_14": dx_out, "adx_14": adx_out}, [dx, adx, float(seen), seed if seen < 14 else 0.0]


def run_sar(x, begin, state, step=0.02, limit=0.2):
    high, low = x["high"].tolist(), x["low"].tolist()
    size = len(high)
    out = np.full(size, np.nan)
    if state is None:
        if size < 2:
            return {"sar": out}, [0.0, 0.0, 0.0, 0.0]
        fall, rise = low[0] - low[1], high[1] - high[0]
        up = not (fall > 0 and fall > rise)
        sar, extreme = (low[0], high[1]) if up else (high[0], low[1])
        af, begin = step, 1
    else:
        up, sar, extreme, af = state[0] == 1.0, state[1], state[2], state[3]
    values = []
    for t in range(begin, size):
        # the bar before the first output bar is that bar itself
        before = t if (state is None and t == 1) else t - 1
        hi, lo = max(high[before], high[t]), min(low[before], low[t])
        if up == (low[t] <= sar if up else high[t] < sar):
            # the stop was touched: turn around at the extreme point
            up = not up
            sar = min(extreme, lo) if up else max(extreme, hi)
            values.append(sar)
            af, extreme = step, (high[t] if up else low[t])
        else:
            values.append(sar)
            better = high[t] > extreme if up else low[t] < extreme
            if better:
                extreme = high[t] if up else low[t]
                af = min(af + step, limit)
        sar += af * (extreme - sar)
        sar = min(sar, lo) if up else max(sar, hi)
    out[begin:] = values
    return {"sar": out}, [1.0 if up else 0.0, sar, extreme, af]


def _smoothed(close: np.ndarray) -> np.ndarray:
    """Four-bar weighted price."""
    out = np.zeros(len(close))
    out[3:] = (4 * close[3:] + 3 * close[2:-1] + 2 * close[1:-2] + close[:-3]) / 10
    return out


def _cycle(close: np.ndarray, begin: int, start: int, state: list[float] | None):
    """Homodyne dominant cycle; returns smoothed price, period, I1, Q1 and end state.

    The quadrature filter is 0.0962*(x - x[-6]) + 0.5769*(x[-2] - x[-4]), scaled by
    the last period; histories are zero before row ``start`` of a new series.
    """
    size = len(close)
    smooth = _smoothed(close)
    if state is None:
        begin = min(start, size)
        smooth[:begin] = 0.0
        det, i1, q1 = ([0.0] * 6 for _ in range(3))
        i2 = q2 = re = im = period = smooth_period = 0.0
    else:
        det, i1, q1 = (list(state[j:j + 6]) for j in (0, 6, 12))
        i2, q2, re, im, period, smooth_period = state[18:24]
    s = np.concatenate([np.zeros(6), smooth]).tolist()
    periods = []
    for t in range(begin, size):
        scale = 0.075 * period + 0.54
        d = (0.0962 * (s[t + 6] - s[t]) + 0.5769 * (s[t + 4] - s[t + 2])) * scale
        q = (0.0962 * (d - det[-6]) + 0.5769 * (det[-2] - det[-4])) * scale
        i = det[-3]
        ji = (0.0962 * (i - i1[-6]) + 0.5769 * (i1[-2] - i1[-4])) * scale
        jq = (0.0962 * (q - q1[-6]) + 0.5769 * (q1[-2] - q1[-4])) * scale
        det.append(d)
        i1.append(i)
        q1.append(q)
        q2_now = 0.2 * (q + ji) + 0.8 * q2
        i2_now = 0.2 * (i - jq) + 0.8 * i2
        re = 0.2 * (i2_now * i2 + q2_now * q2) + 0.8 * re
        im = 0.2 * (i2_now * q2 - q2_now * i2) + 0.8 * im
        i2, q2 = i2_now, q2_now
        old = period
        if im != 0.0 and re != 0.0:
            period = 360.0 / math.degrees(math.atan(im / re))
        period = max(min(period, 1.5 * old), 0.67 * old)
        period = min(max(period, 6.0), 50.0)
        period = 0.2 * period + 0.8 * old
        smooth_period = 0.33 * period + 0.67 * smooth_period
        periods.append(smooth_period)
    end = det[-6:] + i1[-6:] + q1[-6:] + [i2, q2, re, im, period, smooth_period]
    return begin, smooth, np.array(periods), np.array(i1[6:]), np.array(q1[6:]), end


def _placed(size: int, begin: int, values: np.ndarray, first: int | None) -> np.ndarray:
    out = np.full(size, np.nan)
    out[begin:] = values
    if first is not None:
        out[:first] = np.nan
    return out


def run_cycle(x, begin, state):
    """Period, phasor and the adaptive averages (fast limit 0.5, slow limit 0.05)."""
    close, size = x["close"], len(x["close"])
    fresh = state is None
    begin, _, period, i1, q1, end = _cycle(close, begin, 12, None if fresh else state[:24])
    mama, fama, before = (0.0, 0.0, 0.0) if fresh else state[24:27]
    with np.errstate(divide="ignore", invalid="ignore"):
        phase = np.where(i1 != 0, np.degrees(np.arctan(q1 / i1)), 0.0)
    turn = np.maximum(np.concatenate([[before], phase[:-1]])[: len(phase)] - phase, 1.0)
    speed = np.maximum(0.5 / turn, 0.05)
    slow, slower = [], []
    for alpha, price in zip(speed.tolist(), close[begin:].tolist()):
        mama += alpha * (price - mama)
        fama += 0.5 * alpha * (mama - fama)
        slow.append(mama)
        slower.append(fama)
    first = 32 if fresh else None
    columns = {
        name: _placed(size, begin, np.array(values), first)
        for name, values in (
            ("ht_dcperiod", period), ("ht_inphase", i1), ("ht_quadrature", q1),
            ("mama", slow), ("fama", slower),
        )
    }
    last = float(phase[-1]) if len(phase) else before
    return columns, end + [mama, fama, last]


def run_phase(x, begin, state):
    """Dominant-cycle phase, sine pair, instantaneous trend line and trend mode."""
    close, size = x["close"], len(x["close"])
    fresh = state is None
    begin, smooth, period, _, _, end = _cycle(close, begin, 37, None if fresh else state[:24])
    phase0, t1, t2, t3, days = (0.0, 0.0, 0.0, 0.0, 0.0) if fresh else state[24:29]
    rows = size - begin
    whole = (period + 0.5).astype(int)
    real, imag, mean = np.zeros(rows), np.zeros(rows), np.zeros(rows)
    history = np.concatenate([np.zeros(50), smooth])
    prices = np.concatenate([np.zeros(50), close])
    for n in np.unique(whole[whole > 0]):
        at = np.flatnonzero(whole == n)
        # newest value first: column j is j rows back
        back = (at + begin + 50)[:, None] - np.arange(n)[None, :]
        angle = np.arange(n) * (2 * np.pi / n)
        real[at] = history[back] @ np.sin(angle)
        imag[at] = history[back] @ np.cos(angle)
        mean[at] = prices[back].mean(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        phase = np.degrees(np.arctan(real / imag))
    # without an imaginary part the phase stays, turned by a quarter
    for t in np.flatnonzero(imag == 0):
        phase[t] = (phase[t - 1] if t else phase0) + 90 * np.sign(real[t])
        phase[t] = _wrapped(phase[t], period[t], imag[t])
    fine = imag != 0
    phase[fine] = _wrapped(phase[fine], period[fine], imag[fine])
    sine, lead = np.sin(np.radians(phase)), np.sin(np.radians(phase + 45))
    m = np.concatenate([[t3, t2, t1], mean])
    trend_line = (4 * m[3:] + 3 * m[2:-1] + 2 * m[1:-2] + m[:-3]) / 10

    old_phase = np.concatenate([[phase0], phase[:-1]])[:rows]
    sine0, lead0 = (0.0, 0.0) if fresh else (
        np.sin(np.radians(phase0)), np.sin(np.radians(phase0 + 45))
    )
    old_sine = np.concatenate([[sine0], sine[:-1]])[:rows]
    old_lead = np.concatenate([[lead0], lead[:-1]])[:rows]
    crossed = ((sine > lead) & (old_sine <= old_lead)) | ((sine < lead) & (old_sine >= old_lead))
    counted = []
    for hit in crossed.tolist():
        days = 1.0 if hit else days + 1.0
        counted.append(days)
    with np.errstate(divide="ignore", invalid="ignore"):
        turn = phase - old_phase
        regular = (
            (period != 0) & (turn > 0.67 * 360 / period) & (turn < 1.5 * 360 / period)
        )
        away = (trend_line != 0) & (
            np.abs((smooth[begin:] - trend_line) / trend_line) >= 0.015
        )
    mode = ~(crossed | (np.array(counted) < 0.5 * period) | regular) | away
    first = 63 if fresh else None
    columns = {
        name: _placed(size, begin, values, first)
        for name, values in (
            ("ht_dcphase", phase), ("ht_sine", sine), ("ht_leadsine", lead),
            ("ht_trendline", trend_line), ("ht_trendmode", mode.astype(float)),
        )
    }
    last = float(phase[-1]) if rows else phase0
    return columns, end + [last, float(m[-1]), float(m[-2]), float(m[-3]), days]


def _wrapped(phase, period, imag):
    phase = phase + 90 + 360 / period + np.where(np.asarray(imag) < 0, 180, 0)
    return np.where(phase > 315, phase - 360, phase)


SYSTEMS: dict[str, tuple[Run, int, set[str]]] = {
    # name: (run, state length, network nodes it reads)
    "directional": (run_directional, 4, {"w_pdm", "w_mdm", "w_tr"}),
    "stop": (run_sar, 4, set()),
    "cycle": (run_cycle, 27, set()),
    "phase": (run_phase, 29, set()),
}


# -- output columns ------------------------------------------------------------
def _share(part: np.ndarray, whole: np.ndarray, scale: float = 100.0) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(np.isnan(whole), np.nan, np.where(whole == 0, 0.0, scale * part / whole))


def _after(values: np.ndarray, x: dict, first: int) -> np.ndarray:
    """NULL before the first published row of a series."""
    return np.where((x["_li"] < first) & ~x["_later"], np.nan, values)


def _t3(x):
    v = 0.7
    return (
        -v ** 3 * x["e5x6"] + (3 * v ** 2 + 3 * v ** 3) * x["e5x5"]
        + (-6 * v ** 2 - 3 * v - 3 * v ** 3) * x["e5x4"]
        + (1 + 3 * v + v ** 3 + 3 * v ** 2) * x["e5x3"]
    )


Output = tuple[set[str], str | None, Callable[[dict], np.ndarray]]
OUTPUTS: dict[str, Output] = {
    # column: (network nodes, non-linear system, expression)
    **{f"ema_{n}": ({f"e{n}"}, None, lambda x, n=n: x[f"e{n}"]) for n in (5, 10, 12, 20, 26, 50)},
    **{
        f"dema_{n}": (
            {f"e{n}", f"e{n}x2"}, None, lambda x, n=n: 2 * x[f"e{n}"] - x[f"e{n}x2"]
        ) for n in (10, 20)
    },
    **{
        f"tema_{n}": (
            {f"e{n}", f"e{n}x2", f"e{n}x3"}, None,
            lambda x, n=n: 3 * x[f"e{n}"] - 3 * x[f"e{n}x2"] + x[f"e{n}x3"],
        ) for n in (10, 20)
    },
    "t3_5": ({"e5x3", "e5x4", "e5x5", "e5x6"}, None, _t3),
    "kama_20": (set(), None, lambda x: x["kama"]),
    **{
        f"rsi_{n}": (
            {f"gain{n}", f"loss{n}"}, None,
            lambda x, n=n: _share(x[f"gain{n}"], x[f"gain{n}"] + x[f"loss{n}"]),
        ) for n in (7, 14, 21)
    },
    "cmo_14": (
        {"gain14", "loss14"}, None,
        lambda x: _share(x["gain14"] - x["loss14"], x["gain14"] + x["loss14"]),
    ),
    "macd": (
        {"macd_fast", "macd_slow"}, None,
        lambda x: _after(x["macd_fast"] - x["macd_slow"], x, 33),
    ),
    "macd_signal": ({"macd_sig"}, None, lambda x: x["macd_sig"]),
    "macd_hist": (
        {"macd_sig"}, None, lambda x: x["macd_fast"] - x["macd_slow"] - x["macd_sig"]
    ),
    "ad": ({"ad"}, None, lambda x: x["ad"]),
    "adosc": (
        {"ad_fast", "ad_slow"}, None, lambda x: _after(x["ad_fast"] - x["ad_slow"], x, 9)
    ),
    "obv": ({"obv"}, None, lambda x: x["obv"]),
    "atr_14": ({"atr"}, None, lambda x: x["atr"]),
    "natr_14": ({"atr"}, None, lambda x: _share(x["atr"], np.where(np.isnan(x["atr"]), np.nan, x["close"]))),
    "plus_dm": ({"w_pdm"}, None, lambda x: x["w_pdm"]),
    "minus_dm": ({"w_mdm"}, None, lambda x: x["w_mdm"]),
    "plus_di": ({"w_pdm", "w_tr"}, None, lambda x: _after(_share(x["w_pdm"], x["w_tr"]), x, 14)),
    "minus_di": ({"w_mdm", "w_tr"}, None, lambda x: _after(_share(x["w_mdm"], x["w_tr"]), x, 14)),
    **{
        name: (set(), system, lambda x, name=name: x[name])
        for system, names in (
            ("directional", ("dx_14", "adx_14")),
            ("stop", ("sar",)),
            ("cycle", ("ht_dcperiod", "ht_inphase", "ht_quadrature", "mama", "fama")),
            ("phase", ("ht_dcphase", "ht_sine", "ht_leadsine", "ht_trendline", "ht_trendmode")),
        )
        for name in names
    },
}
INTEGER_OUTPUTS = {"ht_trendmode"}


@dataclass(frozen=True)
class Plan:
    """What the requested columns need."""

    columns: tuple[str, ...]
    nodes: tuple[Node, ...]
    systems: tuple[str, ...]
    kama: bool
    rows_per_segment: int

    @staticmethod
    def of(columns: list[str], rows_per_segment: int) -> "Plan":
        systems = sorted({OUTPUTS[c][1] for c in columns} - {None})
        names = set().union(*(OUTPUTS[c][0] for c in columns))
        for system in systems:
            names |= SYSTEMS[system][2]
        return Plan(
            tuple(columns), nodes_for(names), tuple(systems), "kama_20" in columns, rows_per_segment
        )

    def state_sizes(self) -> list[int]:
        return [SYSTEMS[s][1] for s in self.systems]


def _empty(*columns: str) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([], dtype=object) for c in columns})


def _slice_inputs(pdf: pd.DataFrame) -> tuple[pd.DataFrame, dict[str, np.ndarray], int]:
    pdf = pdf.sort_values("_li", kind="stable")
    return pdf, price_inputs(pdf), int(pdf["_seg"].iloc[0])


def _with_network(plan: Plan, x: dict, seg: int, carry: np.ndarray | None) -> dict:
    known = None if seg == 0 else carry
    x.update(run_network(plan.nodes, x, known))
    if plan.kama:
        x["kama"] = run_kama(x["close"], None if seg == 0 else carry[len(plan.nodes)])
    return x


def _from(x: dict, first: int, last: int | None = None) -> dict:
    return {name: values[first:last] for name, values in x.items()}


def _split_state(plan: Plan, flat) -> list[list[float]]:
    parts, at = [], 0
    for size in plan.state_sizes():
        parts.append([float(v) for v in flat[at:at + size]])
        at += size
    return parts


def finish(plan: Plan, pdf: pd.DataFrame, carry=None, state=None) -> pd.DataFrame:
    """All requested columns of one segment from its exact starting state."""
    if pdf["_halo"].all():
        return _empty(*PASSED, *plan.columns)
    pdf, x, seg = _slice_inputs(pdf)
    _with_network(plan, x, seg, carry)
    for i, name in enumerate(plan.systems):
        begin, known = (0, None) if seg == 0 else (STATE_AT, _split_state(plan, state)[i])
        x.update(SYSTEMS[name][0](x, begin, known)[0])
    x["_li"], x["_later"] = pdf["_li"].to_numpy(), np.full(len(pdf), seg > 0)
    out = pdf[PASSED].copy()
    for column in plan.columns:
        out[column] = OUTPUTS[column][2](x)
        if column in INTEGER_OUTPUTS:
            out[column] = out[column].fillna(0.0)
    return out


def _final_row(plan: Plan, seg: int) -> int:
    """Slice rows up to where the next segment takes over the linear state."""
    return plan.rows_per_segment - FRAME_ROWS if seg == 0 else INPUT_LAGS + plan.rows_per_segment


def summarise(plan: Plan, pdf: pd.DataFrame) -> pd.DataFrame:
    """End state of a segment run from zero (exact for the first segment)."""
    pdf, x, seg = _slice_inputs(pdf)
    end = _final_row(plan, seg)
    if len(pdf) < end:
        return _empty("symbol", "_seg", "zero", "kama_decay")
    zero = None if seg == 0 else np.zeros(len(plan.nodes) + 1)
    _with_network(plan, x, seg, zero)
    state = [float(x[n.name][end - 1]) for n in plan.nodes]
    state.append(float(x["kama"][end - 1]) if plan.kama else 0.0)
    decay = 0.0
    if plan.kama and seg:
        decay = float(np.prod(1 - kama_speed(x["close"])[INPUT_LAGS:end]))
    return pd.DataFrame(
        {"symbol": [pdf["symbol"].iloc[0]], "_seg": [seg], "zero": [state], "kama_decay": [decay]}
    )


def compose(plan: Plan, symbol: str, pdf: pd.DataFrame, known: np.ndarray | None = None) -> pd.DataFrame:
    """Starting state of every later segment of one symbol; ``known`` is that of segment 1
    where the series does not begin in these rows."""
    matrix = transfer_matrix(plan.nodes, plan.rows_per_segment)
    pdf = pdf.sort_values("_seg")
    state, rows = known, []
    if known is not None:
        rows.append((1, known.tolist()))
    for seg, zero, decay in zip(pdf["_seg"], pdf["zero"], pdf["kama_decay"]):
        zero = np.asarray(zero, dtype=float)
        if state is None:
            state = zero
        else:
            state = np.append(matrix @ state[:-1], decay * state[-1]) + zero
        rows.append((seg + 1, state.tolist()))
    return pd.DataFrame({"symbol": [symbol] * len(rows), "_seg": [r[0] for r in rows], "carry": [r[1] for r in rows]})


def end_state(plan: Plan, pdf: pd.DataFrame, carry, state) -> pd.DataFrame:
    """Assumed start and resulting end state of the non-linear systems."""
    if pdf["_halo"].all():
        return _empty("symbol", "_seg", "start", "end")
    pdf, x, seg = _slice_inputs(pdf)
    _with_network(plan, x, seg, carry)
    # the next segment publishes from its slice row STATE_AT
    end = plan.rows_per_segment - STATE_LAG if seg == 0 else STATE_AT + plan.rows_per_segment
    starts, ends = [], []
    for i, name in enumerate(plan.systems):
        run = SYSTEMS[name][0]
        if seg == 0:
            begin, start = 0, None
        elif state is not None:
            begin, start = STATE_AT, _split_state(plan, state)[i]
        else:
            begin, start = STATE_AT, run(_from(x, INPUT_LAGS, STATE_AT), 0, None)[1]
        starts += start or [0.0] * SYSTEMS[name][1]
        ends += run(_from(x, 0, min(end, len(pdf))), begin, start)[1]
    return pd.DataFrame(
        {"symbol": [pdf["symbol"].iloc[0]], "_seg": [seg], "start": [starts], "end": [ends]}
    )


# -- driver side: which passes run ------------------------------------------------
STATE_TOLERANCE = 1e-12
STATES = "symbol string, _seg long, start array<double>, end array<double>"


def add_recursive(slices: Segmented, wanted: list[str], starts: DataFrame | None = None) -> DataFrame:
    """Append the recursive columns ``wanted`` to segmented bars.

    ``starts`` gives the known starting states (symbol, _seg, carry, state) of
    later segments; otherwise they are found first.
    """
    plan = Plan.of(wanted, slices.rows_per_segment)
    schema = PASSED_SCHEMA + "".join(f", {c} double" for c in wanted)
    df = slices.df.select(*PASSED)
    if not slices.split:
        out = df.groupBy(*KEY).applyInPandas(lambda pdf: finish(plan, pdf), schema)
    else:
        if starts is None:
            df = cut_lineage(df)
            starts = starting_states(plan, df)

        def final(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty:
                return _empty(*PASSED, *wanted)
            return finish(plan, left, _only(right, "carry"), _only(right, "state"))

        out = df.groupBy(*KEY).cogroup(starts.groupBy(*KEY)).applyInPandas(final, schema)
    return out.select(
        *PASSED,
        *(
            (F.col(c).cast("int") if c in INTEGER_OUTPUTS else F.when(~F.isnan(c), F.col(c))).alias(c)
            for c in wanted
        ),
    )


def starting_states(plan: Plan, df: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(symbol, _seg, carry, state) of every later segment; ``known`` holds (symbol, carry,
    state) of the symbols whose segment 1 continues earlier bars."""
    carry = _carries(plan, df, known)
    state = _states(plan, df, carry, known)
    if state is None:
        return carry.withColumn("state", F.array().cast("array<double>"))
    return carry.join(state, KEY)


CLOSING = "symbol string, _seg long, since long, until long, carry array<double>, state array<double>"


def closing(plan: Plan, pdf: pd.DataFrame, carry=None, state=None) -> pd.DataFrame:
    """States from which bars after this slice continue, the time of its last bar, and of
    the first of the HALO bars that such a run reads again; none for short series."""
    if pdf["_halo"].all() or len(pdf) < (TAIL if pdf["_seg"].iloc[0] == 0 else HALO):
        return _empty("symbol", "_seg", "since", "until", "carry", "state")
    pdf, x, seg = _slice_inputs(pdf)
    _with_network(plan, x, seg, carry)
    at = len(pdf) - FRAME_ROWS - 1
    linear = [float(x[n.name][at]) for n in plan.nodes] + [float(x["kama"][at]) if plan.kama else 0.0]
    upto, ends = _from(x, 0, len(pdf) - STATE_LAG), []
    for i, name in enumerate(plan.systems):
        begin, known = (0, None) if seg == 0 else (STATE_AT, _split_state(plan, state)[i])
        ends += SYSTEMS[name][0](upto, begin, known)[1]
    times = pdf["unix_timestamp"]
    return pd.DataFrame({
        "symbol": [pdf["symbol"].iloc[0]], "_seg": [seg], "since": [int(times.iloc[len(pdf) - HALO])],
        "until": [int(times.iloc[-1])], "carry": [linear], "state": [ends]})


def closing_states(slices: Segmented, wanted: list[str], starts: DataFrame | None = None) -> DataFrame:
    """(symbol, carry, state) at the end of every symbol long enough to resume."""
    return segment_ends(slices, wanted, starts).groupBy("symbol").agg(
        F.max_by(F.struct("carry", "state"), "_seg").alias("_s")).select("symbol", "_s.carry", "_s.state")


def segment_ends(slices: Segmented, wanted: list[str], starts: DataFrame | None = None) -> DataFrame:
    """(symbol, _seg, since, until, carry, state) from which the bars behind each segment continue."""
    plan = Plan.of(wanted, slices.rows_per_segment)
    df = slices.df.select(*PASSED)
    if not slices.split:
        out = df.groupBy(*KEY).applyInPandas(lambda pdf: closing(plan, pdf), CLOSING)
    else:
        if starts is None:
            df = cut_lineage(df)
            starts = starting_states(plan, df)

        def body(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty:
                return _empty("symbol", "_seg", "since", "until", "carry", "state")
            return closing(plan, left, _only(right, "carry"), _only(right, "state"))

        out = df.groupBy(*KEY).cogroup(starts.groupBy(*KEY)).applyInPandas(body, CLOSING)
    return out


def _only(pdf: pd.DataFrame, column: str):
    if pdf.empty or column not in pdf:
        return None
    value = pdf[column].iloc[0]
    return None if value is None else np.asarray(value, dtype=float)


def _carries(plan: Plan, df: DataFrame, known: DataFrame | None = None) -> DataFrame:
    zero = df.groupBy(*KEY).applyInPandas(
        lambda pdf: summarise(plan, pdf),
        "symbol string, _seg long, zero array<double>, kama_decay double",
    )
    # one row per segment: the key (symbol, second) bounds it by the calendar
    schema = "symbol string, _seg long, carry array<double>"
    if known is None:
        return cut_lineage(zero.groupBy("symbol").applyInPandas(lambda pdf: compose(plan, pdf["symbol"].iloc[0], pdf), schema))

    def body(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return compose(plan, (right if left.empty else left)["symbol"].iloc[0], left, _only(right, "carry"))

    return cut_lineage(zero.groupBy("symbol").cogroup(known.select("symbol", "carry").groupBy("symbol")).applyInPandas(body, schema))


def _states(plan: Plan, df: DataFrame, carry: DataFrame, known: DataFrame | None = None) -> DataFrame | None:
    """Verified starting state per later segment; reruns segments that guessed wrong."""
    if not plan.systems:
        return None

    def run(rows: DataFrame, start: DataFrame) -> DataFrame:
        def body(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty:
                return _empty("symbol", "_seg", "start", "end")
            return end_state(plan, left, _only(right, "carry"), _only(right, "state"))
        return rows.groupBy(*KEY).cogroup(start.groupBy(*KEY)).applyInPandas(body, STATES)

    start = carry
    if known is not None:
        first = known.select("symbol", F.lit(1).cast("long").alias("_seg"), "state")
        start = carry.join(first, KEY, "left")
    known = cut_lineage(run(df, start))
    while True:
        ends = known.select("symbol", (F.col("_seg") + 1).alias("_seg"), F.col("end").alias("state"))
        differs = F.exists(
            F.arrays_zip("start", "state"),
            lambda p: ~(F.abs(p["start"] - p["state"])
                        <= STATE_TOLERANCE * F.greatest(F.lit(1.0), F.abs(p["state"]))),
        )
        wrong = cut_lineage(known.join(ends, KEY).filter(differs).select(*KEY, "state"))
        if wrong.isEmpty():
            return known.filter("_seg > 0").select(*KEY, F.col("start").alias("state"))
        again = run(
            df.join(wrong.select(*KEY), KEY, "left_semi"), carry.join(wrong, KEY)
        )
        known = cut_lineage(known.join(wrong, KEY, "left_anti").unionByName(again))
