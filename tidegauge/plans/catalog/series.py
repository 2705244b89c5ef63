"""Indicator queries over event bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.plans import fixtures
from tidegauge.plans.catalog import fixed, fixed_sql, query
from tidegauge.plans.indicators import indicators


def bars_sql(minutes: int = 60) -> str:
    """Event bars and their row number ``i``, as common table expressions."""
    return f"""
WITH b AS (
  SELECT event_type AS symbol, (epoch_us(ts) // {minutes * 60_000_000}) * {minutes * 60} AS t,
    first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
    last(value ORDER BY ts, event_id) AS close, CAST(count(*) AS DOUBLE) AS v
  FROM events GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY t) - 1 AS i,
  lag(close) OVER (PARTITION BY symbol ORDER BY t) AS c1,
  lag(high) OVER (PARTITION BY symbol ORDER BY t) AS h1,
  lag(low) OVER (PARTITION BY symbol ORDER BY t) AS l1,
  (high + low + close) / 3 AS tp FROM b)"""


def over(n: int, ending: int = 0) -> str:
    end = "CURRENT ROW" if ending == 0 else f"{ending} PRECEDING"
    return f"OVER (PARTITION BY symbol ORDER BY t ROWS BETWEEN {n - 1 + ending} PRECEDING AND {end})"


SERIES = "OVER (PARTITION BY symbol ORDER BY t)"


def lag(x: str, n: int = 1) -> str:
    return f"lag({x}, {n}) {SERIES}"


def avg(x: str, n: int) -> str:
    return f"avg({x}) {over(n)}"


def full(first_row: int, expr: str) -> str:
    return f"CASE WHEN i >= {first_row} THEN {expr} END"


def share(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) = 0 THEN 0 ELSE ({num}) / ({den}) END"


def register(
    name: str, columns: dict[str, str | None], ctes: str = "", source: str = "r",
    minutes: int = 60, digits: int = 6, integer: bool = False, recursive: bool = False,
) -> None:
    """One query for the output columns of one indicator."""
    names = list(columns)
    sql = None
    if all(columns.values()):
        values = ", ".join(
            f"CAST({expr} AS BIGINT) AS {c}" if integer else f"{fixed_sql(expr, digits)} AS {c}"
            for c, expr in columns.items()
        )
        bars = bars_sql(minutes).replace("WITH b", "WITH RECURSIVE b" if recursive else "WITH b")
        sql = f"{bars}{ctes}\nSELECT symbol, CAST(t AS BIGINT) AS t, {values} FROM {source}"

    @query(name, sql)
    def build(spark, sf_dir):
        table = indicators(fixtures.event_bars(spark, sf_dir, minutes), names)
        return table.select(
            "symbol", F.col("unix_timestamp").alias("t"),
            *((F.col(c).cast("long") if integer else fixed(F.col(c), digits)).alias(c) for c in names),
        )


# -- lists: recursive averages in SQL, one list per symbol ----------------------
LISTS = """,
l AS (SELECT symbol, list(t ORDER BY t) AS ts, list(close ORDER BY t) AS c, list(high ORDER BY t) AS h,
  list(greatest(close - c1, 0) ORDER BY t) AS gain, list(greatest(c1 - close, 0) ORDER BY t) AS loss,
  list(greatest(high - low, abs(high - c1), abs(low - c1)) ORDER BY t) AS tr,
  list(CASE WHEN high - h1 > l1 - low AND high - h1 > 0 THEN high - h1 ELSE 0 END ORDER BY t) AS pdm,
  list(CASE WHEN l1 - low > high - h1 AND l1 - low > 0 THEN l1 - low ELSE 0 END ORDER BY t) AS mdm,
  list(CASE WHEN high > low THEN ((close - low) - (high - close)) / (high - low) * v ELSE 0 END
       ORDER BY t) AS flow
  FROM r GROUP BY symbol)"""


def recur(src: str, seed: str, first: int, decay: float, gain: float) -> str:
    """Values from 1-based position ``first`` on: x = decay * x + gain * input."""
    return (
        f"list_reduce(list_concat([[{seed}]], list_transform({src}[{first + 1}:], lambda x: [x])), "
        f"lambda a, x: list_append(a, {decay!r} * a[-1] + {gain!r} * x[1]))"
    )


def ema(src: str, n: int) -> str:
    k = 2.0 / (n + 1)
    return recur(src, f"list_avg({src}[1:{n}])", n, 1 - k, k)


def wilder(src: str, n: int) -> str:
    """Mean of inputs 2..n+1, then Wilder's average; first value at row n."""
    return recur(src, f"list_avg({src}[2:{n + 1}])", n + 1, (n - 1) / n, 1 / n)


def padded(expr: str, missing: str | int) -> str:
    return f"list_concat(list_transform(range({missing}), lambda q: CAST(NULL AS DOUBLE)), {expr})"


def listed(steps: list[tuple[str, str]], outputs: dict[str, str]) -> str:
    """Steps add list columns; outputs are lists aligned with the rows (padded)."""
    ctes, last = LISTS, "l"
    for i, (name, expr) in enumerate(steps):
        ctes += f",\ns{i} AS (SELECT *, {expr} AS {name} FROM {last})"
        last = f"s{i}"
    columns = ", ".join(f"unnest({expr}) AS {name}" for name, expr in outputs.items())
    return f"{ctes},\nu AS (SELECT symbol, unnest(ts) AS t, {columns} FROM {last})"


def pairwise(a: str, b: str, expr: str) -> str:
    """Elementwise expression over x = a[j], y = b[j]."""
    return f"list_transform(list_zip({a}, {b}), lambda z: {expr.replace('x', 'z[1]').replace('y', 'z[2]')})"


def register_lists(name, steps, outputs, columns=None, digits=6):
    register(
        name, columns or {c: c for c in outputs}, listed(steps, outputs), "u", digits=digits
    )


# -- overlap --------------------------------------------------------------------
register("TA01_sma", {f"sma_{n}": full(n - 1, avg("close", n)) for n in (5, 10, 20, 50, 100, 200)})
register_lists("TA02_ema", [], {f"ema_{n}": padded(ema("c", n), n - 1) for n in (5, 10, 12, 20, 26, 50)})
register("TA03_wma", {
    f"wma_{n}": full(n - 1, " + ".join(f"{n - j} * {lag('close', j)}" for j in range(n)).join("()")
                     + f" / {n * (n + 1) / 2}")
    for n in (10, 20)
})


def chained(n: int, depth: int) -> list[tuple[str, str]]:
    steps, src = [], "c"
    for level in range(1, depth + 1):
        steps.append((f"e{n}_{level}", ema(src, n)))
        src = f"e{n}_{level}"
    return steps


def tail(n: int, level: int, depth: int) -> str:
    """Level-``level`` average, cut to where the deepest one starts."""
    return f"e{n}_{level}[{(depth - level) * (n - 1) + 1}:]"


def dema_list(n: int) -> str:
    return padded(pairwise(tail(n, 1, 2), tail(n, 2, 2), "2 * x - y"), 2 * (n - 1))


def tema_list(n: int) -> str:
    inner = pairwise(tail(n, 1, 3), tail(n, 2, 3), "3 * x - 3 * y")
    return padded(pairwise(inner, tail(n, 3, 3), "x + y"), 3 * (n - 1))


register_lists("TA04_dema", chained(10, 2) + chained(20, 2), {f"dema_{n}": dema_list(n) for n in (10, 20)})
register_lists("TA05_tema", chained(10, 3) + chained(20, 3), {f"tema_{n}": tema_list(n) for n in (10, 20)})
register("TA06_trima", {"trima_20": full(19, f"avg(m) {over(11)}")},
         f", m AS (SELECT *, {avg('close', 10)} AS m FROM r)", "m")
register("TA07_kama", {"kama_20": "k"}, f""",
e AS (SELECT *, sum(abs(close - c1)) {over(20)} AS path, close - {lag('close', 20)} AS move FROM r),
s AS (SELECT *, power((CASE WHEN path = 0 OR path <= move THEN 1 ELSE abs(move) / path END)
  * (2.0/3 - 2.0/31) + 2.0/31, 2) AS sc FROM e),
p AS (SELECT symbol, list(t ORDER BY t) AS ts, list(CASE WHEN i >= 20 THEN [close, sc] ELSE [close] END
  ORDER BY t) AS c FROM s GROUP BY symbol),
u AS (SELECT symbol, unnest(ts) AS t, unnest({padded('''list_reduce(list_concat([[c[20][1]]], c[21:]),
  lambda a, x: list_append(a, a[-1] + x[2] * (x[1] - a[-1])))[2:]''', 20)}) AS k FROM p)""", "u")
V = 0.7
_C = (-V ** 3, 3 * V ** 2 + 3 * V ** 3, -6 * V ** 2 - 3 * V - 3 * V ** 3, 1 + 3 * V + V ** 3 + 3 * V ** 2)
register_lists("TA08_t3", chained(5, 6), {"t3_5": padded(pairwise(
    pairwise("e5_6", tail(5, 5, 6), f"{_C[0]!r} * x + {_C[1]!r} * y"),
    pairwise(tail(5, 4, 6), tail(5, 3, 6), f"{_C[2]!r} * x + {_C[3]!r} * y"), "x + y"), 24)})
_SD = f"stddev_pop(close) {over(20)}"
register("TA09_bbands", {
    "bb_upper": full(19, f"{avg('close', 20)} + 2 * {_SD}"), "bb_middle": full(19, avg("close", 20)),
    "bb_lower": full(19, f"{avg('close', 20)} - 2 * {_SD}"),
})

# -- momentum ---------------------------------------------------------------------
RSI = "CASE WHEN x + y = 0 THEN 0 ELSE 100 * x / (x + y) END"


def rsi_list(n: int) -> str:
    return padded(pairwise(f"g{n}", f"d{n}", RSI), n)


def gains(n: int) -> list[tuple[str, str]]:
    return [(f"g{n}", wilder("gain", n)), (f"d{n}", wilder("loss", n))]


register_lists("TA10_rsi", gains(7) + gains(14) + gains(21), {f"rsi_{n}": rsi_list(n) for n in (7, 14, 21)})
_FAST = recur("c", "list_avg(c[15:26])", 26, 1 - 2 / 13, 2 / 13)
register_lists(
    "TA11_macd",
    [("f", _FAST), ("s", ema("c", 26)), ("m", pairwise("f", "s", "x - y")), ("g", ema("m", 9))],
    {"macd": padded("m[9:]", 33), "macd_signal": padded("g", 33),
     "macd_hist": padded(pairwise("m[9:]", "g", "x - y"), 33)},
)
_RAWK = f""", k AS (SELECT *, 100 * ({share(f"close - min(low) {over(5)}", f"max(high) {over(5)} - min(low) {over(5)}")}) AS k FROM r),
k1 AS (SELECT *, CASE WHEN i >= 4 THEN k END AS raw FROM k),
k2 AS (SELECT *, CASE WHEN i >= 6 THEN avg(raw) {over(3)} END AS slow FROM k1)"""
register("TA12_stoch", {"slowk": full(8, "slow"), "slowd": full(8, avg("slow", 3))}, _RAWK, "k2")
register("TA13_stochf", {"fastk": full(6, "raw"), "fastd": full(6, avg("raw", 3))}, _RAWK, "k2")
register("TA14_stochrsi", {"stochrsi_fastk": full(20, "q"), "stochrsi_fastd": full(20, avg("q", 3))},
         listed(gains(14), {"rsi": rsi_list(14)}) + f""",
n AS (SELECT *, row_number() {SERIES} - 1 AS i FROM u),
q0 AS (SELECT *, 100 * ({share(f"rsi - min(rsi) {over(5)}", f"max(rsi) {over(5)} - min(rsi) {over(5)}")}) AS q1 FROM n),
q2 AS (SELECT *, CASE WHEN i >= 18 THEN q1 END AS q FROM q0)""", "q2")


def cci(n: int) -> str:
    spread = f"list_avg(list_transform(f{n}, lambda x: abs(x - m{n})))"
    return full(n - 1, share(f"tp - m{n}", f"0.015 * {spread}"))


register("TA15_cci", {f"cci_{n}": cci(n) for n in (14, 20)},
         ", m AS (SELECT *, " + ", ".join(
             f"{avg('tp', n)} AS m{n}, list(tp) {over(n)} AS f{n}" for n in (14, 20)) + " FROM r)", "m")
register_lists("TA16_cmo", gains(14), {"cmo_14": padded(
    pairwise("g14", "d14", "CASE WHEN x + y = 0 THEN 0 ELSE 100 * (x - y) / (x + y) END"), 14)})
_C10 = lag("close", 10)
register("TA17_mom", {"mom_10": f"close - {_C10}"})
register("TA18_roc", {"roc_10": f"100 * ({share(f'close - {_C10}', _C10)})"})
register("TA19_rocp", {"rocp_10": share(f"close - {_C10}", _C10)})
register("TA20_rocr", {"rocr_10": share("close", _C10)})
_HH14, _LL14 = f"max(high) {over(14)}", f"min(low) {over(14)}"
register("TA21_willr", {"willr_14": full(13, f"-100 * ({share(f'{_HH14} - close', f'{_HH14} - {_LL14}')})")})
_S12, _S26 = avg("close", 12), avg("close", 26)
register("TA22_ppo", {"ppo": full(25, f"100 * ({share(f'{_S12} - {_S26}', _S26)})")})
register("TA23_apo", {"apo": full(25, f"{_S12} - {_S26}")})
register("TA24_bop", {"bop": share("close - open", "high - low")})
_BP, _TR = "close - least(low, c1)", "greatest(high, c1) - least(low, c1)"
_ULT = [f"({share(f'sum(bp) {over(n)}', f'sum(tr) {over(n)}')})" for n in (7, 14, 28)]
register("TA25_ultosc", {"ultosc": full(28, f"100 * (4 * {_ULT[0]} + 2 * {_ULT[1]} + {_ULT[2]}) / 7")},
         f", m AS (SELECT *, CASE WHEN i > 0 THEN {_BP} END AS bp, CASE WHEN i > 0 THEN {_TR} END AS tr FROM r)", "m")

# -- volume -----------------------------------------------------------------------
_RUNNING = "OVER (PARTITION BY symbol ORDER BY t ROWS UNBOUNDED PRECEDING)"
register("TA26_ad", {"ad": f"sum(CASE WHEN high > low THEN ((close - low) - (high - close)) / (high - low) * v ELSE 0 END) {_RUNNING}"})
_AD = "list_transform(range(1, len(flow) + 1), lambda q: list_sum(flow[1:q]))"
register_lists(
    "TA27_adosc",
    [("ad", _AD), ("f", recur("ad", "ad[1]", 1, 0.5, 0.5)), ("s", recur("ad", "ad[1]", 1, 1 - 2 / 11, 2 / 11))],
    {"adosc": padded(pairwise("f[10:]", "s[10:]", "x - y"), 9)},
)
register("TA28_obv", {"obv": f"sum(CASE WHEN c1 IS NULL OR close > c1 THEN v WHEN close < c1 THEN -v ELSE 0 END) {_RUNNING}"})
_UP, _DOWN = f"sum(CASE WHEN tp > t1 THEN tp * v ELSE 0 END) {over(14)}", f"sum(CASE WHEN tp < t1 THEN tp * v ELSE 0 END) {over(14)}"
register("TA29_mfi", {"mfi_14": full(14, f"CASE WHEN {_UP} + {_DOWN} < 1 THEN 0 ELSE 100 * {_UP} / ({_UP} + {_DOWN}) END")},
         f", m AS (SELECT *, {lag('tp')} AS t1 FROM r)", "m")

# -- volatility, price transforms ---------------------------------------------------
register_lists("TA30_atr", [("a", wilder("tr", 14))], {"atr_14": padded("a", 14)})
register_lists("TA31_natr", [("a", wilder("tr", 14))], {"natr_14": padded(
    pairwise("a", "c[15:]", "CASE WHEN y = 0 THEN 0 ELSE 100 * x / y END"), 14)})
register("TA32_trange", {"trange": "CASE WHEN i > 0 THEN greatest(high - low, abs(high - c1), abs(low - c1)) END"})
register("TA33_avgprice", {"avgprice": "(open + high + low + close) / 4"})
register("TA34_medprice", {"medprice": "(high + low) / 2"})
register("TA35_typprice", {"typprice": "tp"})
register("TA36_wclprice", {"wclprice": "(high + low + 2 * close) / 4"})


# -- trend --------------------------------------------------------------------------
def wilder_sum(src: str) -> str:
    """Sum of inputs 2..14, then x - x/14 + input; first value at row 13."""
    return recur(src, f"list_sum({src}[2:14])", 14, 13 / 14, 1.0)


_DM = [("wp", wilder_sum("pdm")), ("wm", wilder_sum("mdm")), ("wt", wilder_sum("tr"))]
_DI = _DM + [
    ("pdi", pairwise("wp[2:]", "wt[2:]", "CASE WHEN y = 0 THEN 0 ELSE 100 * x / y END")),
    ("mdi", pairwise("wm[2:]", "wt[2:]", "CASE WHEN y = 0 THEN 0 ELSE 100 * x / y END")),
]
_DX = _DI + [("dx", pairwise("pdi", "mdi", "100 * abs(x - y) / (x + y)"))]
_ADX = _DX + [("adx", recur("dx", "list_avg(dx[1:14])", 14, 13 / 14, 1 / 14))]
register_lists("TA37_adx", _ADX, {"adx_14": padded("adx", 27)})
register_lists("TA38_adxr", _ADX, {"adxr_14": padded(pairwise("adx[14:]", "adx[:-14]", "(x + y) / 2"), 40)})
register_lists("TA39_dx", _DX, {"dx_14": padded("dx", 14)})
register_lists("TA40_minus_di", _DI, {"minus_di": padded("mdi", 14)})
register_lists("TA41_plus_di", _DI, {"plus_di": padded("pdi", 14)})
register_lists("TA42_minus_dm", _DM, {"minus_dm": padded("wm", 13)})
register_lists("TA43_plus_dm", _DM, {"plus_dm": padded("wp", 13)})
_EXT = f""", m AS (SELECT *, max(high) {over(15)} AS hh, min(low) {over(15)} AS ll FROM r),
hi AS (SELECT m.symbol, m.i, max(q.i) AS at FROM m JOIN r q ON q.symbol = m.symbol AND q.high = m.hh
  AND q.i BETWEEN m.i - 14 AND m.i GROUP BY 1, 2),
lo AS (SELECT m.symbol, m.i, max(q.i) AS at FROM m JOIN r q ON q.symbol = m.symbol AND q.low = m.ll
  AND q.i BETWEEN m.i - 14 AND m.i GROUP BY 1, 2),
x AS (SELECT m.*, 100 * (14 - (m.i - hi.at)) / 14.0 AS up, 100 * (14 - (m.i - lo.at)) / 14.0 AS down
  FROM m JOIN hi USING (symbol, i) JOIN lo USING (symbol, i))"""
register("TA44_aroon", {"aroon_down": full(14, "down"), "aroon_up": full(14, "up")}, _EXT, "x")
register("TA45_aroonosc", {"aroonosc": full(14, "up - down")}, _EXT, "x")
# parabolic stop: one recursive step per row, stop and extreme of the row before
_SAR_STEP = """
  SELECT symbol, i, t, turned, value,
    CASE WHEN turned THEN NOT up ELSE up END AS up, ext, step,
    CASE WHEN (CASE WHEN turned THEN NOT up ELSE up END)
      THEN least(value + step * (ext - value), lo) ELSE greatest(value + step * (ext - value), hi) END AS sar
  FROM (
    SELECT *, CASE WHEN turned THEN (CASE WHEN up THEN low ELSE high END)
        WHEN up THEN greatest(ext0, high) ELSE least(ext0, low) END AS ext,
      CASE WHEN turned THEN 0.02 WHEN (up AND high > ext0) OR (NOT up AND low < ext0)
        THEN least(step0 + 0.02, 0.2) ELSE step0 END AS step
    FROM (
      SELECT *, CASE WHEN NOT turned THEN sar0 WHEN up THEN greatest(ext0, hi) ELSE least(ext0, lo) END AS value
      FROM (SELECT *, CASE WHEN up THEN low <= sar0 ELSE high >= sar0 END AS turned FROM ({src}) z0) z1) z2) z3"""
_SAR_FIRST = """SELECT symbol, i, t, high, low, high AS hi, low AS lo,
        NOT (l1 - low > 0 AND l1 - low > high - h1) AS up, 0.02 AS step0,
        CASE WHEN l1 - low > 0 AND l1 - low > high - h1 THEN h1 ELSE l1 END AS sar0,
        CASE WHEN l1 - low > 0 AND l1 - low > high - h1 THEN low ELSE high END AS ext0
        FROM r WHERE i = 1"""
_SAR_NEXT = """SELECT r.symbol, r.i, r.t, r.high, r.low, greatest(r.high, r.h1) AS hi,
        least(r.low, r.l1) AS lo, p.up, p.step AS step0, p.sar AS sar0, p.ext AS ext0
        FROM r JOIN p ON r.symbol = p.symbol AND r.i = p.i + 1"""
register("TA46_sar", {"sar": "value"}, ",\np AS (" + _SAR_STEP.format(src=_SAR_FIRST)
         + "\nUNION ALL" + _SAR_STEP.format(src=_SAR_NEXT)
         + "),\nu AS (SELECT r.symbol, r.t, p.value FROM r LEFT JOIN p USING (symbol, i))", "u", recursive=True)

# -- statistics -----------------------------------------------------------------------
_Y = ", m AS (SELECT *, CASE WHEN h1 = 0 THEN 0 ELSE (high - h1) / h1 END AS x, CASE WHEN l1 = 0 THEN 0 ELSE (low - l1) / l1 END AS y FROM r)"
_SX, _SY, _SXY, _SXX = (f"sum({e}) {over(5)}" for e in ("x", "y", "x * y", "x * x"))
register("TA47_beta", {"beta": full(5, share(f"5 * {_SXY} - {_SX} * {_SY}", f"5 * {_SXX} - {_SX} * {_SX}"))}, _Y, "m")
register("TA48_correl", {"correl": full(29, f"coalesce(corr(high, low) {over(30)}, 0)")})
_SLOPE, _MEAN = f"regr_slope(close, i) {over(14)}", avg("close", 14)
register("TA49_linearreg", {"linearreg": full(13, f"{_MEAN} + 6.5 * {_SLOPE}")})
register("TA50_linearreg_angle", {"linearreg_angle": full(13, f"degrees(atan({_SLOPE}))")})
register("TA51_linearreg_intercept", {"linearreg_intercept": full(13, f"{_MEAN} - 6.5 * {_SLOPE}")})
register("TA52_linearreg_slope", {"linearreg_slope": full(13, _SLOPE)})
register("TA53_stddev", {"stddev": full(19, _SD)})
register("TA54_tsf", {"tsf": full(13, f"{_MEAN} + 7.5 * {_SLOPE}")})
register("TA55_var", {"var": full(19, f"var_pop(close) {over(20)}")})

# -- cycle: no SQL, tested against an independent formulation ----------------------------
for _name, _columns in (
    ("TA56_ht_dcperiod", ["ht_dcperiod"]), ("TA57_ht_dcphase", ["ht_dcphase"]),
    ("TA58_ht_trendmode", ["ht_trendmode"]), ("TA59_ht_sine", ["ht_sine", "ht_leadsine"]),
    ("TA60_ht_phasor", ["ht_inphase", "ht_quadrature"]), ("TA61_ht_trendline", ["ht_trendline"]),
    ("TA62_mama", ["mama", "fama"]),
):
    register(_name, dict.fromkeys(_columns), integer=_name == "TA58_ht_trendmode")

# -- candlesticks --------------------------------------------------------------------
_PARTS = f""",
p AS (SELECT *, abs(close - open) AS body, high - greatest(open, close) AS up, least(open, close) - low AS dn,
  greatest(open, close) AS top, least(open, close) AS bot, CASE WHEN close >= open THEN 1 ELSE -1 END AS col FROM r),
a AS (SELECT *, avg(body) {over(10, 1)} AS mb, avg(high - low) {over(10, 1)} AS mr, avg(high - low) {over(5, 1)} AS m5 FROM p),
c AS (SELECT *, """ + ", ".join(
    f"lag({x}, {n}) {SERIES} AS {x}_{n}" for n in (1, 2, 3)
    for x in ("open", "high", "low", "close", "body", "up", "dn", "top", "bot", "col", "mb", "mr", "m5")
) + " FROM a)"


def candle(name: str, column: str, first_row: int, value: str, condition: str) -> None:
    register(name, {column: f"CASE WHEN i >= {first_row} AND {condition} THEN {value} ELSE 0 END"},
             _PARTS, "c", integer=True)


candle("TA63_cdl_doji", "cdl_doji", 10, "100", "body <= 0.1 * mr")
candle("TA64_cdl_hammer", "cdl_hammer", 11, "100",
       "body < mb AND dn > body AND up < 0.1 * mr AND bot <= low_1 + 0.2 * m5_1")
candle("TA65_cdl_inverted_hammer", "cdl_inverted_hammer", 11, "100",
       "body < mb AND up > body AND dn < 0.1 * mr AND top < bot_1")
candle("TA66_cdl_hanging_man", "cdl_hanging_man", 11, "-100",
       "body < mb AND dn > body AND up < 0.1 * mr AND bot >= high_1 - 0.2 * m5_1")
candle("TA67_cdl_shooting_star", "cdl_shooting_star", 11, "-100",
       "body < mb AND up > body AND dn < 0.1 * mr AND bot > top_1")
candle("TA68_cdl_engulfing", "cdl_engulfing", 2, "100 * col", "col = -col_1 AND top > top_1 AND bot < bot_1")
candle("TA69_cdl_morning_star", "cdl_morning_star", 12, "100",
       "body_2 > mb_2 AND col_2 = -1 AND body_1 <= mb_1 AND top_1 < bot_2 AND body > mb AND col = 1 "
       "AND close > close_2 + 0.3 * body_2")
candle("TA70_cdl_evening_star", "cdl_evening_star", 12, "-100",
       "body_2 > mb_2 AND col_2 = 1 AND body_1 <= mb_1 AND bot_1 > top_2 AND body > mb AND col = -1 "
       "AND close < close_2 - 0.3 * body_2")
candle("TA71_cdl_three_white_soldiers", "cdl_three_white_soldiers", 12, "100",
       "col_2 = 1 AND col_1 = 1 AND col = 1 AND up_2 < 0.1 * mr_2 AND up_1 < 0.1 * mr_1 AND up < 0.1 * mr "
       "AND close > close_1 AND close_1 > close_2 AND open_1 > open_2 AND open_1 <= close_2 + 0.2 * m5_2 "
       "AND open > open_1 AND open <= close_1 + 0.2 * m5_1 AND body_1 > body_2 - 0.6 * m5_2 "
       "AND body > body_1 - 0.6 * m5_1 AND body > mb")
candle("TA72_cdl_three_black_crows", "cdl_three_black_crows", 13, "-100",
       "col_3 = 1 AND col_2 = -1 AND col_1 = -1 AND col = -1 AND dn_2 < 0.1 * mr_2 AND dn_1 < 0.1 * mr_1 "
       "AND dn < 0.1 * mr AND open_1 < open_2 AND open_1 > close_2 AND open < open_1 AND open > close_1 "
       "AND high_3 > close_2 AND close_2 > close_1 AND close_1 > close")
candle("TA73_cdl_harami", "cdl_harami", 11, "-100 * col_1",
       "body_1 > mb_1 AND body <= mb AND top < top_1 AND bot > bot_1")
candle("TA74_cdl_dark_cloud_cover", "cdl_dark_cloud_cover", 11, "-100",
       "col_1 = 1 AND body_1 > mb_1 AND col = -1 AND open > high_1 AND close > open_1 "
       "AND close < close_1 - 0.5 * body_1")
candle("TA75_cdl_piercing", "cdl_piercing", 11, "100",
       "col_1 = -1 AND body_1 > mb_1 AND col = 1 AND body > mb AND open < low_1 AND close < open_1 "
       "AND close > close_1 + 0.5 * body_1")
candle("TA76_cdl_marubozu", "cdl_marubozu", 10, "100 * col", "body > mb AND up < 0.1 * mr AND dn < 0.1 * mr")
candle("TA77_cdl_spinning_top", "cdl_spinning_top", 10, "100 * col", "body < mb AND up > body AND dn > body")

# -- features ------------------------------------------------------------------------
_PC = "CASE WHEN c1 <> 0 THEN close / c1 - 1 END"
register("TA78_price_change", {"price_change": _PC})
register("TA79_high_low_ratio", {"high_low_ratio": "CASE WHEN low <> 0 THEN high / low END"})
register("TA80_close_open_ratio", {"close_open_ratio": "CASE WHEN open <> 0 THEN close / open END"})
# half-hour bars: the hourly bars of the small tables are shorter than one frame
_M = f", m AS (SELECT *, {_PC} AS pc, CASE WHEN close <> 0 THEN (high - low) / close END AS hl FROM r)"


def whole(x: str, expr: str) -> str:
    return f"CASE WHEN count({x}) {over(720)} = 720 THEN {expr} END"


register("TA81_volatility_30d", {"volatility_30d": whole("pc", f"stddev_samp(pc) {over(720)} * sqrt(24)")}, _M, "m", 30)
register("TA82_price_volatility_30d", {"price_volatility_30d": whole("close", f"stddev_samp(close) {over(720)}")}, _M, "m", 30)
register("TA83_hl_volatility_30d", {"hl_volatility_30d": whole("hl", avg("hl", 720))}, _M, "m", 30)


@query("TA78_price_change_wrapped", f"""{bars_sql()}
SELECT symbol, CAST(t AS BIGINT) AS t, {fixed_sql("close / coalesce(c1, last(close ORDER BY t) OVER (PARTITION BY symbol)) - 1")} AS price_change FROM
(SELECT *, 1 AS one FROM r) z""".replace(
    "last(close ORDER BY t) OVER (PARTITION BY symbol)",
    "last_value(close) OVER (PARTITION BY symbol ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)",
))
def _wrapped(spark, sf_dir):
    table = indicators(fixtures.event_bars(spark, sf_dir), ["price_change"], wrap_first=True)
    return table.select(
        "symbol", F.col("unix_timestamp").alias("t"), fixed(F.col("price_change")).alias("price_change")
    )
