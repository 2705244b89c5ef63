"""Strategy queries over daily order bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.operators.keyed import join_latest, join_on_date
from tidegauge.plans import fixtures
from tidegauge.plans import strategy as st
from tidegauge.plans.catalog import fixed, fixed_sql, query, rounded
from tidegauge.plans.catalog.series import bars_sql

S = st.Settings()
# closes are 2..3 digit figures of the same series, so that rounding compares well
DAILY_SQL = """
WITH b AS (SELECT CAST(date_trunc('day', o_orderdate) AS DATE) AS d, last(o_totalprice ORDER BY o_orderkey) / 1000 AS close,
  max(o_totalprice) / 1000 AS high, min(o_totalprice) / 1000 AS low, CAST(count(*) AS DOUBLE) AS volume FROM orders GROUP BY 1),
z AS (SELECT *, CASE WHEN count(*) OVER w = 200 THEN avg(close) OVER w END AS realized FROM b
  WINDOW w AS (ORDER BY d ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)),
m AS (SELECT *, CASE WHEN realized <> 0 AND day(d) % 7 <> 0 THEN close / realized END AS mvrv,
  CASE WHEN close <> 0 AND day(d) % 5 <> 0 THEN (close - realized) / close END AS nupl, row_number() OVER (ORDER BY d) AS i FROM z)"""


def daily(spark, sf_dir):
    """Daily rows (date, close, high, low, volume, mvrv, nupl) with gaps in the ratios."""
    bars = fixtures.order_bars(spark, sf_dir, by_priority=False).select(
        F.to_date(F.timestamp_seconds("unix_timestamp")).alias("date"), (F.col("close") / 1000).alias("close"),
        (F.col("high") / 1000).alias("high"), (F.col("low") / 1000).alias("low"), F.col("volume_btc").alias("volume"),
    )
    bars = bars.withColumn("realized_price", st.rolling_mean("close", 200, S))
    rows = st.chain_ratios(bars)
    return rows.select(
        "date", "close", "high", "low", "volume",
        F.when(F.dayofmonth("date") % 7 != 0, F.col("mvrv")).alias("mvrv"),
        F.when(F.dayofmonth("date") % 5 != 0, F.col("nupl")).alias("nupl"),
    )


def dated(df):
    return rounded(df.withColumn("date", F.date_format("date", "yyyy-MM-dd")))


D = "strftime(d, '%Y-%m-%d') AS date"


def rows(n: int) -> str:
    return f"OVER (ORDER BY d ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def guarded(x: str, n: int, expr: str) -> str:
    return f"CASE WHEN count({x}) {rows(n)} = {n} THEN {expr} END"


@query("W03_rolling_mean", f"{DAILY_SQL} SELECT {D}, {fixed_sql(guarded('mvrv', 20, f'avg(mvrv) {rows(20)}'))} AS ma FROM m")
def _mean(spark, sf_dir):
    return dated(daily(spark, sf_dir).select("date", st.rolling_mean("mvrv", 20, S).alias("ma")))


@query("W03_rolling_mean_close", f"{DAILY_SQL} SELECT {D}, {fixed_sql(guarded('close', 220, f'avg(close) {rows(220)}'), 8)} AS ma FROM m")
def _mean_close(spark, sf_dir):
    return daily(spark, sf_dir).select(
        F.date_format("date", "yyyy-MM-dd").alias("date"), fixed(st.rolling_mean("close", 220, S), 8).alias("ma")
    )


@query("W04_rolling_std", f"{DAILY_SQL} SELECT {D}, {fixed_sql(guarded('close', 50, f'stddev_samp(close) {rows(50)}'))} AS sd FROM m")
def _std(spark, sf_dir):
    return dated(daily(spark, sf_dir).select("date", st.rolling_std("close", 50, S).alias("sd")))


def wma_sql(x: str, n: int) -> str:
    return guarded(x, n, f"(sum(i * {x}) {rows(n)} - (i - {n}) * sum({x}) {rows(n)}) / {n * (n + 1) / 2}")


@query("W05_linear_weighted_mean", f"""{DAILY_SQL},
w AS (SELECT d, i, list(close) {rows(300)} AS v FROM m)
SELECT {D}, {fixed_sql('''CASE WHEN len(v) = 300 THEN list_sum(list_transform(v, lambda x, j: x * j)) / 45150 END''')} AS ma FROM w""")
def _wma(spark, sf_dir):
    return dated(st.moving_average(daily(spark, sf_dir).select("date", "close"), "close", "ma", "WMA", 300, S).select("date", "ma"))


def ewm(src: str, n: int) -> str:
    k = 2.0 / (n + 1)
    return (f"list_reduce(list_transform({src}, lambda x: [x]), "
            f"lambda a, x: list_append(a, {1 - k!r} * a[-1] + {k!r} * x[1]))")


EWM_SQL = f"""{DAILY_SQL}, l AS (SELECT list(d ORDER BY d) AS ds, list(close ORDER BY d) AS c FROM m),
e1 AS (SELECT *, {ewm('c', 220)} AS e FROM l), e2 AS (SELECT *, {ewm('e', 220)} AS f FROM e1),
u AS (SELECT unnest(ds) AS d, unnest(c) AS close, unnest(e) AS e, unnest(f) AS f FROM e2)"""


@query("W06_exponential_mean", f"{EWM_SQL} SELECT {D}, {fixed_sql('e')} AS ma FROM u")
def _ewm(spark, sf_dir):
    return dated(st.moving_average(daily(spark, sf_dir).select("date", "close"), "close", "ma", "EMA", 220, S).select("date", "ma"))


@query("W07_double_exponential_mean", f"{EWM_SQL} SELECT {D}, {fixed_sql('2 * e - f')} AS ma FROM u")
def _dewm(spark, sf_dir):
    return dated(st.moving_average(daily(spark, sf_dir).select("date", "close"), "close", "ma", "DEMA", 220, S).select("date", "ma"))


@query("W08_ma_type_dispatch", f"""{DAILY_SQL}, l AS (SELECT list(d ORDER BY d) AS ds, list(close ORDER BY d) AS c FROM m),
e1 AS (SELECT *, {ewm('c', 30)} AS e FROM l), e2 AS (SELECT *, {ewm('e', 30)} AS f FROM e1),
u AS (SELECT unnest(ds) AS d, unnest(e) AS e, unnest(f) AS f FROM e2)
SELECT {D}, {fixed_sql(guarded('close', 30, f'avg(close) {rows(30)}'))} AS sma, {fixed_sql('e')} AS ema,
  {fixed_sql('2 * e - f')} AS dema, {fixed_sql(wma_sql('close', 30))} AS wma,
  {fixed_sql(guarded('close', 30, f'avg(close) {rows(30)}'))} AS other FROM m JOIN u USING (d)""")
def _dispatch(spark, sf_dir):
    df = daily(spark, sf_dir).select("date", "close")
    for kind in ("SMA", "EMA", "DEMA", "WMA", "other"):
        df = st.moving_average(df, "close", kind.lower(), kind, 30, S)
    return dated(df.drop("close"))


# linear in elapsed days; known points before and after each row
_INTERPOLATED = ", ".join(f"""CASE WHEN {x} IS NOT NULL THEN {x} WHEN {x}_n IS NOT NULL
  THEN {x}_b + ({x}_n - {x}_b) * date_diff('day', {x}_bd, d) / date_diff('day', {x}_bd, {x}_nd) ELSE {x}_b END AS {x}"""
                          for x in ("mvrv", "nupl"))
_KNOWN = ", ".join(f"""last_value({x} IGNORE NULLS) OVER bk AS {x}_b, first_value({x} IGNORE NULLS) OVER fw AS {x}_n,
  last_value(CASE WHEN {x} IS NOT NULL THEN d END IGNORE NULLS) OVER bk AS {x}_bd,
  first_value(CASE WHEN {x} IS NOT NULL THEN d END IGNORE NULLS) OVER fw AS {x}_nd""" for x in ("mvrv", "nupl"))
FILLED_SQL = f"""{DAILY_SQL},
k AS (SELECT *, {_KNOWN} FROM m WINDOW bk AS (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  fw AS (ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
f AS (SELECT d, i, close, {_INTERPOLATED} FROM k)"""


@query("W14_time_interpolation", f"{FILLED_SQL} SELECT {D}, {fixed_sql('mvrv')} AS mvrv, {fixed_sql('nupl')} AS nupl FROM f")
def _interpolated(spark, sf_dir):
    return dated(st.interpolate(daily(spark, sf_dir), ["mvrv", "nupl"], S).select("date", "mvrv", "nupl"))


def zscore_sql(x: str) -> str:
    sd = guarded(x, 50, f"stddev_samp({x}) {rows(50)}")
    return f"CASE WHEN ({sd}) <> 0 THEN ({x} - {wma_sql(x, 300)}) / ({sd}) END"


SCORED_SQL = f"""{FILLED_SQL},
q AS (SELECT d, i, close, {zscore_sql('mvrv')} AS zm, {zscore_sql('nupl')} AS zn FROM f)"""


def scored(spark, sf_dir):
    df = st.interpolate(daily(spark, sf_dir), ["mvrv", "nupl"], S)
    return st.zscore(st.zscore(df, "mvrv", S), "nupl", S)


@query("W09_zscore", f"{SCORED_SQL} SELECT {D}, {fixed_sql('zm', 5)} AS mvrv_zscore, {fixed_sql('zn', 5)} AS nupl_zscore FROM q")
def _zscore(spark, sf_dir):
    out = scored(spark, sf_dir)
    return out.select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        *(fixed(F.col(f"{x}_zscore"), 5).alias(f"{x}_zscore") for x in ("mvrv", "nupl")),
    )


_CONSENSUS = "CASE WHEN (zm > 0 AND zn > 0) OR (zm < 0 AND zn < 0) THEN (zm + zn) / 2 ELSE 0.0 END"


@query("W10_combined_score", f"""{SCORED_SQL} SELECT {D}, {fixed_sql('(zm + zn) / 2', 5)} AS average,
  {fixed_sql('zm * 0.8 + zn * 0.2', 5)} AS weighted, {fixed_sql(_CONSENSUS, 5)} AS consensus FROM q""")
def _combined(spark, sf_dir):
    a, b = F.col("mvrv_zscore"), F.col("nupl_zscore")
    return scored(spark, sf_dir).select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        *(fixed(st.combined_score(m, a, b, 0.8, 0.2), 5).alias(m) for m in ("average", "weighted", "consensus")),
    )


# the position as a step-by-step recursion over row numbers
TRADES_SQL = f"""{SCORED_SQL.replace('WITH b', 'WITH RECURSIVE b', 1)},
c AS (SELECT d, i, close, zm, zn, zm * 0.8 + zn * 0.2 AS x FROM q), n AS (SELECT *, lag(x) OVER (ORDER BY i) AS x1 FROM c),
p AS (SELECT CAST(1 AS BIGINT) AS i, 0 AS position, 0 AS signal UNION ALL
  SELECT n.i, CASE WHEN x1 <= -0.52 AND x > -0.52 AND position = 0 THEN 1 WHEN x1 >= -1.32 AND x < -1.32 AND position = 1 THEN 0 ELSE position END,
    CASE WHEN x1 <= -0.52 AND x > -0.52 AND position = 0 THEN 1 WHEN x1 >= -1.32 AND x < -1.32 AND position = 1 THEN -1 ELSE 0 END
  FROM p JOIN n ON n.i = p.i + 1),
t AS (SELECT n.*, p.position, p.signal, lag(close) OVER (ORDER BY n.i) AS c1, lag(p.position) OVER (ORDER BY n.i) AS p1,
  first_value(close) OVER (ORDER BY n.i) AS c0 FROM n JOIN p ON n.i = p.i),
v AS (SELECT *, 10000 * exp(sum(ln(CASE WHEN p1 = 1 THEN close / c1 ELSE 1 END)) OVER (ORDER BY i)) AS pv, 10000 / c0 * close AS bv FROM t),
r AS (SELECT *, pv / lag(pv) OVER (ORDER BY i) - 1 AS sr, bv / lag(bv) OVER (ORDER BY i) - 1 AS br, pv / 10000 - 1 AS sc, close / c0 - 1 AS bc FROM v)"""


def traded(spark, sf_dir):
    return st.run(daily(spark, sf_dir), S)


@query("W11_threshold_cross_signals", f"{TRADES_SQL} SELECT {D}, CAST(position AS BIGINT) AS position, CAST(signal AS BIGINT) AS signal FROM t")
def _signals(spark, sf_dir):
    return dated(traded(spark, sf_dir).select(
        "date", F.col("position").cast("long").alias("position"), F.col("signal").cast("long").alias("signal")
    ))


@query("W12_equity_curve", f"{TRADES_SQL} SELECT {D}, {fixed_sql('pv', 4)} AS portfolio_value, {fixed_sql('bv', 4)} AS buy_hold_value FROM v")
def _equity(spark, sf_dir):
    return traded(spark, sf_dir).select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        *(fixed(F.col(c), 4).alias(c) for c in ("portfolio_value", "buy_hold_value")),
    )


@query("W13_returns", f"""{TRADES_SQL} SELECT {D}, {fixed_sql('sr')} AS strategy_returns, {fixed_sql('br')} AS buy_hold_returns,
  {fixed_sql('sc')} AS strategy_cum_returns, {fixed_sql('bc')} AS buy_hold_cum_returns FROM r""")
def _returns(spark, sf_dir):
    return dated(traded(spark, sf_dir).select(
        "date", "strategy_returns", "buy_hold_returns", "strategy_cum_returns", "buy_hold_cum_returns"
    ))


_BY_SYMBOL = st.Settings(ma_type="SMA", ma_length=30, lookback=20, by=["symbol"])


def _between(x: str) -> str:
    """Linear in time between the known values around a row."""
    return (f"CASE WHEN {x} IS NOT NULL THEN {x} WHEN {x}_a IS NOT NULL THEN {x}_b + ({x}_a - {x}_b) * (t - {x}_tb) / ({x}_ta - {x}_tb) ELSE {x}_b END")


def _around(x: str) -> str:
    at = f"CASE WHEN {x} IS NOT NULL THEN t END"
    return (f"last_value({x} IGNORE NULLS) OVER up AS {x}_b, last_value({at} IGNORE NULLS) OVER up AS {x}_tb, "
            f"first_value({x} IGNORE NULLS) OVER dn AS {x}_a, first_value({at} IGNORE NULLS) OVER dn AS {x}_ta")


def _zscore_sql(x: str) -> str:
    mean = f"CASE WHEN count({x}) OVER w30 = 30 THEN avg({x}) OVER w30 END"
    deviation = f"CASE WHEN count({x}) OVER w20 = 20 THEN stddev_samp({x}) OVER w20 END"
    return f"({x} - {mean}) / nullif({deviation}, 0)"


_SERIES = "PARTITION BY symbol ORDER BY t ROWS BETWEEN"


@query("W12_sliced_equity_by_symbol", f"""{bars_sql()},
x0 AS (SELECT symbol, CAST(t AS BIGINT) AS t, CAST(t AS BIGINT) // 3600 AS h, close,
  CASE WHEN count(*) OVER w = 48 THEN avg(close) OVER w END AS rp FROM b WINDOW w AS ({_SERIES} 47 PRECEDING AND CURRENT ROW)),
x1 AS (SELECT symbol, t, close, CASE WHEN rp <> 0 AND NOT h % 200 BETWEEN 60 AND 140 THEN close / rp END AS m,
  CASE WHEN close <> 0 AND h % 5 <> 0 THEN (close - rp) / close END AS n FROM x0),
x2 AS (SELECT *, {_around('m')}, {_around('n')} FROM x1
  WINDOW up AS ({_SERIES} UNBOUNDED PRECEDING AND CURRENT ROW), dn AS ({_SERIES} CURRENT ROW AND UNBOUNDED FOLLOWING)),
x3 AS (SELECT symbol, t, close, {_between('m')} AS m, {_between('n')} AS n FROM x2),
x4 AS (SELECT symbol, t, close, {_zscore_sql('m')} * 0.8 + {_zscore_sql('n')} * 0.2 AS x FROM x3
  WINDOW w30 AS ({_SERIES} 29 PRECEDING AND CURRENT ROW), w20 AS ({_SERIES} 19 PRECEDING AND CURRENT ROW)),
x5 AS (SELECT *, lag(x) OVER (PARTITION BY symbol ORDER BY t) AS x1 FROM x4),
x6 AS (SELECT *, coalesce(last_value(CASE WHEN x1 <= -0.52 AND x > -0.52 THEN 1 WHEN x1 >= -1.32 AND x < -1.32 THEN 0 END IGNORE NULLS)
  OVER ({_SERIES} UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS position FROM x5),
x7 AS (SELECT *, coalesce(lag(position) OVER s, 0) AS was, lag(close) OVER s AS c1, first_value(close) OVER s AS c0 FROM x6
  WINDOW s AS (PARTITION BY symbol ORDER BY t))
SELECT symbol, t, CAST(position AS BIGINT) AS position, CAST(position - was AS BIGINT) AS signal,
  {fixed_sql("10000 * exp(sum(ln(CASE WHEN was = 1 THEN close / c1 ELSE 1 END)) OVER (PARTITION BY symbol ORDER BY t))", 3)} AS portfolio_value,
  {fixed_sql("10000 / c0 * close", 3)} AS buy_hold_value FROM x7""")
def _sliced(spark, sf_dir):
    """Hourly bars per symbol in slices of 64 rows; the ratio is missing for 81 hours on end."""
    bars = fixtures.event_bars(spark, sf_dir).withColumn("date", F.col("unix_timestamp"))
    rows = st.chain_ratios(bars.withColumn("realized_price", st.rolling_mean("close", 48, _BY_SYMBOL)))
    hour = F.floor(F.col("unix_timestamp") / 3600)
    rows = rows.select(
        "symbol", "unix_timestamp", "close", F.when(~(hour % 200).between(60, 140), F.col("mvrv")).alias("mvrv"),
        F.when(hour % 5 != 0, F.col("nupl")).alias("nupl"))
    out = st.run_sliced(rows, _BY_SYMBOL, 64)
    return out.select(
        "symbol", F.col("unix_timestamp").alias("t"), F.col("position").cast("long").alias("position"), F.col("signal").cast("long").alias("signal"),
        *(fixed(F.col(c), 3).alias(c) for c in ("portfolio_value", "buy_hold_value")))


_LAST = "(SELECT max(i) FROM v)"
_SUMMARY_SQL = f"""{TRADES_SQL},
y AS (SELECT (SELECT strftime(d, '%Y-%m-%d') FROM v WHERE i = {_LAST}) AS execution_date, (SELECT signal FROM v WHERE i = {_LAST}) AS s,
  (SELECT position FROM v WHERE i = {_LAST}) AS p, (SELECT signal FROM v WHERE signal <> 0 ORDER BY i DESC LIMIT 1) AS la,
  (SELECT pv FROM v WHERE i = {_LAST}) AS pv, (SELECT bv FROM v WHERE i = {_LAST}) AS bv, (SELECT close FROM v WHERE i = {_LAST}) AS close,
  (SELECT x FROM v WHERE i = {_LAST}) AS x, (SELECT pv FROM v WHERE i = {_LAST} - 29) AS p30, (SELECT bv FROM v WHERE i = {_LAST} - 29) AS b30)"""
_STATE = "CASE WHEN s = 1 THEN 'LONG' WHEN s = -1 THEN 'SHORT' WHEN p = 1 THEN 'HOLD BTC' ELSE 'HOLD FIAT' END"


@query("W16_performance_summary", f"""{_SUMMARY_SQL} SELECT {fixed_sql('(pv / 10000 - 1) * 100', 4)} AS total_return,
  {fixed_sql('(bv / 10000 - 1) * 100', 4)} AS buy_hold_return, {fixed_sql('(pv - bv) / 100', 4)} AS outperformance,
  {fixed_sql('(pv / p30 - 1) * 100', 4)} AS month_return, {fixed_sql('(bv / b30 - 1) * 100', 4)} AS market_month_return FROM y""")
def _summary(spark, sf_dir):
    names = ("total_return", "buy_hold_return", "outperformance", "month_return", "market_month_return")
    return st.report(traded(spark, sf_dir)).select(*(fixed(F.col(c), 4).alias(c) for c in names))


@query("W17_last_action", f"{_SUMMARY_SQL} SELECT execution_date, {_STATE} AS current_signal, CAST(la AS BIGINT) AS last_action FROM y")
def _action(spark, sf_dir):
    return st.report(traded(spark, sf_dir)).select(
        F.date_format("execution_date", "yyyy-MM-dd").alias("execution_date"), "current_signal",
        F.col("last_action").cast("long").alias("last_action"),
    )


@query("P25_report_record", f"""{_SUMMARY_SQL} SELECT execution_date, {_STATE} AS current_signal, CAST(p AS BIGINT) AS current_position,
  {fixed_sql('close', 4)} AS btc_price, {fixed_sql('x', 4)} AS combined_zscore FROM y""")
def _report(spark, sf_dir):
    return st.report(traded(spark, sf_dir)).select(
        F.date_format("execution_date", "yyyy-MM-dd").alias("execution_date"), "current_signal",
        F.col("current_position").cast("long").alias("current_position"),
        fixed(F.col("btc_price"), 4).alias("btc_price"), fixed(F.col("combined_zscore"), 4).alias("combined_zscore"),
    )


@query("T06_last_signals", f"""{TRADES_SQL} SELECT {D}, CASE WHEN signal = 1 THEN 'LONG' ELSE 'SHORT' END AS signal, {fixed_sql('close')} AS btc_price
FROM v WHERE signal <> 0 ORDER BY i DESC LIMIT 4""")
def _last_signals(spark, sf_dir):
    return dated(st.last_signals(traded(spark, sf_dir)))


_PARTS = """
pm AS (SELECT d, close FROM m WHERE day(d) % 3 <> 0 {limit}),
mm AS (SELECT d, mvrv FROM m WHERE mvrv IS NOT NULL {limit}),
nm AS (SELECT d, nupl FROM m WHERE nupl IS NOT NULL {limit})"""


def outer_sql(limit: str = "") -> str:
    return f"""{DAILY_SQL}, {_PARTS.format(limit=limit)}
SELECT strftime(coalesce(pm.d, mm.d, nm.d), '%Y-%m-%d') AS date, {fixed_sql('close')} AS close, {fixed_sql('mvrv')} AS mvrv, {fixed_sql('nupl')} AS nupl
FROM pm FULL OUTER JOIN mm ON pm.d = mm.d FULL OUTER JOIN nm ON coalesce(pm.d, mm.d) = nm.d"""


def three_inputs(spark, sf_dir):
    rows = daily(spark, sf_dir)
    return (
        rows.filter(F.dayofmonth("date") % 3 != 0).select("date", "close"),
        rows.filter("mvrv IS NOT NULL").select("date", "mvrv"),
        rows.filter("nupl IS NOT NULL").select("date", "nupl"),
    )


@query("J02_three_way_full_outer", outer_sql())
def _outer(spark, sf_dir):
    return dated(join_on_date(*three_inputs(spark, sf_dir)))


@query("T04_latest_60_before_join", outer_sql("ORDER BY d DESC LIMIT 60"))
def _outer_latest(spark, sf_dir):
    return dated(join_latest(*three_inputs(spark, sf_dir), 60))
