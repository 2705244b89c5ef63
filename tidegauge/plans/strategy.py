"""Z-score long/flat strategy over daily rows and its equity curve.

The daily strategy table has one row per date (per symbol, when a symbol column
is named in ``by``), so a series is bounded by the calendar.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.slices import (
    OVERLAP, ROW_NUMBER, SLICE, before, carried, cut, exponential_scan, interpolated, with_overlap,
)


@dataclass(frozen=True)
class Settings:
    """Production settings (fixed values)."""

    combine: str = "weighted"
    ma_type: str = "WMA"
    ma_length: int = 300
    lookback: int = 50
    long_level: float = -0.52
    short_level: float = -1.32
    mvrv_weight: float = 0.80
    nupl_weight: float = 0.20
    capital: float = 10_000.0
    by: list[str] = field(default_factory=list)

    @property
    def series(self):
        keys = self.by or [F.lit(0)]
        return Window.partitionBy(*keys).orderBy("date")

    def rows(self, n: int):
        return self.series.rowsBetween(-(n - 1), 0)


def chain_ratios(df: DataFrame, market: str = "close", realized: str = "realized_price") -> DataFrame:
    m, r = F.col(market), F.col(realized)
    return df.withColumn("mvrv", F.when(r != 0, m / r)).withColumn(
        "nupl", F.when(m != 0, (m - r) / m)
    )


def rolling_mean(x: str, n: int, s: Settings) -> Column:
    return F.when(F.count(x).over(s.rows(n)) == n, F.avg(x).over(s.rows(n)))


def rolling_std(x: str, n: int, s: Settings) -> Column:
    return F.when(F.count(x).over(s.rows(n)) == n, F.stddev_samp(x).over(s.rows(n)))


def _part(n: int) -> int:
    """Divisor of ``n`` nearest to its square root."""
    return min((d for d in range(1, n + 1) if n % d == 0), key=lambda d: abs(d * d - n))


def rolling_total(df: DataFrame, x: str, out: str, n: int, s: Settings) -> DataFrame:
    """Sum over ``n`` rows from sums of a short frame, NULL unless all are present."""
    part = _part(n)
    short = F.when(F.count(x).over(s.rows(part)) == part, F.sum(x).over(s.rows(part)))
    df = df.withColumn("_short", short)
    terms = [F.col("_short")] + [
        F.lag("_short", part * i).over(s.series) for i in range(1, n // part)
    ]
    return df.withColumn(out, reduce(add, terms)).drop("_short")


def weighted_mean(df: DataFrame, x: str, out: str, n: int, s: Settings) -> DataFrame:
    """Linear weights 1..n, from the totals of i*x and x."""
    df = df.withColumn("_row", F.row_number().over(s.series)).withColumn("_ix", F.col("_row") * F.col(x))
    df = rolling_total(rolling_total(df, "_ix", "_moment", n, s), x, "_total", n, s)
    moment = F.col("_moment") - (F.col("_row") - n) * F.col("_total")
    return df.withColumn(out, moment / (n * (n + 1) / 2)).drop("_row", "_ix", "_moment", "_total")


def exponential_means(df: DataFrame, x: str, n: int, levels: int, s: Settings) -> DataFrame:
    """Unseeded exponential mean(s), starting at the first value; columns _e1, _e2.

    Recursive, but a year of rows is an affine map, so years run apart and only their maps
    meet, one row a year."""
    out = df if SLICE in df.columns else df.withColumn(SLICE, F.floor(_axis(df) / YEAR[dict(df.dtypes)["date"] == "date"]))
    by = [k for k in s.by if k != SLICE]
    for i in range(1, levels + 1):
        out = exponential_scan(out, by, "date", x if i == 1 else f"_e{i - 1}", n, f"_e{i}")
    return out if SLICE in df.columns else out.drop(SLICE)


#: A year in the units of a numeric time (seconds) and of a date (days).
YEAR = (31_556_952, 366)


def _axis(df: DataFrame) -> Column:
    return F.unix_date("date") if dict(df.dtypes)["date"] == "date" else F.col("date")


def moving_average(df: DataFrame, x: str, out: str, ma_type: str, n: int, s: Settings) -> DataFrame:
    """SMA, EMA, DEMA or WMA; anything else is SMA."""
    if ma_type in ("EMA", "DEMA"):
        levels = 1 if ma_type == "EMA" else 2
        df = exponential_means(df, x, n, levels, s)
        value = F.col("_e1") if levels == 1 else 2 * F.col("_e1") - F.col("_e2")
        return df.withColumn(out, value).drop("_e1", "_e2")
    if ma_type == "WMA":
        return weighted_mean(df, x, out, n, s)
    return df.withColumn(out, rolling_mean(x, n, s))


def interpolate(df: DataFrame, columns: list[str], s: Settings) -> DataFrame:
    """Linear in elapsed days; leading gaps stay NULL, trailing gaps repeat the last value."""
    back = s.series.rowsBetween(Window.unboundedPreceding, 0)
    # the rows ahead are the rows seen so far in descending order: one pass, where
    # a frame to the end of the series would be scanned again for every row
    ahead = Window.partitionBy(*(s.by or [F.lit(0)])).orderBy(F.col("date").desc()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    day = F.unix_date("date")

    def filled(c: str) -> Column:
        known = F.when(F.col(c).isNotNull(), F.struct(day.alias("t"), F.col(c).alias("v")))
        before, after = F.last(known, True).over(back), F.last(known, True).over(ahead)
        share = (day - before["t"]) / (after["t"] - before["t"])
        return (
            F.when(F.col(c).isNotNull(), F.col(c))
            .when(after.isNotNull(), before["v"] + (after["v"] - before["v"]) * share)
            .otherwise(before["v"])
        )

    return df.select(*((filled(c).alias(c) if c in columns else F.col(c)) for c in df.columns))


def zscore(df: DataFrame, x: str, s: Settings) -> DataFrame:
    return _scored(moving_average(df, x, f"{x}_ma", s.ma_type, s.ma_length, s), x, s)


def _scored(df: DataFrame, x: str, s: Settings) -> DataFrame:
    std = rolling_std(x, s.lookback, s)
    df = df.withColumn(f"{x}_std", std)
    return df.withColumn(
        f"{x}_zscore",
        F.when(F.col(f"{x}_std") != 0, (F.col(x) - F.col(f"{x}_ma")) / F.col(f"{x}_std")),
    )


def combined_score(method: str, a: Column, b: Column, wa: float = 0.5, wb: float = 0.5) -> Column:
    """average, weighted or consensus (0 unless both have one sign); unknown is average."""
    if method == "weighted":
        return a * (wa / (wa + wb)) + b * (wb / (wa + wb))
    if method == "consensus":
        same = ((a > 0) & (b > 0)) | ((a < 0) & (b < 0))
        return F.when(same, (a + b) / 2).otherwise(F.lit(0.0))
    return (a + b) / 2


def _cross(before: Column, now: Column, s: Settings) -> Column:
    """1 on an upward cross of the long level, 0 on a downward cross of the short level."""
    return F.when((before <= s.long_level) & (now > s.long_level), 1).when(
        (before >= s.short_level) & (now < s.short_level), 0
    )


def signals(df: DataFrame, s: Settings, z: str = "combined_zscore") -> DataFrame:
    """Enter on an upward cross of the long level, leave on a downward cross of
    the short level.  One row cannot be both, and a cross into the state already
    held changes nothing, so the position is the last cross seen."""
    df = df.withColumn("_cross", _cross(F.lag(z).over(s.series), F.col(z), s))
    seen = s.series.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("position", F.coalesce(F.last("_cross", True).over(seen), F.lit(0)))
    return df.withColumn(
        "signal", F.col("position") - F.lag("position", 1, 0).over(s.series)
    ).drop("_cross")


def equity(df: DataFrame, s: Settings, price: str = "close") -> DataFrame:
    """Value before the trade of the row, buy & hold and both (cumulative) returns."""
    seen = s.series.rowsBetween(Window.unboundedPreceding, 0)
    p, earlier = F.col(price), F.lag(price).over(s.series)
    held = F.lag("position").over(s.series) == 1
    df = df.withColumn("_growth", F.when(held, p / earlier).otherwise(F.lit(1.0)))
    df = df.withColumn("portfolio_value", s.capital * F.product("_growth").over(seen)).withColumn(
        "buy_hold_value", s.capital / F.first(price).over(seen) * p
    )
    returns = lambda c: F.col(c) / F.lag(c).over(s.series) - 1
    df = df.withColumn("strategy_returns", returns("portfolio_value")).withColumn(
        "buy_hold_returns", returns("buy_hold_value")
    )
    total = lambda c: F.product(1 + F.coalesce(F.col(c), F.lit(0.0))).over(seen) - 1
    return df.withColumn("strategy_cum_returns", total("strategy_returns")).withColumn(
        "buy_hold_cum_returns", total("buy_hold_returns")
    ).drop("_growth")


def run(daily: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Interpolate, score, signal and value the daily strategy rows."""
    numeric = [c for c in ("open", "high", "low", "close", "volume", "mvrv", "nupl") if c in daily.columns]
    df = interpolate(daily, numeric, s)
    for x in ("mvrv", "nupl"):
        df = zscore(df, x, s)
    df = df.withColumn("combined_zscore", combined_score(
        s.combine, F.col("mvrv_zscore"), F.col("nupl_zscore"), s.mvrv_weight, s.nupl_weight
    ))
    return equity(signals(df, s), s)


ROWS_PER_SLICE = 50_000


def run_sliced(bars: DataFrame, s: Settings = Settings(), rows: int = ROWS_PER_SLICE) -> DataFrame:
    """:func:`run` for long series of many symbols: bars (symbol, unix_timestamp, close, mvrv, nupl, ...).

    Each symbol is cut into slices of ``rows`` rows.  Finite frames get the rows before a slice.
    A slice turns the position before it into one behind it (it keeps it, or its last cross
    decides), and multiplies the portfolio by its growth; these maps are combined over the
    slices before, one row a slice.  Same columns as :func:`run`, without ``date``.
    """
    by = ["symbol"]
    numeric = [c for c in ("open", "high", "low", "close", "volume", "mvrv", "nupl") if c in bars.columns]
    df = interpolated(cut(bars, rows), by, "unix_timestamp", numeric)
    if s.ma_type in ("EMA", "DEMA"):
        levels = 1 if s.ma_type == "EMA" else 2
        df = df.withColumn("date", F.col("unix_timestamp"))
        for x in ("mvrv", "nupl"):
            df = exponential_means(df, x, s.ma_length, levels, replace(s, by=by))
            value = F.col("_e1") if levels == 1 else 2 * F.col("_e1") - F.col("_e2")
            df = df.withColumn(f"{x}_ma", value).drop("_e1", "_e2")
        df = df.drop("date")
    # the last overlapping row needs whole frames too, as the first own row looks back on it
    df = with_overlap(df, rows, max(s.ma_length, s.lookback) + 1).withColumn("date", F.col(ROW_NUMBER))
    inside = replace(s, by=[*by, SLICE])
    for x in ("mvrv", "nupl"):
        df = zscore(df, x, inside) if f"{x}_ma" not in df.columns else _scored(df, x, inside)
    df = df.withColumn("combined_zscore", combined_score(
        s.combine, F.col("mvrv_zscore"), F.col("nupl_zscore"), s.mvrv_weight, s.nupl_weight))
    now, last = F.col("combined_zscore"), F.lag("combined_zscore").over(inside.series)
    df = df.withColumn("_cross", _cross(last, now, s)).withColumn("_p1", F.lag("close").over(inside.series)).filter(~F.col(OVERLAP))

    at = F.struct(ROW_NUMBER, "_cross")
    df = carried(df, by, {"_cross_last": F.max(F.when(F.col("_cross").isNotNull(), at))["_cross"]},
                 {"_held": F.coalesce(F.last("_cross_last", True).over(before(by)), F.lit(0))})
    seen = inside.series.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("position", F.coalesce(F.last("_cross", True).over(seen), F.col("_held")))
    df = df.withColumn("_was", F.coalesce(F.lag("position").over(inside.series), F.col("_held")))
    df = df.withColumn("signal", F.col("position") - F.col("_was"))
    df = df.withColumn("_growth", F.when(F.col("_was") == 1, F.col("close") / F.col("_p1")).otherwise(F.lit(1.0)))
    df = carried(df, by, {"_product": F.product("_growth"), "_start": F.min_by("close", ROW_NUMBER)}, {
        "_before": F.coalesce(F.product("_product").over(before(by)), F.lit(1.0)),
        "_p0": F.first("_start").over(Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, 0))})
    grown = F.col("_before") * F.product("_growth").over(seen)
    later = F.col(ROW_NUMBER) > 0
    df = df.select(
        "*", (s.capital * grown).alias("portfolio_value"), (s.capital / F.col("_p0") * F.col("close")).alias("buy_hold_value"),
        F.when(later, F.col("_growth") - 1).alias("strategy_returns"), F.when(later & F.col("_p0").isNotNull(), F.col("close") / F.col("_p1") - 1).alias("buy_hold_returns"),
        (grown - 1).alias("strategy_cum_returns"), F.coalesce(F.col("close") / F.col("_p0") - 1, F.lit(0.0)).alias("buy_hold_cum_returns"))
    return df.drop("date", SLICE, ROW_NUMBER, OVERLAP, "_cross", "_p1", "_held", "_was", "_growth", "_before", "_p0")


def last_signals(df: DataFrame, n: int = 4) -> DataFrame:
    """The newest ``n`` trades, newest first."""
    return (
        df.filter("signal != 0").orderBy(F.col("date").desc()).limit(n)
        .select("date", F.when(F.col("signal") == 1, "LONG").otherwise("SHORT").alias("signal"),
                F.col("close").alias("btc_price"))
    )


def report(df: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One record for the latest row.  The 30-row return compares with the 30th
    row from the end and is 0 for 30 rows or fewer."""
    value = lambda c: F.max_by(c, "date")
    newest = Window.partitionBy(*(s.by or [F.lit(0)])).orderBy(F.col("date").desc())
    df = df.withColumn("_age", F.row_number().over(newest))
    aged = lambda c: F.max(F.when(F.col("_age") == 30, F.col(c)))
    sums = df.groupBy(*s.by).agg(
        aged("portfolio_value").alias("_p30"), aged("buy_hold_value").alias("_b30"),
        F.count(F.lit(1)).alias("_n"), F.max("date").alias("execution_date"),
        value("signal").alias("_signal"), value("position").alias("current_position"),
        F.max_by(F.when(F.col("signal") != 0, F.col("signal")),
                 F.when(F.col("signal") != 0, F.col("date"))).alias("last_action"),
        value("close").alias("btc_price"), value("mvrv_zscore").alias("mvrv_zscore"),
        value("nupl_zscore").alias("nupl_zscore"), value("combined_zscore").alias("combined_zscore"),
        F.min_by("portfolio_value", "date").alias("_p0"), value("portfolio_value").alias("_p"),
        value("buy_hold_value").alias("_b"),
    )
    pct = lambda a, b: (F.col(a) / F.col(b) - 1) * 100
    month = lambda a, b: F.when(F.col("_n") > 30, pct(a, b)).otherwise(F.lit(0.0))
    return sums.select(
        *s.by, "execution_date",
        F.when(F.col("_signal") == 1, "LONG").when(F.col("_signal") == -1, "SHORT")
        .when(F.col("current_position") == 1, "HOLD BTC").otherwise("HOLD FIAT").alias("current_signal"),
        "current_position", "last_action", "btc_price", "mvrv_zscore", "nupl_zscore",
        "combined_zscore", pct("_p", "_p0").alias("total_return"),
        pct("_b", "_p0").alias("buy_hold_return"),
        (pct("_p", "_p0") - pct("_b", "_p0")).alias("outperformance"),
        month("_p", "_p30").alias("month_return"), month("_b", "_b30").alias("market_month_return"),
    ).withColumn("summary", F.format_string(
        "%s at %.2f, total %.2f%%, buy and hold %.2f%%",
        "current_signal", "btc_price", "total_return", "buy_hold_return",
    ))
