"""Hourly bars to the wide indicator table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.frames import BASE, add_frames, inputs_of
from tidegauge.operators.recursive import OUTPUTS, add_recursive
from tidegauge.operators.segments import ROWS_PER_SEGMENT, drop_halo, segment

# The published output columns, in table order.
INDICATORS = [
    "sma_5", "sma_10", "sma_20", "sma_50", "sma_100", "sma_200",
    "ema_5", "ema_10", "ema_12", "ema_20", "ema_26", "ema_50",
    "wma_10", "wma_20", "dema_10", "dema_20", "tema_10", "tema_20", "trima_20", "kama_20", "t3_5",
    "bb_upper", "bb_middle", "bb_lower",
    "rsi_7", "rsi_14", "rsi_21", "macd", "macd_signal", "macd_hist",
    "slowk", "slowd", "fastk", "fastd", "stochrsi_fastk", "stochrsi_fastd",
    "cci_14", "cci_20", "cmo_14", "mom_10", "roc_10", "rocp_10", "rocr_10", "willr_14",
    "ppo", "apo", "bop", "ultosc",
    "ad", "adosc", "obv", "mfi_14", "atr_14", "natr_14", "trange",
    "avgprice", "medprice", "typprice", "wclprice",
    "adx_14", "adxr_14", "dx_14", "minus_di", "plus_di", "minus_dm", "plus_dm",
    "aroon_down", "aroon_up", "aroonosc", "sar",
    "beta", "correl", "linearreg", "linearreg_angle", "linearreg_intercept", "linearreg_slope",
    "stddev", "tsf", "var",
    "ht_dcperiod", "ht_dcphase", "ht_trendmode", "ht_sine", "ht_leadsine",
    "ht_inphase", "ht_quadrature", "ht_trendline", "mama", "fama",
    "cdl_doji", "cdl_hammer", "cdl_inverted_hammer", "cdl_hanging_man", "cdl_shooting_star",
    "cdl_engulfing", "cdl_morning_star", "cdl_evening_star", "cdl_three_white_soldiers",
    "cdl_three_black_crows", "cdl_harami", "cdl_dark_cloud_cover", "cdl_piercing",
    "cdl_marubozu", "cdl_spinning_top",
    "price_change", "high_low_ratio", "close_open_ratio",
    "volatility_30d", "price_volatility_30d", "hl_volatility_30d",
]
WARMUP_ROWS = 720


def indicators(
    bars: DataFrame,
    columns: list[str] | None = None,
    rows_per_segment: int = ROWS_PER_SEGMENT,
    skip_rows: int = 0,
    wrap_first: bool = False,
) -> DataFrame:
    """Bars plus indicator columns; ``bars`` is keyed by (symbol, unix_timestamp).

    ``skip_rows`` drops the first rows of every symbol after computing.
    ``wrap_first`` compares the first close with the last one, as a rotated
    array would, instead of leaving the first price change NULL.
    """
    columns = list(INDICATORS if columns is None else columns)
    base = [c for c in bars.columns if c in BASE]
    slices = segment(bars.select(*base), rows_per_segment)
    recursive = [c for c in OUTPUTS if c in inputs_of(columns)]
    df = add_recursive(slices, recursive) if recursive else slices.df
    df = add_frames(df, columns)
    if skip_rows:
        if skip_rows > rows_per_segment:
            raise ValueError("skip_rows must fit in the first segment")
        df = df.filter((F.col("_seg") > 0) | (F.col("_li") >= skip_rows))
    if wrap_first and "price_change" in columns:
        df = _wrap_price_change(df, bars)
    return drop_halo(df).select(*base, *columns)


def _wrap_price_change(df: DataFrame, bars: DataFrame) -> DataFrame:
    last = bars.groupBy("symbol").agg(F.max_by("close", "unix_timestamp").alias("_last_close"))
    first_row = (F.col("_seg") == 0) & (F.col("_li") == 0) & (F.col("_last_close") != 0)
    return df.join(last, "symbol").withColumn(
        "price_change",
        F.when(first_row, F.col("close") / F.col("_last_close") - 1).otherwise(F.col("price_change")),
    )


def skip_warmup(table: DataFrame, rows: int = WARMUP_ROWS) -> DataFrame:
    """Drop the first rows of every symbol of a stored table.

    Only the ``rows`` oldest keys per symbol are ranked (limited per task before
    the shuffle), then removed by an anti join.
    """
    oldest = (
        table.select("symbol", "unix_timestamp")
        .withColumn(
            "_r", F.row_number().over(Window.partitionBy("symbol").orderBy("unix_timestamp"))
        )
        .filter(F.col("_r") <= rows)
        .drop("_r")
    )
    return table.join(oldest, ["symbol", "unix_timestamp"], "left_anti")
