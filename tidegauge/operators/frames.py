"""Indicators whose frame is finite: native window expressions.

Every column is declared once in ``COLUMNS`` as (inputs, expression).  Columns
are added level by level, so all columns of one level share a single window
operator (same partitioning and order, hence one sort and no extra shuffle).
``_li`` is the 0-based row in the slice; a value before its first full frame is
NULL, integer candlestick columns are 0 there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BASE = {
    "symbol", "unix_timestamp", "open", "high", "low", "close", "volume_btc",
    "volume_usd", "_li", "_seg", "_halo",
}


@dataclass(frozen=True)
class Frames:
    """Window shorthands over one slice; each specification is built once."""

    keys: tuple[str, ...] = ("symbol", "_seg")
    order: str = "unix_timestamp"
    _specs: dict = field(default_factory=dict)

    @property
    def series(self):
        if "series" not in self._specs:
            self._specs["series"] = Window.partitionBy(*self.keys).orderBy(self.order)
        return self._specs["series"]

    def last(self, n: int, ending: int = 0):
        """Frame of n rows whose newest row is ``ending`` rows before the current one."""
        if (n, ending) not in self._specs:
            self._specs[n, ending] = self.series.rowsBetween(-(n - 1) - ending, -ending)
        return self._specs[n, ending]

    def lag(self, name: str, n: int = 1) -> Column:
        return F.lag(name, n).over(self.series)

    def full(self, expr: Column, first_row: int) -> Column:
        return F.when(F.col("_li") >= first_row, expr)

    def mean(self, name: str, n: int, first_row: int | None = None) -> Column:
        return self.full(F.avg(name).over(self.last(n)), n - 1 if first_row is None else first_row)

    def total(self, name: str, n: int, first_row: int | None = None) -> Column:
        return self.full(F.sum(name).over(self.last(n)), n - 1 if first_row is None else first_row)

    def spaced(self, name: str, step: int, times: int) -> Column:
        """name[0] + name[-step] + ... (``times`` terms), NULL while one is missing."""
        return reduce(add, [c(name)] + [self.lag(name, step * i) for i in range(1, times)])


Builder = Callable[[Frames], Column]
COLUMNS: dict[str, tuple[tuple[str, ...], Builder]] = {}


def define(name: str, *inputs: str):
    def register(build: Builder) -> Builder:
        COLUMNS[name] = (inputs, build)
        return build
    return register


def c(name: str) -> Column:
    return F.col(name)


def ratio(num: Column, den: Column, otherwise: float | None = 0.0) -> Column:
    """num/den where den is non-zero."""
    guarded = F.when(den != 0, num / den)
    return guarded if otherwise is None else guarded.otherwise(F.when(den == 0, F.lit(otherwise)))


# -- overlap ---------------------------------------------------------------
for _n in (5, 10, 12, 26):
    define(f"sma_{_n}", "close")(lambda f, n=_n: f.mean("close", n))
# a wide mean is the mean of equally wide neighbours: a few lags instead of a wide frame
for _n, _part in ((20, 10), (50, 10), (100, 50), (200, 50)):
    define(f"sma_{_n}", f"sma_{_part}")(
        lambda f, n=_n, part=_part: f.spaced(f"sma_{part}", part, n // part) / (n // part)
    )

for _n in (10, 20):
    # sum of i*p over the frame, from the slice row number and two running sums
    define(f"wma_{_n}", "_ip")(
        lambda f, n=_n: (f.total("_ip", n) - (c("_li") - n) * f.total("close", n))
        / (n * (n + 1) / 2)
    )
define("_ip", "close")(lambda f: c("_li") * c("close"))

define("_sma_trima", "close")(lambda f: f.mean("close", 10))
define("trima_20", "_sma_trima")(lambda f: f.mean("_sma_trima", 11, 19))

# Wide second moments: mean and squared deviations of a short frame, merged with
# equally long neighbours.  Merging keeps the precision that differences of
# running sums lose.
def merged_moments(source: str, first: int, times: tuple[int, ...], other: str | None = None) -> None:
    """Columns _<source>_m<n> and _<source>_d<n> (with ``other``: co-deviations)."""
    both = f"{source}_{other}" if other else source
    frame = (
        (lambda f: F.covar_pop(source, other).over(f.last(first)) * first) if other
        else (lambda f: F.var_pop(source).over(f.last(first)) * first)
    )
    present = lambda f, expr: F.when(F.count(source).over(f.last(first)) == first, expr)
    if not other:
        define(f"_{source}_m{first}", source)(lambda f: present(f, F.avg(source).over(f.last(first))))
    define(f"_{both}_d{first}", source, *([other] if other else []))(lambda f: present(f, frame(f)))
    rows = first
    for m in times:
        left, right = f"_{source}_m{rows}", f"_{other or source}_m{rows}"
        dev, wide = f"_{both}_d{rows}", rows * m
        if not other:
            define(f"_{source}_m{wide}", left)(
                lambda f, x=left, rows=rows, m=m: f.spaced(x, rows, m) / m
            )

        def merged(f: Frames, a=left, b=right, dev=dev, rows=rows, m=m) -> Column:
            at = lambda name, i: f.lag(name, rows * i) if i else c(name)
            mean_a, mean_b = f.spaced(a, rows, m) / m, f.spaced(b, rows, m) / m
            between = [(at(a, i) - mean_a) * (at(b, i) - mean_b) for i in range(m)]
            return f.spaced(dev, rows, m) + rows * reduce(add, between)

        define(f"_{both}_d{wide}", *dict.fromkeys([left, right, dev]))(merged)
        rows = wide


define("bb_middle", "sma_20")(lambda f: c("sma_20"))
define("_sd20", "close")(lambda f: f.full(F.stddev_pop("close").over(f.last(20)), 19))
define("var", "_sd20")(lambda f: c("_sd20") * c("_sd20"))
define("bb_upper", "bb_middle", "_sd20")(lambda f: c("bb_middle") + 2 * c("_sd20"))
define("bb_lower", "bb_middle", "_sd20")(lambda f: c("bb_middle") - 2 * c("_sd20"))

# -- momentum --------------------------------------------------------------
define("_hh5", "high")(lambda f: F.max("high").over(f.last(5)))
define("_ll5", "low")(lambda f: F.min("low").over(f.last(5)))
define("_raw_k", "_hh5", "_ll5")(
    lambda f: f.full(100 * ratio(c("close") - c("_ll5"), c("_hh5") - c("_ll5")), 4)
)
define("_slow_k", "_raw_k")(lambda f: f.mean("_raw_k", 3, 6))
define("slowk", "_slow_k")(lambda f: f.full(c("_slow_k"), 8))
define("slowd", "_slow_k")(lambda f: f.mean("_slow_k", 3, 8))
define("fastk", "_raw_k")(lambda f: f.full(c("_raw_k"), 6))
define("fastd", "_raw_k")(lambda f: f.mean("_raw_k", 3, 6))

define("_rsi_hi", "rsi_14")(lambda f: F.max("rsi_14").over(f.last(5)))
define("_rsi_lo", "rsi_14")(lambda f: F.min("rsi_14").over(f.last(5)))
define("_stochrsi_raw", "_rsi_hi", "_rsi_lo", "rsi_14")(
    lambda f: f.full(100 * ratio(c("rsi_14") - c("_rsi_lo"), c("_rsi_hi") - c("_rsi_lo")), 18)
)
define("stochrsi_fastk", "_stochrsi_raw")(lambda f: f.full(c("_stochrsi_raw"), 20))
define("stochrsi_fastd", "_stochrsi_raw")(lambda f: f.mean("_stochrsi_raw", 3, 20))

define("typprice")(lambda f: (c("high") + c("low") + c("close")) / 3)
for _ago in range(1, 20):
    define(f"_tp_ago{_ago}", "typprice")(lambda f, n=_ago: f.lag("typprice", n))


def typical_prices(n: int) -> list[str]:
    return ["typprice"] + [f"_tp_ago{i}" for i in range(1, n)]


for _n in (14, 20):
    define(f"_tp_mean_{_n}", *typical_prices(_n))(
        lambda f, n=_n: reduce(add, [c(x) for x in typical_prices(n)]) / n
    )

    # mean distance of the frame's rows from the current row's own mean
    def _cci(f: Frames, n: int = _n) -> Column:
        mean, now = c(f"_tp_mean_{n}"), c("typprice")
        spread = reduce(add, [F.abs(c(x) - mean) for x in typical_prices(n)]) / n
        return f.full(ratio(now - mean, 0.015 * spread), n - 1)

    define(f"cci_{_n}", f"_tp_mean_{_n}", *typical_prices(_n))(_cci)

define("_close_10", "close")(lambda f: f.lag("close", 10))
define("mom_10", "_close_10")(lambda f: c("close") - c("_close_10"))
define("roc_10", "_close_10")(
    lambda f: 100 * ratio(c("close") - c("_close_10"), c("_close_10"))
)
define("rocp_10", "_close_10")(
    lambda f: ratio(c("close") - c("_close_10"), c("_close_10"))
)
define("rocr_10", "_close_10")(lambda f: ratio(c("close"), c("_close_10")))

define("_hh14", "high")(lambda f: F.max("high").over(f.last(14)))
define("_ll14", "low")(lambda f: F.min("low").over(f.last(14)))
define("willr_14", "_hh14", "_ll14")(
    lambda f: f.full(-100 * ratio(c("_hh14") - c("close"), c("_hh14") - c("_ll14")), 13)
)
define("apo", "sma_12", "sma_26")(lambda f: f.full(c("sma_12") - c("sma_26"), 25))
define("ppo", "sma_12", "sma_26")(
    lambda f: f.full(100 * ratio(c("sma_12") - c("sma_26"), c("sma_26")), 25)
)
define("bop")(lambda f: ratio(c("close") - c("open"), c("high") - c("low")))

define("_close_1", "close")(lambda f: f.lag("close"))
define("_bp", "_close_1")(
    lambda f: F.when(c("_li") > 0, c("close") - F.least("low", "_close_1"))
)
define("_ult_range", "_close_1")(
    lambda f: F.when(
        c("_li") > 0, F.greatest("high", "_close_1") - F.least("low", "_close_1")
    )
)


for _x in ("_bp", "_ult_range"):
    define(f"{_x}_7", _x)(lambda f, x=_x: F.sum(x).over(f.last(7)))


def _ultimate(f: Frames) -> Column:
    def part(n: int) -> Column:
        return ratio(f.spaced("_bp_7", 7, n // 7), f.spaced("_ult_range_7", 7, n // 7))
    return f.full(100 * (4 * part(7) + 2 * part(14) + part(28)) / 7, 28)


define("ultosc", "_bp_7", "_ult_range_7")(_ultimate)

# -- volume ----------------------------------------------------------------
define("_flow", "typprice")(lambda f: c("typprice") * c("volume_btc"))
define("_flow_up", "_flow", "_tp_ago1")(
    lambda f: F.when(c("typprice") > c("_tp_ago1"), c("_flow")).otherwise(0.0)
)
define("_flow_down", "_flow", "_tp_ago1")(
    lambda f: F.when(c("typprice") < c("_tp_ago1"), c("_flow")).otherwise(0.0)
)


for _x in ("_flow_up", "_flow_down"):
    define(f"{_x}_7", _x)(lambda f, x=_x: F.sum(x).over(f.last(7)))


def _money_flow(f: Frames) -> Column:
    up, down = f.spaced("_flow_up_7", 7, 2), f.spaced("_flow_down_7", 7, 2)
    share = F.when(up + down < 1, F.lit(0.0)).otherwise(100 * up / (up + down))
    return f.full(share, 14)


define("mfi_14", "_flow_up_7", "_flow_down_7")(_money_flow)

# -- volatility and price transforms ----------------------------------------
define("trange", "_close_1")(
    lambda f: F.when(
        c("_li") > 0,
        F.greatest(
            c("high") - c("low"), F.abs(c("high") - c("_close_1")), F.abs(c("low") - c("_close_1"))
        ),
    )
)
define("avgprice")(lambda f: (c("open") + c("high") + c("low") + c("close")) / 4)
define("medprice")(lambda f: (c("high") + c("low")) / 2)
define("wclprice")(lambda f: (c("high") + c("low") + 2 * c("close")) / 4)

# -- trend -----------------------------------------------------------------
define("adxr_14", "adx_14")(lambda f: f.full((c("adx_14") + f.lag("adx_14", 13)) / 2, 40))
define("_at_high", "high")(
    lambda f: F.max_by("_li", F.struct("high", "_li")).over(f.last(15))
)
define("_at_low", "low")(
    lambda f: F.min_by("_li", F.struct(c("low"), -c("_li"))).over(f.last(15))
)
define("aroon_up", "_at_high")(
    lambda f: f.full(100 * (14 - (c("_li") - c("_at_high"))) / 14.0, 14)
)
define("aroon_down", "_at_low")(
    lambda f: f.full(100 * (14 - (c("_li") - c("_at_low"))) / 14.0, 14)
)
define("aroonosc", "aroon_up", "aroon_down")(lambda f: c("aroon_up") - c("aroon_down"))

# -- statistics ------------------------------------------------------------
define("_ret_high", "high")(
    lambda f: ratio(c("high") - f.lag("high"), f.lag("high"))
)
define("_ret_low", "low")(lambda f: ratio(c("low") - f.lag("low"), f.lag("low")))
define("_ret_xy", "_ret_high", "_ret_low")(lambda f: c("_ret_high") * c("_ret_low"))
define("_ret_xx", "_ret_high")(lambda f: c("_ret_high") * c("_ret_high"))


def _beta(f: Frames) -> Column:
    sx, sy, sxy, sxx = (
        f.total(name, 5, 5) for name in ("_ret_high", "_ret_low", "_ret_xy", "_ret_xx")
    )
    return ratio(5 * sxy - sx * sy, 5 * sxx - sx * sx)


define("beta", "_ret_xy", "_ret_xx", "_ret_high", "_ret_low")(_beta)
merged_moments("high", 6, (5,))
merged_moments("low", 6, (5,))
merged_moments("high", 6, (5,), other="low")
define("correl", "_high_d30", "_low_d30", "_high_low_d30")(
    lambda f: f.full(ratio(c("_high_low_d30"), F.sqrt(c("_high_d30") * c("_low_d30"))), 29)
)
define("linearreg_slope", "close")(
    lambda f: f.full(F.regr_slope("close", "_li").over(f.last(14)), 13)
)
define("_mean14", "close")(lambda f: f.mean("close", 14))
define("linearreg", "linearreg_slope", "_mean14")(
    lambda f: c("_mean14") + 6.5 * c("linearreg_slope")
)
define("linearreg_intercept", "linearreg_slope", "_mean14")(
    lambda f: c("_mean14") - 6.5 * c("linearreg_slope")
)
define("tsf", "linearreg_slope", "_mean14")(
    lambda f: c("_mean14") + 7.5 * c("linearreg_slope")
)
define("linearreg_angle", "linearreg_slope")(
    lambda f: F.degrees(F.atan("linearreg_slope"))
)
define("stddev", "_sd20")(lambda f: c("_sd20"))

# -- features --------------------------------------------------------------
define("price_change", "_close_1")(lambda f: ratio(c("close"), c("_close_1"), None) - 1)
define("high_low_ratio")(lambda f: ratio(c("high"), c("low"), None))
define("close_open_ratio")(lambda f: ratio(c("close"), c("open"), None))
define("_range_share")(lambda f: ratio(c("high") - c("low"), c("close"), None))



for _source in ("price_change", "close", "_range_share"):
    merged_moments(_source, 9, (5, 4, 4))
define("volatility_30d", "_price_change_d720")(
    lambda f: F.sqrt(c("_price_change_d720") / 719) * (24 ** 0.5)
)
define("price_volatility_30d", "_close_d720")(lambda f: F.sqrt(c("_close_d720") / 719))
define("hl_volatility_30d", "__range_share_m720")(lambda f: c("__range_share_m720"))


# -- candlesticks ----------------------------------------------------------
# Thresholds, fixed values of the public definitions:
#   doji 0.1 of the mean range of 10 bars, very short shadow 0.1 of the same,
#   near 0.2 and far 0.6 of the mean range of 5 bars, long/short body = mean
#   body of 10 bars; penetration 0.3 for the stars, 0.5 for dark cloud/piercing.
define("_body")(lambda f: F.abs(c("close") - c("open")))
define("_upper")(lambda f: c("high") - F.greatest("open", "close"))
define("_lower")(lambda f: F.least("open", "close") - c("low"))
define("_top")(lambda f: F.greatest("open", "close"))
define("_bottom")(lambda f: F.least("open", "close"))
define("_range")(lambda f: c("high") - c("low"))
define("_color")(lambda f: F.when(c("close") >= c("open"), 1).otherwise(-1))
define("_body10", "_body")(lambda f: F.avg("_body").over(f.last(10, 1)))
define("_range10", "_range")(lambda f: F.avg("_range").over(f.last(10, 1)))
define("_range5", "_range")(lambda f: F.avg("_range").over(f.last(5, 1)))


FIELDS = {
    "open": "open", "high": "high", "low": "low", "close": "close", "body": "_body", "upper": "_upper",
    "lower": "_lower", "top": "_top", "bottom": "_bottom", "color": "_color", "mean_body": "_body10",
    "range10": "_range10", "range5": "_range5",
}
# earlier bars are lagged once and shared by all patterns; unused ones are pruned
for _field, _column in FIELDS.items():
    for _ago in (1, 2, 3):
        define(f"_{_field}_ago{_ago}", _column)(lambda f, x=_column, n=_ago: f.lag(x, n))


@dataclass(frozen=True)
class Bar:
    """The bar ``ago`` rows before the current one."""

    ago: int = 0

    def __getattr__(self, name: str) -> Column:
        return c(f"_{name}_ago{self.ago}" if self.ago else FIELDS[name])

    @property
    def white(self) -> Column:
        return self.color == 1

    @property
    def black(self) -> Column:
        return self.color == -1

    @property
    def is_long(self) -> Column:
        return self.body > self.mean_body

    @property
    def no_upper(self) -> Column:
        return self.upper < 0.1 * self.range10

    @property
    def no_lower(self) -> Column:
        return self.lower < 0.1 * self.range10

    @property
    def near(self) -> Column:
        return 0.2 * self.range5

    @property
    def far(self) -> Column:
        return 0.6 * self.range5


def pattern(name: str, first_row: int, earlier: int = 0):
    """Register a pattern over ``earlier`` bars back: build() gives (value, conditions)."""
    inputs = tuple(FIELDS.values()) + tuple(
        f"_{field}_ago{ago}" for field in FIELDS for ago in range(1, earlier + 1)
    )

    def register(build):
        def column(f: Frames) -> Column:
            value, conditions = build(Bar)
            hit = reduce(lambda a, b: a & b, conditions) & (c("_li") >= first_row)
            return F.when(hit, value).otherwise(F.lit(0)).cast("int")
        COLUMNS[name] = (inputs, column)
        return build
    return register


@pattern("cdl_doji", 10)
def _doji(bar):
    return F.lit(100), [bar().body <= 0.1 * bar().range10]


@pattern("cdl_hammer", 11, 1)
def _hammer(bar):
    b, p = bar(), bar(1)
    return F.lit(100), [
        b.body < b.mean_body, b.lower > b.body, b.no_upper, b.bottom <= p.low + p.near,
    ]


@pattern("cdl_inverted_hammer", 11, 1)
def _inverted_hammer(bar):
    b, p = bar(), bar(1)
    return F.lit(100), [b.body < b.mean_body, b.upper > b.body, b.no_lower, b.top < p.bottom]


@pattern("cdl_hanging_man", 11, 1)
def _hanging_man(bar):
    b, p = bar(), bar(1)
    return F.lit(-100), [
        b.body < b.mean_body, b.lower > b.body, b.no_upper, b.bottom >= p.high - p.near,
    ]


@pattern("cdl_shooting_star", 11, 1)
def _shooting_star(bar):
    b, p = bar(), bar(1)
    return F.lit(-100), [b.body < b.mean_body, b.upper > b.body, b.no_lower, b.bottom > p.top]


@pattern("cdl_engulfing", 2, 1)
def _engulfing(bar):
    b, p = bar(), bar(1)
    return 100 * b.color, [b.color == -p.color, b.top > p.top, b.bottom < p.bottom]


@pattern("cdl_morning_star", 12, 2)
def _morning_star(bar):
    first, star, b = bar(2), bar(1), bar()
    return F.lit(100), [
        first.is_long, first.black, star.body <= star.mean_body, star.top < first.bottom,
        b.is_long, b.white, b.close > first.close + 0.3 * first.body,
    ]


@pattern("cdl_evening_star", 12, 2)
def _evening_star(bar):
    first, star, b = bar(2), bar(1), bar()
    return F.lit(-100), [
        first.is_long, first.white, star.body <= star.mean_body, star.bottom > first.top,
        b.is_long, b.black, b.close < first.close - 0.3 * first.body,
    ]


@pattern("cdl_three_white_soldiers", 12, 2)
def _white_soldiers(bar):
    x, y, z = bar(2), bar(1), bar()
    return F.lit(100), [
        x.white, y.white, z.white, x.no_upper, y.no_upper, z.no_upper,
        z.close > y.close, y.close > x.close,
        y.open > x.open, y.open <= x.close + x.near,
        z.open > y.open, z.open <= y.close + y.near,
        y.body > x.body - x.far, z.body > y.body - y.far, z.is_long,
    ]


@pattern("cdl_three_black_crows", 13, 3)
def _black_crows(bar):
    before, x, y, z = bar(3), bar(2), bar(1), bar()
    return F.lit(-100), [
        before.white, x.black, y.black, z.black, x.no_lower, y.no_lower, z.no_lower,
        y.open < x.open, y.open > x.close, z.open < y.open, z.open > y.close,
        before.high > x.close, x.close > y.close, y.close > z.close,
    ]


@pattern("cdl_harami", 11, 1)
def _harami(bar):
    b, p = bar(), bar(1)
    return -100 * p.color, [
        p.is_long, b.body <= b.mean_body, b.top < p.top, b.bottom > p.bottom,
    ]


@pattern("cdl_dark_cloud_cover", 11, 1)
def _dark_cloud(bar):
    b, p = bar(), bar(1)
    return F.lit(-100), [
        p.white, p.is_long, b.black, b.open > p.high, b.close > p.open,
        b.close < p.close - 0.5 * p.body,
    ]


@pattern("cdl_piercing", 11, 1)
def _piercing(bar):
    b, p = bar(), bar(1)
    return F.lit(100), [
        p.black, p.is_long, b.white, b.is_long, b.open < p.low, b.close < p.open,
        b.close > p.close + 0.5 * p.body,
    ]


@pattern("cdl_marubozu", 10)
def _marubozu(bar):
    b = bar()
    return 100 * b.color, [b.is_long, b.no_upper, b.no_lower]


@pattern("cdl_spinning_top", 10)
def _spinning_top(bar):
    b = bar()
    return 100 * b.color, [b.body < b.mean_body, b.upper > b.body, b.lower > b.body]


# -- building --------------------------------------------------------------
def inputs_of(wanted: list[str]) -> set[str]:
    """All columns needed for ``wanted``, down to the ones that must already exist."""
    need, todo = set(), list(wanted)
    while todo:
        name = todo.pop()
        if name not in need:
            need.add(name)
            todo.extend(COLUMNS.get(name, ((), None))[0])
    return need


def add_frames(df: DataFrame, wanted: list[str], frames: Frames | None = None) -> DataFrame:
    """Append the finite-frame columns ``wanted`` (and drop their helpers)."""
    frames = frames or Frames()
    have = set(df.columns)
    pending = {n for n in inputs_of(wanted) if n in COLUMNS and n not in have}
    kept = df.columns + [n for n in wanted if n not in have]
    while pending:
        ready = sorted(n for n in pending if all(i in have for i in COLUMNS[n][0]))
        if not ready:
            raise ValueError(f"missing inputs for {sorted(pending)}")
        df = df.select("*", *(COLUMNS[n][1](frames).alias(n) for n in ready))
        have.update(ready)
        pending.difference_update(ready)
    return df.select(*kept)


def row_sum(columns: list[str]) -> Column:
    """Sum that reads a missing value as zero."""
    return reduce(add, [F.coalesce(F.col(x), F.lit(0.0)) for x in columns])
