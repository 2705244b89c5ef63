"""Readers for landed feed files: JSON metrics, klines, CSV histories, sitemaps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.sources.objects import RANGE_BYTES, read_objects


@dataclass(frozen=True)
class Feed:
    """One metric feed: JSON field(s) and the column(s) they fill."""

    columns: tuple[tuple[str, str], ...]
    date_field: str = "d"

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(self.date_field, T.StringType()), T.StructField("unixTs", T.LongType())]
        return T.StructType(fields + [T.StructField(f, T.DoubleType()) for f, _ in self.columns])


def _one(field: str, column: str, date_field: str = "d") -> Feed:
    return Feed(((field, column),), date_field)


# The feeds by metric name, with JSON field and column.
FEEDS: dict[str, Feed] = {
    "market_price": _one("btcPrice", "market_price"),
    "delta_price_pct": _one("deltaPricePct", "delta_price_pct"),
    "mvrv": _one("mvrv", "mvrv"),
    "mvrv_zscore": _one("mvrvZscore", "mvrv_zscore"),
    "nupl": _one("nupl", "nupl"),
    "asol": _one("asol", "asol"),
    "asopr": _one("asopr", "asopr"),
    "aviv": _one("aviv", "aviv"),
    "sth_mvrv": _one("sthMvrv", "sth_mvrv"),
    "lth_mvrv": _one("lthMvrv", "lth_mvrv"),
    "rhodl_ratio": _one("rhodlRatio", "rhodl_ratio"),
    "supply_profit": _one("supplyProfit", "supply_profit"),
    "supply_loss": _one("supplyLoss", "supply_loss"),
    "supply_current": _one("supplyCurrent", "supply_current", "theDay"),
    "long_term_hodler_supply": _one("longTermHodlerSupplyBtc", "lth_supply"),
    "short_term_hodler_supply": _one("shortTermHodlerSupplyBtc", "sth_supply"),
    "realized_price": _one("realizedPrice", "realized_price", "theDay"),
    "etf_flow_btc": _one("etfFlow", "etf_flow"),
    "bitcoin_dominance": _one("bitcoinDominance", "bitcoin_dominance"),
    "funding_rate": _one("fundingRate", "funding_rate"),
    "nvts": _one("nvts", "nvts"),
    "hashrate": _one("hashrate", "hashrate"),
    "puell_multiple": _one("puellMultiple", "puell_multiple"),
    "reserve_risk": _one("reserveRisk", "reserve_risk"),
    "investor_price": _one("investorPrice", "investor_price"),
    "realized_profit_sth": _one("realizedProfitSth", "realized_profit_sth"),
    "realized_profit_lth": _one("realizedProfitLth", "realized_profit_lth"),
    "stocks": Feed(tuple((s, s) for s in (
        "sp500", "gold", "silver", "strategy", "microsoft", "meta", "google", "apple", "amazon",
        "nvidia",
    ))),
    "terminal_price": _one("terminalPrice", "terminal_price"),
    "active_addresses": _one("activeAddresses", "active_addresses"),
    "mvocdd": _one("mvocdd", "mvocdd"),
    "nrpl_btc": _one("nrplBtc", "nrpl_btc"),
    "miner_balances": _one("minerBalances", "miner_balance"),
}
# Exchanges of the open-interest feed.
EXCHANGES = {
    "binance": "binance", "bybit": "bybit", "okx": "okx", "bitget": "bitget", "deribit": "deribit",
    "bitmex": "bitmex", "huobi": "huobi", "bitfinex": "bitfinex", "gateIo": "gate_io",
    "kucoin": "kucoin", "kraken": "kraken", "cryptoCom": "crypto_com", "dydx": "dydx",
    "deltaExchange": "delta_exchange",
}


def feed(name: str) -> Feed:
    if name not in FEEDS:
        raise ValueError(f"unknown metric {name!r}")
    return FEEDS[name]


def read_json_feed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per object of array-of-objects files, however large: see :mod:`tidegauge.sources.objects`."""
    return read_objects(spark, path, schema)


#: Dates of a wide row are those of these feeds; its time is that of the first of STAMPS that has the date.
SPINE = ("market_price", "mvrv", "nupl", "asol", "etf_flow_btc", "bitcoin_dominance", "nvts", "hashrate", "investor_price", "stocks")
STAMPS = ("market_price", "delta_price_pct", "mvrv")


def registry_schema() -> T.StructType:
    """Fields of all feeds, and the feed's name from its folder."""
    dates = sorted({f.date_field for f in FEEDS.values()})
    values = dict.fromkeys(field for f in FEEDS.values() for field, _ in f.columns)
    return T.StructType([T.StructField("feed", T.StringType()), *[T.StructField(d, T.StringType()) for d in dates], T.StructField("unixTs", T.LongType()),
                         *[T.StructField(v, T.DoubleType()) for v in values]])


def read_registry(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Landed files of any feeds below ``path``/feed=NAME as (feed, column, date, unix_ts, value), in one scan.

    A record gives one row per column of its feed, with a NULL value where the field is
    missing.  Records without a date and files of unknown feeds give none.
    """
    rows = read_objects(spark, path, registry_schema(), range_bytes)
    columns = F.lit(None)
    for name, spec in FEEDS.items():
        cells = F.array(*(F.struct(F.lit(column).alias("column"), F.col(field).alias("value")) for field, column in spec.columns))
        columns = F.when(F.col("feed") == name, cells).otherwise(columns)
    dates = sorted({f.date_field for f in FEEDS.values()})
    return rows.select(
        "feed", feed_date(F.coalesce(*dates)).alias("date"), F.col("unixTs").alias("unix_ts"), F.explode(columns).alias("c"),
    ).filter(F.col("date").isNotNull()).select("feed", "c.column", "date", "unix_ts", "c.value")


def read_variant_feed(spark: SparkSession, path: str) -> DataFrame:
    """Schema on read: one object per line in column ``v``."""
    return spark.read.text(path).select(F.expr("try_parse_json(value)").alias("v"))


def variant_field(field: str, type_name: str, variant: str = "v") -> Column:
    return F.expr(f"try_variant_get({variant}, '$.{field}', '{type_name}')")


def feed_date(text: Column) -> Column:
    """Leading yyyy-MM-dd of a date string."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def load_feed(rows: DataFrame, spec: Feed, by: list[str] | None = None) -> DataFrame:
    """Typed (date, unix_ts, values...) projection, behind the columns ``by``; rows without a date are dropped."""
    return rows.select(
        *(by or []),
        feed_date(F.col(spec.date_field)).alias("date"),
        F.col("unixTs").cast("long").alias("unix_ts"),
        *(F.col(field).cast("double").alias(column) for field, column in spec.columns),
    ).filter(F.col("date").isNotNull())


def timestamp_text(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with or without a fraction."""
    return F.when(
        text.contains("."), F.to_timestamp(F.substring(text, 1, 19), "yyyy-MM-dd HH:mm:ss")
    ).otherwise(F.to_timestamp(text, "yyyy-MM-dd HH:mm:ss"))


def whole_number(text: Column) -> Column:
    """Floor of a numeric string as a long."""
    return F.when(text.contains("."), F.floor(text.cast("double")).cast("long")).otherwise(
        text.cast("long")
    )


def read_klines(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    """Positional rows, one JSON array per line: open time (ms), o, h, l, c, volume, _, quote volume.
    ``by`` names columns of a partitioned folder to keep."""
    cell = F.from_json("value", "array<string>")
    return kline_columns(spark.read.text(path).select(*(by or []), cell.alias("k")), by)


def kline_columns(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    k = F.col("k")
    seconds = F.expr("cast(k[0] as bigint) div 1000")
    at = F.timestamp_seconds(seconds)
    return rows.select(
        *(by or []), seconds.alias("unix_timestamp"),
        F.to_date(at).alias("date"),
        F.hour(at).alias("hour_of_day"),
        *(
            k.getItem(i).cast("double").alias(name)
            for i, name in ((1, "open"), (2, "high"), (4, "close"), (3, "low"),
                            (5, "volume_btc"), (7, "volume_usd"))
        ),
    )


def read_price_csv(spark: SparkSession, path: str, by: list[str] | None = None, order: str | None = None) -> DataFrame:
    """(date, close) from a CSV with a Date/Close header; bad or short rows are skipped.
    ``by`` names columns of a partitioned folder to keep, ``order`` a column for a row's place
    in the files (by name, then by line)."""
    rows = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    names = {name.strip().lower(): name for name in rows.columns}
    if not {"date", "close"} <= set(names) or rows.isEmpty():
        raise ValueError("CSV history needs a Date/Close header and at least one row")
    # ids grow within the part of a file that one task reads
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    return rows.select(
        *(by or []), *([place.alias(order)] if order else []), F.try_to_date(F.trim(F.col(names["date"])), "yyyy-MM-dd").alias("date"),
        F.expr(f"try_cast(trim(`{names['close']}`) as double)").alias("close"),
    ).filter(F.col("date").isNotNull() & F.col("close").isNotNull())


def latest_price(history: DataFrame, by: list[str] | None = None) -> DataFrame:
    return history.groupBy(*(by or [])).agg(
        F.max("date").alias("date"), F.max_by("close", "date").alias("close")
    )


def read_ohlcv_csv(spark: SparkSession, path: str, by: list[str] | None = None) -> DataFrame:
    rows = spark.read.option("header", True).csv(path)
    rows = rows.toDF(*(name.lower() for name in rows.columns))
    stamp = F.col("unix_timestamp").cast("long")
    at = F.timestamp_seconds(stamp)
    if "datetime" in rows.columns:
        at = F.coalesce(F.try_to_timestamp("datetime"), at)
    return rows.select(
        stamp.alias("unix_timestamp"), at.alias("datetime"),
        *(F.col(x).cast("double").alias(x) for x in ("open", "high", "close", "low", "volume")), *(by or []),
    )


def read_sitemap(spark: SparkSession, path: str, service: str, kind: str | None = None) -> DataFrame:
    """Page addresses of a stored sitemap; malformed files yield no rows."""
    schema = T.StructType([T.StructField("loc", T.StringType())])
    rows = (
        spark.read.format("xml").option("rowTag", "url").option("mode", "DROPMALFORMED")
        .schema(schema).load(path)
    )
    return rows.select(
        clean_url(F.col("loc")).alias("url"), F.lit(service).alias("service"),
        F.lit(kind).cast("string").alias("type"),
    ).filter(F.col("url") != "")


def clean_url(loc: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(loc, r"^\s+|\s+$", ""), "\n", "")


def with_seeds(scanned: DataFrame, seeds: DataFrame) -> DataFrame:
    """Seed addresses of every service whose scan returned nothing."""
    answered = scanned.select("service").distinct()
    return scanned.unionByName(seeds.join(answered, "service", "left_anti"))


def inline_values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def stored_table(spark: SparkSession, name: str, casts: dict[str, str], key: str | None = None) -> DataFrame:
    """SELECT with casts, ordered by key when one is given."""
    df = spark.table(name).select(*(F.col(c).cast(t).alias(c) for c, t in casts.items()))
    return df.orderBy(key) if key else df


def list_tables(spark: SparkSession, databases: list[str] | None = None) -> list[tuple[str, str]]:
    """(database, table) of stored tables; views and the system schema are left out."""
    names = databases or [d.name for d in spark.catalog.listDatabases()]
    return [
        (database, entry.name)
        for database in names if database.lower() != "information_schema"
        for entry in spark.catalog.listTables(database)
        if entry.tableType in ("MANAGED", "EXTERNAL")
    ]
