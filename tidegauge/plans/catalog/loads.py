"""Loads from file to merged table, over files that Spark lands from the events and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.prices import page_prices, realized_price
from tidegauge.plans.catalog import fixed, fixed_sql, iso, query, rounded
from tidegauge.plans.catalog.sources import land_json
from tidegauge.plans.strategy import chain_ratios
from tidegauge.session import scratch_path, spread, table
from tidegauge.sources import loads
from tidegauge.sources.feeds import EXCHANGES

VENUES = list(EXCHANGES.values())
THEN, NOW = "2024-01-01 00:00:00", "2024-06-01 00:00:00"


def at(text: str):
    return F.to_timestamp(F.lit(text))


def audit_texts(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", iso("created_at")).withColumn("updated_at", iso("updated_at"))


def daily_sql(n: int) -> str:
    """Daily mean of the events of each of n columns."""
    return f"""daily AS (SELECT event_id % {n} AS k, CAST(date_trunc('day', ts) AS DATE) AS day,
  CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS unix_ts, avg(value) AS v FROM events GROUP BY 1, 2, 3),
days AS (SELECT DISTINCT day FROM daily)"""


def daily(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return rows.groupBy((F.col("event_id") % n).alias("k"), F.to_date(F.col("ts").cast("timestamp")).alias("date")).agg(
        F.avg("value").alias("value"))


def stored_dates(spark: SparkSession, sf_dir: str, every: int) -> DataFrame:
    dates = table(spark, sf_dir, "events").select(F.to_date(F.col("ts").cast("timestamp")).alias("date")).distinct()
    return dates.filter(F.dayofmonth("date") % every == 0)


# every ninth day is in the table only, every second one in the table already; on every fifth day
# the first exchange has an explicit null, the second its number as text and the time a fraction
@query("K02_open_interest_load", f"""WITH {daily_sql(len(VENUES))},
fed AS (SELECT day, max(unix_ts) AS unix_ts, {', '.join(
    f"max(v) FILTER (k = {i}{' AND day(day) % 5 <> 0' if i == 0 else ''}) AS {c}" for i, c in enumerate(VENUES))}
  FROM daily WHERE day(day) % 9 <> 0 GROUP BY 1)
SELECT strftime(day, '%Y-%m-%d') AS date, unix_ts, {', '.join(f'{fixed_sql(c)} AS {c}' for c in VENUES)},
  {fixed_sql(' + '.join(f'coalesce({c}, 0)' for c in VENUES))} AS total_open_interest,
  CASE WHEN day(day) % 2 = 0 THEN '{THEN}' ELSE '{NOW}' END AS created_at, '{NOW}' AS updated_at FROM fed
UNION ALL SELECT strftime(day, '%Y-%m-%d'), 0, {', '.join('-1.0::DOUBLE' for _ in VENUES)}, -14.0::DOUBLE, '{THEN}', '{THEN}'
FROM days WHERE day(day) % 18 = 0""")
def _open_interest(spark, sf_dir):
    """Files with 14 exchanges a record to the merged table with its total."""
    path, k, fifth = scratch_path(spark, "interest"), F.col("k"), F.dayofmonth("date") % 5 == 0
    cells = [F.max(F.when(k == i, F.col("value"))).alias(field) for i, field in enumerate(EXCHANGES)]
    wide = daily(spark, sf_dir, len(VENUES)).filter(F.dayofmonth("date") % 9 != 0).groupBy("date").agg(*cells)
    first, second, *others = EXCHANGES
    seconds = F.unix_timestamp(F.col("date").cast("timestamp"))
    record = F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("d"),
        F.when(fifth, F.concat(seconds, F.lit(".75"))).otherwise(seconds.cast("string")).alias("unixTs"),
        F.when(~fifth, F.col(first)).alias(first), F.col(second).cast("string").alias(second), *others,
    )
    land_json(wide, record, path, [])
    stored = loads.open_interest_table(spark, scratch_path(spark, "interest-table"))
    old = stored_dates(spark, sf_dir, 2).select(
        "date", F.lit(0).cast("long").alias("unix_ts"), *(F.lit(-1.0).alias(c) for c in VENUES), F.lit(-14.0).alias("total_open_interest"))
    stored.create(loads.audited(old, at(THEN)))
    out = stored.read(loads.load_open_interest(stored, path, at(NOW)))
    return rounded(audit_texts(out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))))


HOURS_SQL = """hours AS (SELECT epoch_us(ts) // 3600000000 AS h, avg(value) AS v FROM events GROUP BY 1)"""


# every seventh hour has no rate, every eleventh no time; every second one is in the table already
@query("K02_funding_rate_load", f"""WITH {HOURS_SQL},
fed AS (SELECT * FROM hours WHERE h % 7 <> 0 AND h % 11 <> 0)
SELECT strftime(to_timestamp(h * 3600), '%Y-%m-%d %H:%M:%S') AS datetime, CAST(h * 3600 AS BIGINT) AS unix_ts, {fixed_sql('v')} AS funding_rate,
  CASE WHEN h % 2 = 0 THEN '{THEN}' ELSE '{NOW}' END AS created_at, '{NOW}' AS updated_at FROM fed
UNION ALL SELECT strftime(to_timestamp(h * 3600), '%Y-%m-%d %H:%M:%S'), 0, -1.0::DOUBLE, '{THEN}', '{THEN}'
FROM hours WHERE h % 2 = 0 AND (h % 7 = 0 OR h % 11 = 0)""")
def _funding(spark, sf_dir):
    """Files whose times and seconds have fractions in part to the merged table."""
    path, h = scratch_path(spark, "funding"), F.col("h")
    hour = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000)
    hours = table(spark, sf_dir, "events").groupBy(hour.alias("h")).agg(F.avg("value").alias("value")).withColumn("at", F.timestamp_seconds(h * 3600))
    text, seconds = iso("at"), (h * 3600).cast("string")
    record = F.struct(
        F.when(h % 11 != 0, F.when(h % 3 == 0, F.concat(text, F.lit(".001"))).otherwise(text)).alias("d"),
        F.when(h % 5 == 0, F.concat(seconds, F.lit(".9"))).otherwise(seconds).alias("unixTs"), F.when(h % 7 != 0, F.col("value")).alias("fundingRate"))
    land_json(hours.withColumn("date", F.to_date("at")), record, path, [])
    stored = loads.funding_table(spark, scratch_path(spark, "funding-table"))
    old = hours.filter(h % 2 == 0).select(F.col("at").alias("datetime"), F.lit(0).cast("long").alias("unix_ts"), F.lit(-1.0).alias("funding_rate"))
    stored.create(loads.audited(old, at(THEN)))
    out = stored.read(loads.load_funding(stored, path, at(NOW)))
    return rounded(audit_texts(out.withColumn("datetime", iso("datetime"))))


def land_markets(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """A CSV folder per market, with two headers; every seventh day has no readable close, every fifth day an older line before its own."""
    paths, rows = {}, daily(spark, sf_dir, len(loads.MARKETS))
    for i, name in enumerate(loads.MARKETS):
        paths[name] = scratch_path(spark, f"market-{name}")
        own = rows.filter(F.col("k") == i).select("date", "value", F.lit(1).alias("seq"))
        lines = own.unionByName(own.filter(F.dayofmonth("date") % 5 == 0).withColumn("value", F.lit(-5.0)).withColumn("seq", F.lit(0)))
        close = F.when(F.dayofmonth("date") % 7 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("Close")
        day = F.date_format("date", "yyyy-MM-dd").alias("Date")
        cells = [day, close] if name == "vix" else [day, F.lit("1").alias("Open"), F.lit("2").alias("High"), F.lit("x").alias("Low"), close, F.lit("").alias("Volume")]
        month = F.date_format("date", "yyyy-MM")
        lines.repartition(month).sortWithinPartitions("date", "seq").select(*cells).write.option("header", True).csv(paths[name])
    return paths


MARKET_SQL = f"""{daily_sql(len(loads.MARKETS))},
fed AS (SELECT day, {', '.join(f'max(v) FILTER (k = {i}) AS {m}' for i, m in enumerate(loads.MARKETS))} FROM daily WHERE day(day) % 7 <> 0 GROUP BY 1)"""
CLOSES_SQL = ", ".join(f"{fixed_sql(m)} AS {m}" for m in loads.MARKETS)


def market_store(spark: SparkSession, sf_dir: str, every: int):
    stored = loads.market_table(spark, scratch_path(spark, "market-table"))
    old = stored_dates(spark, sf_dir, every).select("date", *(F.lit(-1.0).alias(m) for m in loads.MARKETS))
    stored.create(loads.audited(old, at(THEN)))
    return stored


@query("K02_market_history_load", f"""WITH {MARKET_SQL}
SELECT strftime(day, '%Y-%m-%d') AS date, {CLOSES_SQL}, CASE WHEN day(day) % 2 = 0 THEN '{THEN}' ELSE '{NOW}' END AS created_at, '{NOW}' AS updated_at FROM fed
UNION ALL SELECT strftime(day, '%Y-%m-%d'), {', '.join('-1.0::DOUBLE' for _ in loads.MARKETS)}, '{THEN}', '{THEN}' FROM days WHERE day(day) % 14 = 0""")
def _market_history(spark, sf_dir):
    """Four CSV histories, side by side by date, into a table that is still short."""
    stored, paths = market_store(spark, sf_dir, 2), land_markets(spark, sf_dir)
    out = stored.read(loads.load_market(stored, paths, at(NOW), fewest=1_000_000))
    return rounded(audit_texts(out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))))


@query("K02_market_daily_load", f"""WITH {MARKET_SQL},
newest AS (SELECT k, max(day) AS day, arg_max(v, day) AS v FROM daily WHERE day(day) % 7 <> 0 GROUP BY 1),
one AS (SELECT coalesce({', '.join(f'max(day) FILTER (k = {i})' for i in range(len(loads.MARKETS)))}) AS day,
  {', '.join(f'max(v) FILTER (k = {i}) AS {m}' for i, m in enumerate(loads.MARKETS))} FROM newest)
SELECT strftime(day, '%Y-%m-%d') AS date, {CLOSES_SQL}, CASE WHEN day IN (SELECT day FROM days) THEN '{THEN}' ELSE '{NOW}' END AS created_at, '{NOW}' AS updated_at FROM one
UNION ALL SELECT strftime(day, '%Y-%m-%d'), {', '.join('-1.0::DOUBLE' for _ in loads.MARKETS)}, '{THEN}', '{THEN}' FROM days WHERE day <> (SELECT day FROM one)""")
def _market_daily(spark, sf_dir):
    """The newest closes into a table that is long enough."""
    stored, paths = market_store(spark, sf_dir, 1), land_markets(spark, sf_dir)
    out = stored.read(loads.load_market(stored, paths, at(NOW), fewest=1))
    return rounded(audit_texts(out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))))


_PRICE = "o_totalprice::DOUBLE"
_CENTS = f"(CAST(round({_PRICE} * 100) AS BIGINT) / 100.0)"


# pages of six kinds: the named element; an element without a number before one of class price; a labelled number in
# the text; a number beside it; numbers out of range; nothing at all
@query("P13_price_from_stored_html", f"""
WITH p AS (SELECT o_orderkey, o_orderkey % 6 AS kind, {_PRICE} AS close, {_CENTS} AS x FROM orders),
r AS (SELECT *, CASE WHEN kind IN (0, 1) THEN x WHEN kind IN (2, 3) AND x BETWEEN 5000 AND 100000 THEN x ELSE close * 0.6 END AS realized FROM p)
SELECT o_orderkey, CASE WHEN kind IN (0, 1) THEN 'element' WHEN kind IN (2, 3) AND x BETWEEN 5000 AND 100000 THEN 'text' ELSE 'estimate' END AS found,
  {fixed_sql('realized', 3)} AS realized_price, {fixed_sql('close / realized')} AS mvrv, {fixed_sql('(close - realized) / close')} AS nupl FROM r""")
def _price_pages(spark, sf_dir):
    """A stored page per order: price, where it was found, and the ratios it gives."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("close"))
    shown = F.format_number(F.col("close"), 2)
    kind = F.col("o_orderkey") % 6
    html = (
        F.when(kind == 0, F.concat(F.lit('<div class="x-price">7</div><p>9</p><b class="a realized-price-selector"> $'), shown, F.lit("</b>")))
        .when(kind == 1, F.concat(F.lit('<h1 class="Realized">8</h1><i class="is-realized">soon</i><span class="unit-price">USD <b>$'), shown, F.lit("</b></span>")))
        .when(kind < 5, F.lit("<p>no price 12</p>")).when(kind == 5, F.lit(None).cast("string"))
    )
    text = (
        F.when(kind == 2, F.concat(F.lit("since 2009\nRealized Price: $"), shown)).when(kind == 3, F.concat(F.lit("now $"), shown, F.lit(" or 20,000")))
        .when(kind == 4, F.lit("Realized Price: 12 of 200,000"))
    )
    pages = spread(orders.select("o_orderkey", "close", html.alias("html"), text.alias("markdown")))
    priced = realized_price(page_prices(pages), market="close")
    out = chain_ratios(priced)
    return out.select("o_orderkey", "found", fixed(F.col("realized_price"), 3).alias("realized_price"), fixed(F.col("mvrv")).alias("mvrv"), fixed(F.col("nupl")).alias("nupl"))
