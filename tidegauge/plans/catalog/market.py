"""Projections over feed records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.operators import frames, news
from tidegauge.plans.catalog import fixed, fixed_sql, iso, query, rounded
from tidegauge.plans.catalog.series import bars_sql
from tidegauge.plans.fixtures import event_bars
from tidegauge.plans.strategy import chain_ratios
from tidegauge.session import table
from tidegauge.sources import feeds

K = "CAST(props ->> '$.k' AS DOUBLE)"


def k_value():
    return F.get_json_object("props", "$.k").cast("double")


@query("P01_typed_json_projection", f"""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS unix_ts, {K} AS market_price
FROM events""")
def _typed(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    spec = feeds.feed("market_price")
    text = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd").alias("d"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("unixTs"), k_value().alias("btcPrice"),
    ))
    parsed = events.select("event_id", F.from_json(text, spec.schema).alias("r"))
    return parsed.select(
        "event_id", F.date_format(feeds.feed_date(F.col("r.d")), "yyyy-MM-dd").alias("date"),
        F.col("r.unixTs").alias("unix_ts"), F.col("r.btcPrice").alias("market_price"),
    )


@query("P02_date_string_parse", """
SELECT event_id, strftime(CAST(substr(CAST(ts AS VARCHAR), 1, 10) AS DATE), '%Y-%m-%d') AS date FROM events""")
def _date(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_format(feeds.feed_date(text), "yyyy-MM-dd").alias("date")
    )


_STAMP = "CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '.001' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END"


@query("P03_fractional_timestamp", f"""
SELECT event_id, strftime(CAST(substr({_STAMP}, 1, 19) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS datetime FROM events""")
def _stamp(spark, sf_dir):
    whole = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("event_id") % 2 == 0, F.concat(whole, F.lit(".001"))).otherwise(whole)
    return table(spark, sf_dir, "events").select("event_id", iso(feeds.timestamp_text(text)).alias("datetime"))


@query("P04_numeric_string_floor", """
SELECT event_id, CAST(floor(value) AS BIGINT) AS from_fraction, event_id AS from_whole FROM events""")
def _floor(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", feeds.whole_number(F.col("value").cast("string")).alias("from_fraction"),
        feeds.whole_number(F.col("event_id").cast("string")).alias("from_whole"),
    )


@query("P05_epoch_conversion", """
SELECT event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS unix_timestamp, strftime(ts, '%Y-%m-%d') AS date,
  CAST(hour(ts) AS BIGINT) AS hour_of_day FROM events""")
def _epoch(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    rows = table(spark, sf_dir, "events").select("event_id", F.array(
        ms, *(F.lit("1") for _ in range(7))
    ).alias("k"))
    seconds = F.expr("cast(k[0] as bigint) div 1000")
    at = F.timestamp_seconds(seconds)
    return rows.select(
        "event_id", seconds.alias("unix_timestamp"), F.date_format(at, "yyyy-MM-dd").alias("date"),
        F.hour(at).cast("long").alias("hour_of_day"),
    )


_VENUES = list(feeds.EXCHANGES.values())


def _venue(i: int) -> str:
    return f"CASE WHEN event_id % {i + 2} <> 0 THEN value + {i} END"


@query("P06_null_safe_row_sum", f"""
SELECT event_id, {fixed_sql(' + '.join(f'coalesce({_venue(i)}, 0)' for i in range(len(_VENUES))))} AS total_open_interest
FROM events""")
def _row_sum(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", *(F.expr(_venue(i)).alias(v) for i, v in enumerate(_VENUES))
    )
    return rows.select("event_id", fixed(frames.row_sum(_VENUES)).alias("total_open_interest"))


@query("P07_required_fields", """
SELECT event_id, value FROM events WHERE event_id % 7 <> 0 AND value >= 1""")
def _required(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 7 != 0, F.col("event_id")).alias("event_id"),
        F.when(F.col("value") >= 1, F.col("value")).alias("value"),
    )
    return rows.dropna(subset=["event_id", "value"])


@query("P08_first_non_null_key", """
SELECT event_id, coalesce(CASE WHEN event_id % 2 = 0 THEN user_id END, CASE WHEN event_id % 3 = 0 THEN event_id END, -1) AS key
FROM events""")
def _first(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(
        F.when(F.col("event_id") % 2 == 0, F.col("user_id")),
        F.when(F.col("event_id") % 3 == 0, F.col("event_id")), F.lit(-1),
    ).alias("key"))


@query("P12_chain_ratios", f"""
SELECT o_orderkey, {fixed_sql('o_totalprice / (o_totalprice * 0.6 + o_orderkey)')} AS mvrv,
  {fixed_sql('(o_totalprice - (o_totalprice * 0.6 + o_orderkey)) / o_totalprice')} AS nupl FROM orders WHERE o_totalprice <> 0""")
def _ratios(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").filter("o_totalprice <> 0").select(
        "o_orderkey", F.col("o_totalprice").alias("close"),
        (F.col("o_totalprice") * 0.6 + F.col("o_orderkey")).alias("realized_price"),
    )
    return rounded(chain_ratios(rows).select("o_orderkey", "mvrv", "nupl"))


@query("P13_price_extraction", f"""
WITH t AS (SELECT o_orderkey, o_totalprice AS m, CASE o_orderkey % 4
  WHEN 0 THEN 'Realized Price: $' || CAST(floor(o_totalprice / 10) AS BIGINT) || '.5 today'
  WHEN 1 THEN 'now at ' || CAST(floor(o_totalprice) AS BIGINT) || ' dollars'
  WHEN 2 THEN 'Realized Price $25,' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
  ELSE 'no figure' END AS txt FROM orders),
n AS (SELECT *, TRY_CAST(replace(regexp_extract(txt, 'Realized Price:?\\s*\\$?([\\d,]+\\.?\\d*)', 1), ',', '') AS DOUBLE) AS a,
  TRY_CAST(replace(regexp_extract(txt, '\\$?([\\d,]+\\.?\\d*)', 1), ',', '') AS DOUBLE) AS b FROM t)
SELECT o_orderkey, {fixed_sql('''coalesce(CASE WHEN a BETWEEN 5000 AND 100000 THEN a END,
  CASE WHEN b BETWEEN 5000 AND 100000 THEN b END, m * 0.6)''')} AS realized_price FROM n""")
def _price(spark, sf_dir):
    text = F.expr("""CASE o_orderkey % 4
      WHEN 0 THEN concat('Realized Price: $', cast(floor(o_totalprice / 10) as string), '.5 today')
      WHEN 1 THEN concat('now at ', cast(floor(o_totalprice) as string), ' dollars')
      WHEN 2 THEN concat('Realized Price $25,', lpad(cast(o_orderkey % 1000 as string), 3, '0'))
      ELSE 'no figure' END""")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fixed(news.price_in_text(text, F.col("o_totalprice"))).alias("realized_price")
    )


@query("P22_weekend_flag", """
SELECT o_orderkey, isodow(o_orderdate) >= 6 AS weekend FROM orders""")
def _weekend(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.weekday(F.to_date("o_orderdate")) >= 5).alias("weekend")
    )


@query("P23_month_ranges", """
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS first_day,
  strftime(last_day(o_orderdate), '%Y-%m-%d') AS last_day,
  strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y-%m-%d') AS previous_month,
  CAST(date_diff('month', date_trunc('month', o_orderdate), DATE '2030-01-01') AS BIGINT) AS months_left FROM orders""")
def _months(spark, sf_dir):
    day = F.to_date("o_orderdate")
    first, text = F.trunc(day, "month"), lambda c: F.date_format(c, "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text(first).alias("first_day"), text(F.last_day(day)).alias("last_day"),
        text(F.add_months(first, -1)).alias("previous_month"),
        F.months_between(F.lit("2030-01-01").cast("date"), first).cast("long").alias("months_left"),
    )


@query("W15_circular_lag", f"""{bars_sql()}
SELECT symbol, CAST(t AS BIGINT) AS unix_timestamp, coalesce(c1, last_value(close) OVER (PARTITION BY symbol ORDER BY t
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS previous FROM r""")
def _circular(spark, sf_dir):
    from tidegauge.operators.segments import drop_halo, segment

    bars = event_bars(spark, sf_dir)
    last = bars.groupBy("symbol").agg(F.max_by("close", "unix_timestamp").alias("_last"))
    rows = segment(bars).df.withColumn("previous", frames.Frames().lag("close"))
    first = (F.col("_seg") == 0) & (F.col("_li") == 0)
    rows = rows.join(last, "symbol").withColumn(
        "previous", F.when(first, F.col("_last")).otherwise(F.col("previous"))
    )
    return drop_halo(rows).select("symbol", "unix_timestamp", "previous")
