"""Streaming queries: files dropped in two batches, drained to the end."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge.plans import fixtures
from tidegauge.plans.catalog import fixed, fixed_sql, iso, query, rounded
from tidegauge.plans.catalog.news import SCORED_SQL, articles
from tidegauge.plans.catalog.series import (
    _ADX, RSI, bars_sql, chained, ema, full, listed, over, padded, pairwise, tema_list, wilder,
)
from tidegauge.plans.fear_greed import score_news
from tidegauge.plans.indicators import indicators
from tidegauge.plans.strategy import Settings, moving_average
from tidegauge.session import scratch_path
from tidegauge.streaming import incremental as inc, stateful


def drop(rows, path: str, part: int) -> None:
    """Append the articles of one drop to the landing folder."""
    rows.filter(F.col("id") % 2 == part).write.mode("append").parquet(path)


@query("R01_append_only_stream", f"{SCORED_SQL} SELECT id, {fixed_sql('score')} AS sentiment_score, label AS sentiment_label FROM s")
def _stream(spark, sf_dir):
    landed, out, state = (scratch_path(spark, n) for n in ("landed", "scored", "state"))
    for part in (0, 1):
        drop(articles(spark, sf_dir), landed, part)
        inc.append_scores(inc.news_stream(spark, landed), out, state).awaitTermination()
    return rounded(spark.read.parquet(out).select("id", "sentiment_score", "sentiment_label"))


@query("R01_analysis_time", f"{SCORED_SQL} SELECT id, {fixed_sql('score')} AS sentiment_score, id % 2 + 1 AS batch, true AS after_publication FROM s")
def _analysis_time(spark, sf_dir):
    """Articles of one batch share the time of their analysis; the second batch has a later one."""
    landed, out, state = (scratch_path(spark, n) for n in ("landed", "scored", "state"))
    for part in (0, 1):
        drop(articles(spark, sf_dir), landed, part)
        inc.append_scores(inc.news_stream(spark, landed), out, state).awaitTermination()
    rows = spark.read.parquet(out)
    times = rows.select("analyzed_at").distinct()  # one per batch
    numbered = times.withColumn("batch", F.row_number().over(Window.orderBy("analyzed_at")).cast("long"))
    return rounded(rows.join(F.broadcast(numbered), "analyzed_at").select("id", "sentiment_score", "batch", (F.col("analyzed_at") > F.col("published_datetime")).alias("after_publication")))


def streamed_index(spark, sf_dir, unit: str):
    landed, out, state = (scratch_path(spark, n) for n in ("landed", "index", "state"))
    for part in (0, 1):
        drop(articles(spark, sf_dir), landed, part)
        scored = score_news(inc.news_stream(spark, landed))
        inc.maintain_index(scored, unit, out, state).awaitTermination()
    return inc.current_buckets(spark, out)


def index_sql(unit: str) -> str:
    return (f"{SCORED_SQL}, d AS (SELECT date_trunc('{unit}', pub) AS b, count(*) AS n, "
            f"{fixed_sql('(avg(score) + 1) / 2 * 100')} AS v FROM s GROUP BY 1) "
            "SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS bucket_start, n AS total_articles, v AS fng_index_value FROM d")


@query("R02_triggered_micro_batch", index_sql("day"))
def _daily_stream(spark, sf_dir):
    out = streamed_index(spark, sf_dir, "day")
    return rounded(out.select(iso("bucket_start").alias("bucket_start"), "total_articles", "fng_index_value"))


@query("R04_late_data", index_sql("hour"))
def _hourly_stream(spark, sf_dir):
    """The second drop is late by up to the whole range; every article counts all the same."""
    out = streamed_index(spark, sf_dir, "hour")
    return rounded(out.select(iso("bucket_start").alias("bucket_start"), "total_articles", "fng_index_value"))


@query("R03_merged_daily_statistics", f"""{SCORED_SQL}
SELECT strftime(date_trunc('day', pub), '%Y-%m-%d %H:%M:%S') AS bucket_start, count(*) AS total_articles,
  count(*) FILTER (label IN ('GREED', 'EXTREMELY GREED')) AS positive_articles, count(*) FILTER (label = 'NEUTRAL') AS neutral_articles,
  count(*) FILTER (label IN ('FEAR', 'EXTREMELY FEAR')) AS negative_articles, {fixed_sql('min(score)')} AS min_sentiment_score,
  {fixed_sql('max(score)')} AS max_sentiment_score, {fixed_sql('stddev_samp(score)')} AS stddev_sentiment_score FROM s GROUP BY 1""")
def _merged_statistics(spark, sf_dir):
    """Five drops in three folders: the day rows come from merged counts, sums and extremes only."""
    landed, out, state = (scratch_path(spark, n) for n in ("landed", "index", "state"))
    for part in range(5):
        articles(spark, sf_dir).filter(F.col("id") % 5 == part).write.mode("append").parquet(landed)
        inc.maintain_index(score_news(inc.news_stream(spark, landed)), "day", out, state, slots=3).awaitTermination()
    rows = inc.current_buckets(spark, out).withColumn("bucket_start", iso("bucket_start"))
    return rounded(rows.drop("avg_sentiment_score", "fng_index_value", "fng_index_label"))


@query("R05_streamed_indicators", f"""{bars_sql(30)}{listed(
    [("g", wilder("gain", 14)), ("l0", wilder("loss", 14)), *_ADX],
    {"ema_50": padded(ema("c", 50), 49), "adx_14": padded("adx", 27), "rsi_14": padded(pairwise("g", "l0", RSI), 14)})}
SELECT symbol, CAST(r.t AS BIGINT) AS t, {fixed_sql("u.ema_50")} AS ema_50, {fixed_sql("u.adx_14")} AS adx_14,
  {fixed_sql("u.rsi_14")} AS rsi_14, {fixed_sql("sum(CASE WHEN c1 IS NULL OR close > c1 THEN v WHEN close < c1 THEN -v ELSE 0 END) OVER (PARTITION BY symbol ORDER BY t)")} AS obv
FROM r JOIN u USING (symbol, t)""")
def _streamed_indicators(spark, sf_dir):
    """Bars dropped in two parts; the query ends between them and goes on from Spark's state."""
    columns = ["ema_50", "adx_14", "rsi_14", "obv"]
    landed, out, state = (scratch_path(spark, n) for n in ("bars", "indicators", "state"))
    bars = fixtures.event_bars(spark, sf_dir, 30).select(*stateful.BARS_SCHEMA.names)
    for part in (F.col("unix_timestamp") < _CUT, F.col("unix_timestamp") >= _CUT):
        bars.filter(part).write.mode("append").parquet(landed)
        stateful.keep_indicators(stateful.bar_stream(spark, landed), columns, out, state).awaitTermination()
    rows = spark.read.parquet(out)
    return rows.select("symbol", F.col("unix_timestamp").alias("t"), *(fixed(F.col(c)).alias(c) for c in columns))


_CUT = 1_704_067_200 + 26 * 86_400
_DELTA = ["sma_20", "ema_50", "tema_20", "rsi_14", "obv", "price_volatility_30d"]


_DELTA_SQL = f"""{bars_sql(30)}{listed(
    [("g", wilder("gain", 14)), ("l0", wilder("loss", 14)), *chained(20, 3)],
    {"ema_50": padded(ema("c", 50), 49), "tema_20": tema_list(20), "rsi_14": padded(pairwise("g", "l0", RSI), 14)})}
SELECT symbol, CAST(r.t AS BIGINT) AS t, {fixed_sql(full(19, f'avg(close) {over(20)}'))} AS sma_20,
  {fixed_sql("u.ema_50")} AS ema_50, {fixed_sql("u.tema_20")} AS tema_20, {fixed_sql("u.rsi_14")} AS rsi_14,
  {fixed_sql("sum(CASE WHEN c1 IS NULL OR close > c1 THEN v WHEN close < c1 THEN -v ELSE 0 END) OVER (PARTITION BY symbol ORDER BY t)")} AS obv,
  {fixed_sql(full(719, f"stddev_samp(close) {over(720)}"))} AS price_volatility_30d
FROM r JOIN u USING (symbol, t)"""


@query("R05_incremental_indicators", _DELTA_SQL)
def _incremental(spark, sf_dir):
    """Two runs, the second on the newest bars and the kept progress only."""
    bars = fixtures.event_bars(spark, sf_dir, 30)
    stored, progress = inc.first_run(bars.filter(F.col("unix_timestamp") < _CUT), _DELTA)
    table, _ = inc.delta_indicators(stored, progress, bars.filter(F.col("unix_timestamp") >= _CUT), _DELTA)
    return table.select(
        "symbol", F.col("unix_timestamp").alias("t"), *(fixed(F.col(c)).alias(c) for c in _DELTA)
    )


@query("R05_overlapping_delta", _DELTA_SQL)
def _overlapping(spark, sf_dir):
    """The first run saw other closes in its last 100 half hours and missed one bar; the second run delivers
    these bars again, corrected, with the new ones."""
    bars = fixtures.event_bars(spark, sf_dir, 30)
    again = _CUT - 100 * 1800
    seen = bars.filter(F.col("unix_timestamp") < _CUT).withColumn(
        "close", F.when(F.col("unix_timestamp") >= again, F.col("close") * 1.01).otherwise(F.col("close"))
    ).filter(F.col("unix_timestamp") != again + 50 * 1800)
    stored, progress = inc.first_run(seen, _DELTA)
    table, _ = inc.delta_indicators(stored, progress, bars.filter(F.col("unix_timestamp") >= again), _DELTA)
    return table.select(
        "symbol", F.col("unix_timestamp").alias("t"), *(fixed(F.col(c)).alias(c) for c in _DELTA)
    )


@query("R05_late_delivery", _DELTA_SQL)
def _late(spark, sf_dir):
    """Stored are the bars before the cut but for two days at the beginning; the delivery brings these, corrected
    closes half-way and the bars after the cut.  Each symbol restarts behind the last completed segment before."""
    bars = fixtures.event_bars(spark, sf_dir, 30)
    t = F.col("unix_timestamp")
    start = _CUT - 26 * 86_400
    missing = (t >= start + 20 * 86_400) & (t < start + 22 * 86_400)
    wrong = (t >= start + 23 * 86_400) & (t < start + 24 * 86_400)
    store = inc.IndicatorStore(spark, scratch_path(spark, "indicators"), tuple(_DELTA), 900)
    store.create(bars.filter((t < _CUT) & ~missing).withColumn("close", F.when(wrong, F.col("close") * 1.01).otherwise(F.col("close"))))
    table = store.deliver(bars.filter((t >= _CUT) | missing | wrong))
    return table.select("symbol", t.alias("t"), *(fixed(F.col(c)).alias(c) for c in _DELTA))


@query("R05_segmented_series", f"""{bars_sql(30)}{listed(
    [("g", wilder("gain", 14)), ("l0", wilder("loss", 14)), *_ADX],
    {"ema_50": padded(ema("c", 50), 49), "adx_14": padded("adx", 27), "rsi_14": padded(pairwise("g", "l0", RSI), 14)})}
SELECT symbol, CAST(r.t AS BIGINT) AS t, {fixed_sql(full(199, f'avg(close) {over(200)}'))} AS sma_200,
  {fixed_sql("u.ema_50")} AS ema_50, {fixed_sql("u.adx_14")} AS adx_14, {fixed_sql("u.rsi_14")} AS rsi_14
FROM r JOIN u USING (symbol, t)""")
def _segmented(spark, sf_dir):
    """Every symbol cut into several segments; the results do not depend on it."""
    columns = ["sma_200", "ema_50", "adx_14", "rsi_14"]
    table = indicators(fixtures.event_bars(spark, sf_dir, 30), columns, rows_per_segment=800)
    return table.select(
        "symbol", F.col("unix_timestamp").alias("t"), *(fixed(F.col(c)).alias(c) for c in columns)
    )


@query("F03_rolling_weighted_lambda", f"""{bars_sql()}, w AS (SELECT *, list(close) {over(50)} AS closes FROM r)
SELECT symbol, CAST(t AS BIGINT) AS t, {fixed_sql("CASE WHEN i >= 49 THEN list_sum(list_transform(closes, lambda x, j: x * j)) / 1275 END")} AS ma FROM w""")
def _rolling_lambda(spark, sf_dir):
    """The per-window lambda as totals of short frames, one series per symbol."""
    bars = fixtures.event_bars(spark, sf_dir).withColumn("date", F.col("unix_timestamp"))
    out = moving_average(bars, "close", "ma", "WMA", 50, Settings(by=["symbol"]))
    return out.select("symbol", F.col("unix_timestamp").alias("t"), fixed(F.col("ma")).alias("ma"))


@query("F04_indicator_table")
def _all_columns(spark, sf_dir):
    """All 110 columns over hourly bars."""
    return rounded(indicators(fixtures.event_bars(spark, sf_dir)))
