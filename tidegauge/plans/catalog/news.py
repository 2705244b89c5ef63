"""Sentiment, Fear & Greed and article-feed queries; documents stand in for news."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions import labels
from tidegauge.operators import keyed, news
from tidegauge.plans import fear_greed as fg
from tidegauge.plans.catalog import fixed, fixed_sql, iso, query, rounded
from tidegauge.session import spread, table

EPOCH, STEP = 1_704_067_200, 37 * 60
AS_OF = "2024-01-20 12:30:00"

_POS, _NEG = (f"({', '.join(repr(w) for w in words)})" for words in (labels.POSITIVE, labels.NEGATIVE))


def score_sql(text: str) -> str:
    words = f"regexp_split_to_array(lower({text}), '[^a-z]+')"
    pos = f"len(list_filter({words}, lambda w: w IN {_POS}))"
    neg = f"len(list_filter({words}, lambda w: w IN {_NEG}))"
    return f"(({pos} - {neg}) / greatest({pos} + {neg}, 1))"


TITLE_SQL = "array_to_string(string_split(text, ' ')[1:8], ' ')"
SCORED_SQL = f"""
WITH n AS (SELECT doc_id AS id, {EPOCH} + doc_id * {STEP} AS published_on,
  make_timestamp(({EPOCH} + doc_id * {STEP}) * 1000000) AS pub, {TITLE_SQL} AS title, source, text AS body,
  n_chars % 50 AS upvotes, n_chars % 7 AS downvotes, 'u' || doc_id AS url FROM documents),
s0 AS (SELECT *, {score_sql('body')} AS score, {score_sql('title')} AS title_score FROM n),
s AS (SELECT *, CASE WHEN score <= -0.6 THEN 'EXTREMELY FEAR' WHEN score <= -0.1 THEN 'FEAR'
  WHEN score < 0.1 THEN 'NEUTRAL' WHEN score < 0.6 THEN 'GREED' ELSE 'EXTREMELY GREED' END AS label FROM s0)"""
# the three groups of labels that an index row counts
_GROUPS = {"positive": ("GREED", "EXTREMELY GREED"), "neutral": ("NEUTRAL",), "negative": ("FEAR", "EXTREMELY FEAR")}
COUNTS_SQL = ", ".join([
    "count(*) AS total_articles",
    *(f"count(*) FILTER (list_contains({list(names)}, label)) AS {group}_articles" for group, names in _GROUPS.items()),
    "avg(score) AS mean", "(avg(score) + 1) / 2 * 100 AS idx"])


def index_label_sql(x: str) -> str:
    return (f"CASE WHEN {x} <= 24 THEN 'EXTREME FEAR' WHEN {x} <= 44 THEN 'FEAR' WHEN {x} <= 55 THEN 'NEUTRAL' "
            f"WHEN {x} <= 75 THEN 'GREED' ELSE 'EXTREME GREED' END")


SHARED = "total_articles, positive_articles, neutral_articles, negative_articles"


def hours_sql(where: str = "", name: str = "h") -> str:
    return f", {name} AS (SELECT date_trunc('hour', pub) AS b, {COUNTS_SQL} FROM s {where} GROUP BY 1)"


def days_sql(where: str = "", name: str = "d") -> str:
    return (f", {name}0 AS (SELECT date_trunc('day', pub) AS b, {COUNTS_SQL}, min(score) AS lo, max(score) AS hi, "
            f"stddev_samp(score) AS sd FROM s {where} GROUP BY 1), {name} AS (SELECT *, lag(idx) OVER (ORDER BY b) AS prev FROM {name}0)")


def articles(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "n_chars"))
    return docs.select(
        F.col("doc_id").alias("id"), (F.lit(EPOCH) + F.col("doc_id") * STEP).alias("published_on"),
        F.concat_ws(" ", F.slice(F.split("text", " "), 1, 8)).alias("title"), "source",
        F.col("text").alias("body"), (F.col("n_chars") % 50).alias("upvotes"),
        (F.col("n_chars") % 7).alias("downvotes"), F.concat(F.lit("u"), F.col("doc_id")).alias("url"),
    )


def scored(spark, sf_dir):
    return fg.score_news(articles(spark, sf_dir))


@query("F02_sentiment_function", f"{SCORED_SQL} SELECT id, {fixed_sql('score')} AS body_score, {fixed_sql('title_score')} AS title_score FROM s")
def _scores(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "id", fixed(F.col("sentiment_score")).alias("body_score"),
        fixed(F.col("title_sentiment_score")).alias("title_score"),
    )


@query("F01_procedure_score_news", f"""{SCORED_SQL}
SELECT id, published_on, strftime(pub, '%Y-%m-%d %H:%M:%S') AS published_datetime, title, source,
  {fixed_sql('score')} AS sentiment_score, label AS sentiment_label FROM s""")
def _procedure(spark, sf_dir):
    return rounded(scored(spark, sf_dir).select(
        "id", "published_on", iso("published_datetime").alias("published_datetime"), "title", "source",
        "sentiment_score", "sentiment_label",
    ))


@query("P09_sentiment_label", f"{SCORED_SQL} SELECT id, label FROM s WHERE id % 11 <> 0 UNION ALL SELECT id, 'EXTREMELY GREED' FROM s WHERE id % 11 = 0")
def _label(spark, sf_dir):
    score = F.when(F.col("id") % 11 != 0, F.col("sentiment_score"))
    return scored(spark, sf_dir).select("id", labels.sentiment_label(score).alias("label"))


@query("P10_index_label", f"{SCORED_SQL}, v AS (SELECT id, (score + 1) / 2 * 100 AS x FROM s) SELECT id, {index_label_sql('x')} AS label FROM v")
def _index_label(spark, sf_dir):
    value = labels.index_value(F.col("sentiment_score"))
    return scored(spark, sf_dir).select("id", labels.index_label(value).alias("label"))


@query("P11_index_value", f"{SCORED_SQL} SELECT source, {fixed_sql('(avg(score) + 1) / 2 * 100')} AS value FROM s GROUP BY 1")
def _index_value(spark, sf_dir):
    return scored(spark, sf_dir).groupBy("source").agg(
        fixed(labels.index_value(F.avg("sentiment_score"))).alias("value")
    )


HOURLY_COLUMNS = f"strftime(b, '%Y-%m-%d %H:%M:%S') AS hour_start, {SHARED}, {fixed_sql('mean')} AS avg_sentiment_score, {fixed_sql('idx')} AS fng_index_value, {index_label_sql('idx')} AS fng_index_label"


@query("A01_hourly_sentiment", f"{SCORED_SQL}{hours_sql()} SELECT {HOURLY_COLUMNS} FROM h")
def _hourly(spark, sf_dir):
    return rounded(fg.hourly_index(scored(spark, sf_dir)).withColumn("hour_start", iso("hour_start")))


DAILY_COLUMNS = f"""strftime(b, '%Y-%m-%d') AS date, {SHARED}, {fixed_sql('mean')} AS avg_sentiment_score,
  {fixed_sql('idx')} AS fng_index_value, {index_label_sql('idx')} AS fng_index_label, {fixed_sql('lo')} AS min_sentiment_score,
  {fixed_sql('hi')} AS max_sentiment_score, {fixed_sql('sd')} AS stddev_sentiment_score"""
CHANGE_COLUMNS = f"{fixed_sql('idx - prev')} AS fng_index_change, {fixed_sql('CASE WHEN prev <> 0 THEN (idx - prev) / prev * 100 END')} AS fng_index_change_pct"


def dated(df):
    return rounded(df.withColumn("date", F.date_format("date", "yyyy-MM-dd")))


@query("A02_daily_sentiment", f"{SCORED_SQL}{days_sql()} SELECT {DAILY_COLUMNS} FROM d")
def _daily(spark, sf_dir):
    return dated(fg.daily_stats(scored(spark, sf_dir)))


@query("W02_lag_change", f"{SCORED_SQL}{days_sql()} SELECT {DAILY_COLUMNS}, {CHANGE_COLUMNS} FROM d")
def _change(spark, sf_dir):
    return dated(fg.daily_index(scored(spark, sf_dir)))


@query("A03_conditional_count", f"""{SCORED_SQL} SELECT source, count(*) FILTER (WHERE label IN ('GREED', 'EXTREMELY GREED')) AS positive,
  count(*) FILTER (WHERE label = 'NEUTRAL') AS neutral FROM s GROUP BY 1""")
def _conditional(spark, sf_dir):
    label = F.col("sentiment_label")
    return scored(spark, sf_dir).groupBy("source").agg(
        F.count_if(label.isin("GREED", "EXTREMELY GREED")).alias("positive"),
        F.count_if(label == "NEUTRAL").alias("neutral"),
    )


@query("A06_counts_by_type", "SELECT lang AS type, count(*) AS n FROM documents GROUP BY 1")
def _by_type(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("type")).agg(F.count(F.lit(1)).alias("n"))


@query("A07_weighted_sentiment", f"""{SCORED_SQL} SELECT strftime(date_trunc('hour', pub), '%Y-%m-%d %H:%M:%S') AS hour_start,
  {fixed_sql('CASE WHEN sum(upvotes) <> 0 THEN sum(score * upvotes) / sum(upvotes) END')} AS weighted_sentiment_score FROM s GROUP BY 1""")
def _weighted(spark, sf_dir):
    out = fg.weighted_score(scored(spark, sf_dir), articles(spark, sf_dir))
    return rounded(out.withColumn("hour_start", iso("hour_start")))


@query("A08_hourly_score_arrays", f"""{SCORED_SQL}{hours_sql()} SELECT strftime(date_trunc('day', b), '%Y-%m-%d') AS date,
  array_to_string(list({fixed_sql('idx', 3)} ORDER BY b), ',') AS scores FROM h GROUP BY 1""")
def _arrays(spark, sf_dir):
    hourly = fg.hourly_index(scored(spark, sf_dir)).withColumn("fng_index_value", fixed(F.col("fng_index_value"), 3))
    out = fg.daily_hour_scores(hourly)
    text = F.array_join(F.transform("hourly_scores", lambda v: v.cast("string")), ",")
    return out.select(F.date_format("date", "yyyy-MM-dd").alias("date"), text.alias("scores"))


@query("J03_inner_join_news", f"""{SCORED_SQL} SELECT id, strftime(pub, '%Y-%m-%d %H:%M:%S') AS published_datetime, title, source,
  {fixed_sql('score')} AS sentiment_score, label AS sentiment_label, {fixed_sql('title_score')} AS title_sentiment_score,
  url, upvotes, downvotes FROM s""")
def _joined(spark, sf_dir):
    out = fg.news_with_scores(scored(spark, sf_dir), articles(spark, sf_dir))
    return rounded(out.withColumn("published_datetime", iso("published_datetime")))


@query("J06_scalar_maximum", f"{SCORED_SQL}{hours_sql()} SELECT {HOURLY_COLUMNS} FROM h WHERE b = (SELECT max(b) FROM h)")
def _maximum(spark, sf_dir):
    hourly = fg.hourly_index(scored(spark, sf_dir))
    return rounded(keyed.at_maximum(hourly, "hour_start").withColumn("hour_start", iso("hour_start")))


@query("U02_current_index_view", f"""{SCORED_SQL}{hours_sql()}{days_sql()}
SELECT 'HOURLY' AS timeframe, strftime(b, '%Y-%m-%d %H:%M:%S') AS timestamp, {fixed_sql('idx')} AS fng_index_value,
  {index_label_sql('idx')} AS fng_index_label, {SHARED}, CAST(NULL AS DOUBLE) AS change_value, CAST(NULL AS DOUBLE) AS change_pct
FROM h WHERE b = (SELECT max(b) FROM h) UNION ALL
SELECT 'DAILY', strftime(b, '%Y-%m-%d %H:%M:%S'), {fixed_sql('idx')}, {index_label_sql('idx')}, {SHARED},
  {fixed_sql('idx - prev')}, {fixed_sql('CASE WHEN prev <> 0 THEN (idx - prev) / prev * 100 END')}
FROM d WHERE b = (SELECT max(b) FROM d)""")
def _current(spark, sf_dir):
    rows = scored(spark, sf_dir)
    out = fg.current_index(fg.hourly_index(rows), fg.daily_index(rows))
    return rounded(out.withColumn("timestamp", iso("timestamp")))


_LOOKBACK = f"TIMESTAMP '{AS_OF}'"


@query("P20_lookback_filter", f"{SCORED_SQL} SELECT id FROM s WHERE pub >= {_LOOKBACK} - INTERVAL 26 HOUR")
def _lookback(spark, sf_dir):
    as_of = F.to_timestamp(F.lit(AS_OF))
    return fg.trailing(scored(spark, sf_dir), as_of, "hour", 26, strict=True).select("id")


def _merged(fresh: str, old: str, columns: str) -> str:
    return f"SELECT {columns} FROM {fresh} UNION ALL SELECT {columns} FROM {old} WHERE b NOT IN (SELECT b FROM {fresh})"


for _strict in (False, True):
    _start = f"{_LOOKBACK} - INTERVAL 24 HOUR"
    _cut = _start if _strict else f"date_trunc('hour', {_start})"

    @query("R03_refresh_hourly" + ("_strict" if _strict else ""), SCORED_SQL
           + hours_sql("WHERE id % 2 = 0", "old") + hours_sql(f"WHERE pub >= {_cut}", "fresh")
           + " " + _merged("fresh", "old", HOURLY_COLUMNS))
    def _refresh_hourly(spark, sf_dir, strict=_strict):
        rows, as_of = scored(spark, sf_dir), F.to_timestamp(F.lit(AS_OF))
        stored = fg.hourly_index(rows.filter("id % 2 = 0"))
        out = fg.refresh_hourly(stored, rows, as_of, strict)
        return rounded(out.withColumn("hour_start", iso("hour_start")))

    _month = "TIMESTAMP '2024-02-05 12:30:00' - INTERVAL 30 DAY"
    _cut = _month if _strict else f"date_trunc('day', {_month}) - INTERVAL 1 DAY"
    _keep = "" if _strict else f" WHERE b >= date_trunc('day', {_month})"

    @query("R03_refresh_daily" + ("_strict" if _strict else ""), SCORED_SQL
           + days_sql("WHERE id % 2 = 0", "old") + days_sql(f"WHERE pub >= {_cut}", "wide")
           + f", fresh AS (SELECT * FROM wide{_keep}) "
           + _merged("fresh", "old", f"{DAILY_COLUMNS}, {CHANGE_COLUMNS}"))
    def _refresh_daily(spark, sf_dir, strict=_strict):
        rows, as_of = scored(spark, sf_dir), F.to_timestamp(F.lit("2024-02-05 12:30:00"))
        stored = fg.daily_index(rows.filter("id % 2 = 0"))
        return dated(fg.refresh_daily(stored, rows, as_of, strict))


# -- article feeds ---------------------------------------------------------------------
_URL = "CASE WHEN doc_id % 2 = 0 THEN 'HTTP://' ELSE 'http://' END || source || '/' || (doc_id % 100)"
_AT = f"make_timestamp(({EPOCH} + doc_id * {STEP}) * 1000000)"
_AV_TIME = f"""CASE doc_id % 4 WHEN 0 THEN strftime({_AT}, '%Y%m%dT%H%M%S') WHEN 1 THEN strftime({_AT}, '%Y%m%dT%H%M')
  WHEN 2 THEN 'soon' ELSE '' END"""
_AV_AT = f"CASE WHEN doc_id % 4 < 2 THEN {_AT} END"


def feed_documents(spark, sf_dir):
    at = F.timestamp_seconds(F.lit(EPOCH) + F.col("doc_id") * STEP)
    url = F.concat(
        F.when(F.col("doc_id") % 2 == 0, "HTTP://").otherwise("http://"), F.col("source"), F.lit("/"),
        (F.col("doc_id") % 100).cast("string"),
    )
    title = F.concat_ws(" ", F.slice(F.split("text", " "), 1, 8))
    return table(spark, sf_dir, "documents").withColumn("at", at).withColumn("url", url).withColumn("title", title)


def guardian(spark, sf_dir):
    docs = feed_documents(spark, sf_dir).filter("doc_id % 3 = 0")
    headline = F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.concat(F.lit("h "), F.col("title")))
    return docs.select(
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("webPublicationDate"),
        F.col("title").alias("webTitle"), F.col("url").alias("webUrl"), F.col("lang").alias("sectionName"),
        F.struct(headline.alias("headline"), F.col("text").alias("trailText")).alias("fields"),
    )


def finnhub(spark, sf_dir):
    docs = feed_documents(spark, sf_dir).filter("doc_id % 3 = 1")
    return docs.select(
        F.unix_timestamp("at").alias("datetime"), F.col("title").alias("headline"),
        F.col("text").alias("summary"), "source", "url",
    )


def alphavantage(spark, sf_dir):
    docs = feed_documents(spark, sf_dir).filter("doc_id % 3 = 2")
    kind = F.col("doc_id") % 4
    stamp = F.when(kind == 0, F.date_format("at", "yyyyMMdd'T'HHmmss")).when(
        kind == 1, F.date_format("at", "yyyyMMdd'T'HHmm")
    ).when(kind == 2, "soon").otherwise("")
    return docs.select(
        stamp.alias("time_published"), "title", F.col("text").alias("summary"), "source", "url",
        F.array(F.struct(F.col("lang").alias("topic")), F.struct(F.lit("news").alias("topic"))).alias("topics"),
        F.array(F.struct(F.col("source").alias("ticker"))).alias("ticker_sentiment"),
    )


_COMMON = "substr(title, 1, 1999)"
FEEDS_SQL = f"""
WITH t AS (SELECT *, {_URL} AS url, {TITLE_SQL} AS title, {_AT} AS pub FROM documents),
f AS (
 SELECT 0 AS p, pub AS datetime, CASE WHEN doc_id % 5 = 0 THEN title ELSE 'h ' || title END AS headline, text AS summary,
  'The Guardian' AS source, url, lang AS categories, '' AS tags, 'guardian' AS api_source FROM t WHERE doc_id % 3 = 0
 UNION ALL SELECT 1, pub, title, text, source, url, '', '', 'finnhub' FROM t WHERE doc_id % 3 = 1
 UNION ALL SELECT 2, CASE WHEN doc_id % 4 = 1 THEN date_trunc('minute', pub) ELSE {_AV_AT} END, title, text, source, url,
  lang || ',news', source, 'alphavantage' FROM t WHERE doc_id % 3 = 2)"""


def feeds(spark, sf_dir):
    return [
        news.from_guardian(guardian(spark, sf_dir)), news.from_finnhub(finnhub(spark, sf_dir)),
        news.from_alphavantage(alphavantage(spark, sf_dir)),
    ]


def shown(df):
    return df.select(
        iso("datetime").alias("datetime"), "headline", F.md5("summary").alias("summary"), "source", "url",
        "categories", "tags", "api_source",
    )


_SHOWN = "strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, headline, md5(summary) AS summary, source, url, categories, tags, api_source"


@query("P15_text_truncation", """
SELECT doc_id, substr(text, 1, 1999) AS headline, md5(substr(text, 1, 9999)) AS summary,
  CASE WHEN doc_id % 2 = 0 THEN source ELSE '' END AS source FROM documents""")
def _clipped(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("headline"), F.col("text").alias("summary"),
        F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("source"),
    )
    return news.clipped(docs).withColumn("summary", F.md5("summary"))


@query("P16_first_non_empty", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN lang WHEN doc_id % 5 = 1 THEN lang ELSE source END AS headline FROM documents")
def _first_text(spark, sf_dir):
    part = F.col("doc_id") % 5
    head = F.when(part == 0, "").when(part > 1, F.col("source"))
    return table(spark, sf_dir, "documents").select("doc_id", news.first_text(head, F.col("lang")).alias("headline"))


@query("P17_nested_list_to_string", "SELECT doc_id, lang || ',' || source AS categories FROM documents")
def _nested(spark, sf_dir):
    topics = F.array(F.struct(F.col("lang").alias("topic")), F.struct(F.col("source").alias("topic")))
    docs = table(spark, sf_dir, "documents").withColumn("topics", topics)
    return docs.select("doc_id", news.joined_names("topics", "topic").alias("categories"))


@query("P18_multi_format_timestamp", f"""
SELECT doc_id, strftime(CASE WHEN doc_id % 4 = 1 THEN date_trunc('minute', {_AT}) ELSE {_AV_AT} END, '%Y-%m-%d %H:%M:%S') AS datetime FROM documents""")
def _compact(spark, sf_dir):
    docs, kind = feed_documents(spark, sf_dir), F.col("doc_id") % 4
    text = F.when(kind == 0, F.date_format("at", "yyyyMMdd'T'HHmmss")).when(
        kind == 1, F.date_format("at", "yyyyMMdd'T'HHmm")
    ).when(kind == 2, "soon").otherwise("")
    return docs.select("doc_id", iso(news.compact_timestamp(text)).alias("datetime"))


@query("P16_feed_normalisation", f"{FEEDS_SQL} SELECT {_SHOWN} FROM f")
def _normalised(spark, sf_dir):
    first, second, third = feeds(spark, sf_dir)
    return shown(first.unionByName(second).unionByName(third))


UNION_SQL = f"""{FEEDS_SQL},
k AS (SELECT *, row_number() OVER (PARTITION BY lower(trim(url)) ORDER BY p, datetime NULLS FIRST, url, headline, md5(summary)) AS rn FROM f
  WHERE trim(url) <> '')"""


def union(spark, sf_dir):
    order = [F.col("datetime"), F.col("url"), F.col("headline"), F.md5("summary")]
    return news.union_by_priority(feeds(spark, sf_dir), order)


@query("U03_priority_union_dedupe", f"{UNION_SQL} SELECT {_SHOWN} FROM k WHERE rn = 1")
def _union(spark, sf_dir):
    return shown(union(spark, sf_dir))


@query("K04_news_insert_only", f"""{UNION_SQL}, st AS (SELECT DISTINCT url FROM t WHERE doc_id % 2 = 0)
SELECT url, 'stored' AS api_source FROM st UNION ALL
SELECT url, api_source FROM k WHERE rn = 1 AND url NOT IN (SELECT url FROM st)""")
def _insert_only(spark, sf_dir):
    """The merge key is the raw address, the dedup key its lower-cased form."""
    stored = feed_documents(spark, sf_dir).filter("doc_id % 2 = 0").select("url").distinct()
    stored = stored.withColumn("api_source", F.lit("stored"))
    return keyed.insert_new(stored, union(spark, sf_dir).select("url", "api_source"), ["url"])
