"""News articles to scored articles to the hourly and daily Fear & Greed index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.labels import (
    Scorer, index_label, index_value, lexicon_score, sentiment_label,
)
from tidegauge.operators.keyed import at_maximum, upsert


def score_news(news: DataFrame, scorer: Scorer = lexicon_score) -> DataFrame:
    """Sentiment rows of articles; each score is computed once."""
    scored = news.select(
        "id", "published_on", F.timestamp_seconds("published_on").alias("published_datetime"),
        "title", "source", "body", scorer(F.col("body")).alias("sentiment_score"),
        scorer(F.col("title")).alias("title_sentiment_score"),
    )
    return scored.withColumn("sentiment_label", sentiment_label(F.col("sentiment_score")))


def stamped(scored: DataFrame, now: Column | None = None) -> DataFrame:
    """Sentiment rows as they are stored, with the time of their analysis: one for a batch."""
    return scored.withColumn("analyzed_at", F.current_timestamp() if now is None else now)


def _counts() -> list[Column]:
    label = F.col("sentiment_label")
    return [
        F.count(F.lit(1)).alias("total_articles"),
        F.count_if(label.isin("GREED", "EXTREMELY GREED")).alias("positive_articles"),
        F.count_if(label == "NEUTRAL").alias("neutral_articles"),
        F.count_if(label.isin("FEAR", "EXTREMELY FEAR")).alias("negative_articles"),
        F.avg("sentiment_score").alias("avg_sentiment_score"),
    ]


def _indexed(df: DataFrame) -> DataFrame:
    return df.withColumn("fng_index_value", index_value(F.col("avg_sentiment_score"))).withColumn(
        "fng_index_label", index_label(F.col("fng_index_value"))
    )


def hourly_index(scored: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", "published_datetime").alias("hour_start")
    return _indexed(scored.groupBy(hour).agg(*_counts()))


def daily_stats(scored: DataFrame) -> DataFrame:
    score = "sentiment_score"
    return _indexed(
        scored.groupBy(F.to_date("published_datetime").alias("date")).agg(
            *_counts(), F.min(score).alias("min_sentiment_score"),
            F.max(score).alias("max_sentiment_score"),
            F.stddev_samp(score).alias("stddev_sentiment_score"),
        )
    )


def with_change(daily: DataFrame) -> DataFrame:
    """Change against the previous day; one row per calendar day, so one small task."""
    value = F.col("fng_index_value")
    before = F.lag("fng_index_value").over(Window.orderBy("date"))
    return daily.withColumn("_before", before).select(
        *daily.columns, (value - F.col("_before")).alias("fng_index_change"),
        F.when(F.col("_before") != 0, (value - F.col("_before")) / F.col("_before") * 100)
        .alias("fng_index_change_pct"),
    )


def daily_index(scored: DataFrame) -> DataFrame:
    return with_change(daily_stats(scored))


def trailing(scored: DataFrame, as_of: Column, unit: str, n: int, strict: bool = False) -> DataFrame:
    """Articles of the last ``n`` hours or days before ``as_of``.

    The start is aligned to the bucket, so that a bucket is never replaced by a
    partial one; ``strict`` cuts at the exact time.
    """
    start = as_of - F.expr(f"interval {n} {unit}s")
    if not strict:
        start = F.date_trunc(unit, start)
    return scored.filter(F.col("published_datetime") >= start)


def refresh_hourly(table: DataFrame, scored: DataFrame, as_of: Column, strict: bool = False) -> DataFrame:
    fresh = hourly_index(trailing(scored, as_of, "hour", 24, strict))
    return upsert(table, fresh, ["hour_start"], checked=False)


def refresh_daily(table: DataFrame, scored: DataFrame, as_of: Column, strict: bool = False) -> DataFrame:
    """Recompute the trailing 30 days; unless strict, the day before them gives
    the oldest day its change."""
    if strict:
        fresh = daily_index(trailing(scored, as_of, "day", 30, True))
    else:
        start = F.date_trunc("day", as_of - F.expr("interval 30 days"))
        fresh = daily_index(trailing(scored, as_of, "day", 31)).filter(
            F.col("date") >= F.to_date(start)
        )
    return upsert(table, fresh, ["date"], checked=False)


def news_with_scores(scored: DataFrame, news: DataFrame) -> DataFrame:
    return scored.select(
        "id", "published_datetime", "title", "source", "sentiment_score", "sentiment_label",
        "title_sentiment_score",
    ).join(news.select("id", "url", "upvotes", "downvotes"), "id")


def current_index(hourly: DataFrame, daily: DataFrame) -> DataFrame:
    """Latest hour and latest day as one relation."""
    shared = [
        "fng_index_value", "fng_index_label", "total_articles", "positive_articles",
        "neutral_articles", "negative_articles",
    ]
    missing = F.lit(None).cast("double")
    hours = at_maximum(hourly, "hour_start").select(
        F.lit("HOURLY").alias("timeframe"), F.col("hour_start").alias("timestamp"), *shared,
        missing.alias("change_value"), missing.alias("change_pct"),
    )
    days = at_maximum(daily, "date").select(
        F.lit("DAILY").alias("timeframe"), F.col("date").cast("timestamp").alias("timestamp"),
        *shared, F.col("fng_index_change").alias("change_value"),
        F.col("fng_index_change_pct").alias("change_pct"),
    )
    return hours.unionByName(days)


def weighted_score(scored: DataFrame, weights: DataFrame) -> DataFrame:
    """Hourly score weighted by upvotes (optional column)."""
    hour = F.date_trunc("hour", "published_datetime").alias("hour_start")
    joined = scored.join(weights.select("id", "upvotes"), "id")
    total = F.sum("upvotes")
    return joined.groupBy(hour).agg(
        F.when(total != 0, F.sum(F.col("sentiment_score") * F.col("upvotes")) / total)
        .alias("weighted_sentiment_score")
    )


def daily_hour_scores(hourly: DataFrame) -> DataFrame:
    """Ordered hourly index values per day: at most 24 entries (optional column)."""
    pair = F.struct("hour_start", "fng_index_value")
    return hourly.groupBy(F.to_date("hour_start").alias("date")).agg(
        F.transform(F.array_sort(F.collect_list(pair)), lambda p: p["fng_index_value"])
        .alias("hourly_scores")
    )
