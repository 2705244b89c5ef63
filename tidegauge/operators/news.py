"""Article feeds to one news contract, and the priority union of the feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.keyed import first_per_key

# Stored column widths.
WIDTHS = {
    "headline": 1999, "summary": 9999, "source": 499, "url": 999, "categories": 999, "tags": 999,
    "api_source": 99,
}
NEWS_COLUMNS = ["datetime", *WIDTHS]


def clipped(df: DataFrame) -> DataFrame:
    """Texts cut to their stored width; a missing text is empty."""
    return df.select(*(
        F.substring(F.coalesce(F.col(c), F.lit("")), 1, WIDTHS[c]).alias(c) if c in WIDTHS else F.col(c)
        for c in df.columns
    ))


def first_text(*texts: Column) -> Column:
    """First text that is neither missing nor empty."""
    return F.coalesce(*(F.nullif(t, F.lit("")) for t in texts), F.lit(""))


def compact_timestamp(text: Column) -> Column:
    """yyyyMMddTHHmmss or yyyyMMddTHHmm, else NULL."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyyMMdd'T'HHmmss")),
        F.try_to_timestamp(text, F.lit("yyyyMMdd'T'HHmm")),
    )


def joined_names(items: str, field: str) -> Column:
    """One field of a nested list as comma-separated text."""
    names = F.transform(F.col(items), lambda x: F.coalesce(x[field], F.lit("")))
    return F.coalesce(F.array_join(names, ","), F.lit(""))


def from_guardian(articles: DataFrame) -> DataFrame:
    at = F.translate(F.substring("webPublicationDate", 1, 19), "T", " ")
    return articles.select(
        F.try_to_timestamp(at).alias("datetime"),
        first_text(F.col("fields.headline"), F.col("webTitle")).alias("headline"),
        F.col("fields.trailText").alias("summary"), F.lit("The Guardian").alias("source"),
        F.col("webUrl").alias("url"), F.col("sectionName").alias("categories"),
        F.lit("").alias("tags"), F.lit("guardian").alias("api_source"),
    )


def from_finnhub(articles: DataFrame) -> DataFrame:
    return articles.select(
        F.timestamp_seconds("datetime").alias("datetime"), "headline", "summary", "source", "url",
        F.lit("").alias("categories"), F.lit("").alias("tags"), F.lit("finnhub").alias("api_source"),
    )


def from_alphavantage(articles: DataFrame) -> DataFrame:
    return articles.select(
        compact_timestamp(F.col("time_published")).alias("datetime"),
        F.col("title").alias("headline"), "summary", "source", "url",
        joined_names("topics", "topic").alias("categories"),
        joined_names("ticker_sentiment", "ticker").alias("tags"),
        F.lit("alphavantage").alias("api_source"),
    )


def url_key(url: Column) -> Column:
    return F.lower(F.trim(url))


def union_by_priority(feeds: list[DataFrame], order: list[Column]) -> DataFrame:
    """One row per lower-cased address: the earliest feed of the list wins, then
    ``order``; rows without an address are dropped."""
    stacked = reduce(DataFrame.unionByName, [
        df.withColumn("_priority", F.lit(i)) for i, df in enumerate(feeds)
    ]).withColumn("_key", url_key(F.col("url")))
    kept = first_per_key(
        stacked.filter(F.col("_key") != ""), ["_key"], [F.col("_priority"), *order]
    )
    return kept.drop("_key", "_priority")


def price_in_text(text: Column, market: Column) -> Column:
    """Realized price named in a text (5000 to 100000), else 60 % of the market price."""
    def read(pattern: str) -> Column:
        number = F.regexp_replace(F.regexp_extract(text, pattern, 1), ",", "").try_cast("double")
        return F.when(number.between(5_000, 100_000), number)

    labelled = read(r"Realized Price:?\s*\$?([\d,]+\.?\d*)")
    return F.coalesce(labelled, read(r"\$?([\d,]+\.?\d*)"), market * 0.60)
