"""Adapters that shape the benchmark tables into the inputs the operators read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import table


def bars(ticks: DataFrame, symbol: str, price: str, order: list[str], bucket: Column) -> DataFrame:
    """Ticks to bars keyed by (symbol, unix_timestamp); partial aggregates only."""
    at = F.struct(*order)
    return ticks.groupBy(
        F.col(symbol).cast("string").alias("symbol"), bucket.alias("unix_timestamp")
    ).agg(
        F.min_by(price, at).alias("open"),
        F.max(price).alias("high"),
        F.max_by(price, at).alias("close"),
        F.min(price).alias("low"),
        F.count(F.lit(1)).cast("double").alias("volume_btc"),
        F.sum(price).alias("volume_usd"),
    )


def event_bars(spark: SparkSession, sf_dir: str, minutes: int = 60) -> DataFrame:
    events = table(spark, sf_dir, "events")
    seconds = F.unix_micros(F.col("ts").cast("timestamp"))
    width = minutes * 60
    bucket = F.floor(seconds / F.lit(1_000_000 * width)) * width
    return bars(events, "event_type", "value", ["ts", "event_id"], bucket)


def order_bars(spark: SparkSession, sf_dir: str, by_priority: bool = True) -> DataFrame:
    """Daily bars of order prices, one symbol per priority or one for all."""
    orders = table(spark, sf_dir, "orders")
    if not by_priority:
        orders = orders.withColumn("o_orderpriority", F.lit("ALL"))
    day = F.floor(F.unix_micros(F.col("o_orderdate").cast("timestamp")) / F.lit(86_400_000_000)) * 86_400
    return bars(orders, "o_orderpriority", "o_totalprice", ["o_orderkey"], day)


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily unit-price bars per supplier: many symbols for scale runs."""
    items = table(spark, sf_dir, "lineitem").withColumn(
        "price", F.col("l_extendedprice") / F.col("l_quantity")
    )
    day = F.floor(F.unix_micros(F.col("l_shipdate").cast("timestamp")) / F.lit(86_400_000_000)) * 86_400
    return bars(
        items, "l_suppkey", "price", ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"], day
    )
