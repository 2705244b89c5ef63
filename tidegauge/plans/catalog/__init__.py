"""Registered queries, each with the equivalent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` gives the same rows on the same tables."""
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship_package(spark)
            return build(spark, sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


def fixed(value: Column, digits: int = 6) -> Column:
    """Rounding both engines compute the same way."""
    scale = 10.0 ** digits
    return F.floor(value * scale + 0.5).cast("double") / scale


def fixed_sql(expr: str, digits: int = 6) -> str:
    return f"floor(({expr}) * 1e{digits} + 0.5) / 1e{digits}"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All floating columns rounded."""
    return df.select(*(
        fixed(F.col(n), digits).alias(n) if t in ("double", "float") else F.col(n)
        for n, t in df.dtypes
    ))


def iso(column: str | Column) -> Column:
    """Timestamp or date as text."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def load_all() -> None:
    from tidegauge.plans.catalog import (  # noqa: F401
        documents, keyed, loads, market, news, series, sources, strategy, streams,
    )
