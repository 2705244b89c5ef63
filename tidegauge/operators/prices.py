"""Realized price from stored pages: from an element of the HTML, else from the text, else an estimate."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.html import Element, parse
from tidegauge.operators.news import price_in_text

# A name among an element's classes, then parts of its class attribute, in the order they are tried.
CLASS_NAME = "realized-price-selector"
CLASS_PARTS = ("realized", "price")
_NUMBER = re.compile(r"\d+\.?\d*")


def element_price(html: str) -> float | None:
    """The first number in the first element that each rule finds; the next rule is tried if it has none."""
    root = parse(html)

    def named(e: Element) -> bool:
        return CLASS_NAME in e.attrs.get("class", "").split()

    rules = [named, *(lambda e, part=part: part in e.attrs.get("class", "") for part in CLASS_PARTS)]
    for rule in rules:
        element = root.find(rule)
        number = _NUMBER.search(element.text().replace("$", "").replace(",", "")) if element is not None else None
        if number:
            return float(number.group())
    return None


def page_prices(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds ``element_price``, NULL where no element of the page names one.  Arrow batches, one page at a time."""
    @F.pandas_udf("double")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if h is None else element_price(h) for h in batch], dtype="float64")

    return pages.withColumn("element_price", read(F.col(html)))


def realized_price(priced: DataFrame, market: str | Column, text: str = "markdown") -> DataFrame:
    """Adds ``realized_price`` and ``found``: element, text or estimate.

    The text of a page counts only if its HTML is there too.  Without a number from 5,000 to
    100,000 in the text the price is estimated as 60 % of the market price.
    """
    close = F.col(market) if isinstance(market, str) else market
    named = F.when(F.col("html").isNotNull(), price_in_text(F.col(text), F.lit(None).cast("double")))
    return priced.withColumn("realized_price", F.coalesce("element_price", named, close * 0.60)).withColumn(
        "found", F.when(F.col("element_price").isNotNull(), "element").when(named.isNotNull(), "text").otherwise("estimate"))
