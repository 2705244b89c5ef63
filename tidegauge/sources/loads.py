"""Loads from landed files to their merged tables: open interest, funding rate, market data.

Each load is one merge into a versioned table, with audit columns: dates or times of the
delivery take its values (NULLs too), new ones are inserted, all other rows stay.  A value that cannot
be read as a number, or a delivery that names one key twice, fails the load and leaves the
table as it was.  A delivery without usable rows makes no version.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators.keyed import aligned
from tidegauge.sources.feeds import EXCHANGES, feed_date, latest_price, read_json_feed, read_price_csv, timestamp_text, whole_number
from tidegauge.sources.snapshots import SnapshotTable

# The columns of the market-data table.
MARKETS = ("nasdaq", "vix", "dxy", "gold")
#: A market table of fewer rows (about one trading year) is loaded with the whole history again.
FEWEST_ROWS = 250


def _texts(*fields: str) -> T.StructType:
    """Fields as text: the files hold some numbers as strings, and whole numbers with a fraction."""
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def audited(rows: DataFrame, now: Column) -> DataFrame:
    """First contents of a table with audit columns."""
    return rows.withColumn("created_at", now).withColumn("updated_at", now)


def open_interest_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, ("date",), F.date_format("date", "yyyy"))


def funding_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, ("datetime",), F.date_format("datetime", "yyyy-MM"))


def market_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, ("date",), F.date_format("date", "yyyy"))


def open_interest_rows(spark: SparkSession, path: str) -> DataFrame:
    """(date, unix_ts, one column per exchange, total_open_interest) of array-of-objects files.

    The total counts a missing exchange as 0.  Records without a readable date give no row.
    """
    rows = read_json_feed(spark, path, _texts("d", "unixTs", *EXCHANGES))
    venues = [F.col(field).cast("double").alias(column) for field, column in EXCHANGES.items()]
    typed = rows.select(feed_date(F.col("d")).alias("date"), whole_number(F.col("unixTs")).alias("unix_ts"), *venues)
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in EXCHANGES.values()])
    return typed.filter(F.col("date").isNotNull()).withColumn("total_open_interest", total)


def funding_rows(spark: SparkSession, path: str) -> DataFrame:
    """(datetime, unix_ts, funding_rate); a fraction of a second is cut off, records without time or rate give no row."""
    rows = read_json_feed(spark, path, _texts("d", "unixTs", "fundingRate"))
    return rows.filter(F.col("d").isNotNull() & F.col("fundingRate").isNotNull()).select(
        timestamp_text(F.col("d")).alias("datetime"), whole_number(F.col("unixTs")).alias("unix_ts"),
        F.col("fundingRate").cast("double").alias("funding_rate"),
    )


def _histories(spark: SparkSession, paths: dict[str, str], in_order: bool = False) -> dict[str, DataFrame]:
    """The series whose files can be read; each by its own header.  None at all is an error."""
    found = {}
    for name, path in paths.items():
        try:
            found[name] = read_price_csv(spark, path, order="ord" if in_order else None)
        except (ValueError, AnalysisException):  # no file, no such header or no row: the others still load
            continue
    if not found:
        raise ValueError("none of the market series can be read")
    return found


def market_history(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row per date with a column for each market, from the CSV history of each.

    Of lines of one date the last of the file counts.  A market whose file cannot be read is NULL
    on all dates.
    """
    found = _histories(spark, paths, in_order=True)
    stacked = reduce(DataFrame.unionByName, [
        rows.select("date", F.col("close").alias("value"), "ord", F.lit(name).alias("series")) for name, rows in found.items()
    ])
    return aligned(stacked, list(MARKETS))


def market_latest(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row: the newest close of each market, on the date of the first market that has one."""
    found = _histories(spark, paths)
    stacked = reduce(DataFrame.unionByName, [
        latest_price(rows).withColumn("series", F.lit(name)) for name, rows in found.items()
    ])  # one row a market
    own = lambda c, name: F.max(F.when(F.col("series") == name, F.col(c)))
    return stacked.agg(
        F.coalesce(*(own("date", m) for m in MARKETS)).alias("date"), *(own("close", m).alias(m) for m in MARKETS)
    ).filter(F.col("date").isNotNull())


def load_open_interest(stored: SnapshotTable, path: str, now: Column) -> int:
    """Merges delivered files; the table's newest version."""
    return stored.merge(open_interest_rows(stored.spark, path), now=now)


def load_funding(stored: SnapshotTable, path: str, now: Column) -> int:
    return stored.merge(funding_rows(stored.spark, path), now=now)


def load_market(stored: SnapshotTable, paths: dict[str, str], now: Column, fewest: int = FEWEST_ROWS) -> int:
    """Merges the newest closes, or the whole history while the table holds fewer than ``fewest`` rows."""
    short = stored.read().limit(fewest).count() < fewest  # rows of a table that the calendar bounds
    rows = market_history(stored.spark, paths) if short else market_latest(stored.spark, paths)
    return stored.merge(rows, now=now)
