"""Bounded slices of long price series.

A series operator needs the rows of one symbol in time order.  Handing a whole
symbol to one task fails as soon as one symbol dominates the table, so a symbol
with more rows than ``rows_per_segment`` is cut into consecutive segments that
are processed independently.  Each segment also receives the last ``HALO`` rows
that precede it, which makes every finite frame exact; recursive averages get
their starting state from :mod:`tidegauge.operators.recursive`.

The bars table is keyed by (symbol, unix_timestamp); rows are numbered per
(symbol, quarter) and shifted by the rows of earlier quarters, so numbering
never gathers a symbol in one task either.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FRAME_ROWS = 720        # longest finite frame
INPUT_LAGS = 32         # rows the inputs of a recursive average look back
HALO = FRAME_ROWS + INPUT_LAGS
STATE_LAG = 16          # rows of non-linear output needed before a segment
SEED_ROWS = 80          # rows after which every recursive average is seeded
TAIL = HALO + SEED_ROWS
ROWS_PER_SEGMENT = 50_000
NUMBERING_SECONDS = 90 * 86_400


@dataclass(frozen=True)
class Segmented:
    """Bars with ``_seg`` (segment), ``_li`` (0-based row in the slice) and ``_halo``."""

    df: DataFrame
    split: bool
    rows_per_segment: int


def longest_series(bars: DataFrame) -> int:
    """Rows of the longest symbol: one narrow pre-aggregated pass."""
    row = bars.groupBy("symbol").count().agg(F.max("count")).first()
    return row[0] or 0


def number_rows(bars: DataFrame) -> DataFrame:
    """0-based row number per symbol in time order, column ``_rn``."""
    sliced = bars.withColumn(
        "_slice", F.floor(F.col("unix_timestamp") / F.lit(NUMBERING_SECONDS))
    )
    sizes = sliced.groupBy("symbol", "_slice").count()
    before = Window.partitionBy("symbol").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        "symbol", "_slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("symbol", "_slice").orderBy("unix_timestamp")
    return (
        sliced.withColumn("_in_slice", F.row_number().over(inside) - 1)
        .join(offsets, ["symbol", "_slice"])
        .withColumn("_rn", F.col("_before") + F.col("_in_slice"))
        .drop("_slice", "_in_slice", "_before")
    )


def segment(bars: DataFrame, rows_per_segment: int = ROWS_PER_SEGMENT) -> Segmented:
    if rows_per_segment < FRAME_ROWS + SEED_ROWS:
        raise ValueError(f"rows_per_segment must be at least {FRAME_ROWS + SEED_ROWS}")
    if longest_series(bars) <= rows_per_segment:
        order = Window.partitionBy("symbol", "_seg").orderBy("unix_timestamp")
        df = (
            bars.withColumn("_seg", F.lit(0).cast("long"))
            .withColumn("_li", (F.row_number().over(order) - 1).cast("long"))
            .withColumn("_halo", F.lit(False))
        )
        return Segmented(df, False, rows_per_segment)

    size = F.lit(rows_per_segment).cast("long")
    own = F.floor(F.col("_rn") / size)
    in_own = F.col("_rn") - own * size
    # the last HALO rows of a segment are also sent to the next one
    targets = F.when(
        in_own >= size - HALO, F.array(own, own + 1)
    ).otherwise(F.array(own))
    df = (
        number_rows(bars)
        .withColumn("_own", own)
        .withColumn("_seg", F.explode(targets))
        .withColumn("_halo", F.col("_seg") != F.col("_own"))
        .withColumn(
            "_li",
            F.col("_rn") - F.col("_seg") * size
            + F.when(F.col("_seg") > 0, F.lit(HALO)).otherwise(F.lit(0)),
        )
        .drop("_own", "_rn")
    )
    # a copy sent past the end of a symbol forms a segment of halo rows only;
    # they are all dropped with the other halo rows
    return Segmented(df, True, rows_per_segment)


def resume(tail: DataFrame, new: DataFrame, states: DataFrame, rows_per_segment: int = ROWS_PER_SEGMENT) -> Segmented:
    """New bars behind the rows kept of earlier ones, in as many segments as they fill.

    A symbol with a known state continues as segment 1 behind its last HALO rows; any other
    symbol is short, so its tail is its whole history and begins segment 0, of which its rows
    are part.  Rows are numbered as in :func:`segment`, so no task sees all new rows of a symbol.
    """
    if rows_per_segment < FRAME_ROWS + SEED_ROWS:
        raise ValueError(f"rows_per_segment must be at least {FRAME_ROWS + SEED_ROWS}")
    columns = new.columns
    known = states.select("symbol", F.lit(1).cast("long").alias("_first"))
    placed = tail.select(*columns).withColumn("_old", F.lit(True)).unionByName(
        new.withColumn("_old", F.lit(False))).join(known, "symbol", "left").withColumn("_first", F.coalesce("_first", F.lit(0).cast("long")))
    newest = Window.partitionBy("symbol").orderBy(F.col("unix_timestamp").desc())
    before = placed.filter(F.col("_old") & (F.col("_first") == 1)).withColumn("_age", F.row_number().over(newest)).filter(F.col("_age") <= HALO)
    halo = before.select(*columns, F.col("_first").alias("_seg"), F.lit(True).alias("_halo"), (F.lit(HALO) - F.col("_age")).cast("long").alias("_li"))
    size = F.lit(rows_per_segment).cast("long")
    rows = number_rows(placed.filter(~F.col("_old") | (F.col("_first") == 0)))
    own, inside = F.floor(F.col("_rn") / size), F.pmod(F.col("_rn"), size)
    rows = rows.withColumn("_own", own + F.col("_first")).withColumn(
        "_seg", F.explode(F.when(inside >= size - HALO, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array("_own"))))
    start = F.col("_rn") - (F.col("_seg") - F.col("_first")) * size + F.when(F.col("_seg") > 0, F.lit(HALO)).otherwise(F.lit(0))
    rows = rows.select(*columns, "_seg", (F.col("_seg") != F.col("_own")).alias("_halo"), start.cast("long").alias("_li"))
    return Segmented(halo.unionByName(rows), True, rows_per_segment)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("_halo")).drop("_halo", "_seg", "_li")
