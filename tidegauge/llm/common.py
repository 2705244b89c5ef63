"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.session import scratch_path

#: Name of the struct that carries an input row past the helper columns.
ROW = "__packed_row__"
#: ASCII white space, the bytes 20 and 09 to 0D
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table written to the shared folder: survives lost executors, is computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def packed(df: DataFrame) -> DataFrame:
    """All columns as one struct `__packed_row__`, so that no helper column can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW))


def unpacked(df: DataFrame, names: list[str], new: dict[str, Column]) -> DataFrame:
    """The columns `names` of `__packed_row__`, then the new ones; a new one replaces its namesake."""
    taken = {n.lower() for n in new}
    old = [F.col(ROW).getField(n).alias(n) for n in names if n.lower() not in taken]
    return df.select(*old, *[c.alias(n) for n, c in new.items()])


def with_running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Adds, for each name, the sum of its column over all rows before this one in `order`.

    Rows are dealt by range and written once; each range sums its own rows, and one offset
    per range (as many rows as ranges) carries the totals on, so no task sees all rows.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    part = stored(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = part.groupBy("_range").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    offsets = totals.select(
        "_range", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}_from") for n in sums])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = part.join(F.broadcast(offsets), "_range")
    for n, c in sums.items():
        out = out.withColumn(n, F.col(f"_{n}_from") + F.coalesce(F.sum(c).over(inside), F.lit(0)))
    return out.drop("_range", *[f"_{n}_from" for n in sums])
