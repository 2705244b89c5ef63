"""Writers: snapshots of keyed tables, fixed-precision CSV, dated backups, table copy."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.sources.feeds import list_tables


def write_snapshot(df: DataFrame, base: str, partition_by: list[str] | None = None) -> str:
    """Write to a new folder below ``base``; the table being read is never overwritten."""
    path = f"{base.rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def fixed_precision(df: DataFrame, digits: int = 8) -> DataFrame:
    """Floating columns as text with a fixed number of decimals."""
    return df.select(*(
        F.format_string(f"%.{digits}f", F.col(name)).alias(name)
        if kind in ("double", "float") else F.col(name)
        for name, kind in df.dtypes
    ))


def export_csv(df: DataFrame, path: str, key: str, single_file: bool = False) -> None:
    """CSV files whose name order is the key order.

    Rows are also ranged by a hash of the row, so one key with very many rows
    is spread over several files.
    """
    ordered = df.repartitionByRange(F.col(key), F.xxhash64(*df.columns)).sortWithinPartitions(key)
    if single_file:
        ordered = df.coalesce(1).sortWithinPartitions(key)
    fixed_precision(ordered).write.mode("overwrite").option("header", True).csv(path)


def backup_csv(df: DataFrame, path: str, stamp: str, no_comma: list[str]) -> None:
    """Fully quoted CSV below a dated folder; commas are taken out of ``no_comma``."""
    day = stamp[:10]
    cleaned = df.select(*(
        F.regexp_replace(c, ",", "").alias(c) if c in no_comma else F.col(c) for c in df.columns
    ))
    (
        cleaned.withColumn("folder", F.lit(day))
        .write.mode("overwrite").option("header", True).option("quoteAll", True)
        .option("escape", '"').partitionBy("folder").csv(path)
    )


def copy_tables(
    spark: SparkSession, target: str, exclude: Callable[[str, str], bool],
    databases: list[str] | None = None,
) -> list[tuple[str, str]]:
    """Copy every stored table that ``exclude`` does not name to database ``target``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{target}`")
    copied = []
    for database, name in list_tables(spark, databases):
        if database != target and not exclude(database, name):
            rows = spark.table(f"`{database}`.`{name}`")
            rows.write.mode("overwrite").saveAsTable(f"`{target}`.`{database}_{name}`")
            copied.append((database, name))
    return copied


def write_vectors(df: DataFrame, path: str, per_file: int = 100_000) -> None:
    """Vector rows routed to one folder per type."""
    (
        df.write.mode("overwrite").option("maxRecordsPerFile", per_file)
        .partitionBy("type").parquet(path)
    )
