"""A keyed table kept as versioned Parquet partitions, merged without rewriting what a batch does not touch.

Below the table's path stand ``data/version=N/table_part=K`` and one small file per version that
lists, for each partition, the version that holds its rows.  A merge reads and rewrites the
partitions of the batch's keys only; a version counts once its list is written, so a run that
dies leaves the table as it was, and every earlier version stays readable.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegauge.operators.keyed import insert_new, upsert

PART = "table_part"
LIST = "part string, holder long, columns string"


def hashed(keys: list[str], parts: int) -> Column:
    """Partition by hash: for keys without an order that batches follow."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("string")


def by_month(seconds: str) -> Column:
    """Partition by calendar month of a time in seconds: a delta touches the newest ones."""
    return F.date_format(F.timestamp_seconds(F.col(seconds)), "yyyy-MM")


def one_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of df; the job that reads them fails if two share a key.

    An aggregate with partial sums, on the keys that the merge joins on, so it adds no shuffle
    to it.  Rows with a NULL in the key are all kept.
    """
    values = [c for c in df.columns if c not in keys]
    named = F.concat_ws(", ", *(F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys))
    several = F.raise_error(F.concat(F.lit("several source rows for one key: "), named))
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    row = F.struct(*values) if values else F.struct(F.lit(True).alias("_"))
    grouped = df.filter(whole).groupBy(*keys).agg(F.first(row).alias("_row"), F.count(F.lit(1)).alias("_n")).select(
        *keys, F.when(F.col("_n") > 1, several.cast(df.select(row.alias("_")).schema["_"].dataType)).otherwise(F.col("_row")).alias("_row"))
    return grouped.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in values)).select(*df.columns).unionByName(df.filter(~whole))


@dataclass(frozen=True)
class SnapshotTable:
    """``part`` is an expression over the key columns only, so that a key never changes its partition."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    part: Column

    def versions(self) -> list[int]:
        """Numbers of the complete versions."""
        try:
            listed = self.spark.read.schema(f"{LIST}, version long").json(f"{self.path}/versions")
        except AnalysisException:  # no version yet
            return []
        return sorted(r["version"] for r in listed.select("version").distinct().collect())

    def _newest(self) -> int:
        known = self.versions()
        if not known:
            raise ValueError(f"no table at {self.path}")
        return known[-1]

    def _list(self, version: int) -> tuple[dict[str, int], StructType]:
        """The version that holds each partition's rows, and the columns; as many entries as partitions."""
        rows = self.spark.read.schema(LIST).json(f"{self.path}/versions/version={version}").collect()
        columns = next(r["columns"] for r in rows if r["columns"])
        return {r["part"]: r["holder"] for r in rows if r["part"] is not None}, StructType.fromJson(json.loads(columns))

    def _commit(self, version: int, holders: dict[str, int], columns: StructType) -> None:
        """Fails if another writer has committed this version."""
        rows = [*((p, v, None) for p, v in sorted(holders.items())), (None, None, columns.json())]
        self.spark.createDataFrame(rows, LIST).coalesce(1).write.mode("errorifexists").json(f"{self.path}/versions/version={version}")

    def _read(self, holders: dict[str, int], columns: StructType) -> DataFrame:
        if not holders:
            return self.spark.createDataFrame([], columns)
        paths = [f"{self.path}/data/version={v}/{PART}={p}" for p, v in sorted(holders.items())]
        return self.spark.read.schema(columns).parquet(*paths)

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PART, F.coalesce(self.part.cast("string"), F.lit("none")))

    def _write(self, df: DataFrame, version: int) -> str:
        folder = f"{self.path}/data/version={version}"
        # rows of a partition come together, those of a heavy one in several tasks
        self._placed(df).hint("rebalance", F.col(PART)).write.mode("overwrite").partitionBy(PART).parquet(folder)
        return folder

    def holders(self) -> tuple[dict[str, int], StructType]:
        return self._list(self._newest())

    def read(self, version: int | None = None, parts: list[str] | None = None) -> DataFrame:
        """The table's rows, or those of some partitions, as of a version."""
        holders, columns = self._list(version or self._newest())
        return self._read({p: v for p, v in holders.items() if parts is None or p in parts}, columns)

    def create(self, df: DataFrame) -> int:
        """Version 1 of the table from rows with unique keys."""
        folder = self._write(df, 1)
        try:
            kept = [r[PART] for r in self.spark.read.schema(f"{PART} string").parquet(folder).distinct().collect()]
        except AnalysisException:  # no rows, no file
            kept = []
        self._commit(1, dict.fromkeys(kept, 1), df.schema)
        return 1

    def merge(self, source: DataFrame, update: list[str] | None = None, now: Column | None = None, insert_only: bool = False) -> int:
        """Matched rows take the source's values, new keys are inserted, other rows stay; returns the new version.

        The source runs once.  Only partitions that keys of the source fall into are read, joined
        and rewritten.  Two source rows of one key fail the merge, and the table stays as it was.
        See :func:`tidegauge.operators.keyed.upsert` for ``update`` and ``now``; with
        ``insert_only`` stored rows stay.  An empty source makes no version.
        """
        version = self._newest()
        holders, columns = self._list(version)
        held = self._placed(source).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = [r[PART] for r in held.select(PART).distinct().collect()]  # one row a partition
            if not touched:
                return version
            old = self._read({p: holders[p] for p in touched if p in holders}, columns)
            new = one_row_per_key(held.drop(PART), list(self.keys))
            merged = insert_new(old, new, list(self.keys)) if insert_only else upsert(
                old, new, list(self.keys), update=update, now=now, checked=False)
            self._write(merged, version + 1)
        finally:
            held.unpersist()
        self._commit(version + 1, holders | dict.fromkeys(touched, version + 1), columns)
        return version + 1
