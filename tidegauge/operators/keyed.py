"""Operators on tables keyed by date, url or id: merge, joins, dedup, latest rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().filter("count > 1")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str] | None = None,
    now: Column | None = None,
    checked: bool = True,
) -> DataFrame:
    """MERGE as one full outer join: matched rows take the source values (NULLs
    too), new keys are inserted, other rows stay.  NULL keys never match.

    ``update`` limits the columns taken from the source; the others stay, or
    are NULL on insert.  ``now`` maintains created_at / updated_at.
    """
    if checked and not duplicate_keys(source.dropna(subset=keys), keys).isEmpty():
        raise ValueError(f"source holds several rows for one key {keys}")
    audit = {"created_at", "updated_at"} if now is not None else set()
    taken = [
        c for c in (update or source.columns)
        if c not in keys and c in target.columns and c not in audit
    ]
    new = source.select(
        *(F.col(k).alias(f"_k_{k}") for k in keys), *(F.col(c).alias(f"_s_{c}") for c in taken),
        F.lit(True).alias("_in_source"),
    )
    old = target.withColumn("_in_target", F.lit(True))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{k}") for k in keys])
    from_source, from_target = F.col("_in_source").isNotNull(), F.col("_in_target").isNotNull()

    def column(name: str) -> Column:
        if name in keys:
            return F.when(from_target, F.col(name)).otherwise(F.col(f"_k_{name}"))
        if name in taken:
            return F.when(from_source, F.col(f"_s_{name}")).otherwise(F.col(name))
        if name in audit:
            stamp = from_source if name == "updated_at" else from_source & ~from_target
            return F.when(stamp, now).otherwise(F.col(name))
        return F.col(name)

    return old.join(new, on, "full_outer").select(*(column(c).alias(c) for c in target.columns))


def insert_new(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-only merge: rows of known keys are never overwritten."""
    return target.unionByName(source.join(target.select(*keys), keys, "left_anti"))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row with the smallest ``order`` per key.

    An aggregate, not a ranking window: rows are reduced before the shuffle, so
    a key with very many rows costs no more than any other.
    """
    values = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*values), F.struct(*order)).alias("_row"))
        .select(*keys, *(F.col(f"_row.{c}").alias(c) for c in values))
        .select(*df.columns)
    )


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row with the greatest ``order`` per key; see :func:`first_per_key`."""
    values = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_row"))
        .select(*keys, *(F.col(f"_row.{c}").alias(c) for c in values))
        .select(*df.columns)
    )


def wide_by_date(metrics: dict[str, DataFrame], spine: list[str], full_spine: bool = False) -> DataFrame:
    """Keyed series (date, unix_ts, value) side by side on the dates of ``spine``.

    One shuffle: the series are stacked and aggregated per date, instead of a
    chain of joins.  unix_ts falls back over the first three series.  Of several rows
    of a series on one date the one with the greatest unix_ts counts, of those without a time
    the one with the greatest value, and only if no other has a time.
    """
    stacked = reduce(DataFrame.unionByName, [
        df.select("date", "unix_ts", F.col("value").cast("double"), F.lit(name).alias("metric"))
        for name, df in metrics.items()
    ]).filter(F.col("date").isNotNull())
    names = list(metrics)
    is_ = lambda name: F.col("metric") == name
    newest = F.struct(F.col("unix_ts").isNotNull().alias("dated"), "unix_ts", "value")
    out = stacked.groupBy("date").agg(
        *(F.max(F.when(is_(n), F.col("unix_ts"))).alias(f"_ts_{i}") for i, n in enumerate(names[:3])),
        F.max(F.col("metric").isin(spine)).alias("_on_spine"),
        *(F.max_by(F.when(is_(n), F.col("value")), F.when(is_(n), newest)).alias(n) for n in names),
    )
    if not full_spine:
        out = out.filter("_on_spine")
    stamps = [F.col(f"_ts_{i}") for i in range(len(names[:3]))]
    return out.select("date", F.coalesce(*stamps).alias("unix_ts"), *names)


def wide_from_long(rows: DataFrame, columns: list[str], spine: list[str], stamps: list[str], full_spine: bool = False) -> DataFrame:
    """(feed, column, date, unix_ts, value) to one row per date with a column for each of ``columns``.

    Of several records of a feed on one date the one with the greatest unix_ts counts, with its
    NULLs, and of those without a time the one with the greatest value.  Dates are those of the
    feeds in ``spine``; unix_ts is that of the first feed of ``stamps`` that has the date.  One
    aggregate with partial sums: one scan and one shuffle whatever the number of feeds.
    """
    newest = F.struct(F.col("unix_ts").isNotNull().alias("dated"), "unix_ts", F.col("value").isNotNull().alias("known"), "value")
    own = lambda c: F.col("column") == c
    out = rows.filter(F.col("date").isNotNull()).groupBy("date").agg(
        F.max(F.col("feed").isin(list(spine))).alias("_on_spine"),
        *(F.max(F.when(F.col("feed") == f, F.col("unix_ts"))).alias(f"_ts_{i}") for i, f in enumerate(stamps)),
        *(F.max_by(F.when(own(c), F.col("value")), F.when(own(c), newest)).alias(c) for c in columns),
    )
    if not full_spine:
        out = out.filter("_on_spine")
    return out.select("date", F.coalesce(*(F.col(f"_ts_{i}") for i in range(len(stamps)))).alias("unix_ts"), *columns)


def date_spine(tables: list[DataFrame]) -> DataFrame:
    """Distinct dates of several tables."""
    return reduce(DataFrame.union, [t.select("date") for t in tables]).distinct()


def align_by_date(series: dict[str, DataFrame]) -> DataFrame:
    """Independent (date, value, ord) series to one row per date; the later duplicate wins."""
    stacked = reduce(DataFrame.unionByName, [
        df.select("date", "value", "ord", F.lit(name).alias("series")) for name, df in series.items()
    ])
    return aligned(stacked, list(series))


def aligned(rows: DataFrame, series: list[str]) -> DataFrame:
    """(date, series, value, ord) to one row per date with a column per series; the later duplicate wins."""
    return rows.groupBy("date").agg(*(
        F.max_by(
            F.when(F.col("series") == n, F.col("value")), F.when(F.col("series") == n, F.col("ord"))
        ).alias(n) for n in series
    ))


def latest_rows(df: DataFrame, order: str, n: int, by: list[str] | None = None) -> DataFrame:
    """The newest ``n`` rows (per ``by``); Spark limits each task before the shuffle."""
    if not by:
        return df.orderBy(F.col(order).desc()).limit(n)
    newest = Window.partitionBy(*by).orderBy(F.col(order).desc())
    return df.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= n).drop("_r")


def capped(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First ``n`` rows in feed order."""
    return df.orderBy(*order).limit(n)


def join_on_date(prices: DataFrame, mvrv: DataFrame, nupl: DataFrame) -> DataFrame:
    """Three-way full outer join on date; the joined key is the first non-null one."""
    joined = prices.join(mvrv, "date", "full_outer").join(nupl, "date", "full_outer")
    return joined.filter(F.col("date").isNotNull())


def join_latest(prices: DataFrame, mvrv: DataFrame, nupl: DataFrame, n: int = 60) -> DataFrame:
    """Newest ``n`` rows of each input, then joined; the limits come first."""
    return join_on_date(*(latest_rows(df, "date", n) for df in (prices, mvrv, nupl)))


def at_maximum(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key equals the greatest key (ties survive)."""
    top = df.agg(F.max(key).alias("_top"))
    return df.join(F.broadcast(top), df[key] == top["_top"], "left_semi")


def table_status(df: DataFrame, key: str, source_key: str | None = None) -> DataFrame:
    """Row count, key range and what a run has to do, from the keys of the stored
    rows and (in ``source_key``, of other rows) the keys of the source."""
    status = df.agg(
        F.count(key).alias("n_rows"), F.min(key).alias("first_key"),
        F.coalesce(F.max(key), F.lit(0)).alias("last_key"),
        *([F.max(source_key).alias("_source_last")] if source_key else []),
    )
    if not source_key:
        return status
    return status.withColumn(
        "action", next_action(F.col("n_rows"), F.col("last_key"), F.col("_source_last"))
    ).drop("_source_last")


def next_action(n_rows: Column, last_key: Column, source_last: Column) -> Column:
    return F.when(n_rows == 0, "initialize").when(source_last > last_key, "delta").otherwise("skip")


def hour_grid(bounds: DataFrame) -> DataFrame:
    """Every hour from first to last per symbol; bounds(symbol, first_ts, last_ts) in seconds.

    Days are exploded before hours, so no row carries a long array.
    """
    day = 86_400
    days = bounds.withColumn(
        "_day", F.explode(F.expr(f"sequence(first_ts div {day}, last_ts div {day})"))
    )
    hours = days.withColumn("_h", F.explode(F.expr("sequence(0, 23)"))).withColumn(
        "unix_timestamp", F.col("_day") * day + F.col("_h") * 3600
    )
    inside = (F.col("unix_timestamp") >= F.col("first_ts")) & (F.col("unix_timestamp") <= F.col("last_ts"))
    return hours.filter(inside).select("symbol", "unix_timestamp")


def missing_rows(expected: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    return expected.join(stored.select(*keys), keys, "left_anti")


#: Bits of a filter over a delta's keys; with more keys than it can tell apart the filter is left out.
FILTER_BITS, FILTER_KEYS = 1 << 23, 1_000_000


def delta(arrived: DataFrame, registry: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``arrived`` whose key the registry does not hold, for a registry far larger than the delta.

    Registry rows that cannot match (:func:`possibly_held`) never reach the shuffle of the anti
    join, which decides the rest exactly.  With more than FILTER_KEYS new keys the filter would
    let most rows through, and all go to the join.  NULL keys are never in the registry.
    """
    wanted = arrived.select(*keys).distinct()
    if wanted.limit(FILTER_KEYS + 1).count() > FILTER_KEYS:
        return missing_rows(arrived, registry, list(keys))
    return missing_rows(arrived, possibly_held(registry, wanted, *keys), list(keys))


def possibly_held(registry: DataFrame, wanted: DataFrame, *keys: str) -> DataFrame:
    """Keys of the registry that may be among ``wanted``: those whose hash has its bit set in a
    bitmap of FILTER_BITS (a megabyte in rows of 4 KB, built by partial aggregates)."""
    at = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    bucket, bit = F.bitmap_bucket_number(at), F.bitmap_bit_position(at)
    bits = wanted.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    tested = registry.select(*keys, bucket.alias("_bucket"), bit.alias("_bit"))
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = tested.join(F.broadcast(bits), "_bucket").filter(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1)
    return held.select(*keys)


def newer_than_stored(source: DataFrame, stored: DataFrame, key: str, blank: str | None = None) -> DataFrame:
    """Rows above the stored maximum of ``key`` (all rows when nothing is stored)."""
    mark = stored.agg(F.max(key).alias("_mark"))  # one row
    out = source.join(F.broadcast(mark), F.lit(True)).filter(
        F.col("_mark").isNull() | (F.col(key) > F.col("_mark"))
    ).select(*source.columns)
    return out if blank is None else out.filter(F.trim(F.coalesce(F.col(blank), F.lit(""))) != "")
