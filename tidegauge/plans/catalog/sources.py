"""Scans and sinks: tables are written in a landed format and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.topics import SEEDS
from tidegauge.operators.keyed import upsert, wide_from_long
from tidegauge.plans import fixtures
from tidegauge.plans.catalog import fixed, fixed_sql, iso, query, rounded
from tidegauge.plans.catalog.series import bars_sql
from tidegauge.session import scratch_path, table
from tidegauge.sources import feeds, sinks
from tidegauge.sources.snapshots import SnapshotTable

DAY_SQL = """
daily AS (SELECT event_type, CAST(date_trunc('day', ts) AS DATE) AS day,
  CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS unix_ts, avg(value) AS v FROM events GROUP BY 1, 2, 3)"""


def daily_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean per event type: (event_type, date, unix_ts, value)."""
    at = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").groupBy("event_type", F.to_date(at).alias("date")).agg(
        F.avg("value").alias("value")
    ).withColumn("unix_ts", F.unix_timestamp(F.col("date").cast("timestamp")))


def land_json(rows: DataFrame, record, path: str, by: list[str]) -> None:
    """Array-of-objects files, one array per value of ``by`` and month; the months are written by all tasks."""
    text = F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(record)), ","), F.lit("]"))
    months = rows.groupBy(*by, F.date_trunc("month", "date").alias("_month")).agg(text.alias("value")).drop("_month")
    (months.write.partitionBy(*by) if by else months.write).text(path)


def of_type(rows: DataFrame, event_type: str) -> DataFrame:
    return rows.filter(F.col("event_type") == event_type)


@query("S01_json_feed_scan", f"""WITH {DAY_SQL}
SELECT event_type, strftime(day, '%Y-%m-%d') AS date, unix_ts, {fixed_sql('v')} AS market_price FROM daily""")
def _json_feed(spark, sf_dir):
    path, spec = scratch_path(spark, "feed"), feeds.feed("market_price")
    record = F.struct("event_type", F.date_format("date", "yyyy-MM-dd").alias("d"), F.col("unix_ts").alias("unixTs"), F.col("value").alias("btcPrice"))
    land_json(daily_values(spark, sf_dir), record, path, [])
    rows = feeds.read_json_feed(spark, path, spec.schema.add("event_type", "string"))
    out = feeds.load_feed(rows, spec, ["event_type"])
    return rounded(out.withColumn("date", F.date_format("date", "yyyy-MM-dd")))


@query("S01_json_variant_scan", """
SELECT event_id, CAST(props ->> '$.k' AS DOUBLE) AS k FROM events""")
def _variant(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    parsed = events.select("event_id", F.expr("try_parse_json(props)").alias("v"))
    return parsed.select("event_id", feeds.variant_field("k", "double").alias("k"))


METRICS = [(name, field, column) for name, spec in feeds.FEEDS.items() for field, column in spec.columns]
COLUMNS = [column for _, _, column in METRICS]
ON_SPINE = [i for i, (name, _, _) in enumerate(METRICS) if name in feeds.SPINE]

# every event counts for one of the columns; on every ninth day no feed of the spine has a record, and a
# record of every fifth day came an hour earlier with other values, without the stocks' first column
METRIC_SQL = f"""
metric AS (SELECT * FROM (SELECT event_id % {len(METRICS)} AS k, CAST(date_trunc('day', ts) AS DATE) AS day,
  CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS unix_ts, avg(value) AS v FROM events GROUP BY 1, 2, 3) m
  WHERE day(day) % 9 <> 0 OR k NOT IN ({', '.join(map(str, ON_SPINE))}))"""


def metric_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean of the events of each registered column: (k, date, unix_ts, value)."""
    at = F.col("ts").cast("timestamp")
    rows = table(spark, sf_dir, "events").groupBy((F.col("event_id") % len(METRICS)).alias("k"), F.to_date(at).alias("date")).agg(F.avg("value").alias("value"))
    return rows.filter((F.dayofmonth("date") % 9 != 0) | ~F.col("k").isin(ON_SPINE)).withColumn(
        "unix_ts", F.unix_timestamp(F.col("date").cast("timestamp")))


def land_registry(spark: SparkSession, sf_dir: str) -> str:
    """The files of all 33 feeds, with older records that later ones replace; the folder they stand in."""
    path, k = scratch_path(spark, "registry"), F.col("k")
    values = metric_values(spark, sf_dir)
    named = values.withColumn("feed", F.array(*(F.lit(n) for n, _, _ in METRICS))[k])
    early = named.filter(F.dayofmonth("date") % 5 == 0).withColumn("unix_ts", F.col("unix_ts") - 3600).withColumn("value", F.lit(-1.0))
    cells = [F.max(F.when(k == i, F.col("value"))).alias(field) for i, (_, field, _) in enumerate(METRICS)]
    rows = named.unionByName(early).groupBy("feed", "date", "unix_ts").agg(*cells)
    dates = {f.date_field for f in feeds.FEEDS.values()}
    text = F.when(F.col("feed") == "bitcoin_dominance", F.date_format("date", "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format("date", "yyyy-MM-dd"))
    own = {d: F.col("feed").isin([n for n, f in feeds.FEEDS.items() if f.date_field == d]) for d in dates}
    record = F.struct(*(F.when(own[d], text).alias(d) for d in sorted(dates)), F.col("unix_ts").alias("unixTs"), *(field for _, field, _ in METRICS))
    land_json(rows, record, path, ["feed"])
    return path


@query("S02_metric_registry_scan", f"""WITH {METRIC_SQL},
named AS (SELECT * FROM metric JOIN (VALUES {', '.join(f"({i}, '{n}', '{c}')" for i, (n, _, c) in enumerate(METRICS))}) x(k, feed, col) USING (k)),
feed_day AS (SELECT DISTINCT feed, day, unix_ts FROM named),
expected AS (SELECT f.feed, x.col, x.k, f.day, f.unix_ts FROM feed_day f
  JOIN (VALUES {', '.join(f"({i}, '{n}', '{c}')" for i, (n, _, c) in enumerate(METRICS))}) x(k, feed, col) USING (feed))
SELECT e.feed, e.col AS metric, strftime(e.day, '%Y-%m-%d') AS date, e.unix_ts, {fixed_sql('m.v')} AS value
FROM expected e LEFT JOIN metric m ON m.k = e.k AND m.day = e.day
UNION ALL SELECT e.feed, e.col, strftime(e.day, '%Y-%m-%d'), e.unix_ts - 3600, CASE WHEN m.v IS NOT NULL THEN -1.0::DOUBLE END
FROM expected e LEFT JOIN metric m ON m.k = e.k AND m.day = e.day WHERE day(e.day) % 5 = 0""")
def _registry(spark, sf_dir):
    """All 33 feeds, 42 columns, in one scan of byte ranges."""
    rows = feeds.read_registry(spark, land_registry(spark, sf_dir), 1 << 16)
    return rows.select("feed", F.col("column").alias("metric"), F.date_format("date", "yyyy-MM-dd").alias("date"), "unix_ts", fixed(F.col("value")).alias("value"))


@query("J01_global_wide_table", f"""WITH {METRIC_SQL},
s AS (SELECT DISTINCT day FROM metric WHERE k IN ({', '.join(map(str, ON_SPINE))})),
w AS (SELECT day, {', '.join(f"max(v) FILTER (k = {i}) AS {c}" for i, c in enumerate(COLUMNS))},
  {', '.join(f"max(unix_ts) FILTER (k = {[n for n, _, _ in METRICS].index(f)}) AS t{i}" for i, f in enumerate(feeds.STAMPS))} FROM metric GROUP BY 1)
SELECT strftime(day, '%Y-%m-%d') AS date, coalesce(t0, t1, t2) AS unix_ts, {', '.join(f"{fixed_sql(c)} AS {c}" for c in COLUMNS)},
  CASE WHEN day(day) % 2 = 0 THEN '2024-01-01 00:00:00' ELSE '2024-06-01 00:00:00' END AS created_at, '2024-06-01 00:00:00' AS updated_at
FROM w JOIN s USING (day)""")
def _global(spark, sf_dir):
    """33 feeds to the wide daily table, merged with audit columns into one that holds every second date already."""
    rows = feeds.read_registry(spark, land_registry(spark, sf_dir))
    wide = wide_from_long(rows, COLUMNS, list(feeds.SPINE), list(feeds.STAMPS))
    then, now = (F.to_timestamp(F.lit(x)) for x in ("2024-01-01 00:00:00", "2024-06-01 00:00:00"))
    stored = SnapshotTable(spark, scratch_path(spark, "global"), ("date",), F.date_format("date", "yyyy"))
    known = table(spark, sf_dir, "events").select(F.to_date(F.col("ts").cast("timestamp")).alias("date")).distinct().filter(F.dayofmonth("date") % 2 == 0)
    on_spine = known.filter((F.dayofmonth("date") % 9 != 0))
    empty = [F.lit(None).cast("double").alias(c) for c in COLUMNS]
    stored.create(on_spine.select("date", F.lit(0).cast("long").alias("unix_ts"), *empty, then.alias("created_at"), then.alias("updated_at")))
    out = stored.read(stored.merge(wide, now=now))
    return rounded(out.withColumn("date", F.date_format("date", "yyyy-MM-dd")).withColumn("created_at", iso("created_at")).withColumn("updated_at", iso("updated_at")))


@query("S03_kline_scan", f"""{bars_sql()}
SELECT CAST(t AS BIGINT) AS unix_timestamp, strftime(to_timestamp(t), '%Y-%m-%d') AS date,
  CAST(hour(to_timestamp(t)) AS BIGINT) AS hour_of_day, open, high, close, low, v AS volume_btc, symbol FROM b""")
def _klines(spark, sf_dir):
    path = scratch_path(spark, "klines")
    text = lambda c: F.col(c).cast("string")
    cells = [
        (F.col("unix_timestamp") * 1000).cast("string"), text("open"), text("high"), text("low"),
        text("close"), text("volume_btc"), (F.col("unix_timestamp") * 1000 + 3_599_999).cast("string"),
        text("volume_usd"),
    ]
    bars = fixtures.event_bars(spark, sf_dir)
    bars.select("symbol", F.to_json(F.array(*cells)).alias("value")).write.partitionBy("symbol").text(path)
    return feeds.read_klines(spark, path, ["symbol"]).select(
        "symbol", "unix_timestamp", F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.col("hour_of_day").cast("long").alias("hour_of_day"), "open", "high", "close", "low", "volume_btc",
    )


def land_price_csv(spark: SparkSession, sf_dir: str) -> str:
    """Date/Close files of every event type, in which every seventh day has an unreadable close."""
    path = scratch_path(spark, "prices")
    close = F.when(F.dayofmonth("date") % 7 == 0, "n/a").otherwise(F.col("value").cast("string"))
    daily_values(spark, sf_dir).select(
        "event_type", F.date_format("date", "yyyy-MM-dd").alias("Date"), F.lit("x").alias("Open"), close.alias("Close")
    ).write.option("header", True).partitionBy("event_type").csv(path)
    return path


@query("S04_csv_history_scan", f"""WITH {DAY_SQL}
SELECT event_type, strftime(day, '%Y-%m-%d') AS date, {fixed_sql('v')} AS close FROM daily WHERE day(day) % 7 <> 0""")
def _csv_history(spark, sf_dir):
    out = feeds.read_price_csv(spark, land_price_csv(spark, sf_dir), ["event_type"])
    return rounded(out.withColumn("date", F.date_format("date", "yyyy-MM-dd")))


@query("S04_csv_latest_row", f"""WITH {DAY_SQL}
SELECT event_type, strftime(max(day), '%Y-%m-%d') AS date, {fixed_sql('arg_max(v, day)')} AS close FROM daily
WHERE day(day) % 7 <> 0 GROUP BY 1""")
def _csv_latest(spark, sf_dir):
    out = feeds.latest_price(feeds.read_price_csv(spark, land_price_csv(spark, sf_dir), ["event_type"]), ["event_type"])
    return rounded(out.withColumn("date", F.date_format("date", "yyyy-MM-dd")))


@query("S05_ohlcv_csv_load", f"""{bars_sql()}
SELECT CAST(t AS BIGINT) AS unix_timestamp, strftime(to_timestamp(t), '%Y-%m-%d %H:%M:%S') AS datetime,
  open, high, close, low, v AS volume, symbol FROM b""")
def _ohlcv_csv(spark, sf_dir):
    path = scratch_path(spark, "ohlcv")
    fixtures.event_bars(spark, sf_dir).select(
        "symbol", F.col("unix_timestamp").alias("UNIX_TIMESTAMP"), F.col("open").alias("OPEN"),
        F.col("high").alias("HIGH"), F.col("close").alias("CLOSE"), F.col("low").alias("LOW"),
        F.col("volume_btc").alias("VOLUME"),
    ).write.option("header", True).partitionBy("symbol").csv(path)
    return feeds.read_ohlcv_csv(spark, path, ["symbol"]).withColumn("datetime", iso("datetime"))


URLS_PER_SITEMAP = 50_000     # limit of the sitemap format


def land_sitemap(spark: SparkSession, sf_dir: str) -> str:
    """Sitemap files of at most 50,000 addresses each, one folder per file."""
    path = scratch_path(spark, "sitemap")
    entry = F.concat(
        F.lit("<url><loc>\n  "), F.regexp_replace("url", "&", "&amp;"), F.lit("\n</loc></url>")
    )
    body = F.array_join(F.collect_list(entry), "")
    table(spark, sf_dir, "pages").groupBy(
        F.floor(F.col("page_id") / URLS_PER_SITEMAP).alias("part")
    ).agg(
        F.concat(
            F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), body, F.lit("</urlset>")
        ).alias("value")
    ).repartition("part").write.partitionBy("part").text(path)
    return path


@query("S06_sitemap_scan", "SELECT url, 'docs' AS service, 'dbt' AS type FROM pages")
def _sitemap(spark, sf_dir):
    return feeds.read_sitemap(spark, land_sitemap(spark, sf_dir), "docs", "dbt")


_SEED_ROWS = [
    (service, url, "dbt" if service.startswith("dbt") else "iics")
    for service, urls in SEEDS.items() for url in urls
]


@query("S07_seed_fallback", f"""
SELECT url, 'dbt-core' AS service, 'dbt' AS type FROM pages UNION ALL
SELECT url, service, type FROM (VALUES {', '.join(str(r) for r in _SEED_ROWS)}) s(service, url, type)
WHERE service <> 'dbt-core'""")
def _seeds(spark, sf_dir):
    scanned = feeds.read_sitemap(spark, land_sitemap(spark, sf_dir), "dbt-core", "dbt")
    seeds = feeds.inline_values(spark, _SEED_ROWS, "service string, url string, type string")
    return feeds.with_seeds(scanned, seeds)


def new_database(spark: SparkSession, name: str) -> str:
    """A database of its own in the shared folder."""
    full = f"{name}_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE `{full}` LOCATION '{scratch_path(spark, name)}'")
    return full


@query("S08_stored_table_scan", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(o_totalprice AS DOUBLE) AS close, o_orderkey FROM orders""")
def _stored(spark, sf_dir):
    db = new_database(spark, "stored")
    table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("date"),
        F.col("o_totalprice").cast("string").alias("close"),
    ).write.saveAsTable(f"`{db}`.bars")
    casts = {"date": "date", "close": "double", "o_orderkey": "long"}
    out = feeds.stored_table(spark, f"`{db}`.bars", casts)
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


_LABELS = [("click", 1), ("view", 2), ("error", 3), ("purchase", 4), ("signup", 5)]


@query("S09_inline_values", f"""
SELECT event_type, CAST(rank AS BIGINT) AS rank, count(*) AS n FROM events
JOIN (VALUES {', '.join(str(r) for r in _LABELS)}) v(event_type, rank) USING (event_type) GROUP BY 1, 2""")
def _inline(spark, sf_dir):
    labels = feeds.inline_values(spark, _LABELS, "event_type string, rank long")
    # a fixed list of five rows
    counts = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(labels, "event_type").select("event_type", "rank", "n")


def two_databases(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    left, right = new_database(spark, "analytics"), new_database(spark, "data")
    table(spark, sf_dir, "nation").write.saveAsTable(f"`{left}`.nation")
    table(spark, sf_dir, "region").write.saveAsTable(f"`{left}`.news")
    table(spark, sf_dir, "supplier").write.saveAsTable(f"`{right}`.supplier")
    spark.sql(f"CREATE VIEW `{right}`.v AS SELECT 1 AS one")
    return left, right


@query("S10_catalog_listing", """
SELECT 'analytics' AS db, 'nation' AS name, count(*) AS n FROM nation UNION ALL
SELECT 'analytics', 'news', count(*) FROM region UNION ALL
SELECT 'data', 'supplier', count(*) FROM supplier""")
def _listing(spark, sf_dir):
    found = feeds.list_tables(spark, list(two_databases(spark, sf_dir)))
    out = None
    for db, name in found:
        row = spark.table(f"`{db}`.`{name}`").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(db.rsplit("_", 1)[0]).alias("db"), F.lit(name).alias("name"), "n"
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("K05_fixed_precision_csv_export", f"""{bars_sql()}
SELECT symbol, CAST(t AS VARCHAR) AS unix_timestamp, printf('%.8f', open) AS open,
  printf('%.8f', close) AS close, printf('%.8f', volume_usd) AS volume_usd
FROM (SELECT b.*, u.volume_usd FROM b JOIN (SELECT event_type AS symbol, (epoch_us(ts) // 3600000000) * 3600 AS t,
  CAST(round(sum(value), 2) AS DOUBLE) AS volume_usd FROM events GROUP BY 1, 2) u USING (symbol, t)) z""")
def _csv_export(spark, sf_dir):
    path = scratch_path(spark, "export")
    bars = fixtures.event_bars(spark, sf_dir).withColumn("volume_usd", F.round("volume_usd", 2))
    sinks.export_csv(bars.select("symbol", "unix_timestamp", "open", "close", "volume_usd"), path, "unix_timestamp")
    return spark.read.option("header", True).csv(path)


@query("K06_quoted_csv_backup", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, replace(source || ',' || lang, ',', '') AS source,
  'say "' || lang || '"' AS title, '2024-01-31' AS folder FROM documents""")
def _backup(spark, sf_dir):
    path = scratch_path(spark, "backup")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat_ws(",", "source", "lang").alias("source"),
        F.concat(F.lit('say "'), F.col("lang"), F.lit('"')).alias("title"),
    )
    sinks.backup_csv(rows, path, "2024-01-31T05:00:00", ["source"])
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    return back.withColumn("folder", F.date_format("folder", "yyyy-MM-dd"))


@query("K07_bulk_table_copy", """
SELECT 'analytics_nation' AS copied, count(*) AS n FROM nation UNION ALL
SELECT 'data_supplier', count(*) FROM supplier""")
def _copy(spark, sf_dir):
    left, right = two_databases(spark, sf_dir)
    target = new_database(spark, "copy")
    skip = lambda db, name: db == left and name == "news"
    out = None
    for db, name in sinks.copy_tables(spark, target, skip, [left, right]):
        row = spark.table(f"`{target}`.`{db}_{name}`").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(f"{db.rsplit('_', 1)[0]}_{name}").alias("copied"), "n"
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("K09_vector_upsert_routed", f"""
SELECT CAST(vec_id AS VARCHAR) AS id, CASE WHEN label % 2 = 0 THEN 'dbt' ELSE 'iics' END AS type,
  {fixed_sql("list_sum(embedding::DOUBLE[])", 4)} AS total FROM embeddings""")
def _vectors(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), F.col("embedding").alias("values"),
        F.when(F.col("label") % 2 == 0, "dbt").otherwise("iics").alias("type"),
    )
    stored = vectors.filter("id % 3 = 0").withColumn("values", F.array(F.lit(0.0).cast("float")))
    path = scratch_path(spark, "vectors")
    sinks.write_vectors(upsert(stored, vectors, ["id"]), path, 100)
    total = F.aggregate("values", F.lit(0.0), lambda a, v: a + v.cast("double"))
    return spark.read.parquet(path).select("id", "type", fixed(total, 4).alias("total"))
