"""Merge, delta, union and latest-row queries on keyed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions.topics import AWS_SKIPPED, AWS_TOPICS, DBT_TOPICS, IICS_TOPICS, MIGRATION_SKIPPED, WAREHOUSE_SKIPPED, WAREHOUSE_TOPICS
from tidegauge.operators import keyed as ops
from tidegauge.operators.documents import topical
from tidegauge.operators.slices import missing_ranges
from tidegauge.plans import fixtures
from tidegauge.plans.catalog import fixed, fixed_sql, iso, query, rounded
from tidegauge.plans.catalog.series import bars_sql
from tidegauge.plans.catalog.sources import DAY_SQL, daily_values, of_type
from tidegauge.session import scratch_path, table
from tidegauge.sources.snapshots import SnapshotTable, hashed

KEYS_SQL = """
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
  o_orderkey DESC) AS rn FROM orders) z WHERE rn = 1),
tgt AS (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS price, arg_max(o_orderstatus, o_orderkey) AS status
  FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1),
src AS (SELECT o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS price,
  o_orderstatus AS status FROM latest WHERE o_orderkey % 3 <> 0)"""


def customer_tables(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    target = ops.latest_per_key(
        orders.filter("o_orderkey % 2 = 0").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus"),
        ["o_custkey"], [F.col("o_orderkey")],
    ).select("o_custkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    latest = ops.latest_per_key(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    source = latest.filter("o_orderkey % 3 <> 0").select(
        "o_custkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("price"),
        F.col("o_orderstatus").alias("status"),
    )
    return target, source


def kept_table(spark, df, keys, parts: int = 8) -> SnapshotTable:
    """df as a new stored table, in partitions by hash of the key."""
    kept = SnapshotTable(spark, scratch_path(spark, "table"), tuple(keys), hashed(keys, parts))
    kept.create(df)
    return kept


@query("K01_upsert_by_key", f"""WITH {KEYS_SQL}
SELECT coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
  CASE WHEN s.o_custkey IS NOT NULL THEN s.price ELSE t.price END AS price,
  CASE WHEN s.o_custkey IS NOT NULL THEN s.status ELSE t.status END AS status
FROM tgt t FULL OUTER JOIN src s ON t.o_custkey = s.o_custkey""")
def _upsert(spark, sf_dir):
    target, source = customer_tables(spark, sf_dir)
    kept = kept_table(spark, target, ["o_custkey"])
    return kept.read(kept.merge(source))


@query("K02_upsert_with_audit", f"""WITH {KEYS_SQL}
SELECT coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
  CASE WHEN s.o_custkey IS NOT NULL THEN s.price ELSE t.price END AS price,
  CASE WHEN t.o_custkey IS NULL THEN '2024-06-01 00:00:00' ELSE '2024-01-01 00:00:00' END AS created_at,
  CASE WHEN s.o_custkey IS NOT NULL THEN '2024-06-01 00:00:00' ELSE '2024-01-01 00:00:00' END AS updated_at
FROM tgt t FULL OUTER JOIN src s ON t.o_custkey = s.o_custkey""")
def _audit(spark, sf_dir):
    target, source = customer_tables(spark, sf_dir)
    then, now = (F.to_timestamp(F.lit(x)) for x in ("2024-01-01 00:00:00", "2024-06-01 00:00:00"))
    target = target.drop("status").withColumn("created_at", then).withColumn("updated_at", then)
    kept = kept_table(spark, target, ["o_custkey"])
    out = kept.read(kept.merge(source.drop("status"), now=now))
    return out.withColumn("created_at", iso("created_at")).withColumn("updated_at", iso("updated_at"))


@query("K03_partial_column_upsert", f"""WITH {KEYS_SQL}
SELECT coalesce(t.o_custkey, s.o_custkey) AS o_custkey,
  CASE WHEN s.o_custkey IS NOT NULL THEN s.price ELSE t.price END AS price, t.status AS status
FROM tgt t FULL OUTER JOIN src s ON t.o_custkey = s.o_custkey""")
def _partial(spark, sf_dir):
    target, source = customer_tables(spark, sf_dir)
    kept = kept_table(spark, target, ["o_custkey"])
    return kept.read(kept.merge(source, update=["price"]))


@query("K04_insert_only_merge", f"""WITH {KEYS_SQL}
SELECT * FROM tgt UNION ALL SELECT * FROM src WHERE o_custkey NOT IN (SELECT o_custkey FROM tgt)""")
def _insert_new(spark, sf_dir):
    return ops.insert_new(*customer_tables(spark, sf_dir), ["o_custkey"])


@query("W01_latest_row_per_key", f"""WITH {KEYS_SQL}
SELECT o_custkey, o_orderkey, o_totalprice FROM latest""")
def _latest(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    out = ops.latest_per_key(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return out.drop("o_orderdate")


@query("T01_order_by_key", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey")
def _ordered(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey")


@query("T02_latest_n_per_symbol", f"""{bars_sql()}
SELECT symbol, CAST(t AS BIGINT) AS unix_timestamp, close FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY t DESC) AS k FROM b) z WHERE k <= 100""")
def _newest_bars(spark, sf_dir):
    bars = fixtures.event_bars(spark, sf_dir).select("symbol", "unix_timestamp", "close")
    return ops.latest_rows(bars, "unix_timestamp", 100, ["symbol"]).orderBy("symbol", "unix_timestamp")


@query("T02_latest_n", "SELECT * FROM (SELECT event_id, value FROM events ORDER BY event_id DESC LIMIT 1000) z ORDER BY event_id")
def _newest(spark, sf_dir):
    return ops.latest_rows(table(spark, sf_dir, "events").select("event_id", "value"), "event_id", 1000).orderBy("event_id")


@query("T03_latest_close", f"""{bars_sql()}
SELECT symbol, arg_max(close, t) AS close FROM b GROUP BY 1""")
def _latest_close(spark, sf_dir):
    return fixtures.event_bars(spark, sf_dir).groupBy("symbol").agg(F.max_by("close", "unix_timestamp").alias("close"))


@query("T05_cap_per_run", "SELECT page_id, url FROM pages WHERE page_id % 2 = 1 ORDER BY page_id LIMIT 100")
def _capped(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    seen = pages.filter("page_id % 2 = 0").select("url")
    return ops.capped(ops.missing_rows(pages, seen, ["url"]), ["page_id"], 100)


@query("J04_anti_join_delta", "SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 2 = 0)")
def _delta(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return ops.delta(pages, pages.filter("page_id % 2 = 0"), "url")


@query("U04_set_difference", "SELECT o_custkey FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_orderkey % 2 = 0")
def _difference(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_custkey").subtract(orders.filter("o_orderkey % 2 = 0").select("o_custkey"))


# several pages may have one url, and a page may come several times
PAGE = ["url", "page_id"]


def page_entries(spark, sf_dir):
    """Each page once, with the number of its rows."""
    return table(spark, sf_dir, "pages").groupBy(*PAGE).agg(F.count(F.lit(1)).alias("copies"))


@query("K08_registry_append", """
SELECT url, '2024-02-01' AS scraped_at, CASE WHEN page_id % 3 = 0 THEN 'new' ELSE 'old' END AS title,
  'dbt' AS type FROM pages WHERE page_id % 3 = 0
UNION ALL SELECT url, '2024-01-01', 'old', 'dbt' FROM pages WHERE page_id % 3 <> 0 AND page_id % 2 = 0""")
def _registry(spark, sf_dir):
    pages = page_entries(spark, sf_dir)
    entry = lambda df, day, title: df.select(
        *PAGE, "copies", F.lit(day).alias("scraped_at"), F.lit(title).alias("title"), F.lit("dbt").alias("type")
    )
    registry = entry(pages.filter("page_id % 2 = 0"), "2024-01-01", "old")
    kept = kept_table(spark, registry, PAGE)
    merged = kept.read(kept.merge(entry(pages.filter("page_id % 3 = 0"), "2024-02-01", "new")))
    each = merged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select("url", "scraped_at", "title", "type")


def _like(words, negate=False):
    tests = [f"contains(lower(url), '{w.lower()}')" for w in dict.fromkeys(words)]
    return f"NOT ({' OR '.join(tests)})" if negate else f"({' OR '.join(tests)})"


for _name, _topics, _skip in (
    ("aws", AWS_TOPICS, AWS_SKIPPED), ("warehouse", WAREHOUSE_TOPICS, WAREHOUSE_SKIPPED),
    ("dbt", DBT_TOPICS, MIGRATION_SKIPPED), ("iics", IICS_TOPICS, MIGRATION_SKIPPED),
):
    @query(f"P14_topic_filter_{_name}", f"""
SELECT page_id, url FROM (SELECT page_id, url || CASE page_id % 4 WHEN 0 THEN '/Tables/' WHEN 1 THEN '/guide'
  WHEN 2 THEN '/apireference/API-Reference/' ELSE '' END AS url FROM pages) p
WHERE {_like(_topics)} AND {_like(_skip, True)}""")
    def _topical(spark, sf_dir, topics=_topics, skip=_skip):
        ending = F.expr(
            "CASE page_id % 4 WHEN 0 THEN '/Tables/' WHEN 1 THEN '/guide' WHEN 2 THEN "
            "'/apireference/API-Reference/' ELSE '' END"
        )
        pages = table(spark, sf_dir, "pages").select("page_id", F.concat("url", ending).alias("url"))
        return topical(pages, topics, skip)


@query("A04_table_status", f"""{bars_sql()}
SELECT count(*) AS n_rows, CAST(min(t) AS BIGINT) AS first_key, CAST(coalesce(max(t), 0) AS BIGINT) AS last_key,
  'delta' AS action FROM b""")
def _status(spark, sf_dir):
    stored = fixtures.event_bars(spark, sf_dir).select("unix_timestamp", F.lit(None).cast("long").alias("_source"))
    arrived = table(spark, sf_dir, "events").select(
        F.lit(None).cast("long").alias("unix_timestamp"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("_source"),
    )
    return ops.table_status(stored.unionByName(arrived), "unix_timestamp", "_source")


# -- dates ---------------------------------------------------------------------------
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
_GAPS_SQL = f"""WITH {DAY_SQL},
g AS (SELECT * FROM daily WHERE (day(day) + CASE event_type {' '.join(
    f"WHEN '{e}' THEN {i}" for i, e in enumerate(EVENT_TYPES))} END) % 6 <> 0)"""


def gapped(spark, sf_dir):
    """Daily series per event type, each without some days."""
    rows = daily_values(spark, sf_dir)
    return {
        e: of_type(rows, e).filter((F.dayofmonth("date") + i) % 6 != 0) for i, e in enumerate(EVENT_TYPES)
    }


_SPINE = ("click", "view")
_FIRST3 = EVENT_TYPES[:3]


@query("J01_date_spine_wide_join", f"""{_GAPS_SQL},
s AS (SELECT DISTINCT day FROM g WHERE event_type IN {_SPINE})
SELECT strftime(s.day, '%Y-%m-%d') AS date, coalesce({', '.join(f'{e}.unix_ts' for e in _FIRST3)}) AS unix_ts,
  {', '.join(f"{fixed_sql(f'{e}.v')} AS {e}" for e in EVENT_TYPES)} FROM s
{' '.join(f"LEFT JOIN (SELECT * FROM g WHERE event_type = '{e}') {e} ON {e}.day = s.day" for e in EVENT_TYPES)}""")
def _wide(spark, sf_dir):
    out = ops.wide_by_date(gapped(spark, sf_dir), list(_SPINE))
    return rounded(out.withColumn("date", F.date_format("date", "yyyy-MM-dd")))


@query("U01_union_distinct_dates", f"{_GAPS_SQL} SELECT DISTINCT strftime(day, '%Y-%m-%d') AS date FROM g WHERE event_type IN {_SPINE}")
def _spine(spark, sf_dir):
    series = gapped(spark, sf_dir)
    return ops.date_spine([series[e] for e in _SPINE]).select(F.date_format("date", "yyyy-MM-dd").alias("date"))


@query("A05_distinct_dates", "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date FROM events")
def _distinct(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("date")).distinct()


_ALIGNED = ", ".join(fixed_sql(f"max(v) FILTER (event_type = '{e}')") + f" AS {e}" for e in EVENT_TYPES)


@query("J05_outer_align_by_date", f"{_GAPS_SQL} SELECT strftime(day, '%Y-%m-%d') AS date, {_ALIGNED} FROM g GROUP BY 1")
def _aligned(spark, sf_dir):
    """Every series, each date once with an early value and once with the later one that counts; one scan."""
    i = F.array_position(F.array(*(F.lit(e) for e in EVENT_TYPES)), F.col("event_type")) - 1
    late = daily_values(spark, sf_dir).filter((F.dayofmonth("date") + i) % 6 != 0)
    both = F.explode(F.array(F.struct(F.lit(-1.0).alias("value"), F.lit(0).alias("ord")), F.struct("value", F.lit(1).alias("ord"))))
    rows = late.select("date", F.col("event_type").alias("series"), both.alias("r")).select("date", "series", "r.*")
    return rounded(ops.aligned(rows, list(EVENT_TYPES)).withColumn("date", F.date_format("date", "yyyy-MM-dd")))


_GRID = f"""{bars_sql()},
x AS (SELECT symbol, min(t) AS a, max(t) AS z FROM b GROUP BY 1),
g AS (SELECT symbol, unnest(range(CAST(a AS BIGINT), CAST(z AS BIGINT) + 1, 3600)) AS unix_timestamp FROM x)"""


def grid(spark, sf_dir):
    bars = fixtures.event_bars(spark, sf_dir)
    bounds = bars.groupBy("symbol").agg(
        F.min("unix_timestamp").alias("first_ts"), F.max("unix_timestamp").alias("last_ts")
    )
    return bars, ops.hour_grid(bounds)


@query("P24_expected_hour_grid", f"{_GRID} SELECT symbol, unix_timestamp FROM g")
def _grid(spark, sf_dir):
    return grid(spark, sf_dir)[1]


@query("R06_missing_range_selection", f"{_GRID} SELECT symbol, unix_timestamp FROM g WHERE (symbol, unix_timestamp) NOT IN (SELECT (symbol, CAST(t AS BIGINT)) FROM b)")
def _missing(spark, sf_dir):
    bars, hours = grid(spark, sf_dir)
    return ops.missing_rows(hours, bars, ["symbol", "unix_timestamp"])


@query("R06_missing_ranges", f"""{bars_sql(1)}
SELECT symbol, CAST(t + 60 AS BIGINT) AS first_missing, CAST(t2 - 60 AS BIGINT) AS last_missing, CAST((t2 - t) / 60 - 1 AS BIGINT) AS n_missing
FROM (SELECT symbol, t, lead(t) OVER (PARTITION BY symbol ORDER BY t) AS t2 FROM b) z WHERE t2 - t > 60""")
def _missing_ranges(spark, sf_dir):
    """Minute bars, cut into days: one row per gap instead of a grid of all minutes."""
    bars = fixtures.event_bars(spark, sf_dir, 1).select("symbol", "unix_timestamp")
    return missing_ranges(bars, ["symbol"], "unix_timestamp", 60, 86_400)


@query("R07_delta_crawl_registry", """
SELECT count(*) AS known, count(*) FILTER (WHERE page_id % 2 = 1) AS fetched FROM pages""")
def _crawl(spark, sf_dir):
    pages = page_entries(spark, sf_dir)
    entry = lambda df, title: df.select(*PAGE, "copies", F.lit(title).alias("title"))
    registry = entry(pages.filter("page_id % 2 = 0"), "old")
    kept = kept_table(spark, registry, PAGE)
    fresh = ops.delta(pages, kept.read(), *PAGE)
    merged = kept.read(kept.merge(entry(fresh, "new"), insert_only=True))
    rows = lambda copies: F.coalesce(F.sum(copies), F.lit(0))
    return merged.agg(rows("copies").alias("known"), rows(F.when(F.col("title") == "new", F.col("copies"))).alias("fetched"))


@query("P19_high_watermark_filter", """
SELECT doc_id, n_chars FROM documents WHERE doc_id > coalesce((SELECT max(doc_id) FROM documents
  WHERE doc_id <= (SELECT avg(doc_id) FROM documents)), -1) AND trim(coalesce(text, '')) <> ''""")
def _watermark(spark, sf_dir):
    """Stored are the documents up to the mean id; about half of the table lies above the mark at any size."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "text")
    middle = docs.agg(F.avg("doc_id").alias("_middle"))  # one row
    stored = docs.join(F.broadcast(middle), F.col("doc_id") <= F.col("_middle"), "left_semi")
    return ops.newer_than_stored(docs, stored, "doc_id", "text").drop("text")


@query("P21_warmup_skip", f"""{bars_sql(30)}
SELECT symbol, CAST(t AS BIGINT) AS unix_timestamp FROM r WHERE i >= 720""")
def _warm(spark, sf_dir):
    from tidegauge.plans.indicators import skip_warmup

    return skip_warmup(fixtures.event_bars(spark, sf_dir, 30)).select("symbol", "unix_timestamp")
