"""Page queries: sections, chunks, vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.operators import documents as docs
from tidegauge.operators.cells import CellIndex
from tidegauge.plans.catalog import fixed, fixed_sql, query
from tidegauge.session import scratch_path, spread, table

def pages_of(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages").select("url", "html"))


# HTML reads these entities without their semicolon, too
_ENTITIES = {
    "lt": "'<'", "gt": "'>'", "quot": "chr(34)", "#39": "chr(39)", "nbsp": "chr(160)", "amp": "'&'",
}
TITLE_SQL = "regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 's')"
for _entity, _text in _ENTITIES.items():
    TITLE_SQL = f"regexp_replace({TITLE_SQL}, '&{_entity};?', {_text}, 'g')"


@query("D01_title_extraction", f"SELECT url, trim({TITLE_SQL}) AS title FROM pages")
def _titles(spark, sf_dir):
    return docs.extract(pages_of(spark, sf_dir), "warehouse").select("url", F.col("raw_title").alias("title"))


_SUFFIXES = (" - Amazon Web Services docs", " – AWS Documentation", " | dbt Docs", "")


@query("D02_title_suffix_cleanup", f"SELECT doc_id, lang || '-' || source AS title FROM documents")
def _clean_titles(spark, sf_dir):
    suffix = F.element_at(F.array(*(F.lit(s) for s in _SUFFIXES)), (F.col("doc_id") % 4 + 1).cast("int"))
    title = F.concat("lang", F.lit("-"), "source", suffix)
    cleaned = docs.clean_title(docs.clean_title(title, "aws"), "dbt")
    return table(spark, sf_dir, "documents").select("doc_id", cleaned.alias("title"))


@query("D03_main_container", "SELECT url, contains(html, '<article') AS has_content FROM pages")
def _container(spark, sf_dir):
    found = docs.extract(pages_of(spark, sf_dir), "aws")
    return found.select("url", (F.size("sections") > 0).alias("has_content"))


@query("D04_section_segmentation")
def _sections(spark, sf_dir):
    out = None
    for kind in docs.RULES:
        rows = docs.section_rows(docs.extract(pages_of(spark, sf_dir), kind))
        rows = rows.select(F.lit(kind).alias("kind"), "url", "idx", "heading", F.length("content").alias("n_chars"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("D05_text_cleanup")
def _clean(spark, sf_dir):
    rows = docs.section_rows(docs.extract(pages_of(spark, sf_dir), "aws"))
    return rows.select("url", "idx", F.md5("content").alias("content"))


# documents as sections, so that the chunk rules compare with SQL
_SECTION_SQL = """WITH s AS (SELECT doc_id, source AS url, lang AS service, 'T' || doc_id AS title, doc_id % 9 AS idx,
  CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'H' || lang END AS heading, text AS content FROM documents)"""
_LONG = "length(regexp_replace(content, '\\s', '', 'g')) > 0"


def sections(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("url"), F.col("lang").alias("service"),
        F.concat(F.lit("T"), F.col("doc_id")).alias("title"), (F.col("doc_id") % 9).alias("idx"),
        F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("H"), F.col("lang"))).alias("heading"),
        F.col("text").alias("content"),
    )


@query("D06_small_section_filter", f"""{_SECTION_SQL}
SELECT 'aws' AS kind, doc_id FROM s WHERE {_LONG} AND length(content) >= 50 UNION ALL
SELECT 'warehouse', doc_id FROM s WHERE {_LONG}""")
def _long(spark, sf_dir):
    rows = sections(spark, sf_dir)
    picked = [docs.long_enough(rows, k).select(F.lit(k).alias("kind"), "doc_id") for k in ("aws", "warehouse")]
    return picked[0].unionByName(picked[1])


_HEADS = {
    "aws": "'AWS Service: ' || upper(service) || chr(10) || 'Title: ' || title || chr(10)",
    "warehouse": "'Title: ' || title || chr(10)",
    "dbt": "'Migration context: IICS → dbt' || chr(10) || 'Tool: dbt (migration target)' || chr(10) || 'Service: ' || service || chr(10) || 'Page: ' || title || chr(10)",
    "iics": "'Migration context: IICS → dbt' || chr(10) || 'Tool: Informatica IICS (migration source)' || chr(10) || 'Service: ' || service || chr(10) || 'Page: ' || title || chr(10)",
}


def chunk_sql(kind: str) -> str:
    return (f"{_HEADS[kind]} || CASE WHEN heading <> '' THEN 'Section: ' || heading || chr(10) || chr(10) "
            "ELSE '' END || content")


@query("D07_chunk_text_template", _SECTION_SQL + " UNION ALL ".join(
    f" SELECT '{k}' AS kind, doc_id, md5({chunk_sql(k)}) AS text FROM s" for k in _HEADS))
def _templates(spark, sf_dir):
    rows, out = sections(spark, sf_dir), None
    for kind in _HEADS:
        text = F.md5(docs.chunk_text(kind, F.col("service"))).alias("text")
        part = rows.select(F.lit(kind).alias("kind"), "doc_id", text)
        out = part if out is None else out.unionByName(part)
    return out


@query("D08_chunk_id", f"{_SECTION_SQL} SELECT doc_id, md5(url || '_' || idx) AS id FROM s")
def _ids(spark, sf_dir):
    return sections(spark, sf_dir).select("doc_id", docs.chunk_id().alias("id"))


@query("D09_truncation", f"""{_SECTION_SQL}
SELECT md5(url || '_' || idx) AS id, title, md5(substr({chunk_sql('dbt')}, 1, 8000)) AS embed_text,
  substr({chunk_sql('dbt')}, 1, 1000) AS text FROM s WHERE {_LONG} AND length(content) >= 50""")
def _truncated(spark, sf_dir):
    out = docs.chunks(sections(spark, sf_dir), "dbt", F.col("service"), F.lit("2024-01-01"))
    return out.select("id", "title", F.md5("embed_text").alias("embed_text"), "text")


@query("D09_chunk_metadata", f"""{_SECTION_SQL}
SELECT 'dbt' AS type, 'dbt (migration target)' AS role, md5(url || '_' || idx) AS id, url, service, title, heading AS section, '2024-01-01' AS scraped_at
FROM s WHERE {_LONG} AND length(content) >= 50
UNION ALL SELECT 'iics', 'Informatica IICS (migration source)', md5(url || '_' || idx), url, service, title, heading, '2024-01-01' FROM s WHERE {_LONG} AND length(content) >= 50
UNION ALL SELECT 'aws', NULL, md5(url || '_' || idx), url, service, title, heading, '2024-01-01' FROM s WHERE {_LONG} AND length(content) >= 50""")
def _metadata(spark, sf_dir):
    """What is stored beside a chunk's vector, for pages with and without a part in a migration."""
    rows, out = sections(spark, sf_dir), None
    for kind in ("dbt", "iics", "aws"):
        part = docs.chunks(rows, kind, F.col("service"), F.lit("2024-01-01")).drop("embed_text", "text")
        out = part if out is None else out.unionByName(part)
    return out


@query("D10_embedding")
def _embedded(spark, sf_dir):
    pages = docs.section_rows(docs.extract(pages_of(spark, sf_dir), "aws"))
    chunks = docs.chunks(pages, "aws", F.lit("docs"), F.lit("2024-01-01"))
    norm = F.sqrt(F.aggregate("values", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))
    return docs.embed(chunks).select("id", F.size("values").alias("size"), fixed(norm, 4).alias("norm"))


@query("D11_cosine_top_k", f"""
WITH q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS q FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT query_id, vec_id, list_cosine_similarity(embedding::DOUBLE[], q) AS score FROM embeddings, q)
SELECT query_id, vec_id, {fixed_sql('score', 5)} AS score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s.score DESC, vec_id) <= 10""")
def _nearest(spark, sf_dir):
    """From the stored index, all cells visited."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = CellIndex(spark, scratch_path(spark, "cells")).build(vectors, "vec_id", "embedding")
    out = index.search(vectors.filter("vec_id % 50 = 0"), "vec_id", "embedding", 10)
    return out.select("query_id", F.col("id").alias("vec_id"), fixed(F.col("score"), 5).alias("score"))
