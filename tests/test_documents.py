"""Sections and chunks of small pages."""

from __future__ import annotations

import gc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegauge.functions.html import clean_text, parse
from tidegauge.functions.topics import AWS_SKIPPED, AWS_TOPICS
from tidegauge.operators import documents as docs

PAGE = """<html><head><title>T &amp; x</title><script>var p = "<p>no</p>";</script></head><body>
<nav><p>menu</p></nav><header><h1>Site</h1></header>
<main><h1>Guide - Amazon Web Services docs</h1><p>Intro  text<br>second line</p>
<h2>Part one</h2><ul><li><p>nested point</p></li><li>plain</li></ul><pre>code
 line</pre><table><tr><td>cell</td></tr></table>
<h3>Empty</h3><h4>Quote</h4><blockquote>said <script>x()</script>so</blockquote><p>  </p>
</main><footer><p>foot</p></footer></body></html>"""


def test_sections_in_document_order():
    title, sections = docs.page_sections(PAGE, docs.RULES["aws"])
    assert title == "Site"
    assert sections[0] == ("Guide - Amazon Web Services docs", "Intro textsecond line\n\n")
    # the paragraph inside the list counts within the list and by itself
    assert sections[1] == ("Part one", "nested pointplain\n\nnested point\n\ncode line\n\ncell\n\n")
    # quotes are no block for this kind of site, so the last heading stays empty
    assert len(sections) == 2


def test_navigation_is_cleared_first_for_migration_pages():
    title, sections = docs.page_sections(PAGE, docs.RULES["dbt"])
    assert title == "Guide - Amazon Web Services docs"
    assert [h for h, _ in sections] == ["Part one"]       # others are 30 characters or fewer
    assert "menu" not in str(sections) and "foot" not in str(sections)


def test_container_order():
    page = "<body><div id='Main-Content'><p>in div</p></div><main><p>in main</p></main><article><p>in article</p></article></body>"
    first = {k: docs.page_sections(page, docs.SiteRules(**{**docs.RULES[k].__dict__, "min_section": 0}))[1][0][1] for k in docs.RULES}
    assert first == {"aws": "in main\n\n", "warehouse": "in main\n\n", "dbt": "in article\n\n", "iics": "in div\n\n"}


def test_implied_paragraph_ends():
    root = parse("<div><p>one <b>bold<p>two<ul><li>a<li>b</ul>three</div><p>four")
    assert [e.text() for e in root.walk() if e.tag == "p"] == ["one bold", "two", "four"]
    assert [e.text() for e in root.walk() if e.tag == "li"] == ["a", "b"]


def test_clean_text():
    assert clean_text("  a  b \n\n c   d\n") == "a b c d"


def test_a_tree_leaves_nothing_to_the_cycle_collector():
    gc.collect()
    gc.disable()
    try:
        page = PAGE + "<div>" * 3000 + "deep"
        assert docs.page_sections(page, docs.RULES["dbt"])[0] == "Guide - Amazon Web Services docs"
        assert gc.collect() == 0
    finally:
        gc.enable()


def test_pages_of_a_batch_are_read_few_at_a_time(spark):
    class Held:
        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            self.run = run
            return spark.createDataFrame([], schema)

    held, html = Held(), "<main><p>" + "x" * 500_000
    docs.extract(held, "aws")
    batch = pa.RecordBatch.from_arrays([pa.array("abcdefghi"), pa.array([None, "", *[html] * 6, "<h1>t</h1><main><p>y"])], names=["url", "html"])
    out = list(held.run(iter([batch])))
    assert max(o.num_rows for o in out) <= 5  # of a million bytes
    assert [r for o in out for r in o.column("url").to_pylist()] == list("abcdefghi")
    assert [len(r) for o in out for r in o.column("sections").to_pylist()] == [0, 0, *[1] * 7]


@pytest.fixture
def extracted(spark):
    pages = spark.createDataFrame([("http://x/s3", PAGE), ("http://y", None)], "url string, html string")
    return docs.extract(pages, "aws")


def test_chunks(extracted):
    rows = docs.section_rows(extracted)
    assert rows.count() == 2
    chunks = docs.chunks(rows, "aws", F.lit("s3"), F.lit("2024"))
    r = chunks.first()
    assert chunks.count() == 1      # the first section is shorter than 50 characters
    assert r.text.startswith("AWS Service: S3\nTitle: Site\nSection: Part one\n\nnested point")
    # the index counts before the filter
    assert r.id == rows.filter("idx = 1").select(docs.chunk_id()).first()[0]


def test_titles_lose_site_suffixes(spark):
    df = spark.createDataFrame([("Guide - Amazon Web Services docs",), ("A | DBT Docs",)], "t string")
    assert df.select(docs.clean_title(F.col("t"), "aws")).first()[0] == "Guide"
    assert df.select(docs.clean_title(F.col("t"), "dbt")).collect()[1][0] == "A"


def test_hashed_embedding_is_unit_length_and_by_content(spark):
    df = spark.createDataFrame([("a", "red green red"), ("b", "green red red"), ("c", "blue")], "id string, embed_text string")
    vectors = {r.id: r["values"] for r in docs.embed(df, size=256).collect()}
    assert all(abs(sum(v * v for v in x) - 1) < 1e-6 for x in vectors.values())
    assert vectors["a"] == vectors["b"] != vectors["c"] and len(vectors["a"]) == 256
    near = docs.nearest(docs.embed(df, size=256), list(vectors["a"]), 2).collect()
    assert [r.id for r in near] == ["a", "b"] and near[0].score == pytest.approx(1)


def test_topic_filter_compares_lower_case(spark):
    urls = ["http://h/S3/guide", "http://h/APIReference/s3", "http://h/none", "http://h/cli/s3"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [r.url for r in docs.topical(df, AWS_TOPICS, AWS_SKIPPED).collect()]
    assert got == ["http://h/S3/guide"]
