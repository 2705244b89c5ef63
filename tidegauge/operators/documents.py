"""Documentation pages to titled sections to embeddable chunks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.html import Element, clean_text, parse, tagged, with_attribute

HEADINGS = frozenset({"h1", "h2", "h3", "h4"})
EMBEDDED_CHARS, PREVIEW_CHARS = 8_000, 1_000
#: Bytes of HTML that are read together (a page is never cut).
PAGE_BYTES = 1 << 20
_SECTIONS = pa.list_(pa.struct([("heading", pa.string()), ("content", pa.string())]))


@dataclass(frozen=True)
class SiteRules:
    """Where a kind of site keeps its content (fixed values per site kind)."""

    containers: tuple[Callable[[Element], bool], ...]
    blocks: frozenset[str]
    removed: frozenset[str]                     # never part of a block's text
    cleared: frozenset[str] = frozenset()       # taken off the page first
    title_suffixes: tuple[str, ...] = ()
    min_section: int = 0                        # stripped length a section must exceed
    min_chunk: int = 1                          # length a chunk's content must reach


_TEXT = frozenset({"p", "ul", "ol", "pre"})
_PLAIN = frozenset({"script", "style", "nav", "footer"})
_MIGRATION = dict(
    blocks=_TEXT | {"table", "blockquote"},
    removed=_PLAIN | {"header", "aside", "noscript"},
    cleared=frozenset({"nav", "aside", "footer", "header"}),
    title_suffixes=(
        r"(?i)\s*[-–|]\s*dbt Docs.*$", r"(?i)\s*[-–|]\s*Informatica.*$",
        r"(?i)\s*[-–|]\s*dbt Developer Hub.*$",
    ),
    min_section=30, min_chunk=50,
)
RULES: dict[str, SiteRules] = {
    "aws": SiteRules(
        (tagged("main"), tagged("article"), with_attribute("div", "id", "^main-content$"),
         with_attribute("div", "class", "^awsdocs-content$"), tagged("body")),
        _TEXT | {"table"}, _PLAIN | {"header", "aside"},
        title_suffixes=(r"\s*[-–]\s*Amazon Web Services.*$", r"\s*[-–]\s*AWS Documentation.*$"),
        min_chunk=50,
    ),
    "warehouse": SiteRules((tagged("main"), tagged("article"), tagged("body")), _TEXT, _PLAIN),
    "dbt": SiteRules(
        (tagged("article"), with_attribute("div", "class", "docItemContainer|markdown"),
         tagged("main"), tagged("body")), **_MIGRATION,
    ),
    "iics": SiteRules(
        (with_attribute("div", "id", "content|main", re.I), tagged("main"), tagged("article"),
         tagged("body")), **_MIGRATION,
    ),
}


def _drop(root: Element, tags: frozenset[str]) -> None:
    for node in [root, *root.walk()]:
        node.children = [c for c in node.children if isinstance(c, str) or c.tag not in tags]


def page_sections(html: str, rules: SiteRules) -> tuple[str, list[tuple[str, str]]]:
    """(raw title, [(heading, content)]): headings open a section, blocks add text.

    Blocks are visited in document order, so a paragraph inside a list adds its
    text twice: within the list and by itself.
    """
    root = parse(html)
    if rules.cleared:
        _drop(root, rules.cleared)
    titled = root.find(tagged("h1")) or root.find(tagged("title"))
    title = titled.text().strip() if titled is not None else ""
    main = next((m for m in (root.find(test) for test in rules.containers) if m is not None), None)
    sections: list[tuple[str, str]] = []
    heading, content = "", ""
    for node in main.walk() if main is not None else ():
        if node.tag in HEADINGS:
            if content.strip():
                sections.append((heading, content))
            heading, content = node.text().strip(), ""
        elif node.tag in rules.blocks:
            text = clean_text(node.text(rules.removed))
            if text:
                content += text + "\n\n"
    if content.strip():
        sections.append((heading, content))
    return title, [s for s in sections if len(s[1].strip()) > rules.min_section]


def extract(pages: DataFrame, kind: str) -> DataFrame:
    """pages(url, html) to (url, title, n_sections, sections array)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = RULES[kind]
        for batch in batches:
            until = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
            at = 0
            while at < batch.num_rows:
                to = int(np.searchsorted(until, PAGE_BYTES + (until[at - 1] if at else 0))) + 1
                some = batch.slice(at, to - at)
                found = [page_sections(html or "", rules) for html in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([title for title, _ in found], pa.string()),
                     pa.array([[{"heading": h, "content": c} for h, c in sections] for _, sections in found], _SECTIONS)],
                    names=["url", "raw_title", "sections"])
                at = to

    schema = "url string, raw_title string, sections array<struct<heading string, content string>>"
    out = pages.select("url", "html").mapInArrow(run, schema)
    return out.select("url", clean_title(F.col("raw_title"), kind).alias("title"), "raw_title", "sections")


def clean_title(title: Column, kind: str) -> Column:
    """Title without the site's own suffixes."""
    for suffix in RULES[kind].title_suffixes:
        title = F.regexp_replace(title, suffix, "")
    return F.regexp_replace(title, r"^\s+|\s+$", "")


def section_rows(extracted: DataFrame) -> DataFrame:
    """One row per section; ``idx`` counts before any length filter."""
    return extracted.select(
        "url", "title", F.posexplode("sections").alias("idx", "_s")
    ).select("url", "title", "idx", F.col("_s.heading").alias("heading"), F.col("_s.content").alias("content"))


def long_enough(sections: DataFrame, kind: str) -> DataFrame:
    blank = F.regexp_replace("content", r"\s", "") == ""
    return sections.filter(~blank & (F.length("content") >= RULES[kind].min_chunk))


def role_of(kind: str) -> str | None:
    """Part of a page of this kind in a migration; other kinds have none."""
    return {"dbt": "dbt (migration target)", "iics": "Informatica IICS (migration source)"}.get(kind)


def chunk_text(kind: str, service: Column) -> Column:
    """Context lines, optional section line and content."""
    title = F.coalesce(F.col("title"), F.lit(""))
    if kind == "aws":
        head = F.concat(F.lit("AWS Service: "), F.upper(service), F.lit("\nTitle: "), title, F.lit("\n"))
    elif kind == "warehouse":
        head = F.concat(F.lit("Title: "), title, F.lit("\n"))
    else:
        head = F.concat(
            F.lit(f"Migration context: IICS → dbt\nTool: {role_of(kind)}\nService: "), service,
            F.lit("\nPage: "), title, F.lit("\n"),
        )
    section = F.when(
        F.coalesce(F.col("heading"), F.lit("")) != "",
        F.concat(F.lit("Section: "), F.col("heading"), F.lit("\n\n")),
    ).otherwise("")
    return F.concat(head, section, F.col("content"))


def chunk_id(url: str = "url", idx: str = "idx") -> Column:
    return F.md5(F.concat_ws("_", F.col(url), F.col(idx).cast("string")))


def chunks(sections: DataFrame, kind: str, service: Column, scraped_at: Column) -> DataFrame:
    text = chunk_text(kind, service)
    return long_enough(sections, kind).select(
        chunk_id().alias("id"), "url", service.alias("service"), F.lit(kind).alias("type"),
        F.lit(role_of(kind)).cast("string").alias("role"), "title",
        F.col("heading").alias("section"), F.substring(text, 1, EMBEDDED_CHARS).alias("embed_text"),
        F.substring(text, 1, PREVIEW_CHARS).alias("text"), scraped_at.alias("scraped_at"),
    )


Embedder = Callable[[DataFrame, str, int], DataFrame]


def hashed_embedding(df: DataFrame, text: str, size: int) -> DataFrame:
    """Default embedding: unit-length hashed word counts; no model needed."""
    words = df.withColumn("_words", F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\W+"))
    counted = HashingTF(numFeatures=size, inputCol="_words", outputCol="_tf").transform(words)
    unit = Normalizer(inputCol="_tf", outputCol="_unit", p=2.0).transform(counted)
    return unit.withColumn("values", vector_to_array("_unit", "float32")).drop("_words", "_tf", "_unit")


def embed(df: DataFrame, text: str = "embed_text", size: int = 1536, embedder: Embedder = hashed_embedding) -> DataFrame:
    """Adds ``values``; rows without a vector are dropped."""
    return embedder(df, text, size).filter(F.col("values").isNotNull())


def cosine(a: Column, b: Column) -> Column:
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm != 0, dot(a, b) / norm)


def nearest(vectors: DataFrame, query: list[float], k: int, vector: str = "values", key: str = "id") -> DataFrame:
    """Top-k report for one query vector, by cosine."""
    target = F.array(*(F.lit(float(v)) for v in query))
    scored = vectors.select(key, cosine(F.col(vector), target).alias("score"))
    return scored.orderBy(F.col("score").desc(), key).limit(k)


def topical(urls: DataFrame, topics: tuple[str, ...], skipped: tuple[str, ...]) -> DataFrame:
    """Addresses that contain a topic and no skip pattern (both lower-cased)."""
    url = F.lower("url")
    wanted = "|".join(re.escape(t.lower()) for t in dict.fromkeys(topics))
    unwanted = "|".join(re.escape(t.lower()) for t in skipped)
    return urls.filter(url.rlike(wanted) & ~url.rlike(unwanted))
