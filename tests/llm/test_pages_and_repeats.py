"""HTML text, repeated byte strings and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import ODD_TEXTS
from tidegauge.llm import queries as Q
from tidegauge.llm import repeats
from tidegauge.llm.bwt import sorted_suffixes
from tidegauge.llm.components import components
from tidegauge.llm.html_diff import common_lines, extract_main_text, lines_of
from tidegauge.llm.repeats import remove_repeats


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, text string")


def text_of(page):
    return " ".join(t for t, main in lines_of(page) if main)


def test_markup():
    assert text_of("<article><h1>A &amp; B</h1><p>one<br>two  <b>th</b>ree<p>caf&eacute; &lt;x&gt;</article><p>after") == "A & B one two three café <x>"
    assert text_of("<main>a<script>var t='</p>';</script><style>p{}</style><!-- <p>no --><aside>no</aside><div class='reader-comments'><p>no</div>b</main>") == "a b"
    assert text_of('<article>x<div class="article-body" title="a>b">y</div><form>no<input></form>z') == "x y z"
    assert text_of("<article><p>unclosed <i>tags<p>go on</article><footer>no</footer>") == "unclosed tags go on"
    assert lines_of(None) == lines_of("") == lines_of("<p") == []
    assert lines_of("plain &am") == [("plain &am", False)]


@pytest.mark.parametrize("wrapper", ["content with-sidebar", "has-header", "no-comments", "elementor-widget", "page-header sidebar"])
def test_marks_of_wrappers_do_not_empty_a_page(wrapper):
    page = f"<div class='{wrapper}'><article><p>whole text</article><div id=navBar>no</div></div><div class=sidebar>no</div>"
    assert lines_of(page) == [("whole text", True)]
    assert lines_of(f"<div class='{wrapper}'><p>most of the text</div><div class=cookie-notice>no</div>") == [("most of the text", False)]
    assert lines_of(f"<div class='{wrapper}'><p>one half</div><div class='{wrapper}'><p>the rest</div>") == [("one half", False), ("the rest", False)]


def test_marks_without_an_article_still_set_aside():
    page = "<p>the text of the page<div class='article-comments'>first</div><div class='social share'>on</div><aside><article>x</article></aside>"
    assert lines_of(page) == [("the text of the page", False)]
    assert lines_of("<div class=widget>ab</div><div class=sidebar>cd</div><div class=promo>ef</div>") == [("ab", False), ("cd", False), ("ef", False)]


def test_common_lines_are_a_longest_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        left, right = common_lines(a, b)
        assert len(left) == len(right) == table[-1, -1]
        assert [a[i] for i in sorted(left)] == [b[j] for j in sorted(right)]


def test_shared_lines_go_where_no_element_marks_the_text(spark):
    page = "<div>Site name</div><p>{0} first</p><p>{0} second</p><p>Read our terms</p>"
    rows = [(i, f"http://a.example/x/{i}?q=1", page.format(w)) for i, w in enumerate(["red", "green", "blue"])]
    rows.append((9, "http://b.example/x/1", page.format("lone")))
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages_of(spark, rows).coalesce(1)).collect()}
    assert got == {0: "red first red second", 1: "green first green second", 2: "blue first blue second",
                   9: "Site name lone first lone second Read our terms"}


def test_copies_and_odd_pages_keep_their_text(spark):
    body = "<article><p>same text</article>"
    rows = [(1, "http://a/1", body), (2, "http://a/1", body), (2, "http://a/1", body), (3, None, None), (4, "", ""), (None, "x", "<p>é</p>"), (5, "http://a/2", "<p>y</p>"), (6, "http://a/2", "<p>y</p>")]
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in extract_main_text(pages_of(spark, rows)).collect())
    assert got == [(0, "é", 1), (1, "same text", 9), (2, "same text", 9), (2, "same text", 9), (3, "", 0), (4, "", 0), (5, "y", 1), (6, "y", 1)]
    assert extract_main_text(pages_of(spark, rows).limit(0)).count() == 0


def test_lines_are_compared_inside_and_outside_of_articles(spark):
    page = "<div>Site name</div><article><p>Read our terms</p><p>{0} teaser</p></article><p>{0} rest</p><p>Sign off</p>"
    rows = [(i, f"http://a.example/x/{i}", page.format(w)) for i, w in enumerate(["red", "green", "blue", "grey"])]
    # nearly the same article twice: one other page is not enough to take lines out of an article
    rows += [(10 + i, f"http://b.example/x/{i}", f"<div>Site</div><article><p>one<p>two<p>{w}</article>") for i, w in enumerate(["x", "y"])]
    # nothing left: the article speaks
    rows += [(20 + i, f"http://c.example/x/{i}", f"<div>Site</div><article><p>one</article><p>{w}</p>") for i, w in enumerate(["x", "", "y"])]
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages_of(spark, rows)).collect()}
    assert got == {0: "red teaser red rest", 1: "green teaser green rest", 2: "blue teaser blue rest", 3: "grey teaser grey rest",
                   10: "one two x", 11: "one two y", 20: "x", 21: "one", 22: "y"}


def test_only_equal_pages_are_copies_and_ranges_do_not_matter(spark):
    menu = "".join(f"<div>menu {i}</div>" for i in range(40))
    page = lambda w: menu + "".join(f"<p>{w} {i}</p>" for i in range(5))
    rows = [(10 * i + j, f"http://a.example/p{i}?copy={j}", page(w)) for i, w in enumerate(["red", "green", "blue"]) for j in range(4)]
    rows += [(100, "http://a.example/p1?copy=2x", None), (200, "http://b.example/1", page("lone")), (300, "http://c.example/1", menu), (301, "http://c.example/2", page("c"))]
    seen = []
    for n in (1, 3, 200):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            seen.append({r["page_id"]: r["text"] for r in extract_main_text(pages_of(spark, rows)).collect()})
        finally:
            spark.conf.unset("spark.sql.shuffle.partitions")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert seen[0] == seen[1] == seen[2]
    for i, w in enumerate(["red", "green", "blue"]):
        assert {seen[0][10 * i + j] for j in range(4)} == {" ".join(f"{w} {k}" for k in range(5))}
    assert seen[0][100] == "" and seen[0][200].startswith("menu 0") and seen[0][301] == "c 0 c 1 c 2 c 3 c 4"


def test_main_text_reads_its_table_by_a_plan_that_names_it(spark, tmp_path):
    menu = "<div>Site name</div><p>{0}</p><p>Read our terms</p>"
    urls = [None, "", "http://ä.example/1", "http://z.example/1", "http://😀.example/1", "http://￮.example/1"]
    rows = [(k or None, u, menu.format(f"text {k}")) for u in urls for k in range(12)]
    rows += [rows[5]] * 3
    pages_of(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    seen = []
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            out = extract_main_text(spark.read.parquet(f"{tmp_path}/pages.parquet"))
            assert out.inputFiles() and all(f"{tmp_path}/pages.parquet/" in f for f in out.inputFiles())
            seen.append(sorted(((r["page_id"] or 0, r["url"] or "", r["text"]) for r in out.collect())))
        finally:
            spark.conf.unset("spark.sql.shuffle.partitions")
    assert seen[0] == seen[1] == sorted((k or 0, u or "", f"text {k or 0}") for k, u, _ in rows)


def test_the_same_one_of_equal_lines_goes_for_any_number_of_ranges(spark):
    first, second, other = ("<article>" + "".join(f"<p>{t}" for t in lines) + "</article>" for lines in ("abcdx", "xxpx", "qrxst"))
    rows = [(100 * i + j, f"http://a.example/{i}?{j}", h) for i, h in enumerate([first, second, other, "<p>end"]) for j in range(4)]
    seen = []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for n in (1, 2, 3, 8):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            seen.append({r["page_id"]: r["text"] for r in extract_main_text(pages_of(spark, rows)).collect()})
    finally:
        spark.conf.unset("spark.sql.shuffle.partitions")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(s == seen[0] for s in seen) and seen[0][100] == "x x p x"


def test_pages_query_against_plain_form(spark):
    import html
    import re

    sf = "/root/testdata/sf0.01"
    for r in Q.op3(spark, sf).join(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = re.search(r"(?s)<article>(.*?)</article>", r["html"])[1]
        want = " ".join(html.unescape(re.sub(r"<[a-zA-Z/][^>]*>", " ", re.sub(r"</?b>", "", article))).split())
        assert (r["text"], r["n_chars"]) == (want, len(want))


def test_suffix_order_against_sorting():
    rng = np.random.default_rng(1)
    for _ in range(150):
        size = rng.integers(0, 30, rng.integers(1, 6))
        symbols = rng.integers(0, rng.integers(1, 4), size.sum())
        begin = np.cumsum(size) - size
        want = sorted(([int(v) + len(size) for v in symbols[b + i:b + n]] + [k], int(b + i))
                      for k, (b, n) in enumerate(zip(begin, size, strict=True)) for i in range(n))
        order, prefix = sorted_suffixes(symbols, begin, size)
        assert order.tolist() == [at for _, at in want]
        for i in range(1, len(want)):
            a, b = want[i - 1][0], want[i][0]
            assert prefix[i] == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("group", [2000, 1])
def test_repeats_against_brute_force(spark, docs_of, monkeypatch, group):
    rng = random.Random(7)
    monkeypatch.setattr(repeats, "GROUP", group)
    noise = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared = [noise(rng.randint(40, 260)) for _ in range(6)]
    rows = [(i, "".join(rng.choice([noise(rng.randint(0, 90)), rng.choice(shared), rng.choice(shared)[:rng.randint(1, 200)]]) for _ in range(rng.randint(0, 7)))) for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[4][1][:-1]), (102, "xy" * 300), (103, "z" * 95), (103, None), (104, ""), (105, noise(3000))]
    out = remove_repeats(docs_of(rows, extra=True), length=96)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), brute.sha(bytes(r["kept"]))) for r in out.collect()]
    assert sorted(got) == sorted(brute.repeats(rows, 96))


def test_repeats_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, Q.op9(spark, sf).collect())) == sorted(brute.repeats(docs))


def test_copies_of_a_text_are_cut_once(spark, docs_of, monkeypatch):
    rng = random.Random(9)
    shared, cut = "".join(rng.choice("abcdé \n") for _ in range(150)), []
    texts = [f"{i} " + "".join(rng.choice("abcdé \n") for _ in range(60)) + shared + f" {i}" for i in range(3)]
    rows = [(i, texts[0]) for i in range(400)] + [(1000, texts[1]), (1001, texts[2])]
    keep = repeats.stored
    monkeypatch.setattr(repeats, "stored", lambda df, name: cut.append(keep(df, name)) or cut[-1])
    out = remove_repeats(docs_of(rows).repartition(4), length=96)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), brute.sha(bytes(r["kept"]))) for r in out.collect()]
    assert sorted(got) == sorted(brute.repeats(rows, 96))
    assert cut[-1].count() == cut[-1].select("f1", "f2").distinct().count()


def test_repeats_on_odd_rows(spark, docs_of):
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), brute.sha(bytes(r["kept"]))) for r in remove_repeats(docs_of(ODD_TEXTS)).collect()]
    assert sorted(got, key=repr) == sorted(brute.repeats(ODD_TEXTS), key=repr)
    assert remove_repeats(docs_of(ODD_TEXTS).limit(0)).count() == 0


def test_components_against_union(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    links += [(2000, 2001 + i) for i in range(50)]
    parent = {n: n for pair in links for n in pair}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: root(n) for n in linked}


def test_pipeline_against_plain_steps(spark):
    import corpus_pipeline as P
    from tidegauge.llm.quality import score_quality

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in P.STAGES[:-1]:
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), before.schema)
        kept[name] = (before, docs)
        assert docs.columns == before.columns
    before, after = kept["quality"]
    rules = Q.quality_rules(spark, before, sf)
    assert after.count() == score_quality(before, rules).filter("predicted = 1").count() > 0.7 * before.count()
    before, after = kept["near_dedup"]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(d for d, _, c in brute.simhash(rows) if c == d)
    before, after = kept["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    judged = brute.decontamination([(r["doc_id"], r["text"]) for r in before.collect()], items)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(j[0] for j in judged if not j[5])
    before, after = kept["mixing"]
    assert after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    out = P.run(spark, sf)
    from tidegauge.llm.token_files import Encoder

    want = brute.tokens([(r["doc_id"], r["text"]) for r in after.collect()], Encoder(Q.tokenizer_path()).library)
    assert sorted(map(tuple, out.collect())) == want
