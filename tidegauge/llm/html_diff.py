"""Main text of pages: differencing against the nearest different pages of the host, with markup as evidence beside it."""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|svg|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>",
                     re.S | re.I)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>""")
_CUT_OFF = re.compile(r"<[/!?]?[a-zA-Z][^<>]*\Z|<[/!?]?\Z")
_MARKS = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Elements that hold no main text.
ASIDE = frozenset("head nav header footer aside form script style noscript template button select option iframe object dialog menu svg".split())
#: Words of class, id and role that mark such elements.
ASIDE_MARKS = frozenset((
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer sidebar aside complementary contentinfo notice notices alert cookie cookies "
    "consent popup modal dialog overlay newsletter subscribe signup comment comments discussion disqus replies respond "
    "share sharing social related recommended pagination pager widget toolbar search login").split())
#: Words after which a class name only mentions or denies such an element.
MENTIONS = frozenset("with without has have no not".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i img ins kbd mark q s samp small span strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(("article", "main"))
#: Different pages that are kept on either side of a page: two to compare with, and one that may be its copy.
KEPT = 3
#: Pages of a range that is not joined with the next one.
FEW = 200
#: Columns by which pages are dealt to ranges and lie in them.
ORDER = ["_host", "_path", "_url", "_id", "_body"]


def _named(name: str, attributes: str) -> bool:
    """Whether an element holds no main text by its name or because it is hidden."""
    if name in ASIDE:
        return True
    if name in ("body", "html", "article", "main") and "comment" not in attributes.lower():
        return False
    return "hidden" in attributes.lower().split() or 'aria-hidden="true"' in attributes.lower()


def _marks(name: str, attributes: str) -> set[str]:
    """Words of class, id and role that mark an element; none from a name that denies or only mentions them (no-comments, with-sidebar)."""
    if name in ("body", "html", "article", "main") and "comment" not in attributes.lower():
        return set()
    found: set[str] = set()
    for _, *values in _MARKS.findall(attributes):
        for one in "".join(values).split():
            words = re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", one).lower())
            found.update(w for i, w in enumerate(words) if w in ASIDE_MARKS and MENTIONS.isdisjoint(words[:i]))
    return found


def _trusted(pieces: list[tuple[str, tuple[int, ...]]], marked: list[set[str]], whole: set[int]) -> set[int]:
    """Numbers of the marked elements that are set aside.

    Not those that hold an article or main element (whole) or more than half of the page's text,
    and none by a word whose elements hold more than half of it. None at all if no text were left.
    """
    size = [(len("".join(text.split())), around) for text, around in pieces]
    total = sum(n for n, _ in size)
    held: dict[int, int] = defaultdict(int)
    for n, around in size:
        for element in around:
            held[element] += n
    kept = {e for e in range(len(marked)) if e not in whole and 2 * held[e] <= total}
    by_word: dict[str, int] = defaultdict(int)
    for n, around in size:
        for word in set().union(*(marked[e] for e in around if e in kept)):
            by_word[word] += n
    kept = {e for e in kept if any(2 * by_word[w] <= total for w in marked[e])}
    return kept if any(n and kept.isdisjoint(around) for n, around in size) else set()


def lines_of(page: str | None) -> list[tuple[str, bool]]:
    """(text of a block, whether it is in an article or main element), in page order.

    Blocks of elements that are set aside by name or mark are left out. An element ends with
    its own end tag or that of any element around it; a stray end tag is passed over.
    """
    source = _HIDDEN.sub(" ", page or "")
    source = _CUT_OFF.sub("", source)
    blocks: list[tuple[list[tuple[str, tuple[int, ...]]], bool]] = []
    held: list[tuple[str, tuple[int, ...]]] = []  # text and the marked elements around it
    stack: list[tuple[str, int, int, tuple[int, ...]]] = []  # name, elements set aside by name around it, main elements, marked elements
    marked: list[set[str]] = []
    whole: set[int] = set()

    def close() -> None:
        if held:
            blocks.append((held.copy(), bool(stack and stack[-1][2])))
            held.clear()

    at = 0
    for tag in _TAG.finditer(source):
        aside, main, around = stack[-1][1:] if stack else (0, 0, ())
        if not aside and at < tag.start():
            held.append((source[at:tag.start()], around))
        at = tag.end()
        name = tag[2].lower()
        if name not in INLINE:
            close()
        if tag[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                del stack[depth:]
        elif name not in VOID and not tag[3].endswith("/"):
            if name in ("p", "li", "td", "th", "tr", "dt", "dd") and stack and stack[-1][0] == name:
                stack.pop()
                aside, main, around = stack[-1][1:] if stack else (0, 0, ())
            words = _marks(name, tag[3])
            aside += _named(name, tag[3])
            if name in MAIN and not aside and not words:
                whole.update(around)
            if words:
                around = (*around, len(marked))
                marked.append(words)
            stack.append((name, aside, main + (name in MAIN), around))
    if not (stack and stack[-1][1]) and at < len(source):
        held.append((source[at:], stack[-1][3] if stack else ()))
    close()
    gone = _trusted([p for pieces, _ in blocks for p in pieces], marked, whole) if marked else set()
    out = []
    for pieces, main in blocks:
        if text := " ".join(html.unescape("".join(t for t, around in pieces if gone.isdisjoint(around))).split()):
            out.append((text, main))
    return out


def common_lines(a: list[str], b: list[str]) -> tuple[set[int], set[int]]:
    """Places in a and in b of a longest common subsequence of lines.

    Works on matching places only (longest increasing subsequence of them), so lines that are
    rare on a page cost next to nothing.
    """
    places: dict[str, list[int]] = defaultdict(list)
    for j, line in enumerate(b):
        places[line].append(j)
    ends: list[int] = []
    last: list[tuple] = []  # chain (i, j, previous chain) for each length
    for i, line in enumerate(a):
        for j in reversed(places.get(line, ())):
            k = bisect_left(ends, j)
            chain = (i, j, last[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                last.append(chain)
            else:
                ends[k], last[k] = j, chain
    left, right = set(), set()
    chain = last[-1] if last else None
    while chain:
        left.add(chain[0])
        right.add(chain[1])
        chain = chain[2]
    return left, right


def main_text(lines: list[tuple[str, bool]], shared: list[set[int]]) -> str:
    """Lines that other pages of the host do not share; shared holds the places shared with each of up to two of them.

    A line inside an article or main element goes if two pages share it, any other line if one
    does. These elements decide alone on a page without another page, and on one of which
    no line would stay.
    """
    once = set().union(*shared)
    twice = set.intersection(*shared) if len(shared) > 1 else set()
    left = [text for i, (text, main) in enumerate(lines) if i not in (twice if main else once)]
    if shared and left:
        return " ".join(left)
    inside = [text for text, main in lines if main]
    return " ".join(inside or left)


class _Page:
    """Lines of a page; of one beyond the range only their digests are known."""

    def __init__(self, host: str, lines: list[str] | None, digests: bytes | None = None):
        self.host, self.lines, self._digests = host, lines, digests

    def digests(self) -> bytes:
        if self._digests is None:
            self._digests = b"".join(blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest() for t in self.lines)
        return self._digests

    def same(self, other: _Page) -> bool:
        if self.lines is None or other.lines is None:
            return self.digests() == other.digests()
        return self.lines == other.lines

    def common(self, other: _Page) -> tuple[set[int], set[int]]:
        if self.lines is None or other.lines is None:
            return common_lines(*([d[i:i + 8] for i in range(0, len(d), 8)] for d in (self.digests(), other.digests())))
        return common_lines(self.lines, other.lines)


def _different(pages: list[_Page], most: int = KEPT) -> list[_Page]:
    """The first few of the pages, each different from those before it."""
    out: list[_Page] = []
    for page in pages:
        if len(out) < most and not any(page.same(p) for p in out):
            out.append(page)
    return out


class _Run:
    """Copies side by side, with the nearest different pages before and after them."""

    def __init__(self, page: _Page, rows: list[tuple], recent: list[_Page]):
        self.page, self.rows = page, rows
        self.before = _different([page, *recent])[1:]
        self.after: list[_Page] = []
        self.shared: dict[int, set[int]] = {}

    def follow(self, page: _Page) -> bool:
        """Takes a page after it; whether no more of them are needed."""
        self.after = _different([self.page, *self.after, page])[1:3]
        return len(self.after) > (0 if self.before else 1)

    def texts(self) -> Iterator[tuple]:
        near = _different(self.before[:1] + self.after[:1] + self.before[1:] + self.after[1:], 2)
        for p in near:
            if id(p) not in self.shared:  # the page just before comes first, as within a range: else others of equal lines are taken
                self.shared[id(p)] = p.common(self.page)[1] if p in self.before[:1] else self.page.common(p)[0]
        shared = [self.shared[id(p)] for p in near]
        marks = text = None
        for page, url, main in self.rows:
            if main is not marks:
                marks, text = main, main_text(list(zip(self.page.lines, main, strict=True)), shared)
            yield page, url, text


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str], list[tuple]]]:
    """(host, lines, [(id, url, whether each line is in an article or main element)]) of the runs of copies:
    neighbouring pages of a host whose whole line lists are equal.

    Pages without lines are runs of their own.
    """
    host, lines, rows = None, [], []
    for batch in batches:
        for page, url, at, body in zip(*(batch.column(k) for k in range(4)), strict=True):
            found, place = lines_of(body.as_py()), at.as_py()
            one, main = [t for t, _ in found], tuple(m for _, m in found)
            if not one:
                yield place, one, [(page.as_py(), url.as_py(), main)]
                continue
            if rows and (place != host or one != lines):
                yield host, lines, rows
                rows = []
            host, lines = place, one
            if rows and rows[-1][2] == main:
                main = rows[-1][2]
            rows.append((page.as_py(), url.as_py(), main))
    if rows:
        yield host, lines, rows


def _numbered(batches: Iterator[pa.RecordBatch], seen: dict) -> Iterator[pa.RecordBatch]:
    """Notes the number of the range and the type of the ids."""
    for batch in batches:
        seen["kind"] = batch.schema.field(0).type
        if batch.num_rows:
            seen["range"] = batch.column(4)[0].as_py()
        yield batch


def _rank(key: tuple) -> tuple:
    """What puts keys into Spark's order: NULL first, strings by code point."""
    return tuple((v is not None, v) for v in key)


def _first_keys(rows: DataFrame) -> list[tuple]:
    """The smallest key of each range, in order; Spark draws the ranges from the keys alone.

    Ranges of a few pages are joined with the next ones, as long as there is one for each core.
    """
    spark = rows.sparkSession
    keys = rows.select(*ORDER).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *ORDER)
    counted = keys.withColumn("_range", F.spark_partition_id()).groupBy("_range").agg(
        F.count(F.lit(1)).alias("_pages"), F.min(F.struct(*ORDER)).alias("_first")).select("_pages", "_first.*").toArrow()
    drawn = sorted(zip(*(c.to_pylist() for c in counted.columns), strict=True), key=lambda r: _rank(r[1:]))
    least = min(FEW, sum(r[0] for r in drawn) / spark.sparkContext.defaultParallelism)
    firsts, held = [], least
    for pages, *key in drawn:
        if held >= least:
            firsts.append(tuple(key))
            held = 0
        held += pages
    return firsts


def _range_of(firsts: list[tuple]):
    """The number of the range that a key is in."""
    ranks = [_rank(key) for key in firsts[1:]]

    @F.arrow_udf("int")
    def number(*key: pa.Array) -> pa.Array:
        return pa.array([bisect_right(ranks, _rank(k)) for k in zip(*(c.to_pylist() for c in key), strict=True)], pa.int32())

    return number


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The range and key of each page that has lines, with the digests of these."""
    for batch in batches:
        digests = [_Page("", [t for t, _ in lines_of(body.as_py())]).digests() for body in batch.column(len(ORDER) + 1)]
        found = batch.select(range(len(ORDER) + 1)).append_column("_lines", pa.array(digests, pa.binary()))
        yield found.filter(pa.array([bool(d) for d in digests], pa.bool_()))


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a range that has lines: its first and its last host, and of each the digests of the
    KEPT different pages that are nearest to that end, outermost first. Rows are range, host, digests, in order."""
    number, first, last = None, [], []
    for batch in batches:
        for number, host, digests in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            page = _Page(host, None, digests)
            if not first or host == first[0].host:
                first = _different([*first, page])
            last = _different([page, *(p for p in last if p.host == host)])
    if first:
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), pa.array([first[0].host], pa.string()), pa.array([last[0].host], pa.string()),
             *(pa.array([[p.digests() for p in pages]], pa.list_(pa.binary())) for pages in (first, last))],
            names=["range", "first_host", "last_host", "first", "last"])


def carried(edges: list[tuple[int, str, str, list[bytes], list[bytes]]]) -> dict[int, list[tuple[str | None, list[bytes]]]]:
    """For each range with lines: (host, nearest different pages before the range), and the same after it.

    A range that holds too few different pages, all of one host, passes on those behind it.
    """
    def pass_on(seen, host, near, whole):
        behind = seen[1] if whole and seen[0] == host else []
        return host, list(dict.fromkeys([*near, *behind]))[:KEPT]

    out: dict[int, list] = {e[0]: [] for e in edges}
    seen = (None, [])
    for number, head, tail, _, last in sorted(edges):
        out[number].append(seen)
        seen = pass_on(seen, tail, last, head == tail)
    seen = (None, [])
    for number, head, tail, first, _ in sorted(edges, reverse=True):
        out[number].append(seen)
        seen = pass_on(seen, head, first, head == tail)
    return out


def _compare(shared_edges):
    """Rows come in order of host and path; each run of copies is compared with the nearest different pages of its host."""

    def packed(rows: list[tuple], kind) -> pa.RecordBatch:
        ids, urls, texts = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, kind), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["_id", "_url", "text", "n_chars"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        out: list[tuple] = []
        recent: list[_Page] | None = None  # different pages of the host, nearest first
        waiting: list[_Run] = []

        def beyond(side: int, host: str) -> list[_Page]:
            place, pages = shared_edges.value[seen["range"]][side]
            return [_Page(host, None, d) for d in pages] if place == host else []

        for host, lines, rows in _runs(_numbered(batches, seen)):
            if not lines:
                out.extend((page, url, "") for page, url, _ in rows)
            else:
                page = _Page(host, lines)
                if recent is None:
                    recent = beyond(0, host)
                elif recent[0].host != host:
                    for r in waiting:
                        out.extend(r.texts())
                    recent, waiting = [], []
                now = _Run(page, rows, recent)
                if waiting and waiting[-1].page is recent[0]:
                    waiting[-1].shared[id(page)], now.shared[id(recent[0])] = recent[0].common(page)
                still = []
                for r in waiting:
                    if r.follow(page):
                        out.extend(r.texts())
                    else:
                        still.append(r)
                waiting = [*still, now]
                recent = _different([page, *recent])
            while len(out) >= 500:
                yield packed(out[:500], seen["kind"])
                del out[:500]
        for r in waiting:
            for page in beyond(1, r.page.host):
                r.follow(page)
            out.extend(r.texts())
        for at in range(0, len(out), 500):
            yield packed(out[at:at + 500], seen["kind"])

    return run


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The id and url of each page with text and n_chars (code points).

    Pages are dealt by range of (host, path), so a host of any size is many tasks and pages
    with the nearest URLs lie side by side. Each page is aligned with the nearest different page
    before it and after it in its host (at the end of a host: the two nearest on one side) by the
    longest common subsequence of their lines. A line that one of the two shares is deleted; a line
    inside an article or main element only if both do. Copies are pages whose whole line
    lists are equal; a run of them is compared as one page. The outermost different pages of
    every range (line digests, one row per range) are carried to the ranges beside it, so the
    text does not depend on how many ranges there are. The keys at which ranges begin are taken
    first; for the edges only the digests of the lines are shuffled, for the texts the pages, each once.

    NULL or empty html: empty text. NULL urls form one host. Repeated rows are copies of each
    other and stay. An empty table gives an empty result.
    """
    url = F.coalesce(F.col(f"`{url_col}`").cast("string"), F.lit(""))
    rest = F.regexp_replace(F.lower(url), r"^[a-z]+://|[?#].*$", "")
    host = F.regexp_replace(F.regexp_extract(rest, r"^([^/]*)", 1), r"^(www|m|mobile)\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/]*(.*)$", 1), r"(/|\.html?)+$", "")
    body = F.col(f"`{html_col}`").cast("string")
    rows = pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").cast("string").alias("_url"), host.alias("_host"),
                        body.alias("_html"), path.alias("_path"), F.xxhash64(body).alias("_body"))
    kind = pages.schema[id_col].dataType.simpleString()
    firsts = _first_keys(rows)
    rows = rows.withColumn("_range", _range_of(firsts)(*ORDER))

    def dealt(part: DataFrame) -> DataFrame:
        return part.repartitionById(max(1, len(firsts)), "_range").sortWithinPartitions(*ORDER)

    lines = rows.select("_range", *ORDER, "_html").mapInArrow(
        _digested, f"_range int, _host string, _path string, _url string, _id {kind}, _body long, _lines binary")
    edges = dealt(lines).select("_range", "_host", "_lines").mapInArrow(
        _edges, "range int, first_host string, last_host string, first array<binary>, last array<binary>").collect()
    near = carried([(r[0], r[1], r[2], [bytes(d) for d in r[3]], [bytes(d) for d in r[4]]) for r in edges])
    shared_edges = pages.sparkSession.sparkContext.broadcast(near)
    return (dealt(rows).select("_id", "_url", "_host", "_html", "_range")
            .mapInArrow(_compare(shared_edges), f"_id {kind}, _url string, text string, n_chars long")
            .withColumnRenamed("_id", id_col).withColumnRenamed("_url", url_col))
