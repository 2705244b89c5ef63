"""Benchmark decontamination: Wu-Manber search for word windows of test items.

The alphabet is words. All windows of one length form a pattern set with a block shift table
(how far the scan may jump), suffix-hash buckets (which windows may end here) and a direct
comparison. The scan moves many lanes of the text at once, so numpy does the stepping.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import stored, with_running

WINDOW = 13
#: Characters of items that are searched for in one pass over the documents.
BLOCK_CHARS = 4_000_000
LANE = 256
BATCH_BYTES = 4 << 20

_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of digits, letters a-z (A-Z lower-cased) and characters from U+0080 on."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


class PatternSet:
    """All windows of one length: shift table, suffix buckets, the windows and their items."""

    def __init__(self, windows: dict[tuple[int, ...], list[int]], length: int):
        self.length, self.block = length, min(2, length)
        self.rows = np.array(list(windows), dtype=np.int32).reshape(len(windows), length)
        self.bits = max(10, int(np.ceil(np.log2(max(2, len(windows) * length * 4)))))
        self.shift = np.full(1 << self.bits, length - self.block + 1, dtype=np.int16)
        for end in range(self.block - 1, length):  # the last block of the window gets 0
            at = self._block_hash(self.rows[:, end - 1] if self.block > 1 else None, self.rows[:, end])
            np.minimum.at(self.shift, at, length - 1 - end)
        self.mix = np.random.default_rng(13).integers(1, 1 << 62, length, dtype=np.uint64) | np.uint64(1)
        hashes = self._suffix_hash(self.rows)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.rows = hashes[order], self.rows[order]
        items = list(windows.values())
        self.items = [items[i] for i in order]

    def _block_hash(self, first, last):
        h = last.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        if first is not None:
            h ^= first.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
            h *= np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def _suffix_hash(self, rows):
        return (rows.astype(np.uint64) * self.mix).sum(axis=1, dtype=np.uint64)

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the occurrences in ids and the rows of their windows."""
        last, n = self.length - 1, len(ids)
        pos = np.maximum(np.arange(0, n, LANE), last)
        stop = np.minimum(np.arange(0, n, LANE) + LANE, n)
        found = []
        keep = pos < stop
        pos, stop = pos[keep], stop[keep]
        while len(pos):
            at = self._block_hash(ids[pos - 1] if self.block > 1 else None, ids[pos])
            step = self.shift[at]
            found.append(pos[step == 0])
            pos = pos + np.maximum(step, 1)
            keep = pos < stop
            pos, stop = pos[keep], stop[keep]
        ends = np.concatenate(found) if found else np.zeros(0, np.int64)
        if not len(ends):
            return ends, ends
        text = ids[ends[:, None] + np.arange(-last, 1)]
        hashes = self._suffix_hash(text)
        low, high = np.searchsorted(self.hashes, hashes), np.searchsorted(self.hashes, hashes, "right")
        out_end, out_row = [], []
        while (more := low < high).any():  # one step for each window of the deepest bucket
            ends, text, low, high = ends[more], text[more], low[more], high[more]
            same = (self.rows[low] == text).all(axis=1)
            out_end.append(ends[same])
            out_row.append(low[same])
            low = low + 1
        if not out_end:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(out_end), np.concatenate(out_row)


class Patterns:
    """Windows of a block of items, grouped by length, over one vocabulary."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        sets: dict[int, dict[tuple[int, ...], list[int]]] = {}
        for k, (_, text) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            length = min(window, len(ids))
            for i in range(len(ids) - length + 1 if length else 0):
                at = sets.setdefault(length, {}).setdefault(tuple(ids[i:i + length]), [])
                if not at or at[-1] != k:
                    at.append(k)
        self.sets = [PatternSet(windows, length) for length, windows in sorted(sets.items())]

    def hits(self, texts: list[list[bytes]]) -> list[tuple[np.ndarray, set[str]]]:
        """For each text, which words lie in an occurrence, and the names of the items."""
        size = np.array([len(t) for t in texts], dtype=np.int64)
        start = np.concatenate([[0], np.cumsum(size + 1)])  # a 0, which no window holds, between texts
        ids = np.zeros(start[-1], dtype=np.int32)
        for at, words in zip(start, texts, strict=False):
            ids[at:at + len(words)] = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))
        cover = np.zeros(len(ids) + 1, dtype=np.int32)
        names: list[set[str]] = [set() for _ in texts]
        for patterns in self.sets:
            ends, rows = patterns.search(ids)
            np.add.at(cover, ends - patterns.length + 1, 1)
            np.add.at(cover, ends + 1, -1)
            doc = np.searchsorted(start, ends, "right") - 1
            for d, r in np.unique(np.stack([doc, rows], axis=1), axis=0):
                names[d].update(self.names[k] for k in patterns.items[r])
        hit = np.cumsum(cover)[:-1] > 0
        return [(hit[a:a + n], s) for a, n, s in zip(start, size, names, strict=False)]


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of about BLOCK_CHARS characters; a block is what a pass broadcasts."""
    named = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("_item"),
                         F.col(text_col).cast("string").alias("_body")).filter(F.length("_body") > 0)
    blocks = stored(with_running(named, [F.col("_item"), F.col("_body")], {"_before": F.length("_body")})
                    .withColumn("_block", F.floor(F.col("_before") / BLOCK_CHARS)), "items")
    last = blocks.agg(F.max("_block")).first()[0]
    for k in range(0 if last is None else last + 1):
        yield [(r["_item"], r["_body"]) for r in blocks.filter(F.col("_block") == k).toLocalIterator()]


def find_items(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Adds n_words, n_hit and item_names (sorted) to docs.

    A word is hit if it lies in any occurrence of `window` consecutive words of an item; an
    item of fewer words is one window. No shuffle of documents: each pass is a narrow
    mapInArrow with one block of items broadcast (bounded by BLOCK_CHARS); with more items
    there are more passes, each adding to the hits so far.

    NULL or empty text and empty tables have no words and no hits. A NULL item id is the empty
    name; items with equal windows all count. Columns of docs with the names of new ones are
    replaced.
    """
    new = ["n_words", "n_hit", "item_names"]
    out = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new])
    columns = out.columns
    fields = list(out.schema.fields)
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                           T.StructField("item_names", T.ArrayType(T.StringType())), T.StructField("_hit", T.BinaryType())])
    where = columns.index(text_col)
    done = False
    for block in _blocks(items, item_col, item_text_col):
        if done:
            out = stored(out, "hits")
        shared = out.sparkSession.sparkContext.broadcast(Patterns(block, window))
        out, done = out.mapInArrow(_pass(shared, where, len(columns)), schema), True
    if not done:
        out = out.mapInArrow(_pass(None, where, len(columns)), schema)
    return out.select(*[F.col(f"`{c}`") for c in columns], *new)


def _pass(shared, where: int, width: int):
    """One pass; behind the `width` own columns there may be the hits of earlier passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = shared.value if shared is not None else Patterns([])
        for batch in batches:
            begin, held, group = 0, 0, []
            for i, value in enumerate(batch.column(where)):
                words = words_of(None if (v := value.as_py()) is None else str(v))
                group.append(words)
                held += 8 * len(words)
                if held >= BATCH_BYTES:
                    yield _extended(batch.slice(begin, len(group)), patterns.hits(group), group, width)
                    begin, held, group = i + 1, 0, []
            if group:
                yield _extended(batch.slice(begin, len(group)), patterns.hits(group), group, width)

    return run


def _extended(batch: pa.RecordBatch, hits, group, width: int) -> pa.RecordBatch:
    earlier = batch.num_columns > width
    n_hit, bits, names = [], [], []
    for i, (hit, found) in enumerate(hits):
        if earlier:
            if before := batch.column(width + 3)[i].as_py():
                hit = hit | np.unpackbits(np.frombuffer(before, np.uint8))[:len(hit)].astype(bool)
            found = found | set(batch.column(width + 2)[i].as_py() or [])
        n_hit.append(int(hit.sum()))
        bits.append(np.packbits(hit).tobytes() if hit.any() else b"")
        names.append(sorted(found))
    columns = [*batch.columns[:width], pa.array([len(w) for w in group], pa.int64()), pa.array(n_hit, pa.int64()),
               pa.array(names, pa.list_(pa.string())), pa.array(bits, pa.binary())]
    return pa.RecordBatch.from_arrays(
        columns, names=[*batch.schema.names[:width], "n_words", "n_hit", "item_names", "_hit"])


def contaminated(n_words, n_hit):
    """The contamination rule: at least a twentieth of the words is hit."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)
