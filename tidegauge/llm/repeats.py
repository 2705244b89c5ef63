"""Removal of repeated byte strings across all documents, by suffix order.

Every string of `length` bytes belongs to one fragment: the run of starts that share the same
smallest 16-byte hash (leftmost of equals) in their string. Equal strings have equal smallest
hashes at equal distances, so all occurrences of a string are in fragments of one group, and
fragments of a group are cut into 8-byte symbols alike. Groups are independent and fragments
bounded (two lengths), so the collection is sorted group by group, column by column (bwt.py),
in as many rounds as a fragment has symbols, whatever the length of the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.bwt import sorted_suffixes
from tidegauge.llm.common import stored

LENGTH, GRAM, SYMBOL = 400, 16, 8
#: Bytes of fragments that are sorted together (whole groups).
BATCH = 1 << 20
#: Fragments of a group that one task sorts (some 12 MB of text, 100 MB of arrays); the strings of
#: a larger group are counted by hash over all tasks instead.
GROUP = 20_000
#: Starts that are looked at together in a long text.
PIECE = 1 << 19
_INDEX_BITS = np.uint64(20)


def _words(data: np.ndarray) -> np.ndarray:
    """The little-endian 8-byte word at every offset."""
    return np.ndarray((max(0, len(data) - 7),), dtype="<u8", buffer=data, strides=(1,))


def fragments(data: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """(start, starts in it, offset of the smallest hash, the hash) for each fragment of a text."""
    for base in range(0, len(data) - length + 1, PIECE):
        piece = data[base:base + PIECE + length - 1]
        word = _words(piece)
        mixed = (word[:-8] * np.uint64(0x9E3779B97F4A7C15)) ^ (word[8:] * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        key = mixed >> _INDEX_BITS << _INDEX_BITS | np.arange(len(mixed), dtype=np.uint64)
        width = length - GRAM + 1
        padded = np.full(-(-len(key) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[:len(key)] = key
        table = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
        behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        starts = len(key) - width + 1
        least = np.minimum(behind[:starts], ahead[width - 1:width - 1 + starts])
        cut = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1, [starts]])
        smallest = least[cut[:-1]]
        at = (smallest & np.uint64((1 << 20) - 1)).astype(np.int64) - cut[:-1]
        value = (smallest >> _INDEX_BITS).astype(np.int64)
        yield from zip((cut[:-1] + base).tolist(), np.diff(cut).tolist(), at.tolist(), value.tolist(), strict=True)


def repeated_starts(parts: list[bytes], offset: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each fragment, which of its strings is in these fragments more than once."""
    size = np.array([len(p) for p in parts], dtype=np.int64)
    joined = np.frombuffer(b"".join(parts) + bytes(2 * SYMBOL), dtype=np.uint8)
    first = np.cumsum(size) - size
    lead = np.array(offset, dtype=np.int64) % SYMBOL
    count = (size - lead) // SYMBOL
    begin = np.cumsum(count) - count
    word = _words(joined)
    each = np.arange(int(count.sum())) - np.repeat(begin, count)
    _, symbols = np.unique(word[np.repeat(first + lead, count) + SYMBOL * each], return_inverse=True)
    order, prefix = sorted_suffixes(symbols, begin, count)
    inner = length // SYMBOL - 1  # whole symbols that any string holds
    kind = np.empty(len(order), dtype=np.int64)
    kind[order] = np.cumsum(prefix < inner)
    windows = size - length + 1
    owner = np.repeat(np.arange(len(parts)), windows)
    start = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    tail = (lead[owner] - start) % SYMBOL  # bytes before the first whole symbol
    whole = start + tail
    middle = kind[begin[owner] + (whole - lead[owner]) // SYMBOL]
    bits = (8 * tail).astype(np.uint64)
    ends = word[first[owner] + start] & ((np.uint64(1) << bits) - np.uint64(1))
    ends |= word[first[owner] + whole + SYMBOL * inner] << bits  # what lies beyond the string is shifted out
    rank = np.lexsort((ends, middle * SYMBOL + tail))
    group, rest = (middle * SYMBOL + tail)[rank], ends[rank]
    equal = (group[1:] == group[:-1]) & (rest[1:] == rest[:-1])
    twice = np.zeros(len(rank), dtype=bool)
    twice[rank[1:][equal]] = True
    twice[rank[:-1][equal]] = True
    return np.split(twice, np.cumsum(windows)[:-1])


def _runs(flags: np.ndarray) -> list[int]:
    """First and last start of each run of flags, flat."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return (edge.reshape(-1, 2) - [0, 1]).reshape(-1).tolist()


def _encoded(value) -> bytes:
    return ("" if value is None else str(value)).encode("utf-8", "surrogatepass")


def _list_fragments(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: dict[bytes, tuple[bytes, int]] = {}
            for value in batch.column(0).to_pylist():
                raw = _encoded(value)
                if len(raw) >= length:
                    key = hashlib.md5(raw).digest()
                    texts[key] = (raw, texts.get(key, (raw, 0))[1] + 1)
            rows: list[tuple] = []
            for key, (raw, weight) in texts.items():
                for start, windows, at, least in fragments(np.frombuffer(raw, np.uint8), length):
                    digest = xxhash.xxh3_128_digest(raw[start:start + windows + length - 1])
                    rows.append((key, least, digest, start, windows, at, weight))
                if len(rows) >= 50_000:
                    yield _rows(rows)
                    rows = []
            if rows:
                yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    key, least, digest, start, windows, at, weight = zip(*rows, strict=True)
    halves = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.binary()), pa.array(least, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
         pa.array(start, pa.int32()), pa.array(windows, pa.int32()), pa.array(at, pa.int32()), pa.array(weight, pa.int64())],
        names=["t", "g", "f1", "f2", "start", "windows", "at", "weight"])


def _slice(length: int):
    """Bytes of the fragments that are asked of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["g", "f1", "f2", "at", "hot", "bytes"]
        for batch in batches:
            for value, wanted in zip(batch.column(0), batch.column(1), strict=True):
                raw = _encoded(value.as_py())
                rows = [(w["g"], w["f1"], w["f2"], w["at"], w["hot"], raw[w["start"]:w["start"] + w["windows"] + length - 1])
                        for w in wanted.as_py()]
                for i in range(0, len(rows), 5000):
                    columns = zip(*rows[i:i + 5000], strict=True)
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _sort_groups(length: int):
    """Repeated starts of the fragments of each group; rows come group by group."""

    def out(batch: list[tuple]) -> pa.RecordBatch:
        flags = repeated_starts([b[4] for b in batch], [b[3] for b in batch], length)
        return pa.RecordBatch.from_arrays(
            [*(pa.array([b[k] for b in batch], pa.int64()) for k in range(3)),
             pa.array([_runs(f) for f in flags], pa.list_(pa.int32()))], names=["g", "f1", "f2", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last, seen = 0, None, set()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != last:
                    if size >= BATCH:
                        yield out(held)
                        held, size = [], 0
                    last, seen = row[0], set()
                if row[1:3] not in seen:  # repeated rows of a document ask for a fragment twice
                    seen.add(row[1:3])
                    held.append(row)
                    size += len(row[4])
        if held:
            yield out(held)

    return run


def _hash_strings(length: int):
    """The hash of every string of the fragments of very large groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, f1, f2, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = len(raw) - length + 1
                halves = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[i:i + length]) for i in range(n)), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * n, pa.int64()), pa.array([f1] * n, pa.int64()), pa.array([f2] * n, pa.int64()),
                     pa.array(range(n), pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                    names=["g", "f1", "f2", "s", "h1", "h2"])

    return run


def _digest(text):
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(t, spans): for the digest of each text with repeats, [from, to) byte pairs, unmerged.

    Only fragments that share a group with another one go on; of equal fragments one is
    sorted. Groups above GROUP fragments (a passage in that many surroundings) are decided by
    a count per string hash over all tasks, exact like the rest up to 128-bit collisions.
    """
    text = F.col(f"`{text_col}`").cast("string")
    listed = docs.select(text.alias("text")).mapInArrow(
        _list_fragments(length), "t binary, g long, f1 long, f2 long, start int, windows int, at int, weight long")
    held = stored(listed.groupBy("t", "g", "f1", "f2", "start", "windows", "at").agg(F.sum("weight").alias("weight")), "fragments")
    kinds = held.groupBy("g", "f1", "f2", "windows", "at").agg(
        F.sum("weight").alias("times"), F.min(F.struct("t", "start")).alias("place"))
    groups = kinds.groupBy("g").agg(F.count(F.lit(1)).alias("kinds"), F.sum("times").alias("all")).filter("all > 1")
    shared = stored(kinds.join(groups, "g").select("g", "f1", "f2", "windows", "at", "times", "place", "kinds"), "shared")
    wanted = (
        shared.filter("kinds > 1")
        .groupBy(F.col("place.t").alias("t"))
        .agg(F.collect_list(F.struct("g", "f1", "f2", "at", (F.col("kinds") > GROUP).alias("hot"),
                                     F.col("place.start").alias("start"), "windows")).alias("wanted")))
    # copies are equal texts: each map task hands on one of them
    bodies = docs.select(_digest(text).alias("t"), text.alias("text")).groupBy("t").agg(F.any_value("text").alias("text"))
    cut = bodies.join(wanted, "t").select("text", "wanted").mapInArrow(
        _slice(length), "g long, f1 long, f2 long, at int, hot boolean, bytes binary")
    cut = stored(cut, "cut")
    runs = (
        cut.filter("not hot").select("g", "f1", "f2", "at", "bytes").repartition("g").sortWithinPartitions("g")
        .mapInArrow(_sort_groups(length), "g long, f1 long, f2 long, runs array<int>"))
    strings = cut.filter("hot").select("g", "f1", "f2", "bytes").mapInArrow(
        _hash_strings(length), "g long, f1 long, f2 long, s int, h1 long, h2 long").distinct()
    twice = strings.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    hot = strings.join(twice, ["h1", "h2"]).groupBy("g", "f1", "f2").agg(
        F.flatten(F.collect_list(F.array("s", "s"))).alias("runs"))
    whole = shared.filter("times > 1").select("g", "f1", "f2", F.array(F.lit(0), F.col("windows") - 1).alias("runs"))
    found = runs.unionByName(hot).unionByName(whole).filter(F.size("runs") > 0)
    return (
        held.join(found, ["g", "f1", "f2"])
        .groupBy("t").agg(F.collect_list(F.struct("start", "runs")).alias("spans")))


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = _encoded(value)
                pairs = sorted((s["start"] + a, s["start"] + b + length) for s in spans or [] for a, b in zip(s["runs"][::2], s["runs"][1::2], strict=True))
                merged: list[list[int]] = []
                for a, b in pairs:
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                kept, at = [], 0
                for a, b in merged:
                    kept.append(raw[at:a])
                    at = b
                kept.append(raw[at:])
                rows.append((len(raw), sum(b - a for a, b in merged), merged, b"".join(kept)))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.list_(pa.list_(pa.int64()))), pa.array(columns[3], pa.binary())],
                names=[batch.schema.names[0], "n_bytes", "n_removed", "spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Each row's id with n_bytes, n_removed, spans ([from, to) of the removed runs) and kept (bytes).

    A byte goes if a string of `length` bytes (a multiple of 8, at least 48) over it also starts
    anywhere else; all strings are judged on the input. NULL text is empty; repeated rows are
    documents of their own and so lose their strings. An empty table gives an empty result.
    """
    spans = repeated_spans(docs, text_col, length).withColumnRenamed("t", "_t")
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    joined = rows.join(spans, _digest(F.col("_text")) == F.col("_t"), "left").select("_id", "_text", "spans")
    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(_remove(length), f"_id {kind}, n_bytes long, n_removed long, spans array<array<long>>, kept binary") \
        .withColumnRenamed("_id", id_col)
