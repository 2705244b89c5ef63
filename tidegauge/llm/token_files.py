"""Token ids in binary blocks: frequency-ranked ids, byte-aligned, control bytes apart.

Ids are replaced by their frequency rank over all documents, so the commonest 256 take one
byte and nearly all others two. The lengths (1 to 4 bytes) of four ranks share one control
byte; control bytes and data bytes are separate runs, and decoding is table lookup.

A block is: `TGB1`, then little-endian uint32 documents, uint64 ids before it in its shard,
uint32 ids; int64 document ids; uint8 flags (1: the document id is not NULL); uint32 ids per
document; control bytes; data bytes. A table of blocks (shard, block, n_ids, bytes) is written
with Spark's writer, so any file system that Spark reaches will do and failed tasks leave
nothing behind; shards are ranges of the document id in ascending order.
"""

from __future__ import annotations

import re
import string
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import stored

MAGIC, HEAD = b"TGB1", struct.Struct("<4sIQI")
#: Ids after which a block is closed; a document is never cut.
BLOCK_IDS = 1 << 18
#: Distinct words in a generation of a Python worker's memory; it holds two generations.
MEMO = 500_000
#: Bytes of texts that are encoded together (a text is never cut).
GROUP_BYTES = 4 << 20

_LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)
_BETWEEN = regex.compile(r"(?<=\S) (?=\S)")
#: White space beyond single spaces, and single or double line feeds, between other characters: the texts that hold it
#: take the careful cut.
_ODD = r"  | \n|\n |\n\n\n|\A | \z|\n\n\z|" + "[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_NOTHING = pa.scalar(b"", pa.large_binary())
#: ASCII marks, none of them a letter, digit or white space.
_MARKS = string.punctuation


def compress(ranks: np.ndarray) -> bytes:
    """Control bytes, then data bytes."""
    values = ranks.astype("<u4")
    size = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    control = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    control[:len(values)] = size - 1
    control = control.reshape(-1, 4) @ np.array([1, 4, 16, 64], dtype=np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes() + data.tobytes()


def expand(raw: bytes, n: int) -> np.ndarray:
    """The n values that compress() was given."""
    head = -(-n // 4)
    size = _LENGTHS[np.frombuffer(raw, np.uint8, head)].reshape(-1)[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    data = np.concatenate([np.frombuffer(raw, np.uint8, offset=head), np.zeros(4, np.uint8)])
    out = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        out[longer] |= data[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


class Encoder:
    """The tokenizers library with a memory of the words it has encoded.

    A single space or line feed between two other characters always starts a token, and a word of
    letters shares none with the marks behind it. So a text is cut before its spaces and feeds, and
    a piece is a word and the marks behind it. Arrow cuts the texts and numbers distinct words and
    marks; new words are encoded together and told apart by the bytes that each token stands for;
    Arrow lays the ids end to end.
    """

    _held: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        size = self.library.get_vocab_size()
        self.width = np.zeros(size, dtype=np.int64)
        for token, k in self.library.get_vocab().items():
            self.width[k] = len(token)  # byte-level: one character stands for one byte
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.odd = "|".join([_ODD, *map(re.escape, special)])

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._held:
            cls._held[path] = cls(path)
        return cls._held[path]

    def _whole(self, text: str) -> bytes:
        return b"" if not text else np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Words without their leading space, or with a leading line feed; none empty."""
        for i in range(0, len(words), 1024):
            some = words[i:i + 1024]
            told = [w if w[0] == "\n" else " " + w for w in some]
            ids = np.array(self.library.encode_batch_fast(["".join(told)], add_special_tokens=False)[0].ids, dtype=self.kind)
            ends = np.cumsum(np.fromiter(map(len, map(str.encode, told)), np.int64, len(told)))
            cut = ((np.searchsorted(np.cumsum(self.width[ids]), ends) + 1) * ids.itemsize).tolist()
            self.memo.update(zip(some, map(ids.tobytes().__getitem__, map(slice, [0, *cut], cut)), strict=True))

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        if len(self.memo) > MEMO:
            self.older, self.memo = self.memo, {}
        if "\n" not in self.memo:  # would share a token with white space at the end of the word before it
            self.memo["\n"] = self._whole("\n")
        memo, older, new = self.memo, self.older, []
        raws = list(map(memo.get, words))
        for i in [i for i, raw in enumerate(raws) if raw is None]:
            raw = older.get(words[i])
            if raw is None:
                new.append(i)
            else:
                memo[words[i]] = raws[i] = raw
        self._learn([words[i] for i in new])
        for i in new:
            raws[i] = memo[words[i]]
        return raws

    def laid(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """Ids of each text (large_string, none NULL) as bytes, `end` behind them."""
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        order = np.argsort(odd, kind="stable")
        even = texts.filter(pa.array(~odd))
        even = pc.split_pattern(pc.replace_substring(even, "\n", " \n"), " ")
        careful = [_BETWEEN.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        flat = pa.concat_arrays([even.flatten(), pa.array(list(chain.from_iterable(careful)), pa.large_string())])
        count = np.concatenate([np.diff(even.offsets.to_numpy()), np.array([len(c) for c in careful], np.int64)])
        after = np.cumsum(count)
        leads = np.zeros(len(flat), bool)
        leads[after - count] = True
        first = _strings(flat.filter(pa.array(leads)))
        pieces = flat.filter(pa.array(~leads)).dictionary_encode()
        word, marks = (c.dictionary_encode() for c in _word_and_marks(pieces.dictionary))
        known = pa.array(self._known(_strings(word.dictionary)), pa.large_binary()).take(word.indices)
        behind = pa.array(map(self._whole, marks.dictionary.to_pylist()), pa.large_binary()).take(marks.indices)
        raws = pa.concat_arrays([pc.binary_join_element_wise(known, behind, _NOTHING), pa.array(map(self._whole, first), pa.large_binary())])
        codes = np.empty(len(flat), np.int32)
        codes[~leads], codes[leads] = pieces.indices.to_numpy(), np.arange(len(known), len(raws))
        _, offsets, data = raws.take(pa.array(codes)).buffers()
        edges = np.frombuffer(offsets, np.int64)[np.concatenate([[0], after])]
        ids = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(edges), data])
        return pc.binary_join_element_wise(ids.take(pa.array(np.argsort(order))), pa.scalar(end, pa.large_binary()), _NOTHING)

    def encode(self, texts: list[str], end: bytes = b"") -> list[bytes]:
        """Ids of each text as bytes, `end` behind them."""
        return self.laid(pa.array(texts, pa.large_string()), end).to_pylist() if texts else []


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()  # ten times as fast as to_pylist()


def _word_and_marks(pieces: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The word of letters that a piece begins with and the ASCII marks that are the rest of it; else the piece and nothing."""
    word = pc.utf8_rtrim(pieces, _MARKS)
    word = pc.if_else(pc.utf8_is_alpha(pc.utf8_ltrim(word, "\n")), word, pieces)
    length = pc.binary_length(pieces).to_numpy()
    size = length - pc.binary_length(word).to_numpy()
    data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)
    after = np.cumsum(size)
    to = np.frombuffer(pieces.buffers()[1], np.int64, len(pieces) + 1, 8 * pieces.offset)[1:] if len(pieces) else size
    cut = data[np.repeat(to - after, size) + np.arange(int(size.sum()))]
    marks = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(np.append(0, after)), pa.py_buffer(np.ascontiguousarray(cut)))
    return word, marks


def _tokenize(path: str, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        end = b"" if end_id is None else np.array([end_id], dtype=encoder.kind).tobytes()
        width = np.dtype(encoder.kind).itemsize
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            until = np.cumsum(pc.binary_length(texts).to_numpy())
            at = 0
            while at < len(texts):
                to = int(np.searchsorted(until, GROUP_BYTES + (until[at - 1] if at else 0))) + 1
                raw = encoder.laid(texts.slice(at, to - at), end)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, to - at), pc.divide(pc.binary_length(raw), width),
                     pa.array([width] * len(raw), pa.int32()), raw.cast(pa.binary())],
                    names=["doc", "n", "width", "ids"])
                at = to

    return run


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1, dtype=np.int64)
    for batch in batches:
        raws: dict[int, list[bytes]] = {}
        for width, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raws.setdefault(width, []).append(raw)
        for width, some in raws.items():
            seen = np.bincount(np.frombuffer(b"".join(some), f"<u{width}"))
            if len(seen) > len(total):
                total = np.concatenate([total, np.zeros(len(seen) - len(total), np.int64)])
            total[:len(seen)] += seen
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["id", "n"])


def _block(docs: list, lengths: list[int], ranks: np.ndarray, before: int) -> bytes:
    return b"".join([
        HEAD.pack(MAGIC, len(docs), before, len(ranks)), np.array([d or 0 for d in docs], "<i8").tobytes(),
        np.array([d is not None for d in docs], np.uint8).tobytes(), np.array(lengths, "<u4").tobytes(), compress(ranks)])


def _encode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, shard = shared.value, TaskContext.get().partitionId()
        block, before = 0, 0
        docs: list = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal block, before
            ranks = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            out = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int64()), pa.array([len(ranks)], pa.int64()),
                 pa.array([_block(docs, lengths, ranks, before)], pa.binary())],
                names=["shard", "block", "n_ids", "bytes"])
            block, before = block + 1, before + len(ranks)
            docs.clear(), lengths.clear(), parts.clear()
            return out

        for batch in batches:
            for doc, width, raw in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                docs.append(doc)
                parts.append(rank[np.frombuffer(raw, f"<u{width}")])
                lengths.append(len(parts[-1]))
                if sum(lengths[-1:]) >= BLOCK_IDS or len(docs) % 64 == 0 and sum(lengths) >= BLOCK_IDS:
                    yield close()
        if docs:
            yield close()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id",
                      text_col: str = "text", end_id: int | None = 2) -> None:
    """Encodes every whole text and writes blocks below path/blocks, the rank table below path/ranks.

    Documents are in ascending id order (NULL first; equal ids by a hash of their ids, then by their bytes). NULL and
    empty texts hold the end id alone. An empty table writes empty tables. Each text is
    tokenized once; rank counts are partial sums per task; the range shuffle carries ids, not
    text; a task holds one block. The id column must be integer.
    """
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    tokens = stored(source.mapInArrow(_tokenize(tokenizer, end_id), "doc long, n long, width int, ids binary"), "tokens")
    counted = tokens.select("width", "ids").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counted.write.mode("overwrite").parquet(f"{path}/ranks")
    spark = docs.sparkSession
    ids = read_ranks(spark, path)
    rank = np.zeros(int(ids.max()) + 1 if len(ids) else 1, dtype=np.uint32)
    rank[ids] = np.arange(len(ids))
    # ranges are drawn from a sample of their keys on the driver, so the ids' hash stands for them
    hashed = tokens.withColumn("hash", F.xxhash64("ids"))
    ordered = hashed.repartitionByRange("doc", "hash").sortWithinPartitions("doc", "hash", "ids").select("doc", "width", "ids")
    blocks = ordered.mapInArrow(_encode(spark.sparkContext.broadcast(rank)), "shard int, block long, n_ids long, bytes binary")
    blocks.write.mode("overwrite").option("compression", "none").parquet(f"{path}/blocks")


def read_ranks(spark, path: str) -> np.ndarray:
    """Ids by rank, commonest first (ties: smaller id): at most one row per vocabulary entry."""
    rows = spark.read.schema("id long, n long").parquet(f"{path}/ranks").collect()
    return np.array([r["id"] for r in sorted(rows, key=lambda r: (-r["n"], r["id"]))], dtype=np.int64)


def read_block(raw: bytes, ids: np.ndarray) -> tuple[int, list, list[np.ndarray]]:
    """Ids before the block in its shard, document ids, ids of each document."""
    magic, n, before, total = HEAD.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at = HEAD.size
    names, valid = np.frombuffer(raw, "<i8", n, at), np.frombuffer(raw, np.uint8, n, at + 8 * n)
    lengths = np.frombuffer(raw, "<u4", n, at + 9 * n).astype(np.int64)
    values = ids[expand(raw[at + 13 * n:], total)]
    docs = [int(d) if v else None for d, v in zip(names, valid, strict=True)]
    return before, docs, np.split(values, np.cumsum(lengths)[:-1]) if n else []


def _decode(shared, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for offset, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                before, docs, parts = read_block(raw, table)
                sizes = np.array([len(p) for p in parts], dtype=np.int64)
                columns = [pa.array(docs, pa.int64()), pa.array(offset + before + np.cumsum(sizes) - sizes, pa.int64()),
                           pa.array(sizes, pa.int64()),
                           pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in parts], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([p.tolist() for p in parts], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_token_files(spark, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    blocks = spark.read.schema("shard int, block long, n_ids long, bytes binary").parquet(f"{path}/blocks")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("_n"))
    offsets = shards.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))  # one row per shard
    table = spark.sparkContext.broadcast(read_ranks(spark, path))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return blocks.join(F.broadcast(offsets), "shard").select("_from", "bytes").mapInArrow(_decode(table, with_ids), schema)
