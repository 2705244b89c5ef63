"""SimHash near-dedup with deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.llm.common import ROW, packed, stored, unpacked
from tidegauge.llm.components import components

BITS, DISTANCE = 64, 4
SEED = 42
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64 majority bits over the XXH64 values of the word shingles, repeats included; signed."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    begin = end - size
    n = max(1, len(words) - shingle + 1)
    ends = end[-n:] if len(words) >= shingle else end[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(begin[:n].tolist(), ends.tolist(), strict=True)], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        piece = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(None if (v := x.as_py()) is None else str(v), shingle) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.int64()), *batch.columns[1:]],
                                             names=["_fp", *batch.schema.names[1:]])

    return run


def segments(distance: int = DISTANCE) -> list[tuple[int, int]]:
    """(first bit, width): as few segments as make one of them differ in at most one bit.

    `distance` differing bits over s segments leave one with at most distance // s of them.
    """
    count = distance // 2 + 1
    cut = [BITS * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:], strict=False)]


def _mask(first: int, width: int) -> int:
    return ((1 << width) - 1) << first


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint_links(fingerprints: DataFrame, column: str = "_fp", distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at `distance` or fewer differing bits.

    Each fingerprint is indexed under every segment with each one bit of it deleted (64
    variants); two fingerprints within the distance share a variant of some segment. A pair is
    verified inside the join and given out under one variant only: that of the first segment
    with at most one differing bit, deleted at that bit (at the segment's first bit, if equal).
    """
    cut = segments(distance)
    variants = F.array(*[
        F.struct(F.lit(first + k).cast("tinyint").alias("at"),
                 F.col(column).bitwiseAND(F.lit(_signed(_mask(first, width) & ~(1 << (first + k))))).alias("rest"))
        for first, width in cut for k in range(width)])
    index = fingerprints.select(F.col(column).alias("fp"), F.explode(variants).alias("_v")).select("fp", "_v.at", "_v.rest")
    left, right = index.select(F.col("fp").alias("a"), "at", "rest"), index.select(F.col("fp").alias("b"), "at", "rest")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    first_variant = F.coalesce(*[
        F.when(F.bit_count(part) == 1, F.round(F.log2(F.abs(part.cast("double")))).cast("int")).when(F.bit_count(part) == 0, F.lit(first))
        for first, width in cut for part in [differ.bitwiseAND(F.lit(_signed(_mask(first, width))))]])
    # the index is 64 times its table, which Spark's size estimate does not see: never broadcast it
    return left.hint("merge").join(right, (left["at"] == right["at"]) & (left["rest"] == right["rest"]) & (F.col("a") < F.col("b"))
                     & (F.bit_count(differ) <= distance) & (left["at"] == first_variant)).select("a", "b")


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    distance: int = DISTANCE) -> DataFrame:
    """One row per row of docs: its id (named as in docs), text_md5, fingerprint, component_id.

    Documents with equal fingerprints are one node, so a group of copies is one row before
    anything is joined. component_id is the smallest id that links reach, the document's own
    included. Texts without words (NULL, empty, blank) have fingerprint zero and are linked
    like any other. A NULL id takes part in links, but is a component's id only if all its ids
    are NULL. Repeated rows stay; an empty table gives an empty result. The shuffles carry
    fingerprints and ids, never texts.
    """
    text = F.col(f"`{text_col}`").cast("string")
    slim = stored(
        docs.select(text.alias("_text"), F.col(f"`{id_col}`").alias("_id"), F.md5(F.coalesce(text, F.lit(""))).alias("_t"))
        .mapInArrow(_fingerprints(shingle), T.StructType([
            T.StructField("_fp", T.LongType()), T.StructField("_id", docs.schema[id_col].dataType),
            T.StructField("_t", T.StringType())])),
        "fingerprints")
    nodes = stored(slim.groupBy("_fp").agg(F.min("_id").alias("_least")), "nodes")
    found = components(fingerprint_links(nodes, "_fp", distance), "a", "b")
    member = nodes.join(found, nodes["_fp"] == found["node"], "left").select(
        "_fp", "_least", F.coalesce("root", "_fp").alias("_root"))
    roots = member.groupBy("_root").agg(F.min("_least").alias("component_id"))
    classes = stored(member.join(roots, "_root").select("_fp", "component_id"), "classes")
    return slim.join(classes, "_fp").select(
        F.col("_id").alias(id_col), F.col("_t").alias("text_md5"),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with one document of each group: the row whose id is the component's.

    Of rows that share that id, the one with the smallest text digest stays, once; a group
    whose ids are all NULL keeps one row likewise.
    """
    classes = simhash_classes(docs, id_col, text_col, **options)
    keep = (
        classes.filter(F.col(id_col).eqNullSafe(F.col("component_id")))
        .groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("_f"))
        .agg(F.min("text_md5").alias("_t2")).select(F.col("component_id").alias("_id2"), "_t2")
    )
    rows = packed(docs)
    text = F.coalesce(F.col(ROW).getField(text_col).cast("string"), F.lit(""))
    found = rows.join(keep, F.col(ROW).getField(id_col).eqNullSafe(F.col("_id2")) & (F.md5(text) == F.col("_t2")), "left_semi")
    once = found.groupBy(F.col(ROW).getField(id_col).alias("_i"), F.md5(text).alias("_m")).agg(F.first(ROW).alias(ROW))
    return unpacked(once, docs.columns, {})
