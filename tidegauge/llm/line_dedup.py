"""Line dedup: lines that many documents share stay in one document only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import BLANKS, ROW, ascii_lower, packed, unpacked


def line_key(trimmed):
    """The key of a line that has no ASCII white space at its ends: A-Z lower-cased."""
    return F.when(F.octet_length(trimmed) == F.length(trimmed), F.lower(trimmed)).otherwise(ascii_lower(trimmed))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 20, min_docs: int = 3, salts: int = 16) -> DataFrame:
    """Drops lines whose key is in at least `min_docs` documents, except in the largest id.

    Lines are exploded to (128-bit hash of the key, document, position); documents are counted
    per hash after a distinct, both with partial aggregates, so a line in a third of all
    documents weighs no more than one row per task. The verdict goes back to the lines by a
    join on (hash, salt), then positions are gathered per document (bounded by its lines) and
    the document is put together again from the positions that stay.

    Returns the columns of docs with `n_lines`, `n_dropped` and `kept_text`; columns of docs
    with these names are replaced. NULL and empty text: one empty line. Rows with the same id
    count as one document; a NULL id counts as one document below all others. Empty table:
    empty result.
    """
    rows = packed(docs)
    text = F.coalesce(F.col(ROW).getField(text_col).cast("string"), F.lit(""))
    lines = (
        rows.select(F.col(ROW).getField(id_col).alias("_id"), F.md5(text).alias("_t"),
                    F.posexplode(F.split(text, "\n", -1)).alias("_pos", "_line"))
        .withColumn("_line", F.btrim("_line", F.lit(BLANKS)))
        .filter(F.length("_line") >= min_chars)
        .select("_id", "_t", "_pos", F.unhex(F.md5(line_key(F.col("_line")))).alias("_k"))
    )
    held = lines.select("_k", "_id").distinct()
    shared = (
        held.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_keeper"))
        .filter(F.col("_n") >= min_docs)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    salted = lines.withColumn("_salt", F.pmod(F.xxhash64("_id", "_t"), F.lit(salts)).cast("int"))
    drops = (
        salted.join(shared, ["_k", "_salt"])
        .filter(~F.col("_id").eqNullSafe(F.col("_keeper")))
        .groupBy("_id", "_t").agg(F.collect_set("_pos").alias("_drop"))
        .withColumnRenamed("_id", "_id2").withColumnRenamed("_t", "_t2")
    )
    joined = rows.join(
        drops, F.col(ROW).getField(id_col).eqNullSafe(F.col("_id2")) & (F.md5(text) == F.col("_t2")),
        "left")
    parts = F.split(text, "\n", -1)
    every = F.sequence(F.lit(0), F.size(parts) - 1)
    stay = F.array_sort(F.array_except(every, F.coalesce(F.col("_drop"), F.array().cast("array<int>"))))
    kept = F.when(F.col("_drop").isNull(), text).otherwise(
        F.array_join(F.transform(F.arrays_zip(stay.alias("p")), lambda z: F.element_at(parts, z["p"] + 1)), "\n"))
    return unpacked(joined, docs.columns, {
        "n_lines": F.size(parts).cast("long"),
        "n_dropped": F.coalesce(F.size("_drop"), F.lit(0)).cast("long"),
        "kept_text": kept,
    })
