"""Mixing sources to target weights by repeating documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import ROW, packed, stored, unpacked, with_running

#: Hash-seeded draws that one SHA-256 digest yields (32 bits each).
DRAWS = 8


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """`target` for each row (source, source_size) of sizes.

    Sources in code-point order, NULL last, take the weights in turn. Shares follow the
    weights; a share stops at cap * source_size and the excess is shared again until none is
    above. That fixed point is min(cap * size, weight * level); with sources sorted by
    cap * size / weight, the level is the largest of (rest of all sizes) / (rest of the
    weights), so running sums give it without a loop.
    """
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = with_running(sizes, [F.col("source").asc_nulls_last()], {"_rank": F.lit(1)})
    ranked = ranked.withColumn("_w", turn).withColumn("_cap", F.col("source_size") * cap)
    order = [(F.col("_cap") / F.col("_w")).asc(), F.col("source").asc_nulls_last()]
    filled = with_running(ranked, order, {"_capped": F.col("_cap"), "_used": F.col("_w")})
    totals = filled.agg(F.sum("source_size").alias("_all"), F.sum("_w").alias("_all_w"))
    filled = filled.join(F.broadcast(totals), F.lit(True))
    level = filled.select(F.max(
        (F.col("_all") - F.col("_capped")).cast("double") / (F.col("_all_w") - F.col("_used")).cast("double")
    ).alias("_level"))
    return filled.join(F.broadcast(level), F.lit(True)).select(
        "source", "source_size",
        F.least(F.col("_cap").cast("double"), F.col("_w") * F.col("_level")).alias("target"))


def _draw(digest, k: int):
    return F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """Adds size, source_size, target, copies and taken; `repeated` emits the copies.

    A source's repetition rate is target / source_size (at most cap). Each document is taken
    floor(rate) times and once more with probability rate - floor(rate). The draw is a 32-bit
    piece of SHA-256 of the id, so reruns agree. Each digest holds 8 such pieces; every source
    uses the piece whose sum comes nearest its target (one more partial aggregate), which keeps
    sources of few or very uneven documents near their targets.

    size: runs of characters other than ASCII white space; NULL text: 0. NULL source is a
    source of its own, last in order. Rows with the same id draw alike; a NULL id draws as the
    empty string. Sources without words have target 0 and take nothing. Columns of docs with
    the names of new ones are replaced. Per-source rows are the only ones joined back; Spark
    broadcasts them only below its size threshold and splits a hot source otherwise.
    """
    rows = packed(docs)
    field = F.col(ROW).getField
    size = F.coalesce(F.regexp_count(field(text_col).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    digest = F.sha2(F.coalesce(field(id_col).cast("string"), F.lit("")).cast("binary"), 256)
    slim = stored(rows.select(field(source_col).cast("string").alias("source"), size.alias("size"), digest.alias("_h")), "sizes")
    per = stored(source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap), "targets")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))).otherwise(0.0)
    base, part = F.floor(rate), (rate - F.floor(rate)) * 4294967296.0
    per = per.select("source", "source_size", "target", base.alias("_base"), part.alias("_part"))
    sums = (
        slim.join(per.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .groupBy("_s").agg(*[
            F.sum(F.col("size") * (F.col("_base") + (_draw(F.col("_h"), k) < F.col("_part")).cast("long"))).alias(f"_t{k}")
            for k in range(DRAWS)])
        .withColumnRenamed("_s", "_s2")
    )
    chosen = stored(
        per.join(sums, F.col("source").eqNullSafe(F.col("_s2")))
        .withColumn("_k", F.array_min(F.array(*[
            F.struct(F.abs(F.col(f"_t{k}") - F.col("target")).alias("d"), F.lit(k).alias("k"))
            for k in range(DRAWS)])).getField("k"))
        .select("source", "source_size", "target", "_base", "_part", "_k"), "chosen")
    joined = rows.join(chosen, field(source_col).cast("string").eqNullSafe(F.col("source")))
    draw = F.conv(F.substring(digest, F.col("_k") * 8 + 1, F.lit(8)), 16, 10).cast("long")
    copies = F.col("_base") + (draw < F.col("_part")).cast("long")
    return unpacked(joined, docs.columns, {
        "size": size, "source_size": F.col("source_size"), "target": F.col("target"),
        "copies": copies, "taken": size * copies})


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row `copies` times."""
    return (mixed.filter(F.col("copies") > 0)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(*[F.col(f"`{c}`") for c in columns]))
