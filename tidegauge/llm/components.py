"""Connected components of a link table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import cut_lineage


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of the links; root is the smallest node it is connected with.

    Alternates the large-star and small-star steps until the links are stars; each step keeps
    connectivity and never more links than before, and the number of rounds grows with the
    logarithm of the size. Every round is an aggregate (partial per task, so a hub costs one
    row per task) and a join back, cut off with a reliable checkpoint. Nodes may be of any
    type with an order; NULL ends and self links are ignored.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = cut_lineage(edges)
    state = _state(edges)
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame):
    """Count and order-free checksum: two equal values mean that a round changed nothing."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of u to the smallest of u and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links u and its smaller neighbours to the smallest of them; here every v is below its u."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.union(least.select("u", F.col("m").alias("v"))).distinct()
