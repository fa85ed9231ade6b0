"""Connected components of distributed edges by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelab.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    both = edges.select(F.col("u"), F.col("v")).union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy(F.col("v")).agg(F.min("u").alias("m"))
    tied = edges.join(least, "v").where("u > m").select(F.col("m").alias("u"), F.col("u").alias("v"))
    return tied.union(least.select(F.col("m").alias("u"), "v")).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node on an edge; root is the least node of its
    component.  Edges never leave the executors; each round is written to the
    checkpoint folder, and the rounds end when the stars no longer change
    (a number logarithmic in the nodes)."""
    now = materialize(edges.where(F.col(a) != F.col(b)).select(
        F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first()
        if state == before or state[0] == 0:
            break
        before = state
        now = materialize(_small_star(_large_star(now)), "stars")
    return (now.select(F.col("v").alias("node"), F.col("u").alias("root"))
            .union(now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()))
