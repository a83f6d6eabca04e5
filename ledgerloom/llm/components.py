"""Connected components of an edge table, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stage


def _state(edges: DataFrame) -> tuple:
    # the sum is taken over 32-bit parts, so that it can't overflow
    return tuple(
        edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.hash("v", "u").cast("long"))).first()
    )


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (the larger ones, or the smaller ones) linked to its smallest."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if large:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Root of every node of the edges (u, v): ``node, root``, the root being the smallest.

    Alternates the large-star and small-star steps until the edges are stars. Both shrink a
    chain of n links in about log(n) rounds; each round's edges are a written table, no row of
    which reaches the driver but a count and two checksums. Hot nodes are skewed join keys,
    which AQE splits; their neighbours never meet in one group.
    """
    edges = (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )
    edges = stage(edges, "edges")
    before = _state(edges)
    while before[0]:
        edges = stage(_stars(_stars(edges, True), False), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
