"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b), any orientation, to (node, label): the smallest node of each
    node's component.  Nodes without links are absent.

    Each step points the neighbours of a node at its smallest neighbour, first the
    larger ones, then the smaller ones; minima are aggregated map-side, so a hub
    is never collected.  Steps are written tables; it ends when a step changes
    nothing, after about log(size) steps.
    """
    big, small = F.greatest("a", "b"), F.least("a", "b")
    edges = stored(links.select(big.alias("a"), small.alias("b")).where("a <> b").distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: larger neighbours to the smallest
        edges = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: smaller neighbours and the node itself to the smallest
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        edges = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        edges = stored(edges, "links")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    return edges.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("node"), "label").unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Tells two edge sets apart, whatever their order."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first())
