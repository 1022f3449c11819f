"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelfold.llm.common import through_table


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is the smallest node.

    Each round links every node's larger neighbours to its smallest one, then the
    smaller ones, until the edges are stars around their smallest nodes.  Rounds
    are written to the shared folder; the driver sees a count and a checksum.  The
    smallest neighbours are written before they meet the edges: both sides of the
    join are then plain exchanges, so adaptive execution can split the edges of a
    node that most others hang on.
    Fails loudly if ``max_rounds`` (ample: rounds grow with the logarithm of the
    nodes) are not enough.
    """
    e = through_table(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "star-edges")
    mark = _mark(e)
    for _ in range(max_rounds):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = through_table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
                            "star-low")
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = through_table(large, "star-large")
        low2 = through_table(large.groupBy("a").agg(F.min("b").alias("m")), "star-low")
        small = (large.join(low2, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low2.select("a", "m")).distinct())
        e = through_table(small, "star-edges")
        new = _mark(e)
        if new == mark:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                e.select("b", "b").distinct())
        mark = new
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
    return tuple(r)
