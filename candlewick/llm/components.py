"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from candlewick.llm import common as C


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Connect neighbours of every node to the least node of its neighbourhood: all larger
    neighbours (large star), or the node and its smaller neighbours (small star)."""
    if small:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    else:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = C.shared_table(around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"),
                                                   F.count(F.lit(1)).alias("degree")), "star")
    linked = C.join_counted(around, least, ["a"], "degree")       # the centre of a star is a hot key
    if small:
        linked = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    else:
        linked = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return C.shared_table(linked.where("a <> b").distinct(), "edges")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)),
                           F.bit_xor(F.xxhash64(F.greatest("a", "b"), F.least("a", "b")))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns a, b; long): root is the least node
    of its component. Rounds are logarithmic in the longest path; each starts from a table in
    the shared folder."""
    edges = C.shared_table(edges.where("a <> b").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        edges = _star(_star(edges, small=False), small=True)
        new = _mark(edges)
        if new == mark:
            break
        mark = new
    stars = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root")).distinct()
