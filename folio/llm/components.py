"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.shared import drop, stored

#: Parts that a hub's arcs are dealt to.
SALTS = 1024


def _star(arcs: DataFrame) -> DataFrame:
    """arcs (u, v) with each u's least neighbour or itself as m.

    Arcs are dealt by (u, salt), so a hub's are not gathered; a row for each (u, salt) there is, SALTS for a node at most, takes m to them.
    """
    salted = arcs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    part = salted.groupBy("u", "salt").agg(F.min("v").alias("m"))
    least = part.groupBy("u").agg(F.least(F.min("m"), F.col("u")).alias("m"), F.collect_list("salt").alias("salts"))
    return salted.join(least.select("u", "m", F.explode("salts").alias("salt")), ["u", "salt"]).select("u", "v", "m")


def _settled(edges: DataFrame) -> bool:
    """Whether every node that hangs on another hangs on one only, which hangs on none."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("hangs")).unionByName(edges.select(F.col("v").alias("x"), F.lit(None).cast("int").alias("hangs")))
    found = ends.groupBy("x").agg(F.count("hangs").alias("up"), F.count_if(F.col("hangs").isNull()).alias("down"))
    return found.where("up > 1 or up > 0 and down > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in edges (a, b): root is the least node that can be reached.

    Each round hangs neighbours on their least common neighbour until every node hangs on
    its root. Rounds grow with the logarithm of the longest chain. No edges: no rows.
    """
    edges = stored(edges.select("a", "b").where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        small = _star(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        before, edges = edges, stored(small.where("u != v").distinct(), "small")
        drop(before, large)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
