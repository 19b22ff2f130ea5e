"""Connected components of a table of links, in rounds of edge contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch


def components(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) for every id that has a link; component_id is the smallest id reachable.

    In each round every node joins the neighbour with the most links, itself included, and edges are
    redrawn between what has been joined.  A star is joined at once; ranks of equal degree are random
    anew in each round, so long paths shrink by a constant factor.  A node with very many links is no burden: minima are
    taken in each task first, and joins on its id are of the kind that Spark splits when skewed.
    """
    edges = scratch.keep(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "edges"
    )
    ends = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    label = scratch.keep(ends.withColumn("at", F.col("id")), "labels")
    seed = 0
    while not edges.isEmpty():
        seed += 1
        both = edges.union(edges.select("b", "a"))
        # Stored first: rows that meet it are then read as they lie, and a node of very many links can be split.
        degree = scratch.keep(both.groupBy("b").agg(F.count(F.lit(1)).alias("d")), "degrees")
        rank = lambda c, d: F.struct((-d).alias("d"), F.xxhash64(c, F.lit(seed)).alias("h"), F.col(c).alias("p"))
        best = both.join(degree, "b").groupBy("a").agg(F.min(rank("b", F.col("d"))).alias("best"), F.count(F.lit(1)).alias("d"))
        parent = scratch.keep(best.select("a", F.least("best", rank("a", F.col("d")))["p"].alias("p")), "parents")
        redrawn = scratch.keep(
            edges.join(parent, "a")
            .select(F.col("p").alias("x"), "b")
            .join(parent.select(F.col("a").alias("b"), F.col("p").alias("y")), "b")
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "edges",
        )
        moved = scratch.keep(
            label.join(parent.withColumnRenamed("a", "at"), "at", "left").select("id", F.coalesce("p", "at").alias("at")),
            "labels",
        )
        scratch.drop(edges, label, parent, degree)
        edges, label = redrawn, moved
    least = label.groupBy("at").agg(F.min("id").alias("component_id"))
    found = scratch.keep(label.join(least, "at").select("id", "component_id"), "components")
    scratch.drop(edges, label)
    return found
