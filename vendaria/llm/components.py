"""Connected components of links that no machine holds together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaria.sources.scratch import materialize


def components(links: DataFrame, path: str) -> DataFrame:
    """`node` and `root` (the smallest node that links lead to) for every node of `links` (a, b).

    In each round every node points to the smallest of itself and its neighbours, pointers are followed to their
    ends, and the graph is contracted to the roots. Roots are never neighbours, so each round leaves at most half of
    the nodes that still have links. Each step is written to `path` before the next reads it.
    """
    both = links.filter("a <> b").select("a", "b")
    both = both.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    edges = materialize(both, f"{path}/edges-0")
    roots, step = None, 0
    while not edges.isEmpty():
        step += 1
        pointers = edges.groupBy("a").agg(F.least("a", F.min("b")).alias("root")).withColumnRenamed("a", "node")
        pointers = materialize(pointers, f"{path}/pointers-{step}-0")
        jump = 0
        while True:
            jump += 1
            ends = pointers.select(F.col("node").alias("root"), F.col("root").alias("end"))
            followed = pointers.join(ends, "root").select("node", F.col("end").alias("root"), "root").toDF("node", "root", "was")
            followed = materialize(followed, f"{path}/pointers-{step}-{jump}")
            pointers = followed.select("node", "root")
            if followed.filter("root <> was").isEmpty():
                break
        if roots is None:
            roots = pointers
        else:
            moved = pointers.select(F.col("node").alias("root"), F.col("root").alias("end"))
            roots = roots.join(moved, "root", "left").select("node", F.coalesce("end", "root").alias("root"))
            roots = materialize(roots, f"{path}/roots-{step}")
        of_a = pointers.select(F.col("node").alias("a"), F.col("root").alias("c"))
        of_b = pointers.select(F.col("node").alias("b"), F.col("root").alias("d"))
        edges = edges.join(of_a, "a").join(of_b, "b").filter("c <> d").select(F.col("c").alias("a"), F.col("d").alias("b"))
        edges = materialize(edges.distinct(), f"{path}/edges-{step}")
    return roots if roots is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
