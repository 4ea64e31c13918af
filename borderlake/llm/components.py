"""Connected components by randomised contraction, each round a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b), both long; nodes of one component
    share a root, which is one of them.

    In each round a node joins that one of its neighbours and itself whose hash, seeded
    by the round, is smallest. The joined nodes become one, so about half of them go in
    a round whatever the shape of the graph. A node with very many neighbours is reduced
    by the map-side part of an aggregate."""
    label = {"a": "b", "b": "a"}
    edges = stored(edges.filter("a != b").distinct(), "edges")
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        salt = F.lit(len(moves))

        def hashed(name: str) -> F.Column:
            return F.struct(F.xxhash64(salt, name).alias("h"), F.col(name).alias("to"))

        both = edges.select("a", "b").union(edges.select(*label.values()).toDF("a", "b"))
        nearest = both.groupBy(F.col("a").alias("node")).agg(F.min(hashed("b")).alias("best"))
        move = stored(nearest.select("node", F.least("best", hashed("node"))["to"].alias("root")), "moves")
        moves.append(move)
        next_edges = edges
        for side in ("a", "b"):
            joined = next_edges.join(move.toDF(side, f"to_{side}"), side)
            next_edges = joined.drop(side).withColumnRenamed(f"to_{side}", side)
        next_edges = stored(next_edges.select("a", "b").filter("a != b").distinct(), "edges")
        drop_stored(edges)
        edges = next_edges
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves[-1]
    for move in reversed(moves[:-1]):
        later = found.select(F.col("node").alias("root"), F.col("root").alias("later"))
        found = move.join(later, "root", "left").select("node", F.coalesce("later", "root").alias("root"))
    return found
