"""Connected components by contraction, for link tables of any size and shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b): two nodes share a root exactly if
    links lead from one to the other.

    In each round every node points to the neighbour, or itself, with the smallest hash of
    that round, and the links are drawn anew between the nodes pointed to. Random hashes
    make chains shrink as fast as stars. Each round is written to the shared folder, so a
    lost executor costs one round. No links give an empty table.
    """
    edges = written(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a <> b").distinct(), "links")
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        order = F.xxhash64("b", F.lit(len(maps)))
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = written(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min(F.struct(order.alias("h"), F.col("b"))).alias("least"))
            .select("node", F.when(F.xxhash64("node", F.lit(len(maps))) < F.col("least.h"),
                                   F.col("node")).otherwise(F.col("least.b")).alias("parent")),
            "parents")
        maps.append(parent)
        edges = written(
            edges.join(parent, edges.a == parent.node)
            .select(F.col("parent").alias("a"), "b")
            .join(parent, F.col("b") == parent.node)
            .select(F.least("a", "parent").alias("a"), F.greatest("a", "parent").alias("b"))
            .where("a <> b").distinct(), "links")
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = maps[-1].select("node", F.col("parent").alias("root"))
    for parent in reversed(maps[:-1]):
        later = found.select(F.col("node").alias("parent"), "root")
        found = parent.join(later, "parent", "left").select(
            "node", F.coalesce("root", "parent").alias("root"))
    return found
