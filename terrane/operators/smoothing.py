"""Locally weighted regression of a surface along a path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def local_regression(
    points: DataFrame, path: DataFrame, bandwidth: float, by: Sequence[str] = (),
    x: str = "x", z: str = "z", node: str = "node",
) -> DataFrame:
    """Local straight-line fit of z at every node of the path, with tricube weights of
    the points nearer than ``bandwidth`` in x.

    The axis is cut into cells as wide as the bandwidth. A node looks into its own and
    the two neighbouring cells, so the join is on the cell, and each node needs only
    five weighted sums. Points of equal x are summed before they meet the nodes.
    """
    cell = F.floor(F.col(x) / F.lit(bandwidth)).cast("bigint")
    data = points.filter(F.col(x).isNotNull() & F.col(z).isNotNull()).select(
        *by, F.col(x).cast("double").alias("_x"), F.col(z).cast("double").alias("_z"),
        cell.alias("_cell"),
    ).groupBy(*by, "_x", "_cell").agg(F.count(F.lit(1)).alias("_n"), F.sum("_z").alias("_z"))
    home = F.floor(F.col(node) / F.lit(bandwidth)).cast("bigint")
    nodes = path.select(*by, F.col(node).cast("double").alias(node)).distinct().withColumn(
        "_cell", F.explode(F.array(home - 1, home, home + 1))
    )
    u = F.col("_x") - F.col(node)
    far = F.abs(u) / F.lit(bandwidth)
    w = F.pow(1 - F.pow(far, F.lit(3)), F.lit(3))
    sums = data.join(nodes, [*by, "_cell"]).filter(far < 1).groupBy(*by, node).agg(
        F.sum("_n").alias("n"), F.sum(w * F.col("_n")).alias("s"),
        F.sum(w * u * F.col("_n")).alias("su"), F.sum(w * u * u * F.col("_n")).alias("suu"),
        F.sum(w * F.col("_z")).alias("sz"),
        F.sum(w * u * F.col("_z")).alias("suz"),
    )
    det = F.col("s") * F.col("suu") - F.col("su") * F.col("su")
    line = (F.col("suu") * F.col("sz") - F.col("su") * F.col("suz")) / det
    flat = F.col("s") * F.col("suu") * F.lit(1e-12)
    return sums.select(
        *by, node, "n",
        F.when(det > flat, line).otherwise(F.col("sz") / F.col("s")).alias("z_smoothed"),
    )
