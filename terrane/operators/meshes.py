"""The 25 x 25 mesh of every triple."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions.numbers import MESH_STEPS, axis_bounds
from terrane.operators.factors import BY_TRIPLE


def axis_spans(rows: DataFrame, by: Sequence[str] = BY_TRIPLE) -> DataFrame:
    """Means, and least and greatest axis values, of every triple in one aggregation."""
    return rows.groupBy(*by).agg(
        *[F.avg(v).alias(f"m{v}") for v in "xyz"],
        *[f(v).alias(f"{name}_{v}") for v in "xy"
          for name, f in (("low", F.min), ("high", F.max))],
    )


def axis_ranges(spans: DataFrame, by: Sequence[str] = BY_TRIPLE) -> DataFrame:
    """Rounded bounds of both axes; ``reason`` tells why a triple has no mesh."""
    bounds = {}
    for v in "xy":
        lower, upper = axis_bounds(F.col(f"low_{v}"), F.col(f"high_{v}"))
        bounds[f"{v}_lower"], bounds[f"{v}_upper"] = lower, upper
    flat = F.col("x_lower").isNull() | F.col("y_lower").isNull()
    return spans.select(*by, *[c.alias(name) for name, c in bounds.items()]).withColumn(
        "reason", F.when(flat, F.lit("constant axis"))
    )


def mesh(ranges: DataFrame, by: Sequence[str] = BY_TRIPLE, steps: int = MESH_STEPS) -> DataFrame:
    """Mesh points ``ix iy x y``; each axis has ``steps`` points from its lower bound."""
    index = F.sequence(F.lit(0), F.lit(steps - 1))

    def point(axis: str) -> Column:
        width = (F.col(f"{axis}_upper") - F.col(f"{axis}_lower")) / F.lit(float(steps))
        return F.col(f"{axis}_lower") + F.col(f"i{axis}") * width

    return (
        ranges.filter(F.col("reason").isNull())
        .withColumn("ix", F.explode(index))
        .withColumn("iy", F.explode(index))
        .select(*by, "ix", "iy", point("x").alias("x"), point("y").alias("y"))
    )
