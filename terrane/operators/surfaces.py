"""One surface out of the landscape table: selection, grid, points, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions.labels import x_axis_label, y_axis_label, z_axis_label
from terrane.functions.numbers import MESH_STEPS
from terrane.functions.predicates import quoted
from terrane.operators.factors import TRIPLE


def pick_surface(
    surface: DataFrame, x: str | None = None, y: str | None = None, z: str | None = None
) -> DataFrame:
    """Mesh points of one triple. Axes that are not named are the first by name, x before
    y before z, among the triples with the named ones."""
    named = {c: name for c, name in zip(TRIPLE, (x, y, z)) if name is not None}
    for column, name in named.items():
        surface = surface.filter(F.col(column) == F.lit(name))
    if len(named) == len(TRIPLE):
        return surface
    first = surface.agg(F.min(F.struct(*TRIPLE))).scalar()
    return surface.filter(F.struct(*TRIPLE) == first)


def surface_grid(surface: DataFrame, steps: int = MESH_STEPS) -> DataFrame:
    """Rows by y, one column ``x0 .. x24`` per mesh step of x, with the mean of z.

    The columns are mesh steps and not x values, so that the schema is the same for
    every surface; ``grid_axis`` gives the x value of each step.
    """
    grid = surface.groupBy(*TRIPLE, "y_predicted").pivot("ix", list(range(steps))).agg(
        F.avg("z_predicted")
    )
    return grid.withColumnsRenamed({str(i): f"x{i}" for i in range(steps)})


def grid_axis(surface: DataFrame) -> DataFrame:
    return surface.select(*TRIPLE, "ix", "x_predicted").distinct()


def observed_points(df: DataFrame, x: str, y: str, z: str, key: str = "variant_hash") -> DataFrame:
    """Rows of the wide table with all three values of a surface."""
    return df.select(
        quoted(key), quoted(x).alias("x"), quoted(y).alias("y"), quoted(z).alias("z")
    ).dropna()


def axis_labels(triples: DataFrame) -> DataFrame:
    """Readable labels of the axes of each triple."""
    return triples.select(
        *TRIPLE,
        x_axis_label(F.col("x_factor")).alias("x_label"),
        y_axis_label(F.col("y_factor")).alias("y_label"),
        z_axis_label(F.col("z_factor")).alias("z_label"),
    )
