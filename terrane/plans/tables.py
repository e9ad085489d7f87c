"""From the extracts to the imputed wide tables and the landscapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.operators.factors import Triple, factor_triples
from terrane.operators.features import long_features, subtype_table
from terrane.operators.imputing import impute_table
from terrane.operators.landscapes import Landscape, plane_landscape
from terrane.operators.merging import COLUMN_MARKS
from terrane.operators.trees import FAMILIES, Family, tree_landscape
from terrane.session import written


def consolidated(
    genetic: DataFrame, distances: DataFrame, energies: DataFrame, references: DataFrame,
    antigenic: DataFrame, individual: bool = False,
    subtypes: Sequence[str] = tuple(COLUMN_MARKS),
) -> dict[str, DataFrame]:
    """The wide table of every subtype, before imputation. The long twin is written once, and
    every table pivots its own labels of it."""
    long = written(long_features(distances, antigenic, individual), "long-features")
    return {
        subtype: subtype_table(long, genetic, energies, references, subtype, individual)
        for subtype in subtypes
    }


def write_tables(tables: dict[str, DataFrame], root: str, prefix: str = "") -> None:
    """Wide tables and their imputed forms. The columns differ by subtype, so each has
    its own folder, named by its mark."""
    for subtype, table in tables.items():
        folder = f"{root.rstrip('/')}/{prefix}{COLUMN_MARKS[subtype]}"
        table.write.mode("overwrite").parquet(f"{folder}_consolidated")
        stored = table.sparkSession.read.parquet(f"{folder}_consolidated")
        impute_table(stored).write.mode("overwrite").parquet(f"{folder}_iconsolidated")


def reportable_lots(sera: DataFrame) -> list[str]:
    """Lots of the recent seasons: names that pick columns, a few dozen."""
    return [r[0] for r in sera.select("lot").distinct().sort("lot").collect()]


def write_landscapes(
    table: DataFrame, root: str, name: str, key: Sequence[str], context: str = "antigenic",
    lots: Sequence[str] | None = None, **options: object,
) -> list[Triple]:
    """Plane landscapes of all triples of one wide table, as four tables."""
    triples = factor_triples(table.columns, context, lots)
    _write(plane_landscape(table, triples, key, **options), root, name)
    return triples


def write_tree_landscapes(
    table: DataFrame, root: str, name: str, key: Sequence[str], triples: Sequence[Triple],
    families: Sequence[Family] = FAMILIES, **options: object,
) -> None:
    """Tree landscapes of the triples of one wide table, as four tables, written anew."""
    _write(tree_landscape(table, triples, key, families, **options), root, name)


def _write(result: Landscape, root: str, name: str) -> None:
    folder = f"{root.rstrip('/')}/{name}"
    by = [F.col(c) for c in ("x_factor", "y_factor", "z_factor")]
    result.mesh.repartition(*by).write.mode("overwrite").parquet(f"{folder}_plandscape")
    result.metrics.write.mode("overwrite").parquet(f"{folder}_plandscape_metrics")
    result.summary.write.mode("overwrite").parquet(f"{folder}_plandscape_summary")
    result.triples.write.mode("overwrite").parquet(f"{folder}_plandscape_triples")
