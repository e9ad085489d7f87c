"""Refresh of all extracts the later steps read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from terrane.operators.antisera import reportable_sera
from terrane.operators.eligibility import Warehouse
from terrane.operators.titers import individual_summary, titer_summary
from terrane.operators.versions import distance_extract, energy_summary
from terrane.sources.tables import load_table


def open_warehouse(spark: SparkSession, databases: Mapping[str, str]) -> Warehouse:
    """The warehouse tables from the catalog; ``databases`` names the database of each."""
    return Warehouse(**{
        name: load_table(spark, f"{database}.{name}") for name, database in databases.items()
    })


def extracts(w: Warehouse, as_of: dt.date | None = None) -> dict[str, DataFrame]:
    """Every extract by name, lazily."""
    return {
        "antigenic_summaries": titer_summary(w),
        "indv_antigenic_summaries": individual_summary(w),
        "rosetta_summaries": energy_summary(
            w.relaxed_rosetta_energy_rmsd, w.relaxed_structural_distance),
        "structural_distance": distance_extract(w.relaxed_structural_distance),
        "seasonal_antisera_references": reportable_sera(w.archive_serum_ref, as_of),
    }


def refresh(
    w: Warehouse, root: str, names: Sequence[str] | None = None, as_of: dt.date | None = None
) -> list[str]:
    """Write the extracts below ``root``, replacing older ones; returns their names."""
    if unknown := set(names or ()) - set(extracts(w, as_of)):
        raise ValueError(f"no such extracts: {sorted(unknown)}")
    chosen = {n: df for n, df in extracts(w, as_of).items() if names is None or n in names}
    for name, df in chosen.items():
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")
    return list(chosen)
