"""Latest versions and context extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.operators.eligibility import STRUCTURE_SUBTYPES

# Energy terms in table order, and the atomic contexts.
ENERGY_TERMS = [
    "total_score", "disulfide_potential", "attraction_potential", "electrostatic_potential",
    "intraresidue_repulsion", "weight_aniso_solvation", "repulsive_potential",
    "solvation_potential", "hbond_bb_sc", "hbond_longrange_bb", "hbond_sidechain",
    "hbond_shortrange_bb", "omega", "yhh_planarity",
]
ATOMIC_CONTEXTS = ("calpha", "carbon", "heavy")


def latest(df: DataFrame, key: str, version: str) -> DataFrame:
    """All rows of the greatest version of their key; ties stay.

    The maximum is aggregated first, with a partial aggregate, and joined back. A
    window would sort all rows of a key in one task.
    """
    newest = (
        df.filter(F.col(version).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(version).alias("_newest"))
    )
    return df.join(
        newest, (F.col(key) == F.col("_key")) & (F.col(version) == F.col("_newest")), "left_semi"
    )


def energy_summary(energies: DataFrame, distances: DataFrame, protein: str = "HA") -> DataFrame:
    """Latest energies of the variants with a modelled structure."""
    modelled = distances.filter(
        F.col("subtype").isin(*STRUCTURE_SUBTYPES) & (F.col("protein") == protein)
    ).select("variant_hash").distinct()
    return (
        latest(energies, "variant_hash", "version")
        .join(modelled, "variant_hash", "left_semi")
        .select(*ENERGY_TERMS, F.col("variant_hash").alias("identifier"), "version")
        .distinct()
    )


def distance_extract(
    distances: DataFrame, contexts: Sequence[str] = ATOMIC_CONTEXTS
) -> DataFrame:
    """Structural distance rows of the modelled subtypes for all contexts at once."""
    return distances.filter(
        F.col("subtype").isin(*STRUCTURE_SUBTYPES) & F.col("atomic_context").isin(*contexts)
    ).select(
        "protein", "subtype", "reference_context", F.col("variant_hash").alias("identifier"),
        "atomic_context", "atomic_distance", "site_confidence", "range_limit", "site_range", "sd",
    )
