"""Structural distances of new structure files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators.contacts import (
    CONTACT_LIMIT, CONTEXT_ATOMS, MIN_CONFIDENCE, structural_distance,
)
from terrane.operators.membership import pending
from terrane.session import written
from terrane.sources.structures import read_structures, reference_labels
from terrane.sources.tables import append_table


def pending_pairs(
    atoms: DataFrame, done: DataFrame | None, contexts: Sequence[str], limit: float,
    confidence: float | None, sites: str | None, proteomic_context: str | None,
) -> DataFrame:
    """(structure_id, sd_context): the pairs without a finished distance under the same
    settings, by one anti join for all contexts. A structure done in one context, or with
    another limit, confidence, site range, or proteomic context, is not done. ``done`` is the
    output so far; a setting that it has no column for counts as equal, so a bare list of
    identifiers means done in every way."""
    pairs = atoms.select("structure_id").distinct().withColumn(
        "sd_context", F.explode(F.array(*[F.lit(c) for c in contexts])))
    if done is None:
        return pairs
    settings = {"sd_limit": limit, "sd_confidence": confidence, "site_range": sites,
                "proteomic_context": proteomic_context}
    for name, value in settings.items():
        if name in done.columns:
            done = done.filter(F.col(name).eqNullSafe(F.lit(value)))
    keys = ["structure_id", *(["sd_context"] if "sd_context" in done.columns else [])]
    return pending(pairs, done.withColumnRenamed("identifier", "structure_id"), keys)


def append_distances(
    atoms: DataFrame, references: DataFrame, output: str, done: DataFrame | None = None,
    contexts: Sequence[str] = tuple(CONTEXT_ATOMS), limit: float = CONTACT_LIMIT,
    confidence: float | None = MIN_CONFIDENCE, sites: str | None = None,
    proteomic_context: str | None = "HA",
) -> None:
    """Append the distances of all pairs of structure and context that are not ``done``."""
    pairs = written(
        pending_pairs(atoms, done, contexts, limit, confidence, sites, proteomic_context), "pending")
    append_table(structural_distance(
        atoms, references, contexts, limit, confidence, sites, proteomic_context, pairs), output)


def update_distances(
    spark: SparkSession,
    structures: str,
    references: str,
    output: str,
    done: DataFrame | None = None,
    contexts: Sequence[str] = tuple(CONTEXT_ATOMS),
    limit: float = CONTACT_LIMIT,
    confidence: float = MIN_CONFIDENCE,
    sites: str | None = None,
    proteomic_context: str | None = "HA",
) -> None:
    """Read the structure files, leave out what is done, and append the distances.

    Relaxed structures meet the relaxed references and are not masked, so each of the two
    kinds is one job over all its structures and contexts.
    """
    atoms = read_structures(spark, structures)
    known = reference_labels(read_structures(spark, references))
    for relaxed in (False, True):
        append_distances(
            atoms.filter(F.col("relaxed") == relaxed), known.filter(F.col("relaxed") == relaxed),
            output, done, contexts, limit, None if relaxed else confidence, sites,
            proteomic_context)
