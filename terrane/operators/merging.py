"""Pivots and null-safe merges into one wide table per subtype."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions.labels import distance_label, titer_label
from terrane.functions.predicates import cols_matching, quoted
from terrane.operators.versions import ENERGY_TERMS

# One name per energy term for all later steps, and the subtypes with the
# text that marks their columns.
ENERGY_NAMES = {
    "electrostatic_potential": "potential_energy",
    "weight_aniso_solvation": "weighted_anisotropic_solvation",
    "solvation_potential": "solvation_energy",
    "hbond_bb_sc": "hbond_bb_sidechain",
    "hbond_longrange_bb": "hbond_long_backbone",
    "hbond_shortrange_bb": "hbond_short_backbone",
    "omega": "omega_dihedral",
    "yhh_planarity": "tyrosine_torsion",
}
COLUMN_MARKS = {"B vic": "B", "H1 swl": "H1", "H3": "H3"}
SPECIMEN = ["ag_cdc_id", "ag_isolate_id"]
#: Most columns that a pivot makes.
MAX_LABELS = 20_000
ENERGIES = [ENERGY_NAMES.get(term, term) for term in ENERGY_TERMS]
RELATIVE = ["rrel_total_score", "srel_total_score"]


def pivot_mean(
    df: DataFrame, index: Sequence[str], label: str, value: str,
    labels: Sequence[str] | None = None,
) -> DataFrame:
    """One row per index, one column per label, with the mean of the value.

    Rows with a missing index, label, or value take no part. Without ``labels`` the
    distinct labels are read first; they become the schema, so more than ``MAX_LABELS`` of
    them raise a ValueError.
    """
    kept = df.dropna(subset=[*index, label, value])
    if labels is None:
        found = kept.select(label).distinct().limit(MAX_LABELS + 1).collect()
        if len(found) > MAX_LABELS:
            raise ValueError(f"more than {MAX_LABELS} labels in {label}")
        labels = sorted(r[0] for r in found)
    return kept.groupBy(*index).pivot(label, list(labels)).agg(F.avg(value))


def merge(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join on keys where missing equals missing; the keys appear once."""
    clash = (set(left.columns) & set(right.columns)) - set(on)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    theirs = {k: f"_right_{i}" for i, k in enumerate(on)}
    other = right.withColumnsRenamed(theirs)
    condition = reduce(
        lambda a, b: a & b, [quoted(k).eqNullSafe(quoted(r)) for k, r in theirs.items()]
    )
    joined = left.join(other, condition, how)
    if how == "left":
        return joined.drop(*theirs.values())
    keys = {k: F.coalesce(quoted(k), quoted(r)) for k, r in theirs.items()}
    return joined.withColumns(keys).drop(*theirs.values())


def merge_outer(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    return reduce(lambda a, b: merge(a, b, on, "full"), frames)


def reference_scores(references: DataFrame, energies: DataFrame) -> DataFrame:
    """Total score of the historical and of the seasonal reference, side by side by
    subtype. Several references of a subtype give several rows."""
    scored = merge(
        references.select("identifier", "subtype", "context"),
        energies.select("identifier", "total_score"), ["identifier"], "left",
    )

    def of(context: str, name: str) -> DataFrame:
        return scored.filter(F.col("context") == context).select(
            "subtype", F.col("total_score").alias(name)
        )

    return merge(
        of("reference", "total_score_x"), of("seasonal", "total_score_y"), ["subtype"], "full"
    )


def attach_references(df: DataFrame, scores: DataFrame) -> DataFrame:
    """Scores relative to the references of the row's subtype: reference - variant."""
    joined = merge(df, scores, ["subtype"], "left")
    return joined.withColumns({
        "rrel_total_score": F.col("total_score_x") - F.col("total_score"),
        "srel_total_score": F.col("total_score_y") - F.col("total_score"),
    }).drop("total_score_x", "total_score_y")


def merge_features(
    genetic: DataFrame,
    distances: DataFrame,
    energies: DataFrame,
    references: DataFrame,
    antigenic: DataFrame,
    individual: bool = False,
    distance_labels: Sequence[str] | None = None,
    titer_labels: Sequence[str] | None = None,
) -> DataFrame:
    """The wide table of all subtypes: sequence, energy, structure, and titer columns.

    All contexts of the structural distance pivot together, because their labels name
    the context. A row without a genetic record has no subtype.
    """
    energies = energies.select(
        "identifier", *[F.col(t).alias(ENERGY_NAMES.get(t, t)) for t in ENERGY_TERMS]
    )
    sd = pivot_mean(
        distances.withColumn(
            "label", distance_label(
                F.col("subtype"), F.col("reference_context"), F.col("atomic_context"))
        ),
        ["identifier"], "label", "sd", distance_labels,
    )
    index = ["identifier", *(SPECIMEN if individual else [])]
    titers = pivot_mean(
        antigenic.withColumn(
            "label", titer_label(
                F.col("subtype"), F.col("test_protocol"), F.col("aggregation"), F.col("lot"))
        ),
        index, "label", "avg_logfold", titer_labels,
    )
    features = merge_outer([genetic, merge_outer([sd, energies], ["identifier"])], ["identifier"])
    related = attach_references(features, reference_scores(references, energies))
    merged = merge_outer([related, titers], ["identifier"])
    first = [*genetic.columns, *(SPECIMEN if individual else []), *ENERGIES, *RELATIVE]
    rest = [c for c in merged.columns if c not in first]
    return merged.select(*[quoted(c) for c in first + rest])


def subset_for(df: DataFrame, subtype: str) -> DataFrame:
    """Rows of one subtype with its own structure and titer columns."""
    mark = COLUMN_MARKS[subtype]
    processed = [c for c in df.columns if c.endswith(("_sd", "|logfold"))]
    own = cols_matching(processed, rf".*({mark}(_|\|)).*")
    kept = [c for c in df.columns if c not in processed] + own
    return (
        df.filter(F.col("subtype") == subtype)
        .select(*[quoted(c) for c in kept])
        .withColumnRenamed("identifier", "variant_hash")
    )
