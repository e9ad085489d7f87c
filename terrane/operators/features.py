"""The long twin of the wide table, and one pivot per subtype that reads its own labels.

The structure and titer sources are unioned as rows (kind, identifier, feature, value) and
averaged once, with a partial aggregate; nothing is as wide as all labels of all subtypes. A
subtype's table starts from its own rows, takes their long rows by a semi join, and pivots the
labels that carry the subtype's mark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions.labels import distance_label, titer_label
from terrane.functions.predicates import quoted
from terrane.operators.merging import (
    COLUMN_MARKS, ENERGIES, ENERGY_NAMES, MAX_LABELS, RELATIVE, SPECIMEN, attach_references,
    merge, reference_scores,
)
from terrane.operators.versions import ENERGY_TERMS

STRUCTURE, TITER = "structure", "titer"


def long_features(distances: DataFrame, antigenic: DataFrame, individual: bool = False) -> DataFrame:
    """(kind, identifier, [specimen keys], feature, lot, value) of all subtypes: means of
    structural distances and of titers per feature label.

    Rows with a missing identifier, specimen key of a titer, label, or value take no part.
    ``lot`` is the titer's lot or list of lots. Structure rows have no specimen keys.
    """
    keys = SPECIMEN if individual else []
    structure = distances.select(
        F.lit(STRUCTURE).alias("kind"), "identifier",
        *[F.lit(None).cast("string").alias(k) for k in keys],
        distance_label(F.col("subtype"), F.col("reference_context"), F.col("atomic_context"))
        .alias("feature"),
        F.lit(None).cast("string").alias("lot"), F.col("sd").cast("double").alias("value"))
    titers = antigenic.dropna(subset=keys) if keys else antigenic
    titers = titers.select(
        F.lit(TITER).alias("kind"), "identifier", *keys,
        titer_label(F.col("subtype"), F.col("test_protocol"), F.col("aggregation"), F.col("lot"))
        .alias("feature"), "lot", F.col("avg_logfold").cast("double").alias("value"))
    both = structure.unionByName(titers).dropna(subset=["identifier", "feature", "value"])
    return both.groupBy("kind", "identifier", *keys, "feature", "lot").agg(
        F.avg("value").alias("value"))


def limited_to_lots(long: DataFrame, lots: DataFrame) -> DataFrame:
    """Structure rows, and titer rows whose lot holds one of ``lots`` (lot) as text.

    The few different lots of the long table meet the list; the rows then meet those that
    stay by equality.
    """
    asked = lots.select(F.col("lot").alias("_asked")).dropna().distinct()
    own = long.filter(F.col("kind") == TITER).select("lot").distinct()
    stay = own.join(asked, F.col("lot").contains(F.col("_asked")), "left_semi")
    titers = long.filter(F.col("kind") == TITER).join(stay, "lot", "left_semi")
    return long.filter(F.col("kind") == STRUCTURE).unionByName(titers)


def labels_of(long: DataFrame, subtype: str) -> list[str]:
    """The labels that carry the mark of a subtype, sorted; they become columns, so more than
    ``MAX_LABELS`` raise a ValueError."""
    mark = COLUMN_MARKS[subtype]
    own = long.select("feature").distinct().filter(F.col("feature").rlike(rf"{mark}(_|\|)"))
    labels = [r[0] for r in own.limit(MAX_LABELS + 1).collect()]
    if len(labels) > MAX_LABELS:
        raise ValueError(f"{subtype} has more than {MAX_LABELS} labels")
    return sorted(labels)


def subtype_table(
    long: DataFrame, genetic: DataFrame, energies: DataFrame, references: DataFrame,
    subtype: str, individual: bool = False, labels: Sequence[str] | None = None,
) -> DataFrame:
    """The wide table of one subtype: sequence, energy, relative score, structure, and titer
    columns of its rows. ``labels`` default to those that the long table has."""
    if labels is None:
        labels = labels_of(long, subtype)
    named = energies.select(
        "identifier", *[F.col(t).alias(ENERGY_NAMES.get(t, t)) for t in ENERGY_TERMS])
    own = genetic.filter(F.col("subtype") == subtype)
    base = attach_references(
        merge(own, named, ["identifier"], "left"), reference_scores(references, named))
    asked = long.join(own.select("identifier").dropna().distinct(), "identifier", "left_semi")

    def pivoted(rows: DataFrame, index: list[str], names: list[str]) -> DataFrame:
        return rows.groupBy(*index).pivot("feature", names).agg(F.avg("value"))

    if not individual:
        wide = merge(base, pivoted(asked, ["identifier"], list(labels)), ["identifier"], "left")
    else:
        titer = [c for c in labels if c.endswith("|logfold")]
        other = [c for c in labels if c not in titer]
        sides = [
            (asked.filter(F.col("kind") == STRUCTURE), ["identifier"], other),
            (asked.filter(F.col("kind") == TITER), ["identifier", *SPECIMEN], titer)]
        wide = base
        for rows, index, names in sides:
            part = pivoted(rows, index, names) if names else rows.select(*index).distinct()
            wide = merge(wide, part, ["identifier"], "left")
    first = [*genetic.columns, *(SPECIMEN if individual else []), *ENERGIES, *RELATIVE]
    return wide.select(*[quoted(c) for c in [*first, *labels]]).withColumnRenamed(
        "identifier", "variant_hash")
