"""Column labels made of data values, and axis labels made of column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text of a missing part, and the short names of two subtypes.
MISSING_PART = "nan"
SHORT_SUBTYPES = {"H1 swl": "H1", "B vic": "B"}


def joined_label(sep: str, *parts: Column) -> Column:
    return F.concat_ws(
        sep, *[F.coalesce(p.cast("string"), F.lit(MISSING_PART)) for p in parts]
    )


def short_subtype(subtype: Column) -> Column:
    short = subtype
    for full, name in SHORT_SUBTYPES.items():
        short = F.when(subtype == full, F.lit(name)).otherwise(short)
    return short


def titer_label(subtype: Column, protocol: Column, aggregation: Column, lot: Column) -> Column:
    return F.concat(
        joined_label("|", short_subtype(subtype), protocol, aggregation, lot), F.lit("|logfold")
    )


def distance_label(subtype: Column, reference: Column, context: Column) -> Column:
    """The label is NULL, and so never pivoted, when the atomic context is."""
    return F.concat(joined_label("_", subtype, reference), F.lit("_"), context, F.lit("_sd"))


def _captured(name: Column, pattern: str) -> Column:
    """Last match of a group in the name, NULL when there is none."""
    found = F.regexp_extract(name, f".*({pattern}).*", 1)
    return F.when(found != "", found)


def x_axis_label(name: Column) -> Column:
    return F.when(name == "hd", F.lit("Hamming Distance (HD)")).when(
        name == "pcd", F.lit("Physiochemical Distance (PCD)")
    )


def score_label(name: Column) -> Column:
    kind = _captured(name, "rrel|srel")
    return (
        F.when(kind == "srel", F.lit("Rosetta Total Score [Relative, Seasonal]"))
        .when(kind == "rrel", F.lit("Rosetta Total Score [Relative, Reference]"))
        .otherwise(F.lit("Rosetta Total Score"))
    )


def y_axis_label(name: Column) -> Column:
    period = F.initcap(_captured(name, "seasonal|reference|srel|rrel"))
    atoms = F.replace(
        F.initcap(_captured(name, "calpha|carbon|heavy")), F.lit("Calpha"), F.lit("Ca")
    )
    distance = F.concat(
        F.lit("Structural Distance [SD, "), period, F.lit(" ("), atoms, F.lit(")]")
    )
    return F.when(F.contains(name, F.lit("sd")), distance).when(
        F.contains(name, F.lit("total_score")), score_label(name)
    )


def z_axis_label(name: Column) -> Column:
    scale = _captured(name, "logfold|log|total_score")
    fill = F.when(
        F.contains(name, F.lit("cladei")) | F.contains(name, F.lit("meani")),
        F.concat(F.lit("("), F.initcap(_captured(name, "clade|mean")), F.lit(")")),
    ).otherwise(F.lit(""))
    reagent = F.coalesce(_captured(name, r"\d{4}-\d{3}"), F.lit(""))
    serum = F.replace(F.upper(_captured(name, "ha_protein|lot")), F.lit("_"), F.lit(" "))
    titer = F.concat(
        serum, F.lit(": "), reagent, F.lit(" ["), F.upper(scale), F.lit("] "), fill
    )
    return F.when(F.contains(scale, F.lit("log")), titer).otherwise(score_label(name))
