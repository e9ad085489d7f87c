"""Titer summaries by antiserum lot and by antiserum protein, pooled or per isolate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.operators.antisera import lot_groups
from terrane.operators.eligibility import (
    STRUCTURE_SUBTYPES, Warehouse, eligible_tests, with_species,
)
from terrane.operators.membership import join_list_member
from terrane.operators.replicates import distinct_values, fanout_stats, replicate_mean

RULES = ("rule1", "rule2")
ANTIGEN = ["ag_cdc_id", "ag_isolate_id", "ag_variant_hash"]
SERUM = ["subtype", "test_protocol", "sr_variant_hash"]


def modelled(distances: DataFrame) -> DataFrame:
    """Structural distance rows of the modelled subtypes."""
    return distances.filter(F.col("subtype").isin(*STRUCTURE_SUBTYPES))


def isolate_means(tests: DataFrame) -> DataFrame:
    """Isolate means per lot, one column per rule set."""
    return replicate_mean(
        tests, [*SERUM, "lot", *ANTIGEN], "test_id", "titer_logfold",
        weight=F.col("weight"), where={rule: F.col(rule) for rule in RULES},
    )


def isolate_values_by_lot(means: DataFrame) -> DataFrame:
    """Distinct isolate means per lot over both rule sets."""
    return distinct_values(means, RULES, "titer_logfold")


def isolate_values_by_protein(
    t: Warehouse, means: DataFrame, keep_species: bool = False
) -> DataFrame:
    """Isolate means per antiserum protein: lots of one group are pooled.

    The species class depends on the lot alone, so it joins the means and not the
    tests. Equal means of two lots of a group count once, separately for the rule
    sets and the classes. The classes are then averaged together unless
    ``keep_species``.
    """
    pooled = join_list_member(
        with_species(means, t.hiserum), lot_groups(t.archive_serum_ref),
        [("subtype", "subtype"), ("test_protocol", "test_protocol"),
         ("sr_variant_hash", "variant_hash")],
        "lot", "lot_group",
    )
    by_rule = pooled.select(
        *SERUM, "inoculated_species", "lot_group", *ANTIGEN,
        F.explode(
            F.filter(
                F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("titer")) for r in RULES]),
                lambda m: m["titer"].isNotNull(),
            )
        ).alias("m"),
    ).select("*", "m.rule", "m.titer").drop("m").distinct()
    keys = [*SERUM, *(["inoculated_species"] if keep_species else []), *ANTIGEN]
    # one lot group per antiserum variant, so any aggregate returns it
    grouped = by_rule.groupBy(*keys).agg(
        F.max("lot_group").alias("lot"),
        *[F.avg(F.when(F.col("rule") == r, F.col("titer"))).alias(r) for r in RULES],
    )
    return distinct_values(grouped, RULES, "titer_logfold")


def _named(df: DataFrame, aggregation: str, values: list[str]) -> DataFrame:
    return df.select(
        "subtype", "test_protocol", "sr_variant_hash", "lot",
        F.lit(aggregation).alias("aggregation"),
        F.col("ag_variant_hash").alias("identifier"), *values,
    )


STATS = ["min_logfold", "max_logfold", "avg_logfold", "sd_logfold", "logfold_count"]


def summary_by_lot(t: Warehouse, means: DataFrame, dedupe: bool = False) -> DataFrame:
    stats = fanout_stats(
        isolate_values_by_lot(means), [*SERUM, "lot", "ag_variant_hash"],
        "titer_logfold", "logfold", modelled(t.relaxed_structural_distance),
        ("ag_variant_hash", "variant_hash"), dedupe,
    )
    return _named(stats, "lot", STATS)


def summary_by_protein(t: Warehouse, means: DataFrame, dedupe: bool = False) -> DataFrame:
    stats = fanout_stats(
        isolate_values_by_protein(t, means), [*SERUM, "lot", "ag_variant_hash"],
        "titer_logfold", "logfold", modelled(t.relaxed_structural_distance),
        ("ag_variant_hash", "variant_hash"), dedupe,
    )
    return _named(stats, "ha_protein", STATS)


def titer_summary(t: Warehouse, dedupe: bool = False) -> DataFrame:
    """Titer statistics per (antiserum lot, variant) and (antiserum protein, variant).

    By default a variant's rows count once per structural distance row, as a join
    would have it; ``dedupe`` counts them once.
    """
    means = isolate_means(eligible_tests(t))
    return summary_by_lot(t, means, dedupe).unionByName(summary_by_protein(t, means, dedupe))


def individual_summary(t: Warehouse) -> DataFrame:
    """The same two aggregations, kept per isolate."""
    means = isolate_means(eligible_tests(t))
    available = modelled(t.relaxed_structural_distance).select(
        F.col("variant_hash").alias("ag_variant_hash")
    ).distinct()
    detail = ["ag_cdc_id", "ag_isolate_id", F.col("titer_logfold").alias("avg_logfold")]
    lots = isolate_values_by_lot(means).join(available, "ag_variant_hash", "left_semi")
    proteins = isolate_values_by_protein(t, means).join(available, "ag_variant_hash", "left_semi")
    return _named(lots, "lot", detail).unionByName(_named(proteins, "ha_protein", detail))
