"""Which titer measurements enter a summary, and with how many copies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions.predicates import absent_or_zero, blank, present
from terrane.functions.sequences import letter_count, residue_at
from terrane.operators.membership import not_in

# Fixed values of the surveillance protocol.
SEASONAL_SUBTYPES = ("H1 swl", "H3", "B vic", "B yam")
STRUCTURE_SUBTYPES = ("B", "H1", "H3")
FOCUS_PROTOCOL = "fra_protocol"
HINT_PROTOCOL = "hint_protocol"
HINT_METHOD = "AFLUT"
MIN_BACK_TITER = 4
SURVEILLANCE = "surveillance"
TEST_ANTIGEN = "test"
EGG_PASSAGE = "%E%"
HUMAN_LOTS = ("%HUMAN%", "%uman%")
MINORITY = "Minority"
MINOR_PROTEINS = ("HA", "NA")
EXCLUDED_REFERENCE = "BRISBANE60"
AMBIGUOUS = "X"


@dataclass(frozen=True)
class Warehouse:
    """The tables the summaries read."""

    antigenic_tests: DataFrame
    archive_serum_ref: DataFrame
    specimen: DataFrame
    isolate: DataFrame
    hiserum: DataFrame
    variant_taxonomy: DataFrame
    isolate_pair_variants: DataFrame
    alignments: DataFrame
    aligned_proteins: DataFrame
    variants_filtered: DataFrame
    relaxed_structural_distance: DataFrame
    relaxed_rosetta_energy_rmsd: DataFrame


def ambiguity(alignments: DataFrame, protein: str = "NA") -> DataFrame:
    """Ambiguous residues per alignment of one protein."""
    return alignments.filter(F.col("protein") == protein).select(
        "isolate_id", letter_count(F.col("aa_aln"), AMBIGUOUS).alias("na_variants")
    )


def minor_variants(calls: DataFrame, proteins: DataFrame) -> DataFrame:
    """Positions per (isolate, sequence) where a minority call differs from the
    reference residue at its position."""
    chosen = calls.filter(
        (F.col("allele_type") == MINORITY)
        & F.col("protein").isin(*MINOR_PROTEINS)
        & (F.col("reference_id") != EXCLUDED_REFERENCE)
    )
    return (
        chosen.join(proteins.select("variant_hash", "reference_id", "aa_aln"),
                    ["variant_hash", "reference_id"])
        .filter(F.col("residue") != residue_at(F.col("aa_aln"), F.col("position_aa")))
        .groupBy("isolate_id", "flu_sequence_id")
        .agg(F.count_distinct("position_disc").alias("minor_variants"))
    )


def _copies(rows: DataFrame, flaw: str) -> DataFrame:
    """Per isolate, how many of its rows are free of the flaw."""
    clean = F.when(absent_or_zero(F.col(flaw)), 1).otherwise(0)
    return rows.groupBy("isolate_id").agg(F.sum(clean).alias("copies"))


def eligible_tests(t: Warehouse) -> DataFrame:
    """Tests that pass rule set 1, rule set 2, or both, flagged ``rule1``/``rule2``.

    One scan serves both rule sets. Dimension rows that only decide whether a test
    counts are reduced to one row per key before they meet the tests. Joining them
    as they are would copy all rows of a summary unit equally often, which leaves
    every mean as it is. Copies that can differ inside a unit, by sequenced isolate,
    are kept as ``weight``.
    """
    tests = t.antigenic_tests.filter(
        F.col("test_subtype").isin(*SEASONAL_SUBTYPES)
        & blank(F.col("ag_entry_error"))
        & F.col("titer_logfold").isNotNull()
        & ~F.col("titer_error")
        & (F.col("ag_type") == TEST_ANTIGEN)
        & ~F.col("ag_passage").like(EGG_PASSAGE)
        & F.col("ag_variant_hash").isNotNull()
    )
    assay1 = (
        (F.col("test_protocol") == FOCUS_PROTOCOL) | (F.col("ag_back_titer") >= MIN_BACK_TITER)
    ) & F.col("titer_reportable")
    assay2 = (F.col("test_protocol") == HINT_PROTOCOL) & (
        F.col("test_hint_calculation_method") == HINT_METHOD
    )
    tests = tests.select(
        "test_subtype", "test_protocol", "test_id", "ag_cdc_id", "ag_isolate_id",
        "ag_sequenced_isolate_id", "ag_variant_hash", "sr_variant_hash", "sr_lot",
        F.col("titer_logfold").cast("double").alias("titer_logfold"),
        F.coalesce(assay1, F.lit(False)).alias("assay1"),
        F.coalesce(assay2, F.lit(False)).alias("assay2"),
    ).filter(F.col("assay1") | F.col("assay2"))

    cell_lots = (
        t.archive_serum_ref.filter(~F.col("egg_vaccine"))
        .select(F.col("lot").alias("sr_lot"))
        .distinct()
    )
    reported = (
        t.isolate.filter(F.col("date_report").isNotNull())
        .select(F.col("cdc_id").alias("ag_cdc_id"), F.lit(True).alias("reported"))
        .distinct()
    )
    specimens = (
        t.specimen.filter(
            (F.col("reason_for_submission") == SURVEILLANCE) & present(F.col("strain_name"))
        )
        .select(F.col("cdc_id").alias("ag_cdc_id"))
        .distinct()
        .join(reported, "ag_cdc_id", "left")
    )
    isolates = not_in(
        t.isolate.select(F.col("isolate_id").alias("ag_isolate_id"))
        .filter(F.col("ag_isolate_id").isNotNull())
        .distinct(),
        "ag_isolate_id", t.isolate_pair_variants, "isolate_id",
    )
    grouped = (
        t.variant_taxonomy.filter(present(F.col("variant_genetic_group")))
        .select(F.col("variant_hash").alias("ag_variant_hash"))
        .distinct()
    )
    linked = _copies(ambiguity(t.alignments), "na_variants").select(
        F.col("isolate_id").alias("ag_sequenced_isolate_id"), F.col("copies").alias("linked")
    )
    minors = _copies(
        minor_variants(t.variants_filtered, t.aligned_proteins), "minor_variants"
    ).select(F.col("isolate_id").alias("ag_sequenced_isolate_id"), F.col("copies").alias("minors"))

    rule1 = F.col("assay1") & F.coalesce(F.col("reported"), F.lit(False))
    weight = F.coalesce(F.col("linked"), F.lit(1)) * F.coalesce(F.col("minors"), F.lit(1))
    return (
        tests.join(cell_lots, "sr_lot", "left_semi")
        .join(grouped, "ag_variant_hash", "left_semi")
        .join(isolates, "ag_isolate_id", "left_semi")
        .join(specimens, "ag_cdc_id", "inner")
        .join(linked, "ag_sequenced_isolate_id", "left")
        .join(minors, "ag_sequenced_isolate_id", "left")
        .select(
            F.col("test_subtype").alias("subtype"), "test_protocol", "test_id",
            "ag_cdc_id", "ag_isolate_id", "ag_variant_hash", "sr_variant_hash",
            F.col("sr_lot").alias("lot"), "titer_logfold",
            rule1.alias("rule1"), F.col("assay2").alias("rule2"), weight.alias("weight"),
        )
        .filter((F.col("rule1") | F.col("rule2")) & (F.col("weight") > 0))
    )


def species_class(lot: str, animal: str) -> Column:
    """``ferret`` for a lot with a known animal, unless the lot is of human origin."""
    human = F.col(lot).like(HUMAN_LOTS[0]) | F.col(lot).like(HUMAN_LOTS[1])
    return F.when(F.col(animal).isNull() | human, "non-ferret").otherwise("ferret")


def with_species(df: DataFrame, hiserum: DataFrame) -> DataFrame:
    """Rows with the species class of their ``lot``; a lot of two classes gives both."""
    animals = hiserum.select(
        F.col("lot").alias("_lot"), F.col("animal_id").isNull().alias("_unknown")
    ).distinct().select(
        "_lot", F.when(~F.col("_unknown"), F.lit("known")).alias("_animal")
    )
    return (
        df.join(animals, F.col("lot") == F.col("_lot"), "left")
        .withColumn("inoculated_species", species_class("lot", "_animal"))
        .drop("_lot", "_animal")
    )
