"""Queries and oracles of the titer, antiserum, and version operators."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.bindings.star import ctes, derive, star, warehouse
from terrane.operators import antisera, eligibility, titers, versions
from terrane.plans import refresh as refreshing
from terrane.session import shared_dir

TITER_TABLES = [
    "antigenic_tests", "archive_serum_ref", "specimen", "isolate", "hiserum",
    "variant_taxonomy", "isolate_pair_variants", "alignments", "aligned_proteins",
    "variants_filtered", "relaxed_structural_distance",
]

# The summaries join several alignments to an isolate, whose copies weigh its tests.
SHARED = {"alignments": "shared_alignments"}

# Tests after all joins and filters, rows multiplied as the joins multiply them.
# The two rule sets are flags, so one pass gives both.
ELIGIBLE = """
minors AS (
  SELECT isolate_id, COUNT(DISTINCT position_disc) AS minor_count
  FROM (
    SELECT v.isolate_id, v.flu_sequence_id, v.position_disc, v.residue,
           RIGHT(SUBSTRING(p.aa_aln, 1, v.position_aa), 1) AS expected
    FROM variants_filtered v JOIN aligned_proteins p USING (variant_hash, reference_id)
    WHERE v.allele_type = 'Minority' AND v.protein IN ('HA', 'NA')
      AND v.reference_id <> 'BRISBANE60')
  WHERE residue <> expected
  GROUP BY isolate_id, flu_sequence_id),
linked AS (
  SELECT isolate_id, LENGTH(aa_aln) - LENGTH(REPLACE(aa_aln, 'X', '')) AS x_count
  FROM alignments WHERE protein = 'NA'),
eligible AS (
  SELECT a.test_subtype AS subtype, a.test_protocol, a.test_id, a.ag_cdc_id, a.ag_isolate_id,
         a.ag_variant_hash, a.sr_variant_hash, a.sr_lot AS lot, a.titer_logfold AS v,
         (a.test_protocol = 'fra_protocol' OR a.ag_back_titer >= 4) AND a.titer_reportable
           AND a.ag_cdc_id IN (SELECT cdc_id FROM isolate WHERE date_report IS NOT NULL) AS rule1,
         a.test_protocol = 'hint_protocol'
           AND a.test_hint_calculation_method = 'AFLUT' AS rule2
  FROM antigenic_tests a
  JOIN (SELECT lot FROM archive_serum_ref WHERE NOT egg_vaccine) r ON r.lot = a.sr_lot
  JOIN specimen s ON s.cdc_id = a.ag_cdc_id
  JOIN isolate i ON i.isolate_id = a.ag_isolate_id
  JOIN variant_taxonomy t ON t.variant_hash = a.ag_variant_hash
  LEFT JOIN linked l ON l.isolate_id = a.ag_sequenced_isolate_id
  LEFT JOIN minors m ON m.isolate_id = a.ag_sequenced_isolate_id
  WHERE s.reason_for_submission = 'surveillance' AND s.strain_name <> ''
    AND a.test_subtype IN ('H1 swl', 'H3', 'B vic', 'B yam')
    AND regexp_matches(a.ag_entry_error, '^\\s*$') AND a.titer_logfold IS NOT NULL
    AND NOT a.titer_error AND a.ag_type = 'test' AND a.ag_passage NOT LIKE '%E%'
    AND t.variant_genetic_group <> ''
    AND a.ag_isolate_id NOT IN (SELECT isolate_id FROM isolate_pair_variants)
    AND COALESCE(m.minor_count, 0) = 0 AND COALESCE(l.x_count, 0) = 0)
"""

# Isolate values by lot and by serum protein, distinct over the two rule sets.
ISOLATE_VALUES = """
lot_tests AS (
  SELECT subtype, test_protocol, sr_variant_hash, lot, ag_cdc_id, ag_isolate_id,
         ag_variant_hash, test_id,
         AVG(v) FILTER (WHERE rule1) AS m1, AVG(v) FILTER (WHERE rule2) AS m2
  FROM eligible GROUP BY ALL),
lot_means AS (
  SELECT subtype, test_protocol, sr_variant_hash, lot, ag_cdc_id, ag_isolate_id,
         ag_variant_hash, AVG(m1) AS m1, AVG(m2) AS m2
  FROM lot_tests GROUP BY ALL),
lot_values AS (
  SELECT * EXCLUDE (m1, m2), m1 AS value FROM lot_means WHERE m1 IS NOT NULL
  UNION
  SELECT * EXCLUDE (m1, m2), m2 AS value FROM lot_means WHERE m2 IS NOT NULL),
species AS (
  SELECT e.*, CASE WHEN h.animal_id IS NULL OR e.lot LIKE '%HUMAN%' OR e.lot LIKE '%uman%'
                   THEN 'non-ferret' ELSE 'ferret' END AS class
  FROM eligible e LEFT JOIN (SELECT DISTINCT lot, animal_id IS NULL AS u,
                                    MIN(animal_id) AS animal_id
                             FROM hiserum GROUP BY ALL) h ON h.lot = e.lot),
class_tests AS (
  SELECT subtype, test_protocol, sr_variant_hash, lot, class, ag_cdc_id, ag_isolate_id,
         ag_variant_hash, test_id,
         AVG(v) FILTER (WHERE rule1) AS m1, AVG(v) FILTER (WHERE rule2) AS m2
  FROM species GROUP BY ALL),
class_means AS (
  SELECT subtype, test_protocol, sr_variant_hash, lot, class, ag_cdc_id, ag_isolate_id,
         ag_variant_hash, AVG(m1) AS m1, AVG(m2) AS m2
  FROM class_tests GROUP BY ALL),
groups AS (
  SELECT subtype, test_protocol, variant_hash, list_sort(list_distinct(list(lot))) AS lots
  FROM archive_serum_ref WHERE NOT egg_vaccine GROUP BY ALL),
pooled AS (
  SELECT c.*, array_to_string(g.lots, ', ') AS lot_group
  FROM class_means c JOIN groups g
    ON g.subtype = c.subtype AND g.test_protocol = c.test_protocol
   AND g.variant_hash = c.sr_variant_hash AND list_contains(g.lots, c.lot)),
pooled_values AS (
  SELECT DISTINCT 1 AS rule, subtype, test_protocol, sr_variant_hash, class, lot_group,
         ag_cdc_id, ag_isolate_id, ag_variant_hash, m1 AS value
  FROM pooled WHERE m1 IS NOT NULL
  UNION ALL
  SELECT DISTINCT 2, subtype, test_protocol, sr_variant_hash, class, lot_group,
         ag_cdc_id, ag_isolate_id, ag_variant_hash, m2
  FROM pooled WHERE m2 IS NOT NULL),
protein_values AS (
  SELECT DISTINCT * EXCLUDE (rule) FROM (
    SELECT rule, subtype, test_protocol, sr_variant_hash, MAX(lot_group) AS lot, ag_cdc_id,
           ag_isolate_id, ag_variant_hash, AVG(value) AS value
    FROM pooled_values
    GROUP BY rule, subtype, test_protocol, sr_variant_hash, ag_cdc_id, ag_isolate_id,
             ag_variant_hash))
"""


def _summary_sql(dedupe: bool, digits: int = 6, **other: str) -> str:
    distances = (
        "(SELECT DISTINCT variant_hash FROM relaxed_structural_distance "
        "WHERE subtype IN ('B', 'H1', 'H3'))"
        if dedupe else
        "(SELECT variant_hash FROM relaxed_structural_distance "
        "WHERE subtype IN ('B', 'H1', 'H3'))"
    )
    part = """
  SELECT subtype, test_protocol, sr_variant_hash, lot, '{label}' AS aggregation,
         ag_variant_hash AS identifier,
         ROUND(MIN(value), {digits}) AS min_logfold, ROUND(MAX(value), {digits}) AS max_logfold,
         ROUND(AVG(value), {digits}) AS avg_logfold, ROUND(STDDEV_SAMP(value), {digits}) AS sd_logfold,
         CAST(COUNT(value) AS INT) AS logfold_count
  FROM {values} v JOIN {distances} d ON d.variant_hash = v.ag_variant_hash
  GROUP BY subtype, test_protocol, sr_variant_hash, lot, ag_variant_hash"""
    return (
        f"WITH {ctes(*TITER_TABLES, **other)},{ELIGIBLE},{ISOLATE_VALUES}"
        + part.format(label="lot", values="lot_values", distances=distances, digits=digits)
        + "\n  UNION"
        + part.format(label="ha_protein", values="protein_values", distances=distances,
                      digits=digits)
    )


def _individual_sql(digits: int = 6, **other: str) -> str:
    part = """
  SELECT subtype, test_protocol, sr_variant_hash, lot, '{label}' AS aggregation,
         ag_variant_hash AS identifier, ag_cdc_id, ag_isolate_id,
         ROUND(value, {digits}) AS avg_logfold
  FROM {values} WHERE ag_variant_hash IN (
    SELECT variant_hash FROM relaxed_structural_distance WHERE subtype IN ('B', 'H1', 'H3'))"""
    return (
        f"WITH {ctes(*TITER_TABLES, **other)},{ELIGIBLE},{ISOLATE_VALUES}"
        + part.format(label="lot", values="lot_values", digits=digits)
        + "\n  UNION ALL"
        + part.format(label="ha_protein", values="protein_values", digits=digits)
    )


def _rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


LOGFOLD = ["min_logfold", "max_logfold", "avg_logfold", "sd_logfold"]


def titer_summary(spark, sf):
    return _rounded(titers.titer_summary(warehouse(spark, sf, **SHARED)), LOGFOLD)


def titer_summary_deduped(spark, sf):
    return _rounded(titers.titer_summary(warehouse(spark, sf, **SHARED), dedupe=True), LOGFOLD)


def individual_summary(spark, sf):
    return _rounded(titers.individual_summary(warehouse(spark, sf, **SHARED)), ["avg_logfold"])


def eligible_tests(spark, sf):
    tests = eligibility.eligible_tests(warehouse(spark, sf, **SHARED))
    return (
        tests.groupBy("subtype", "test_protocol", "rule1", "rule2")
        .agg(F.sum("weight").cast("bigint").alias("n"),
             F.round(F.sum(F.col("weight") * F.col("titer_logfold")), 6).alias("total"))
    )


ELIGIBLE_SQL = f"""
WITH {ctes(*TITER_TABLES, **SHARED)},{ELIGIBLE},
-- joins to lots copy rows; one lot row per lot keeps the copies by sequenced isolate only
lot_rows AS (SELECT lot, COUNT(*) AS k FROM archive_serum_ref WHERE NOT egg_vaccine GROUP BY lot)
SELECT subtype, test_protocol, rule1, rule2, CAST(ROUND(SUM(1.0 / k)) AS BIGINT) AS n,
       ROUND(SUM(v / k), 6) AS total
FROM eligible JOIN lot_rows USING (lot) WHERE rule1 OR rule2
GROUP BY subtype, test_protocol, rule1, rule2
"""


def species_class(spark, sf):
    w = warehouse(spark, sf)
    lots = w.antigenic_tests.select(F.col("sr_lot").alias("lot"), "titer_logfold")
    return (
        eligibility.with_species(lots, w.hiserum)
        .groupBy("lot", "inoculated_species")
        .agg(F.count("*").alias("n"), F.round(F.avg("titer_logfold"), 6).alias("mean"))
    )


SPECIES_SQL = f"""
WITH {ctes("antigenic_tests", "hiserum")},
classes AS (
  SELECT DISTINCT lot, animal_id IS NULL AS unknown FROM hiserum)
SELECT a.sr_lot AS lot,
       CASE WHEN COALESCE(c.unknown, TRUE) OR a.sr_lot LIKE '%HUMAN%' OR a.sr_lot LIKE '%uman%'
            THEN 'non-ferret' ELSE 'ferret' END AS inoculated_species,
       COUNT(*) AS n, ROUND(AVG(a.titer_logfold), 6) AS mean
FROM antigenic_tests a LEFT JOIN classes c ON c.lot = a.sr_lot
GROUP BY 1, 2
"""


def ambiguity_count(spark, sf):
    return eligibility.ambiguity(derive(spark, sf, "alignments"))


AMBIGUITY_SQL = f"""
WITH {ctes("alignments")}
SELECT isolate_id, CAST(LENGTH(aa_aln) - LENGTH(REPLACE(aa_aln, 'X', '')) AS INT) AS na_variants
FROM alignments WHERE protein = 'NA'
"""


def residue_diff(spark, sf):
    return eligibility.minor_variants(
        derive(spark, sf, "variants_filtered"), derive(spark, sf, "aligned_proteins")
    )


RESIDUE_SQL = f"""
WITH {ctes("variants_filtered", "aligned_proteins")}
SELECT v.isolate_id, v.flu_sequence_id, COUNT(DISTINCT v.position_disc) AS minor_variants
FROM variants_filtered v JOIN aligned_proteins p USING (variant_hash, reference_id)
WHERE v.allele_type = 'Minority' AND v.protein IN ('HA', 'NA') AND v.reference_id <> 'BRISBANE60'
  AND v.residue <> RIGHT(SUBSTRING(p.aa_aln, 1, v.position_aa), 1)
GROUP BY v.isolate_id, v.flu_sequence_id
"""


def lot_groups(spark, sf):
    return antisera.lot_groups(derive(spark, sf, "archive_serum_ref"))


LOT_GROUPS_SQL = f"""
WITH {ctes("archive_serum_ref")}
SELECT subtype, test_protocol, variant_hash,
       array_to_string(list_sort(list_distinct(list(lot))), ', ') AS lot_group
FROM archive_serum_ref WHERE NOT egg_vaccine
GROUP BY subtype, test_protocol, variant_hash
"""


def reportable_sera(day: dt.date):
    def run(spark, sf):
        return antisera.reportable_sera(derive(spark, sf, "archive_serum_ref"), day)
    return run


def _reportable_sql(condition: str) -> str:
    return f"""
WITH {ctes("archive_serum_ref")}
SELECT DISTINCT subtype, strain_name, passage, lot FROM archive_serum_ref
WHERE NOT egg_vaccine AND ({condition})
"""


def energy_summary(spark, sf):
    w = warehouse(spark, sf)
    return versions.energy_summary(w.relaxed_rosetta_energy_rmsd, w.relaxed_structural_distance)


ENERGY_SQL = f"""
WITH {ctes("relaxed_rosetta_energy_rmsd", "relaxed_structural_distance")},
ranked AS (
  SELECT *, RANK() OVER (PARTITION BY variant_hash ORDER BY version DESC NULLS LAST) AS place
  FROM relaxed_rosetta_energy_rmsd WHERE version IS NOT NULL)
SELECT DISTINCT {", ".join(versions.ENERGY_TERMS)}, variant_hash AS identifier, version
FROM ranked
WHERE place = 1 AND variant_hash IN (
  SELECT variant_hash FROM relaxed_structural_distance
  WHERE subtype IN ('B', 'H1', 'H3') AND protein = 'HA')
"""


def latest_version(spark, sf):
    orders = star(spark, sf, "orders")
    return versions.latest(orders, "o_custkey", "o_orderdate").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate")
    )


LATEST_SQL = """
SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate
FROM (SELECT *, RANK() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS place FROM orders)
WHERE place = 1
"""


def distance_extract(spark, sf):
    return versions.distance_extract(
        derive(spark, sf, "relaxed_structural_distance")
    ).drop("site_range")


EXTRACT_SQL = f"""
WITH {ctes("relaxed_structural_distance")}
SELECT protein, subtype, reference_context, variant_hash AS identifier, atomic_context,
       atomic_distance, site_confidence, range_limit, sd
FROM relaxed_structural_distance
WHERE subtype IN ('B', 'H1', 'H3') AND atomic_context IN ('calpha', 'carbon', 'heavy')
"""

# per extract: a group, and the value that is added up in it
READ_BACK = {
    "antigenic_summaries": ("CONCAT(subtype, '|', aggregation)", "avg_logfold"),
    "indv_antigenic_summaries": ("CONCAT(subtype, '|', aggregation)", "avg_logfold"),
    "rosetta_summaries": ("version", "total_score"),
    "structural_distance": ("CONCAT(subtype, '|', atomic_context)", "sd"),
    "seasonal_antisera_references": ("CONCAT(subtype, '|', lot)", "0.0"),
}
SPRING = dt.date(2000, 5, 10)


def refresh_extracts(spark, sf):
    """All extracts written to a folder and read back: rows and totals of their groups. A
    seventh of a total is shown, as totals of halves may lie in the middle of two roundings."""
    root = f"{shared_dir(spark).rstrip('/')}/extracts-{uuid.uuid4().hex}"
    names = refreshing.refresh(warehouse(spark, sf), root, as_of=SPRING)
    parts = [
        spark.read.parquet(f"{root}/{name}").groupBy(F.expr(group).alias("part")).agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.sum(F.expr(f"CAST({value} AS DOUBLE)")) / 7, 4).alias("seventh"))
        .select(F.lit(name).alias("extract"), "part", "n", "seventh")
        for name, (group, value) in READ_BACK.items() if name in names
    ]
    return reduce(DataFrame.unionByName, parts)


def _refresh_sql() -> str:
    sources = {
        "antigenic_summaries": f"({_summary_sql(False, 12)})",
        "indv_antigenic_summaries": f"({_individual_sql(12)})",
        "rosetta_summaries": f"({ENERGY_SQL})", "structural_distance": f"({EXTRACT_SQL})",
        "seasonal_antisera_references": f"({_reportable_sql('season >= 1999')})",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS extract, {READ_BACK[name][0]} AS part, COUNT(*) AS n, "
        f"ROUND(SUM(CAST({READ_BACK[name][1]} AS DOUBLE)) / 7, 4) AS seventh "
        f"FROM {source} GROUP BY 2"
        for name, source in sources.items())


QUERIES = {
    "titer_summary": titer_summary,
    "titer_summary_deduped": titer_summary_deduped,
    "individual_summary": individual_summary,
    "eligible_tests": eligible_tests,
    "species_class": species_class,
    "ambiguity_count": ambiguity_count,
    "residue_diff": residue_diff,
    "lot_groups": lot_groups,
    "reportable_spring": reportable_sera(dt.date(2000, 5, 10)),
    "reportable_autumn": reportable_sera(dt.date(1999, 10, 1)),
    "energy_summary": energy_summary,
    "latest_version": latest_version,
    "distance_extract": distance_extract,
    "refresh_extracts": refresh_extracts,
}

ORACLES = {
    "titer_summary": _summary_sql(False, **SHARED),
    "titer_summary_deduped": _summary_sql(True, **SHARED),
    "individual_summary": _individual_sql(**SHARED),
    "eligible_tests": ELIGIBLE_SQL,
    "species_class": SPECIES_SQL,
    "ambiguity_count": AMBIGUITY_SQL,
    "residue_diff": RESIDUE_SQL,
    "lot_groups": LOT_GROUPS_SQL,
    "reportable_spring": _reportable_sql("season >= 1999"),
    "reportable_autumn": _reportable_sql(
        "CONCAT(CAST(season AS STRING), hemisphere) IN ('1999NH', '1999SH', '1998NH')"
    ),
    "energy_summary": ENERGY_SQL,
    "latest_version": LATEST_SQL,
    "distance_extract": EXTRACT_SQL,
    "refresh_extracts": _refresh_sql(),
}
