"""The surveillance tables, derived from the star-schema test tables.

Each binding is one projection of one source table. Its expressions read the same in
Spark SQL and in the oracle's SQL, so both sides see the same tables. Every row of the
source takes part, and the number of rows grows with the source.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from terrane.operators.eligibility import Warehouse
from terrane.sources.tables import load_table

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


@dataclass(frozen=True)
class Binding:
    """``columns`` maps names to expressions; ``each`` repeats every row per value."""

    source: str
    columns: dict[str, str]
    each: dict[str, list] = field(default_factory=dict)


SUBTYPE_OF = (
    "CASE CAST({key} % 5 AS INT) WHEN 0 THEN 'H1 swl' WHEN 1 THEN 'H3' "
    "WHEN 2 THEN 'B vic' WHEN 3 THEN 'B yam' ELSE 'H5' END"
)
LOT_OF = (
    "CASE CAST({key} % 6 AS INT) WHEN 5 THEN 'L5-HUMAN' "
    "ELSE CONCAT('L', CAST({key} % 6 AS STRING)) END"
)
SERUM_VARIANT_OF = (
    "CASE WHEN {key} % 6 < 2 THEN 'a0' WHEN {key} % 6 < 4 THEN 'a1' ELSE 'a2' END"
)

BINDINGS: dict[str, Binding] = {
    "antigenic_tests": Binding("lineitem", {
        "test_subtype": SUBTYPE_OF.format(key="l_partkey"),
        "test_protocol": "CASE l_returnflag WHEN 'R' THEN 'hi_protocol' "
                         "WHEN 'A' THEN 'fra_protocol' ELSE 'hint_protocol' END",
        "test_id": "CONCAT('t', CAST(EXTRACT(YEAR FROM l_shipdate) AS STRING))",
        "test_hint_calculation_method": "CASE l_linestatus WHEN 'F' THEN 'AFLUT' ELSE 'MANUAL' END",
        "ag_cdc_id": "CONCAT('s', CAST(l_partkey AS STRING))",
        "ag_isolate_id": "CONCAT('i', CAST(l_partkey AS STRING), '.', "
                         "CAST(l_linenumber % 2 AS STRING))",
        "ag_sequenced_isolate_id": "CASE WHEN l_tax > 0.055 THEN "
                                   "CONCAT('i', CAST(l_partkey AS STRING), '.0') ELSE "
                                   "CONCAT('i', CAST(l_partkey AS STRING), '.', "
                                   "CAST(l_linenumber % 2 AS STRING)) END",
        "ag_variant_hash": "CASE WHEN l_quantity = 49 THEN NULL "
                           "ELSE CONCAT('v', CAST(l_partkey AS STRING)) END",
        "ag_entry_error": "CASE WHEN l_discount > 0.095 THEN 'clotted' WHEN l_discount > 0.085 "
                          "THEN NULL WHEN l_discount > 0.075 THEN ' ' ELSE '' END",
        "ag_type": "CASE WHEN l_linenumber = 7 THEN 'reference' ELSE 'test' END",
        "ag_passage": "CASE WHEN l_quantity = 50 THEN 'E2' ELSE 'S1' END",
        "sr_lot": LOT_OF.format(key="l_suppkey"),
        "sr_variant_hash": SERUM_VARIANT_OF.format(key="l_suppkey"),
        "ag_back_titer": "l_quantity / 5",
        "titer_logfold": "CASE WHEN l_linenumber = 6 AND l_tax < 0.025 THEN NULL "
                         "ELSE FLOOR(l_extendedprice / 5000) / 4 - 3 END",
        "titer_error": "CASE WHEN l_quantity = 1 THEN NULL WHEN l_quantity = 2 THEN TRUE "
                       "ELSE FALSE END",
        "titer_reportable": "l_discount < 0.035 OR l_discount > 0.045",
    }),
    "archive_serum_ref": Binding("supplier", {
        "lot": LOT_OF.format(key="s_suppkey"),
        "subtype": SUBTYPE_OF.format(key="s_nationkey"),
        "test_protocol": "CASE WHEN s_acctbal < 2000 THEN 'hi_protocol' WHEN s_acctbal < 6000 "
                         "THEN 'fra_protocol' ELSE 'hint_protocol' END",
        "variant_hash": SERUM_VARIANT_OF.format(key="s_suppkey"),
        "strain_name": "s_name",
        "passage": "CASE WHEN s_nationkey % 3 = 0 THEN 'E3' ELSE 'S2' END",
        "hemisphere": "CASE WHEN s_nationkey % 2 = 0 THEN 'NH' ELSE 'SH' END",
        "season": "CAST(1993 + s_nationkey % 9 AS INT)",
        "egg_vaccine": "CASE WHEN s_nationkey = 4 THEN NULL WHEN s_nationkey % 7 = 0 THEN TRUE "
                       "ELSE FALSE END",
    }),
    "specimen": Binding("part", {
        "cdc_id": "CONCAT('s', CAST(p_partkey AS STRING))",
        "reason_for_submission": "CASE p_type WHEN 'PROMO' THEN 'research' ELSE 'surveillance' END",
        "strain_name": "CASE p_size WHEN 1 THEN NULL WHEN 2 THEN '' ELSE p_name END",
    }),
    "isolate": Binding("part", {
        "isolate_id": "CONCAT('i', CAST(p_partkey AS STRING), '.', CAST(copy AS STRING))",
        "cdc_id": "CONCAT('s', CAST(p_partkey AS STRING))",
        "date_report": "CASE WHEN p_size % 7 = 0 THEN NULL ELSE DATE '2024-01-15' END",
    }, {"copy": [0, 1]}),
    "hiserum": Binding("supplier", {
        "lot": LOT_OF.format(key="s_suppkey"),
        "animal_id": "CASE WHEN s_suppkey % 6 = 3 THEN NULL ELSE s_name END",
    }),
    "variant_taxonomy": Binding("part", {
        "variant_hash": "CONCAT('v', CAST(p_partkey AS STRING))",
        "variant_genetic_group": "CASE p_size WHEN 3 THEN NULL WHEN 4 THEN '' ELSE p_brand END",
    }),
    "isolate_pair_variants": Binding("labels", {
        "isolate_id": "CONCAT('i', CAST(doc_id AS STRING), '.', CAST(toxic AS STRING))",
    }),
    "alignments": Binding("documents", {
        "isolate_id": "CONCAT('i', CAST(doc_id AS STRING), '.0')",
        "protein": "CASE WHEN n_chars % 3 = 0 THEN 'HA' ELSE 'NA' END",
        "aa_aln": "text",
    }),
    # each document aligned to an isolate of its own and to one that others share, so that every
    # isolate counts and many have several alignments, whose copies multiply their tests
    "shared_alignments": Binding("documents", {
        "isolate_id": "CONCAT('i', CAST(CASE WHEN copy = 0 THEN doc_id ELSE doc_id % 700 END "
                      "AS STRING), '.0')",
        "protein": "CASE WHEN n_chars % 3 = 0 THEN 'HA' ELSE 'NA' END",
        "aa_aln": "text",
    }, {"copy": [0, 1]}),
    "aligned_proteins": Binding("benchmark", {
        "variant_hash": "CONCAT('v', CAST(item_id AS STRING))",
        "reference_id": "CASE WHEN item_id % 4 = 0 THEN 'BRISBANE60' ELSE 'CURRENT' END",
        "aa_aln": "text",
    }),
    "variants_filtered": Binding("conversations", {
        "isolate_id": "CONCAT('i', CAST(conv_id + 600 AS STRING), '.1')",
        "flu_sequence_id": "role",
        "variant_hash": "CONCAT('v', CAST(conv_id % 40 AS STRING))",
        "reference_id": "CASE WHEN conv_id % 4 = 0 THEN 'BRISBANE60' ELSE 'CURRENT' END",
        "allele_type": "CASE WHEN role = 'user' THEN 'Minority' ELSE 'Consensus' END",
        "protein": "CASE CAST(turn % 3 AS INT) WHEN 0 THEN 'HA' WHEN 1 THEN 'NA' ELSE 'PB2' END",
        "residue": "SUBSTRING(text, 2, 1)",
        "position_aa": "CAST(LENGTH(text) % 400 + 1 AS INT)",
        "position_disc": "CASE WHEN LENGTH(text) % 2 = 0 THEN NULL "
                         "ELSE CAST(LENGTH(text) % 400 + 1 AS INT) END",
    }),
    "relaxed_structural_distance": Binding("part", {
        "protein": "CASE WHEN p_size = 7 THEN 'NA' ELSE 'HA' END",
        "subtype": "subtype",
        "reference_context": "reference_context",
        "variant_hash": "CASE WHEN p_size = 9 THEN NULL "
                        "ELSE CONCAT('v', CAST(p_partkey AS STRING)) END",
        "atomic_context": "atomic_context",
        "atomic_distance": "CAST(4.5 AS DOUBLE)",
        "site_confidence": "CAST(70 AS DOUBLE)",
        "range_limit": "CAST(p_size AS DOUBLE)",
        "site_range": "CAST(NULL AS STRING)",
        "sd": "CAST((p_partkey * 7 + p_size * LENGTH(atomic_context) "
              "+ LENGTH(reference_context) * LENGTH(subtype)) % 61 AS INT)",
    }, {
        "subtype": ["B", "H1", "H3", "H5"],
        "reference_context": ["reference", "seasonal"],
        "atomic_context": ["calpha", "carbon", "heavy"],
    }),
    "relaxed_rosetta_energy_rmsd": Binding("part", {
        "total_score": "-CAST(FLOOR(p_retailprice) AS DOUBLE) / 4 - version_no % 2",
        "disulfide_potential": "p_size / 8.0e0",
        "attraction_potential": "-p_size / 2.0e0",
        "electrostatic_potential": "-(p_partkey % 97) / 4.0e0",
        "intraresidue_repulsion": "(p_partkey % 31) / 8.0e0",
        "weight_aniso_solvation": "(p_partkey % 13) / 2.0e0",
        "repulsive_potential": "(p_partkey % 17) / 4.0e0",
        "solvation_potential": "(p_partkey % 19) / 8.0e0",
        "hbond_bb_sc": "-(p_partkey % 23) / 4.0e0",
        "hbond_longrange_bb": "-(p_partkey % 29) / 2.0e0",
        "hbond_sidechain": "-(p_partkey % 37) / 8.0e0",
        "hbond_shortrange_bb": "-(p_partkey % 41) / 4.0e0",
        "omega": "(p_partkey % 43) / 2.0e0",
        "yhh_planarity": "(p_partkey % 47) / 4.0e0",
        "variant_hash": "CONCAT('v', CAST(p_partkey AS STRING))",
        "version": "CASE WHEN version_no = 4 THEN NULL WHEN p_size < 10 AND version_no = 3 "
                   "THEN 'r2' ELSE CONCAT('r', CAST(version_no AS STRING)) END",
    }, {"version_no": [1, 2, 3, 4]}),
    "genetic_summary": Binding("part", {
        "subtype": SUBTYPE_OF.format(key="p_partkey"),
        "protein": "'HA'",
        "clade": "CASE WHEN p_size = 50 THEN NULL ELSE p_brand END",
        "identifier": "CONCAT('v', CAST(p_partkey AS STRING))",
        "hd": "CAST(p_size AS INT)",
        "pcd": "CAST(FLOOR(p_retailprice / 8) AS DOUBLE) / 16",
        "substitution_list": "p_type",
        "aa_seq": "p_name",
    }),
}


def _literal(value: object) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, name, sf_dir, SCHEMAS[name])


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table as a lazy DataFrame; only the columns used are read."""
    binding = BINDINGS[name]
    df = star(spark, sf_dir, binding.source)
    used = {
        c for c in df.columns if any(c in text for text in binding.columns.values())
    }
    df = df.select(*sorted(used))
    for alias, values in binding.each.items():
        items = ", ".join(_literal(v) for v in values)
        df = df.selectExpr("*", f"explode(array({items})) AS {alias}")
    return df.selectExpr(*[f"{text} AS {c}" for c, text in binding.columns.items()])


def derived_sql(name: str) -> str:
    """The same table as a SELECT for the oracle."""
    binding = BINDINGS[name]
    source = binding.source
    for alias, values in binding.each.items():
        items = ", ".join(_literal(v) for v in values)
        source = f"(SELECT *, UNNEST([{items}]) AS {alias} FROM {source})"
    columns = ", ".join(f"{text} AS {c}" for c, text in binding.columns.items())
    return f"SELECT {columns} FROM {source}"


def ctes(*names: str, **other: str) -> str:
    """``WITH`` list of derived tables, without the keyword. ``other`` names the binding of a
    table that has not its own name."""
    return ",\n".join(f"{name} AS ({derived_sql(other.get(name, name))})" for name in names)


def warehouse(spark: SparkSession, sf_dir: str, **other: str) -> Warehouse:
    names = Warehouse.__dataclass_fields__
    return Warehouse(**{name: derive(spark, sf_dir, other.get(name, name)) for name in names})
