"""Queries and oracles of the merge and imputation operators."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.bindings.model_table import (
    GROUP_COLUMN, TITERS, model_sql, model_table,
)
from terrane.bindings.models import COLUMNS as MODEL_COLUMNS, GUARD_SQL, METADATA
from terrane.bindings.star import ctes, derive, star, warehouse
from terrane.bindings.titers import ELIGIBLE, ISOLATE_VALUES, SPRING, TITER_TABLES
from terrane.functions.numbers import log_titer, unlog_titer
from terrane.functions.predicates import quoted
from terrane.operators import (
    antisera, factors, features, imputing, merging, titers, versions,
)
from terrane.plans.tables import reportable_lots
from terrane.session import written

WIDE = {"H3": "", "H1 swl": "_h1", "B vic": "_b"}
BASE = ["subtype", "protein", "clade", "variant_hash", "hd", "pcd", "substitution_list", "aa_seq",
        *merging.ENERGIES, *merging.RELATIVE]

def energy_references(genetic: DataFrame) -> DataFrame:
    """The first and the last variant of a subtype as its two energy references."""
    ends = genetic.groupBy("subtype").agg(
        F.min("identifier").alias("reference"), F.max("identifier").alias("seasonal")
    )
    return ends.select(
        "subtype", F.explode(F.create_map(
            F.lit("reference"), F.col("reference"), F.lit("seasonal"), F.col("seasonal")
        )).alias("context", "identifier"),
    )


def long_of(spark, sf, individual: bool) -> DataFrame:
    w = warehouse(spark, sf)
    return written(features.long_features(
        versions.distance_extract(w.relaxed_structural_distance),
        titers.individual_summary(w) if individual else titers.titer_summary(w), individual,
    ), "long-features")


def long_features(individual: bool):
    def run(spark, sf):
        return long_of(spark, sf, individual).withColumn("value", F.round("value", 6))
    return run


def wide_features(subtype: str, individual: bool):
    """The whole wide table of one subtype: its labels are read from the long table."""
    def run(spark, sf):
        w = warehouse(spark, sf)
        genetic = derive(spark, sf, "genetic_summary")
        table = features.subtype_table(
            long_of(spark, sf, individual), genetic,
            versions.energy_summary(w.relaxed_rosetta_energy_rmsd, w.relaxed_structural_distance),
            energy_references(genetic), subtype, individual)
        numbers = [c for c, kind in table.dtypes if kind == "double"]
        return table.withColumns({c: F.round(quoted(c), 6) for c in numbers})
    return run


def long_features_lots(spark, sf):
    """The long table limited to the lots of the recent seasons, a table of its own."""
    sera = antisera.reportable_sera(derive(spark, sf, "archive_serum_ref"), SPRING)
    return features.limited_to_lots(
        long_of(spark, sf, False), sera.filter(F.col("subtype") == "H3")).withColumn(
        "value", F.round("value", 6))


def lot_triples(spark, sf):
    """The antigenic triples whose titer lot is one of the recent seasons, with their rows."""
    sera = antisera.reportable_sera(derive(spark, sf, "archive_serum_ref"), SPRING)
    lots = reportable_lots(sera.filter(F.col("subtype") == "H3"))
    triples = factors.factor_triples(MODEL_COLUMNS, "antigenic", lots)
    return factors.row_guard(model_table(spark, sf), triples, METADATA)


def _long_ctes(individual: bool) -> str:
    """``long``: (kind, identifier, [specimen keys], feature, lot, value) of all sources."""
    keys = "ag_cdc_id, ag_isolate_id, " if individual else ""
    none = "CAST(NULL AS VARCHAR) AS ag_cdc_id, CAST(NULL AS VARCHAR) AS ag_isolate_id, " \
        if individual else ""
    parts = " UNION ALL ".join(
        f"SELECT CASE subtype WHEN 'H1 swl' THEN 'H1' WHEN 'B vic' THEN 'B' ELSE subtype END "
        f"|| '|' || test_protocol || '|{label}|' || lot || '|logfold' AS feature, lot, "
        f"ag_variant_hash AS identifier, {keys}sr_variant_hash, value FROM {values} "
        "WHERE ag_variant_hash IN (SELECT variant_hash FROM relaxed_structural_distance "
        "WHERE subtype IN ('B', 'H1', 'H3'))"
        for label, values in (("lot", "lot_values"), ("ha_protein", "protein_values")))
    # without specimens a summary row is a mean per antiserum variant first
    rows = "titer_rows" if individual else (
        "(SELECT feature, lot, identifier, sr_variant_hash, AVG(value) AS value "
        "FROM titer_rows GROUP BY ALL)")
    return f"""{ctes(*TITER_TABLES, "relaxed_rosetta_energy_rmsd", "genetic_summary")},
{ELIGIBLE},{ISOLATE_VALUES},
titer_rows AS ({parts}),
long AS (
  SELECT 'titer' AS kind, identifier, {keys}feature, lot, AVG(value) AS value
  FROM {rows} GROUP BY ALL
  UNION ALL
  SELECT 'structure', variant_hash, {none}
         CONCAT(subtype, '_', reference_context, '_', atomic_context, '_sd'),
         CAST(NULL AS VARCHAR), AVG(sd)
  FROM relaxed_structural_distance
  WHERE subtype IN ('B', 'H1', 'H3') AND variant_hash IS NOT NULL GROUP BY ALL)"""


def _long_sql(individual: bool) -> str:
    return (f"WITH {_long_ctes(individual)} "
            "SELECT * REPLACE (ROUND(value, 6) AS value) FROM long")


_SERA = """(SELECT DISTINCT lot FROM archive_serum_ref
  WHERE NOT egg_vaccine AND season >= 1999 AND subtype = 'H3')"""
LONG_LOTS_SQL = f"""
WITH {_long_ctes(False)}
SELECT * REPLACE (ROUND(value, 6) AS value) FROM long l
WHERE kind = 'structure' OR EXISTS (SELECT 1 FROM {_SERA} s WHERE contains(l.lot, s.lot))
"""
LOT_TRIPLES_SQL = f"""
{GUARD_SQL.replace("WITH", f"WITH {ctes('archive_serum_ref')},", 1)}
WHERE z_factor LIKE '%logfold' AND EXISTS (SELECT 1 FROM {_SERA} s WHERE contains(z_factor, s.lot))
"""


def _wide_sql(subtype: str, individual: bool) -> str:
    mark = merging.COLUMN_MARKS[subtype]
    energies = ", ".join(
        f"ROUND(e.{term}, 6) AS {merging.ENERGY_NAMES.get(term, term)}"
        for term in versions.ENERGY_TERMS
    )
    keys = ", ag_cdc_id, ag_isolate_id" if individual else ""
    specimens = """
specimens AS (SELECT DISTINCT identifier, ag_cdc_id, ag_isolate_id FROM long
              WHERE kind = 'titer'),
rows AS (SELECT b.*, ag_cdc_id, ag_isolate_id, row_number() OVER () AS number
         FROM base b LEFT JOIN specimens s ON s.identifier = b.variant_hash),""" \
        if individual else "rows AS (SELECT *, row_number() OVER () AS number FROM base),"
    same = ("AND (kind = 'structure' OR (o.ag_cdc_id = r.ag_cdc_id "
            "AND o.ag_isolate_id = r.ag_isolate_id))" if individual else "")
    return f"""
WITH {_long_ctes(individual)},
energy AS (
  SELECT DISTINCT r.* FROM relaxed_rosetta_energy_rmsd r
  JOIN (SELECT variant_hash, MAX(version) AS version FROM relaxed_rosetta_energy_rmsd
        GROUP BY variant_hash) m USING (variant_hash, version)
  WHERE variant_hash IN (SELECT variant_hash FROM relaxed_structural_distance
                         WHERE subtype IN ('B', 'H1', 'H3') AND protein = 'HA')),
ends AS (
  SELECT subtype, MIN(identifier) AS first_id, MAX(identifier) AS last_id
  FROM genetic_summary GROUP BY subtype),
scores AS (
  SELECT n.subtype, a.total_score AS old_score, b.total_score AS new_score
  FROM ends n LEFT JOIN energy a ON a.variant_hash = n.first_id
  LEFT JOIN energy b ON b.variant_hash = n.last_id),
base AS (
  SELECT g.subtype, g.protein, g.clade, g.identifier AS variant_hash, g.hd,
         ROUND(g.pcd, 6) AS pcd, g.substitution_list, g.aa_seq, {energies},
         ROUND(s.old_score - e.total_score, 6) AS rrel_total_score,
         ROUND(s.new_score - e.total_score, 6) AS srel_total_score
  FROM genetic_summary g
  LEFT JOIN energy e ON e.variant_hash = g.identifier
  LEFT JOIN scores s ON s.subtype = g.subtype
  WHERE g.subtype = '{subtype}'),{specimens}
own AS (SELECT * FROM long WHERE regexp_matches(feature, '{mark}(_|\\|)')),
cells AS (
  SELECT r.*, o.feature, o.value FROM rows r
  FULL JOIN own o ON o.identifier = r.variant_hash {same})
SELECT * EXCLUDE (number) FROM (PIVOT cells ON feature USING ROUND(AVG(value), 6)
  GROUP BY {", ".join(BASE)}{keys}, number) WHERE subtype IS NOT NULL
"""


STATUSES = ["F", "O", "P"]


def pivot_mean(spark, sf):
    orders = star(spark, sf, "orders").withColumn(
        "label", F.concat_ws("|", "o_orderstatus", F.substring("o_orderpriority", 1, 1))
    )
    labels = [f"{s}|{p}" for s, p in product(STATUSES, "12345")]
    wide = merging.pivot_mean(orders, ["o_custkey"], "label", "o_totalprice", labels)
    return wide.withColumns({c: F.round(quoted(c), 4) for c in labels})


PIVOT_SQL = (
    "SELECT o_custkey, " + ", ".join(
        f"ROUND(AVG(o_totalprice) FILTER (WHERE o_orderstatus = '{s}' "
        f"AND o_orderpriority LIKE '{p}%'), 4) AS \"{s}|{p}\""
        for s, p in product(STATUSES, "12345")
    ) + " FROM orders GROUP BY o_custkey"
)


def outer_merge(spark, sf):
    """Three partial tables by a key that may be missing."""
    lines = star(spark, sf, "lineitem").withColumn(
        "part", F.when(F.col("l_linenumber") != 4, F.col("l_partkey"))
    )

    def side(flag: str) -> DataFrame:
        return lines.filter(F.col("l_returnflag") == flag).groupBy("part", "l_suppkey").agg(
            F.count(F.lit(1)).alias(f"n_{flag.lower()}"))

    return merging.merge_outer([side(f) for f in "ANR"], ["part", "l_suppkey"])


OUTER_SQL = """
WITH lines AS (
  SELECT CASE WHEN l_linenumber <> 4 THEN l_partkey END AS part, l_suppkey, l_returnflag AS flag
  FROM lineitem),
a AS (SELECT part, l_suppkey, COUNT(*) AS n_a FROM lines WHERE flag = 'A' GROUP BY ALL),
n AS (SELECT part, l_suppkey, COUNT(*) AS n_n FROM lines WHERE flag = 'N' GROUP BY ALL),
r AS (SELECT part, l_suppkey, COUNT(*) AS n_r FROM lines WHERE flag = 'R' GROUP BY ALL),
every AS (SELECT DISTINCT part, l_suppkey FROM lines)
SELECT e.part, e.l_suppkey, n_a, n_n, n_r FROM every e
LEFT JOIN a ON a.part IS NOT DISTINCT FROM e.part AND a.l_suppkey = e.l_suppkey
LEFT JOIN n ON n.part IS NOT DISTINCT FROM e.part AND n.l_suppkey = e.l_suppkey
LEFT JOIN r ON r.part IS NOT DISTINCT FROM e.part AND r.l_suppkey = e.l_suppkey
"""


def relative_scores(spark, sf):
    w = warehouse(spark, sf)
    genetic = derive(spark, sf, "genetic_summary").select("identifier", "subtype")
    energies = versions.energy_summary(
        w.relaxed_rosetta_energy_rmsd, w.relaxed_structural_distance
    ).select("identifier", "total_score")
    scores = merging.reference_scores(energy_references(genetic), energies)
    return merging.attach_references(
        merging.merge(genetic, energies, ["identifier"], "left"), scores
    )


RELATIVE_SQL = f"""
WITH {ctes("relaxed_rosetta_energy_rmsd", "relaxed_structural_distance", "genetic_summary")},
energy AS (
  SELECT DISTINCT variant_hash, version, * EXCLUDE (variant_hash, version)
  FROM relaxed_rosetta_energy_rmsd
  JOIN (SELECT variant_hash, MAX(version) AS version FROM relaxed_rosetta_energy_rmsd
        GROUP BY variant_hash) USING (variant_hash, version)
  WHERE variant_hash IN (SELECT variant_hash FROM relaxed_structural_distance
                         WHERE subtype IN ('B', 'H1', 'H3') AND protein = 'HA')),
ends AS (
  SELECT subtype, MIN(identifier) AS first_id, MAX(identifier) AS last_id
  FROM genetic_summary GROUP BY subtype)
SELECT g.identifier, g.subtype, e.total_score,
       a.total_score - e.total_score AS rrel_total_score,
       b.total_score - e.total_score AS srel_total_score
FROM genetic_summary g LEFT JOIN energy e ON e.variant_hash = g.identifier
JOIN ends n ON n.subtype = g.subtype
LEFT JOIN energy a ON a.variant_hash = n.first_id
LEFT JOIN energy b ON b.variant_hash = n.last_id
"""


def impute_group(spark, sf):
    table = model_table(spark, sf).select("variant_hash", "clade", *[quoted(c) for c in TITERS])
    filled = imputing.impute_by_group(table, "clade", TITERS)
    return _rounded_fill(filled, imputing.GROUP_SUFFIX)


def impute_column(spark, sf):
    table = model_table(spark, sf).select("variant_hash", "clade", *[quoted(c) for c in TITERS])
    filled = imputing.impute_by_column(table, TITERS)
    return _rounded_fill(filled, imputing.COLUMN_SUFFIX)


def _rounded_fill(df: DataFrame, suffix: str) -> DataFrame:
    return df.select(
        "variant_hash", "clade", *[F.round(quoted(c + suffix), 6).alias(c + suffix) for c in TITERS]
    )


def _impute_sql(suffix: str, over: str) -> str:
    cells = ", ".join(
        f'ROUND(COALESCE("{c}", {over.format(c=c)}), 6) AS "{c}{suffix}"' for c in TITERS
    )
    return f"WITH {model_sql()} SELECT variant_hash, clade, {cells} FROM model"


GROUP_FILL_SQL = _impute_sql(
    imputing.GROUP_SUFFIX,
    f'CASE WHEN {GROUP_COLUMN} IS NOT NULL THEN AVG("{{c}}") OVER (PARTITION BY {GROUP_COLUMN}) END',
)
COLUMN_FILL_SQL = _impute_sql(imputing.COLUMN_SUFFIX, 'AVG("{c}") OVER ()')


def impute_table(spark, sf):
    """Both fills; one column is a raw titer, so it is filled on the log scale."""
    table = model_table(spark, sf).select(
        "variant_hash", "clade", quoted(TITERS[0]),
        F.pow(F.lit(2.0), F.ceil(quoted(TITERS[1]))).alias("titer|logfold"),
    )
    filled = imputing.impute_table(table)
    numbers = [c for c, kind in filled.dtypes if kind == "double"]
    return filled.withColumns({c: F.round(quoted(c), 6) for c in numbers})


IMPUTE_TABLE_SQL = f"""
WITH {model_sql()},
raw AS (SELECT variant_hash, clade, "{TITERS[0]}" AS a,
               POW(2.0, CEIL("{TITERS[1]}")) AS t FROM model),
logged AS (SELECT *, LOG2(t / 5) AS l FROM raw)
SELECT variant_hash, clade, ROUND(a, 6) AS "{TITERS[0]}", ROUND(t, 6) AS "titer|logfold",
  ROUND(COALESCE(a, CASE WHEN clade IS NOT NULL THEN AVG(a) OVER (PARTITION BY clade) END), 6)
    AS "{TITERS[0]}|cladei",
  ROUND(POW(2, COALESCE(l, CASE WHEN clade IS NOT NULL
    THEN AVG(l) OVER (PARTITION BY clade) END)) * 5, 6) AS "titer|logfold|cladei",
  ROUND(COALESCE(a, AVG(a) OVER ()), 6) AS "{TITERS[0]}|meani",
  ROUND(POW(2, COALESCE(l, AVG(l) OVER ())) * 5, 6) AS "titer|logfold|meani"
FROM logged
"""


def log_titers(spark, sf):
    balance = star(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") % 5 == 0, F.lit("*"))
        .otherwise(F.col("c_acctbal").cast("string")).alias("titer")
    )
    return balance.select(
        "c_custkey", F.round(log_titer(F.col("titer")), 6).alias("logged"),
        F.round(unlog_titer(log_titer(F.col("titer"))), 4).alias("restored"),
    )


LOG_SQL = """
SELECT c_custkey, ROUND(LOG2(t / 5), 6) AS logged, ROUND(POW(2, LOG2(t / 5)) * 5, 4) AS restored
FROM (SELECT c_custkey,
             CASE WHEN c_nationkey % 5 <> 0 AND c_acctbal > 0 THEN c_acctbal END AS t
      FROM customer)
"""

QUERIES = {
    "pivot_mean": pivot_mean,
    "outer_merge": outer_merge,
    "relative_scores": relative_scores,
    "long_features": long_features(False),
    "long_features_individual": long_features(True),
    "long_features_lots": long_features_lots,
    "lot_triples": lot_triples,
    **{f"wide_features{name}": wide_features(subtype, False) for subtype, name in WIDE.items()},
    **{f"wide_features_individual{name}": wide_features(subtype, True)
       for subtype, name in WIDE.items()},
    "impute_group": impute_group,
    "impute_column": impute_column,
    "impute_table": impute_table,
    "log_titers": log_titers,
}

ORACLES = {
    "pivot_mean": PIVOT_SQL,
    "outer_merge": OUTER_SQL,
    "relative_scores": RELATIVE_SQL,
    "long_features": _long_sql(False),
    "long_features_individual": _long_sql(True),
    "long_features_lots": LONG_LOTS_SQL,
    "lot_triples": LOT_TRIPLES_SQL,
    **{f"wide_features{name}": _wide_sql(subtype, False) for subtype, name in WIDE.items()},
    **{f"wide_features_individual{name}": _wide_sql(subtype, True)
       for subtype, name in WIDE.items()},
    "impute_group": GROUP_FILL_SQL,
    "impute_column": COLUMN_FILL_SQL,
    "impute_table": IMPUTE_TABLE_SQL,
    "log_titers": LOG_SQL,
}
