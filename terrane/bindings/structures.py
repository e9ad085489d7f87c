"""Queries and oracles of the structure operators.

Every embedding is read as one structure: its atoms are the runs of three consecutive
values, scaled to Angstroms. The first and the last structure of each label serve as
its historical and its seasonal reference.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.bindings.star import star
from terrane.operators import contacts, membership, numbering
from terrane.plans import distances
from terrane.session import shared_dir, written
from terrane.sources import structures

# Atom i of a structure; the same expressions serve both engines.
ATOM_COLUMNS = {
    "structure_id": "CAST(vec_id AS STRING)",
    "label": "label",
    "atom_id": "i",
    "chain_id": "CASE WHEN i <= 20 THEN 'A' WHEN i <= 36 + label THEN 'B' ELSE 'C' END",
    "aa_id": "CAST(FLOOR((i - 1) / 4) + 1 AS INT)",
    "element_id": "CASE CAST(i % 4 AS INT) WHEN 1 THEN 'N' WHEN 2 THEN 'CA' WHEN 3 THEN 'C' "
                  "ELSE 'O' END",
    "x": "CAST(e0 AS DOUBLE) * 20",
    "y": "CAST(e1 AS DOUBLE) * 20",
    "z": "CAST(e2 AS DOUBLE) * 20",
    "plddt": "100 - 150 * ABS(CAST(e3 AS DOUBLE))",
}


def atoms(spark, sf) -> DataFrame:
    runs = star(spark, sf, "embeddings").select(
        "vec_id", "label", F.posexplode(
            F.arrays_zip(
                F.slice("embedding", 1, F.size("embedding") - 3).alias("e0"),
                F.slice("embedding", 2, F.size("embedding") - 3).alias("e1"),
                F.slice("embedding", 3, F.size("embedding") - 3).alias("e2"),
                F.slice("embedding", 4, F.size("embedding") - 3).alias("e3"),
            )
        ).alias("j", "run"),
    ).select("vec_id", "label", (F.col("j") + 1).alias("i"), "run.*")
    return runs.selectExpr(*[f"{text} AS {name}" for name, text in ATOM_COLUMNS.items()])


ATOMS_SQL = f"""
runs AS (
  SELECT vec_id, label, i, embedding[i] AS e0, embedding[i + 1] AS e1,
         embedding[i + 2] AS e2, embedding[i + 3] AS e3
  FROM (SELECT *, UNNEST(range(1, LEN(embedding) - 2)) AS i FROM embeddings)),
atoms AS (SELECT {", ".join(f"{text} AS {name}" for name, text in ATOM_COLUMNS.items())} FROM runs)
"""


def references(spark, sf) -> DataFrame:
    ends = star(spark, sf, "embeddings").groupBy("label").agg(
        F.min("vec_id").alias("reference"), F.max("vec_id").alias("seasonal")
    )
    chosen = ends.select(
        F.concat(F.lit("S"), F.col("label")).alias("subtype"), F.lit("HA").alias("protein"),
        F.explode(F.create_map(
            F.lit("reference"), F.col("reference"), F.lit("seasonal"), F.col("seasonal")
        )).alias("reference_context", "vec_id"),
    )
    return atoms(spark, sf).join(
        chosen.withColumn("structure_id", F.col("vec_id").cast("string")).drop("vec_id"),
        "structure_id",
    )


def contact_pairs(spark, sf):
    numbered = contacts.mask_confidence(
        contacts.align(contacts.atoms_for(atoms(spark, sf), tuple(contacts.CONTEXT_ATOMS)))
    )
    return (
        contacts.contact_pairs(numbered, ["structure_id", "sd_context"])
        .select("structure_id", "sd_context", *[
            F.col(p).cast("bigint").alias(p) for p in ("pos1", "pos2")])
    )


CONTEXT_ROWS = "(VALUES " + ", ".join(
    f"('{context}', '{element}')"
    for context, elements in contacts.CONTEXT_ATOMS.items() for element in elements
) + ") AS m(sd_context, element_id)"

# chain number and number in the chain, then the confidence mask
POSITIONS_SQL = f"""
chosen AS (SELECT a.*, m.sd_context FROM atoms a JOIN {CONTEXT_ROWS} USING (element_id)
           {{where}}),
chains AS (
  SELECT structure_id, sd_context, chain_id,
         ROW_NUMBER() OVER (PARTITION BY structure_id, sd_context
                            ORDER BY MIN(atom_id)) AS chain_no
  FROM chosen GROUP BY structure_id, sd_context, chain_id),
positions AS (
  SELECT c.*, n.chain_no * {contacts.CHAIN_STRIDE}
         + ROW_NUMBER() OVER (PARTITION BY structure_id, sd_context, chain_id
                              ORDER BY atom_id) - 1 AS pos
  FROM chosen c JOIN chains n USING (structure_id, sd_context, chain_id)),
valid AS MATERIALIZED (SELECT * FROM positions WHERE {{mask}}),
pairs AS MATERIALIZED (
  SELECT a.structure_id, a.sd_context, a.pos AS pos1, b.pos AS pos2
  FROM valid a JOIN valid b ON a.structure_id = b.structure_id
   AND a.sd_context = b.sd_context AND a.pos < b.pos
  WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) > 0
    AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)
        < {{limit}} * {{limit}})
"""

CONTACT_SQL = (
    f"WITH {ATOMS_SQL}, "
    + POSITIONS_SQL.format(where="", mask="plddt >= 70", limit="4.5")
    + "SELECT * FROM pairs"
)


def structural_distance(**options):
    def run(spark, sf):
        return contacts.structural_distance(
            atoms(spark, sf), references(spark, sf), tuple(contacts.CONTEXT_ATOMS), **options
        ).select("protein", "subtype", "reference_context", "identifier", "sd_context",
                 "sd_limit", "sd")
    return run


def _distance_sql(where="", mask="plddt >= 70", limit="4.5"):
    return f"""
WITH {ATOMS_SQL}, {POSITIONS_SQL.format(where=where, mask=mask, limit=limit)},
refs AS (
  SELECT CONCAT('S', label) AS subtype, 'reference' AS reference_context,
         CAST(MIN(vec_id) AS STRING) AS ref FROM embeddings GROUP BY label
  UNION ALL
  SELECT CONCAT('S', label), 'seasonal', CAST(MAX(vec_id) AS STRING)
  FROM embeddings GROUP BY label),
combos AS (
  SELECT s.structure_id, s.sd_context, r.ref, r.subtype, r.reference_context
  FROM (SELECT DISTINCT structure_id, sd_context FROM positions) s, refs r),
ref_pairs AS MATERIALIZED (
  SELECT * FROM pairs WHERE structure_id IN (SELECT ref FROM refs)),
ref_valid AS MATERIALIZED (
  SELECT structure_id AS ref, sd_context, pos FROM valid
  WHERE structure_id IN (SELECT ref FROM refs)),
-- contacts of one side, on positions that both have, that the other side lacks
query_only AS (
  SELECT c.structure_id, c.sd_context, c.ref
  FROM (SELECT p.*, r.ref FROM pairs p, refs r) c
  WHERE EXISTS (SELECT 1 FROM ref_valid v
                WHERE v.ref = c.ref AND v.sd_context = c.sd_context AND v.pos = c.pos1)
    AND EXISTS (SELECT 1 FROM ref_valid v
                WHERE v.ref = c.ref AND v.sd_context = c.sd_context AND v.pos = c.pos2)
    AND NOT EXISTS (SELECT 1 FROM ref_pairs o
                    WHERE o.structure_id = c.ref AND o.sd_context = c.sd_context
                      AND o.pos1 = c.pos1 AND o.pos2 = c.pos2)),
ref_only AS (
  SELECT c.structure_id, c.sd_context, c.ref
  FROM (SELECT s.vec AS structure_id, p.sd_context, p.structure_id AS ref, p.pos1, p.pos2
        FROM ref_pairs p, (SELECT CAST(vec_id AS STRING) AS vec FROM embeddings) s) c
  WHERE EXISTS (SELECT 1 FROM valid v WHERE v.structure_id = c.structure_id
                AND v.sd_context = c.sd_context AND v.pos = c.pos1)
    AND EXISTS (SELECT 1 FROM valid v WHERE v.structure_id = c.structure_id
                AND v.sd_context = c.sd_context AND v.pos = c.pos2)
    AND NOT EXISTS (SELECT 1 FROM pairs o
                    WHERE o.structure_id = c.structure_id AND o.sd_context = c.sd_context
                      AND o.pos1 = c.pos1 AND o.pos2 = c.pos2)),
counted AS (
  SELECT structure_id, sd_context, ref, COUNT(*) AS n
  FROM (SELECT * FROM query_only UNION ALL SELECT * FROM ref_only) GROUP BY ALL)
SELECT 'HA' AS protein, c.subtype, c.reference_context, c.structure_id AS identifier,
       c.sd_context, CAST({limit} AS DOUBLE) AS sd_limit,
       CAST(COALESCE(n.n, 0) AS INT) AS sd
FROM combos c LEFT JOIN counted n USING (structure_id, sd_context, ref)
"""


def site_filter(spark, sf):
    chosen = contacts.site_filter(
        star(spark, sf, "lineitem"), "2;4..6", "l_linenumber"
    )
    return chosen.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


SITE_SQL = """
SELECT l_linenumber, COUNT(*) AS n, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem WHERE l_linenumber = 2 OR l_linenumber BETWEEN 4 AND 6 GROUP BY l_linenumber
"""


def row_numbers(spark, sf):
    lines = star(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return numbering.number_rows(lines, ["o_custkey"], "o_orderkey", "place").select(
        "o_custkey", "o_orderkey", F.col("place").cast("bigint").alias("place")
    )


ROW_NUMBERS_SQL = """
SELECT o_custkey, o_orderkey,
       ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place
FROM orders
"""


def pending_inputs(spark, sf):
    return membership.pending(
        star(spark, sf, "documents").select("doc_id", "lang", "source"),
        star(spark, sf, "labels"), ["doc_id"],
    )


PENDING_SQL = """
SELECT doc_id, lang, source FROM documents
WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)
"""


def pending_contexts(spark, sf):
    """Structures to compute per context, when even labels are done for calpha and others
    for heavy."""
    table = atoms(spark, sf)
    done = star(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("identifier"),
        F.when(F.col("label") % 2 == 0, "calpha").otherwise("heavy").alias("sd_context"),
        F.lit(contacts.CONTACT_LIMIT).alias("sd_limit"),
        F.lit(contacts.MIN_CONFIDENCE).alias("sd_confidence"))
    return distances.pending_pairs(
        table, done, tuple(contacts.CONTEXT_ATOMS), contacts.CONTACT_LIMIT,
        contacts.MIN_CONFIDENCE, None, None)


PENDING_CONTEXTS_SQL = """
SELECT DISTINCT CAST(vec_id AS STRING) AS structure_id, sd_context
FROM embeddings, (VALUES ('calpha'), ('carbon'), ('heavy')) AS c(sd_context)
WHERE sd_context <> CASE WHEN label % 2 = 0 THEN 'calpha' ELSE 'heavy' END
"""


def new_distances(spark, sf):
    """The distances of calpha for structures of even labels, then all that is pending
    appended; the folder then holds every distance once."""
    folder = f"{shared_dir(spark)}/distances-{uuid.uuid4().hex}"
    table, known = atoms(spark, sf), references(spark, sf)
    distances.append_distances(
        table.filter(F.col("label") % 2 == 0), known, folder, contexts=("calpha",))
    # the first output as it is now, so that it can be appended to
    done = written(spark.read.parquet(folder), "done")
    distances.append_distances(table, known, folder, done)
    return spark.read.parquet(folder).select(
        "protein", "subtype", "reference_context", "identifier", "sd_context", "sd_limit", "sd")


def structure_files(spark, sf):
    """Writes every structure as a text file, reads the folder back, and parses it."""
    table = atoms(spark, sf)
    stem = F.when(F.col("label") % 2 == 0, F.concat(F.lit("relaxed_"), "structure_id", F.lit("_x")))
    named = table.select(
        F.concat(F.coalesce(stem, F.col("structure_id")), F.lit(".pdb")).alias("file"),
        structures.atom_line({**{c: F.col(c) for c in table.columns}, "aa": F.lit("GLY")})
        .alias("value"),
    )
    folder = f"{shared_dir(spark)}/structures-{uuid.uuid4().hex}"
    # one folder per structure; the part file inside carries the atoms
    named.repartition("file").write.partitionBy("file").text(folder)
    lines = (
        spark.read.option("recursiveFileLookup", True).text(folder)
        .select("value", F.regexp_extract("_metadata.file_path", r"file=([^/]+)/", 1).alias("path"))
    )
    # the files are small: as many tasks read them as wrote them, not one for every few files
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return structures.parse_atoms(lines.coalesce(tasks), path="path").select(
        "structure_id", "relaxed", "atom_id", "element_id", "chain_id", "aa_id",
        F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.round("z", 3).alias("z"),
    )


STRUCTURE_FILES_SQL = f"""
WITH {ATOMS_SQL}
SELECT structure_id, label % 2 = 0 AS relaxed, CAST(atom_id AS INT) AS atom_id, element_id,
       chain_id, aa_id, ROUND(x, 3) + 0 AS x, ROUND(y, 3) + 0 AS y, ROUND(z, 3) + 0 AS z
FROM atoms
"""

QUERIES = {
    "contact_pairs": contact_pairs,
    "structural_distance": structural_distance(),
    "structural_distance_sites": structural_distance(limit=5.5, sites="2..5;8;10..14"),
    "structural_distance_relaxed": structural_distance(confidence=None),
    "masked_structure": structural_distance(confidence=99.0),
    "site_filter": site_filter,
    "row_numbers": row_numbers,
    "pending_inputs": pending_inputs,
    "pending_contexts": pending_contexts,
    "structure_files": structure_files,
    "new_distances": new_distances,
}

ORACLES = {
    "contact_pairs": CONTACT_SQL,
    "structural_distance": _distance_sql(),
    "structural_distance_sites": _distance_sql(
        where="WHERE a.aa_id BETWEEN 2 AND 5 OR a.aa_id = 8 OR a.aa_id BETWEEN 10 AND 14",
        limit="5.5",
    ),
    "structural_distance_relaxed": _distance_sql(mask="TRUE"),
    "masked_structure": _distance_sql(mask="plddt >= 99"),
    "site_filter": SITE_SQL,
    "row_numbers": ROW_NUMBERS_SQL,
    "pending_inputs": PENDING_SQL,
    "pending_contexts": PENDING_CONTEXTS_SQL,
    "structure_files": STRUCTURE_FILES_SQL,
    "new_distances": _distance_sql(),
}
