"""Structure files in the public fixed-column coordinate format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the coordinate format: field -> (first column, width, type).
ATOM_FIELDS = {
    "atom_id": (7, 5, "int"),
    "element_id": (13, 4, "string"),
    "aa": (18, 3, "string"),
    "chain_id": (22, 1, "string"),
    "aa_id": (23, 4, "int"),
    "x": (31, 8, "double"),
    "y": (39, 8, "double"),
    "z": (47, 8, "double"),
    "plddt": (61, 6, "double"),
}
ATOM_RECORD = "ATOM"
RELAXED_PREFIX = r"relaxed_quick_|relaxed_"


def structure_stem(path: Column) -> Column:
    """File name without folders and without the ending."""
    return F.regexp_extract(path, r"([^/]+)\.pdb$", 1)


def is_relaxed(stem: Column) -> Column:
    return F.contains(stem, F.lit("relax"))


def structure_id(stem: Column) -> Column:
    """The stem; for relaxed structures the part between the prefix and the next ``_``.
    A stem without that prefix, or with nothing behind it, stays whole."""
    after = F.get(F.split(stem, RELAXED_PREFIX), F.lit(1))
    part = F.nullif(F.get(F.split(after, "_"), F.lit(0)), F.lit(""))
    return F.when(is_relaxed(stem), F.coalesce(part, stem)).otherwise(stem)


def parse_atoms(lines: DataFrame, line: str = "value", path: str = "path") -> DataFrame:
    """Atoms from text lines; every line that is no atom record is dropped."""
    stem = structure_stem(F.col(path))
    text = F.col(line)
    fields = [
        F.trim(F.substring(text, start, width)).cast(kind).alias(name)
        for name, (start, width, kind) in ATOM_FIELDS.items()
    ]
    return lines.filter(text.startswith(ATOM_RECORD)).select(
        structure_id(stem).alias("structure_id"), stem.alias("file_stem"),
        is_relaxed(stem).alias("relaxed"), *fields,
    )


def read_structures(spark: SparkSession, path: str) -> DataFrame:
    """All structure files below a folder, or matching a pattern, as one table of atoms.

    Small files share a task, large files are split by line; no file is held whole.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.pdb")
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("path"))
    )
    return parse_atoms(lines)


def atom_line(atom: dict[str, Column]) -> Column:
    """The atom record of the format for given columns, the inverse of the parser."""
    return F.format_string(
        "ATOM  %5d %-4s %3s %1s%4d    %8.3f%8.3f%8.3f%6.2f%6.2f",
        atom["atom_id"], atom["element_id"], atom["aa"], atom["chain_id"], atom["aa_id"],
        atom["x"], atom["y"], atom["z"], F.lit(1.0), atom["plddt"],
    )


def reference_labels(atoms: DataFrame) -> DataFrame:
    """Reference atoms with subtype, protein, and context from the file name, as in
    ``H3_HA_seasonal`` or ``relaxed_H3_HA_seasonal``."""
    parts = F.split(F.regexp_replace("file_stem", f"^({RELAXED_PREFIX})", ""), "_")
    return atoms.withColumns({
        "subtype": F.get(parts, F.lit(0)),
        "protein": F.get(parts, F.lit(1)),
        "reference_context": F.get(parts, F.lit(2)),
        "structure_id": F.col("file_stem"),
    })
