"""Contact maps of structures and the distance between two maps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from terrane.functions.lists import range_positions
from terrane.operators import bricks
from terrane.operators.numbering import block_numbers
from terrane.session import written

# Atoms per context, contact limit in Angstroms, least confidence.
CONTEXT_ATOMS = {
    "calpha": ("CA",),
    "carbon": ("CA", "C"),
    "heavy": ("CA", "C", "N", "O"),
}
CONTACT_LIMIT = 4.5
MIN_CONFIDENCE = 70.0
# Chain number and number in the chain share one 64-bit position.
CHAIN_STRIDE = 1 << 32
#: Positions or contacts of all references up to which they are broadcast, and the copies of a
#: larger reference table.
MAX_BROADCAST_ENTRIES = 500_000
SALTS = 64


def atoms_for(atoms: DataFrame, contexts: Sequence[str] = ("calpha",)) -> DataFrame:
    """Atoms of each context, with the context's name: one pass for all contexts."""
    unknown = set(contexts) - set(CONTEXT_ATOMS)
    if unknown:
        raise ValueError(f"contexts are {sorted(CONTEXT_ATOMS)}, not {sorted(unknown)}")
    named = [
        F.when(F.col("element_id").isin(*CONTEXT_ATOMS[c]), F.lit(c)) for c in contexts
    ]
    return atoms.withColumn("sd_context", F.explode(F.array_compact(F.array(*named))))


def site_filter(atoms: DataFrame, ranges: str | None, residue: str = "aa_id") -> DataFrame:
    """Atoms of the residues in a range list such as ``'95;100..110'``."""
    if ranges is None:
        return atoms
    sites = atoms.sparkSession.range(1).select(
        F.explode(range_positions(F.lit(ranges))).alias(residue)
    )
    return atoms.join(sites, residue, "left_semi")


def align(atoms: DataFrame) -> DataFrame:
    """Position of every atom: the number of its chain and its number in the chain.

    Numbers follow ``atom_id``. Two structures align on equal positions, so a shorter
    chain lacks the positions at its end. Numbering works on blocks of atoms, so a
    chain of any length is spread over tasks.
    """
    chain = ["structure_id", "sd_context", "chain_id"]
    blocks = block_numbers(atoms, chain, "atom_id")
    # windows over one row per block: the chains of a structure by their first atom
    opening = F.min("_first").over(Window.partitionBy(*chain))
    by_opening = Window.partitionBy("structure_id", "sd_context").orderBy("_opening", "chain_id")
    starts = (
        blocks.starts.withColumn("_opening", opening)
        .withColumn("_chain_no", F.dense_rank().over(by_opening))
        .drop("_opening")
    )
    return (
        blocks.number(starts)
        .withColumn("pos", F.col("_chain_no") * F.lit(CHAIN_STRIDE) + F.col("_number"))
        .drop("_chain_no", "_number")
    )


def mask_confidence(
    positions: DataFrame, minimum: float | None = MIN_CONFIDENCE
) -> DataFrame:
    """Drop atoms of low confidence. Apply after the positions are set, so that the
    others keep theirs. ``None`` switches the mask off, as for relaxed structures."""
    return positions.filter(confident(minimum))


def confident(minimum: float | None) -> Column:
    if minimum is None:
        return F.lit(True)
    return F.coalesce(F.col("plddt") >= minimum, F.lit(True))


def contact_pairs(
    positions: DataFrame, by: Sequence[str], limit: float = CONTACT_LIMIT
) -> DataFrame:
    """Pairs ``pos1 < pos2`` of one group with 0 < distance < ``limit``.

    Space is cut into bricks of cells as wide as the limit. A pair is found in the brick of its
    later point, so a point goes to its own brick and, from the brick's rim, to the neighbours
    that its half shell of cells reaches: most points are sent once. A large structure is spread
    over its bricks; small ones share a task.
    """
    schema = positions.schema
    found = StructType([
        *[schema[c] for c in by], *[StructField(p, schema["pos"].dataType) for p in ("pos1", "pos2")]])
    points = positions.select(*by, "pos", "x", "y", "z").dropna()
    cell = {a: F.floor(F.col(a) / F.lit(limit)).cast("bigint") for a in "xyz"}

    def brick(*steps: int) -> Column:
        return F.struct(*[
            F.shiftright(cell[a] + F.lit(bricks.SHIFT + step), bricks.BITS).alias(f"_b{a}")
            for a, step in zip("xyz", steps)])

    own = brick(0, 0, 0)
    rim = F.lit(False)
    for a, steps in zip("xyz", ((1,), (-1, 1), (-1, 1))):
        for step in steps:
            at = [step if b == a else 0 for b in "xyz"]
            rim = rim | (brick(*at).getField(f"_b{a}") != own.getField(f"_b{a}"))
    reached = F.array_distinct(F.array(*[brick(*step) for step in bricks.half_shell()]))
    keys = [*by, "_bx", "_by", "_bz"]
    sent = (
        points.withColumn("_brick", F.explode(F.when(rim, reached).otherwise(F.array(own))))
        .select(*by, "_brick.*", "pos", "x", "y", "z")
        .repartition(*keys).sortWithinPartitions(*keys)
    )
    return sent.mapInArrow(partial(bricks.found_pairs, by=list(by), limit=float(limit)), found)


def _meet(queries: DataFrame, references: DataFrame, on: list[str], light: bool,
          how: str = "inner") -> DataFrame:
    """Rows of query structures with a table of the references. Positions and contexts are
    shared by all queries, so a table that is too large to broadcast is copied ``SALTS`` times
    and each query structure meets one copy."""
    if light:
        return queries.join(F.broadcast(references), on, how)
    salt = F.pmod(F.xxhash64("structure_id"), F.lit(SALTS)).cast("int")
    copies = references.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return queries.withColumn("_salt", salt).join(copies, [*on, "_salt"], how).drop("_salt")


def structural_distance(
    queries: DataFrame,
    references: DataFrame,
    contexts: Sequence[str] = ("calpha",),
    limit: float = CONTACT_LIMIT,
    confidence: float | None = MIN_CONFIDENCE,
    sites: str | None = None,
    proteomic_context: str | None = None,
    asked: DataFrame | None = None,
) -> DataFrame:
    """Number of position pairs whose contact state differs, for every query structure,
    reference structure, and context; with ``asked`` (structure_id, sd_context) only for these
    structures and contexts.

    ``queries`` are atoms with ``structure_id``; ``references`` also carry ``subtype``,
    ``protein``, and ``reference_context``. Only positions present in both structures
    count. With Q and R the contacts of the two on those positions the distance is
    |Q| + |R| - 2 |Q and R|, so every row becomes a change of the distance of a (query,
    reference), and these are summed in the task before their only exchange:

    * |Q| and |Q and R| come from the query's contacts, met by the list of references
      per position and per reference contact. References are a handful per context.
    * |R| is all contacts of the reference less those that touch a position the query
      lacks; only the lacking positions become rows.

    The reference side is broadcast if its positions and contacts are at most
    ``MAX_BROADCAST_ENTRIES``, and salted otherwise.
    """
    by = ["structure_id", "sd_context"]
    label = ["subtype", "protein", "reference_context"]
    numbered = written(
        references.select(*label, "structure_id").distinct().withColumn(
            "ref", F.monotonically_increasing_id()
        ),
        "reference-names",
    )
    renamed = references.join(numbered, [*label, "structure_id"]).withColumn(
        "structure_id", F.col("ref")
    )

    def positions(atoms: DataFrame, name: str, only: DataFrame | None = None) -> DataFrame:
        chosen = atoms_for(atoms, contexts)
        if only is not None:
            chosen = chosen.join(only.select(*by), by, "left_semi")
        placed = align(site_filter(chosen, sites))
        return written(
            placed.select(*by, "pos", "x", "y", "z", confident(confidence).alias("kept")), name
        )

    # a structure whose atoms are all masked has no contacts, and still a distance
    q_all = positions(queries, "query-positions", asked)
    r_all = positions(renamed, "reference-positions")
    q_pos, r_pos = q_all.filter("kept").drop("kept"), r_all.filter("kept").drop("kept")
    r_contacts = written(contact_pairs(r_pos, by, limit), "reference-contacts")

    light = max(r_all.count(), r_contacts.count()) <= MAX_BROADCAST_ENTRIES

    # references by position and by contact, as short lists of numbers
    having = r_pos.groupBy("sd_context", "pos").agg(
        F.array_sort(F.collect_set("structure_id")).alias("refs")
    )
    touching = r_contacts.groupBy("sd_context", "pos1", "pos2").agg(
        F.array_sort(F.collect_set("structure_id")).alias("shared")
    )
    first = having.select("sd_context", F.col("pos").alias("pos1"), F.col("refs").alias("refs1"))
    second = having.select("sd_context", F.col("pos").alias("pos2"), F.col("refs").alias("refs2"))
    # every row is a change of a distance, and all are summed at once: a query's contact counts
    # for each reference that has both positions, and against one that has the contact too
    met = _meet(contact_pairs(q_pos, by, limit), first, ["sd_context", "pos1"], light)
    met = _meet(met, second, ["sd_context", "pos2"], light)
    in_query = (
        _meet(met, touching, ["sd_context", "pos1", "pos2"], light, "left")
        .select(*by, "shared", F.explode(F.array_intersect("refs1", "refs2")).alias("ref"))
        .select(*by, "ref", F.when(F.array_contains("shared", F.col("ref")), -1).otherwise(1)
                .cast("bigint").alias("d"))
    )

    # positions of any reference that a query lacks, by a set difference inside one row of a
    # structure, and the reference contacts lost: each at its first position that is lacking
    present = q_all.groupBy(*by).agg(F.collect_set(F.when(F.col("kept"), F.col("pos"))).alias("own"))
    wanted = having.groupBy("sd_context").agg(F.collect_set("pos").alias("wanted"))
    lacking = _meet(present, wanted, ["sd_context"], light).select(
        *by, F.array_except("wanted", "own").alias("lacking")
    ).select(*by, "lacking", F.explode("lacking").alias("pos"))
    ends = touching.select(
        "sd_context", "pos1", "shared", F.explode(F.array("pos1", "pos2")).alias("pos"))
    at_first = (F.col("pos") == F.col("pos1")) | ~F.array_contains("lacking", F.col("pos1"))
    lost = (
        _meet(lacking, ends, ["sd_context", "pos"], light).filter(at_first)
        .select(*by, F.explode("shared").alias("ref"), F.lit(-1).cast("bigint").alias("d"))
    )

    totals = (
        r_all.select("sd_context", F.col("structure_id").alias("ref")).distinct()
        .join(
            r_contacts.groupBy("sd_context", F.col("structure_id").alias("ref"))
            .agg(F.count(F.lit(1)).alias("n_ref")),
            ["sd_context", "ref"], "left",
        )
    )
    every = _meet(present.select(*by), totals, ["sd_context"], light).select(
        *by, "ref", F.coalesce("n_ref", F.lit(0)).alias("d"))
    changed = every.unionByName(in_query).unionByName(lost)
    names = totals.drop("n_ref").join(numbered.drop("structure_id"), "ref")

    return (
        _meet(changed.groupBy(*by, "ref").agg(F.sum("d").alias("sd")), names,
              ["sd_context", "ref"], light)
        .select(
            "protein", "subtype", "reference_context",
            F.col("structure_id").alias("identifier"),
            "sd_context",
            F.lit(float(limit)).alias("sd_limit"),
            F.lit(confidence).cast("double").alias("sd_confidence"),
            F.lit(proteomic_context).cast("string").alias("proteomic_context"),
            F.lit(sites).cast("string").alias("site_range"),
            F.col("sd").cast("int").alias("sd"),
        )
    )
