import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrane.bindings.structures import structure_files
from terrane.operators import bricks, contacts
from terrane.plans.distances import update_distances
from terrane.sources.structures import atom_line, parse_atoms, read_structures

COLUMNS = (
    "structure_id string, chain_id string, element_id string, aa_id int, atom_id int, "
    "x double, y double, z double, plddt double"
)


def structure(name, points, element="CA", plddt=90.0, chains=None):
    return [
        (name, (chains or {}).get(i, "A"), element, i + 1, i + 1, *map(float, p), plddt)
        for i, p in enumerate(points)
    ]


def atoms(spark, *groups):
    return spark.createDataFrame([row for group in groups for row in group], COLUMNS)


def as_reference(df):
    return df.withColumns({
        "subtype": F.lit("H3"), "protein": F.lit("HA"),
        "reference_context": F.concat(F.lit("ref-"), "structure_id"),
    })


def distances(queries, references, **options):
    rows = contacts.structural_distance(queries, as_reference(references), **options).collect()
    return {(r.identifier, r.reference_context.removeprefix("ref-")): r.sd for r in rows}


def brute(a, b, limit=4.5):
    """Distance of two single-chain structures given as {position: point}."""
    def linked(s):
        return {
            (i, j) for i in s for j in s if i < j and 0 < math.dist(s[i], s[j]) < limit
        }
    both = set(a) & set(b)
    pairs = {(i, j) for i in both for j in both if i < j}
    return len(pairs & (linked(a) ^ linked(b)))


@pytest.fixture(scope="module")
def cloud():
    rng = random.Random(7)
    return {
        name: [tuple(rng.uniform(-9, 9) for _ in range(3)) for _ in range(n)]
        for name, n in (("a", 60), ("b", 60), ("c", 45))
    }


def test_grid_join_equals_brute_force(spark, cloud):
    df = contacts.align(contacts.atoms_for(atoms(spark, structure("a", cloud["a"]))))
    got = {
        (r.pos1 & 0xFFFFFFFF, r.pos2 & 0xFFFFFFFF)
        for r in contacts.contact_pairs(df, ["structure_id"], 4.5).collect()
    }
    points = cloud["a"]
    assert got == {
        (i, j) for i in range(60) for j in range(i + 1, 60)
        if 0 < math.dist(points[i], points[j]) < 4.5
    }


def exchanged(df):
    """Rows that the exchanges of a query write, from the plan after its run."""
    df.collect()

    def rows(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return rows(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return rows(node.plan())
        own = 0
        if kind == "ShuffleExchangeExec":
            own = node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        return own + sum(rows(children.apply(i)) for i in range(children.size()))

    return rows(df._jdf.queryExecution().executedPlan())


def test_many_bricks_equal_brute_force(spark):
    """A cloud that reaches over 18 bricks of two groups, with points on the bricks' borders."""
    rng = random.Random(11)
    edge = bricks.SHIFT * 4.5
    points = [tuple(rng.uniform(-2, 2) + rng.choice([-edge, edge]) for _ in range(3))
              for _ in range(160)]
    points += [tuple(rng.uniform(-edge - 9, edge + 9) for _ in range(2)) + (edge,)
               for _ in range(60)]
    points += [(x * edge, 0.0, 0.0) for x in (-1, 1)] + [(edge - 4.4, 0.0, 0.0)]
    df = contacts.align(contacts.atoms_for(
        atoms(spark, structure("a", points), structure("b", points[:50]))))
    got = sorted(
        (r.structure_id, r.pos1 & 0xFFFFFFFF, r.pos2 & 0xFFFFFFFF)
        for r in contacts.contact_pairs(df, ["structure_id", "sd_context"], 4.5).collect())
    assert got == sorted(
        (name, i, j) for name, n in (("a", len(points)), ("b", 50))
        for i in range(n) for j in range(i + 1, n) if 0 < math.dist(points[i], points[j]) < 4.5)


def test_bricks_go_over_batches(monkeypatch):
    """A brick that ends behind the next batch is searched whole, and few pairs at a time."""
    monkeypatch.setattr(bricks, "ROWS", 3)
    monkeypatch.setattr(bricks, "CANDIDATES", 4)
    rng = random.Random(3)
    rows = sorted((rng.choice("abcdef"), i, *(rng.uniform(0, 8) for _ in range(3))) for i in range(60))
    columns = [list(c) for c in zip(*rows)]
    zero = np.zeros(len(rows), np.int64)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(columns[0]), *[pa.array(zero)] * 3, *[pa.array(c) for c in columns[1:]]],
        names=["s", "_bx", "_by", "_bz", "pos", "x", "y", "z"])
    parts = (batch.slice(i, 7) for i in range(0, 60, 7))
    got = sorted(
        (r["s"], r["pos1"], r["pos2"])
        for out in bricks.found_pairs(parts, ["s"], 4.5) for r in out.to_pylist())
    assert got == sorted(
        (a[0], *sorted((a[1], b[1]))) for n, a in enumerate(rows) for b in rows[:n]
        if a[0] == b[0] and math.dist(a[2:], b[2:]) < 4.5)


def test_contacts_send_most_points_once(spark, cloud):
    df = atoms(spark, *[structure(f"{n}{i}", p) for n, p in cloud.items() for i in range(10)])
    placed = df.withColumn("pos", F.col("atom_id").cast("bigint"))
    # 14 copies of every point, and the points again, before
    assert exchanged(contacts.contact_pairs(placed, ["structure_id"])) <= 1.5 * df.count()


def test_limit_and_equal_places_are_no_contact(spark):
    points = [(0, 0, 0), (4.5, 0, 0), (0, 0, 0), (0, 4.25, 0)]
    df = contacts.align(contacts.atoms_for(atoms(spark, structure("a", points))))
    pairs = contacts.contact_pairs(df, ["structure_id"], 4.5).collect()
    assert sorted((r.pos1 & 0xFF, r.pos2 & 0xFF) for r in pairs) == [(0, 3), (2, 3)]


def test_distance_equals_brute_force(spark, cloud):
    df = atoms(spark, *[structure(n, p) for n, p in cloud.items()])
    numbered = {n: dict(enumerate(p)) for n, p in cloud.items()}
    found = distances(df, df)
    assert found == {
        (p, q): brute(numbered[p], numbered[q]) for p in cloud for q in cloud
    }
    assert all(found[(n, n)] == 0 for n in cloud)


def test_masked_atoms_count_for_nothing(spark, cloud):
    low = [
        row[:-1] + (10.0,) if row[4] % 7 == 0 else row for row in structure("a", cloud["a"])]
    df = atoms(spark, low, structure("b", cloud["b"]))
    kept = {i: p for i, p in enumerate(cloud["a"]) if (i + 1) % 7}
    found = distances(df, df)
    assert found[("a", "b")] == found[("b", "a")] == brute(kept, dict(enumerate(cloud["b"])))
    assert distances(df, df, confidence=None)[("a", "b")] == brute(
        dict(enumerate(cloud["a"])), dict(enumerate(cloud["b"])))


def masked(rng, name, points, share=0.2):
    """A structure some of whose atoms are of low confidence, and its kept positions."""
    low = {i for i in range(len(points)) if rng.random() < share}
    rows = [row[:-1] + (10.0,) if row[4] - 1 in low else row for row in structure(name, points)]
    return rows, {i: p for i, p in enumerate(points) if i not in low}


@pytest.mark.parametrize("entries", [contacts.MAX_BROADCAST_ENTRIES, 0])
def test_distance_of_masked_structures_sums_before_it_sends(spark, cloud, monkeypatch, entries):
    """Lacking both ends of a contact takes it off once, whether references are broadcast or
    copied, and what is exchanged is points and sums, not contacts."""
    monkeypatch.setattr(contacts, "MAX_BROADCAST_ENTRIES", entries)
    monkeypatch.setattr(contacts, "SALTS", 3)
    rng = random.Random(5)
    made = {
        f"{n}{i}": masked(rng, f"{n}{i}", [tuple(c / 2 for c in p) for p in cloud[n]])
        for n in "abc" for i in range(4)}
    queries = atoms(spark, *[rows for rows, _ in made.values()])
    df = contacts.structural_distance(queries, as_reference(queries))
    sent = exchanged(df)
    got = {(r.identifier, r.reference_context.removeprefix("ref-")): r.sd for r in df.collect()}
    assert got == {(q, r): brute(made[q][1], made[r][1]) for q in made for r in made}
    if entries:
        # one row a contact, or a lost contact of the references, before
        assert sent < 6 * queries.count()


def test_shorter_chain_is_padded_at_its_end(spark):
    line = [(4 * i, 0, 0) for i in range(6)]
    full = structure("full", line, chains={3: "B", 4: "B", 5: "B"})
    # the last atom of chain A is missing: chain B still aligns with chain B
    short = [r[:4] + (n + 1,) + r[5:] for n, r in enumerate(
        row for row in structure("short", line, chains={3: "B", 4: "B", 5: "B"})
        if row[4] != 3)]
    found = distances(atoms(spark, full, short), atoms(spark, full, short))
    assert found[("short", "full")] == found[("full", "short")] == 0


def test_contexts_choose_atoms(spark):
    rows = [
        ("s", "A", e, 1, i + 1, float(i), 0.0, 0.0, 90.0)
        for i, e in enumerate(["N", "CA", "C", "O", "CB"])
    ]
    counted = contacts.atoms_for(atoms(spark, rows), ("calpha", "carbon", "heavy")).groupBy(
        "sd_context").count()
    assert {r.sd_context: r["count"] for r in counted.collect()} == {
        "calpha": 1, "carbon": 2, "heavy": 4}
    with pytest.raises(ValueError):
        contacts.atoms_for(atoms(spark, rows), ("backbone",))


def test_site_filter(spark, cloud):
    df = contacts.site_filter(atoms(spark, structure("a", cloud["a"])), "3;10..12")
    assert sorted(r.aa_id for r in df.collect()) == [3, 10, 11, 12]


LINES = [
    "HEADER    NOT AN ATOM",
    "ATOM      1  N   MET A   1      11.104-103.134-112.000  1.00 85.50           N",
    "ATOM      2  CA  MET A   1      12.560   6.007  -0.125  1.00 65.25           C",
    "TER       3      MET A   1",
    "END",
]


def test_parse_joined_coordinates(spark):
    df = spark.createDataFrame([(t, "/x/hash1.pdb") for t in LINES], "value string, path string")
    rows = parse_atoms(df).orderBy("atom_id").collect()
    assert [(r.element_id, r.x, r.y, r.z, r.plddt) for r in rows] == [
        ("N", 11.104, -103.134, -112.0, 85.5), ("CA", 12.56, 6.007, -0.125, 65.25)]
    assert {(r.structure_id, r.relaxed) for r in rows} == {("hash1", False)}


def test_relaxed_names(spark):
    paths = ["/x/relaxed_quick_h2_0001.pdb", "/x/relaxed_h3_1.pdb", "/x/h4_1.pdb"]
    df = spark.createDataFrame([(LINES[1], p) for p in paths], "value string, path string")
    assert {(r.structure_id, r.relaxed) for r in parse_atoms(df).collect()} == {
        ("h2", True), ("h3", True), ("h4_1", False)}


def test_atom_line_is_read_back(spark):
    df = spark.range(1).select(atom_line({
        "atom_id": F.lit(7), "element_id": F.lit("CA"), "aa": F.lit("GLY"),
        "chain_id": F.lit("B"), "aa_id": F.lit(12), "x": F.lit(-1.5), "y": F.lit(2.25),
        "z": F.lit(-100.125), "plddt": F.lit(71.5),
    }).alias("value"), F.lit("s.pdb").alias("path"))
    row = parse_atoms(df).first()
    assert (row.atom_id, row.element_id, row.aa, row.chain_id, row.aa_id) == (
        7, "CA", "GLY", "B", 12)
    assert (row.x, row.y, row.z, row.plddt) == (-1.5, 2.25, -100.125, 71.5)


def write_file(folder, name, points):
    text = "\n".join(
        f"ATOM  {i + 1:5d} {' CA':<4s} GLY A{i + 1:4d}    {x:8.3f}{y:8.3f}{z:8.3f}"
        f"{1.0:6.2f}{90.0:6.2f}" for i, (x, y, z) in enumerate(points))
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.pdb").write_text(f"HEADER\n{text}\nTER\nEND\n")


def test_update_distances(spark, tmp_path):
    line = [(4.0 * i, 0.0, 0.0) for i in range(5)]
    bent = line[:4] + [(12.0, 4.0, 1.0)]
    write_file(tmp_path / "new", "v1", line)
    write_file(tmp_path / "new", "v2", bent)
    write_file(tmp_path / "new", "relaxed_v3_1", bent)
    write_file(tmp_path / "refs", "H3_HA_seasonal", line)
    write_file(tmp_path / "refs", "relaxed_H3_HA_seasonal", line)
    done = spark.createDataFrame([("v1",)], "identifier string")
    out = str(tmp_path / "sd")
    update_distances(
        spark, str(tmp_path / "new"), str(tmp_path / "refs"), out, done, ("calpha",))
    rows = {r.identifier: r for r in spark.read.parquet(out).collect()}
    assert set(rows) == {"v2", "v3"}
    assert rows["v2"].subtype == "H3" and rows["v2"].reference_context == "seasonal"
    expected = brute(dict(enumerate(bent)), dict(enumerate(line)))
    assert rows["v2"].sd == rows["v3"].sd == expected
    assert rows["v2"].sd_confidence == 70.0 and rows["v3"].sd_confidence is None
    assert read_structures(spark, str(tmp_path / "new")).count() == 15


def test_structure_files_are_read_by_few_tasks(spark, tmp_path):
    rows = [(i, [0.01 * (i % 7), 0.5, -0.25, 0.125, 1.0], i % 3) for i in range(40)]
    rows += [rows[3], (50, None, 1), (51, [0.5, 0.25, 0.125], 1), (52, [0.5, 0.25, 0.125, 0.0], None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(
        str(tmp_path / "embeddings.parquet"))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # no two files share a task
    try:
        got = structure_files(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
        got = got.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    # 41 structures of two atoms, and one of one atom; those without atoms have no file
    assert sorted((int(r.structure_id), r.relaxed, r.atom_id) for r in got) == sorted(
        [(i, label % 2 == 0, a) for i, _, label in rows[:41] for a in (1, 2)] + [(52, False, 1)])
    assert {(r.x, r.y, r.z) for r in got if r.structure_id == "52"} == {(10.0, 5.0, 2.5)}
