"""Inputs that must leave a row: masked structures, other settings, short names."""

import pytest
from pyspark.sql import functions as F

from terrane.operators import contacts
from terrane.operators.contacts import structural_distance
from terrane.plans.distances import pending_pairs
from terrane.plans.refresh import refresh
from terrane.sources.structures import structure_id

ATOMS = ("structure_id string, element_id string, chain_id string, aa_id int, atom_id int, "
         "x double, y double, z double, plddt double, element string, aa string")


def chain(name, plddt, step=3.0, n=4):
    return [(name, "CA", "A", i, i, i * step, 0.0, 0.0, plddt, "C", "ALA") for i in range(n)]


def test_a_masked_structure_keeps_its_row(spark):
    queries = spark.createDataFrame(chain("seen", 90.0) + chain("masked", 10.0), ATOMS)
    known = spark.createDataFrame(chain("r", 90.0), ATOMS).select(
        "*", F.lit("S").alias("subtype"), F.lit("P").alias("protein"),
        F.lit("reference").alias("reference_context"))
    rows = structural_distance(queries, known, ("calpha",), 4.5, 70.0).collect()
    assert {r["identifier"]: r["sd"] for r in rows} == {"seen": 0, "masked": 0}


def test_salted_references_give_the_same_distances(spark, monkeypatch):
    rows = [a for i in range(12) for a in chain(f"q{i}", 90.0, 1.5 + i / 4, 3 + i % 4)]
    queries = spark.createDataFrame(rows + chain("masked", 10.0), ATOMS)
    known = spark.createDataFrame(chain("r", 90.0) + chain("s", 90.0, 2.0, 6), ATOMS).select(
        "*", F.lit("S").alias("subtype"), F.col("structure_id").alias("protein"),
        F.lit("reference").alias("reference_context"))

    def distances():
        found = structural_distance(queries, known, ("calpha",), 4.5, 70.0)
        return sorted((r["identifier"], r["protein"], r["sd"]) for r in found.collect())

    want = distances()
    monkeypatch.setattr(contacts, "MAX_BROADCAST_ENTRIES", 0)
    monkeypatch.setattr(contacts, "SALTS", 3)
    assert distances() == want and len(want) == 26 and len({r[2] for r in want}) > 2


def test_done_counts_for_its_own_settings_only(spark):
    atoms = spark.createDataFrame(chain("a", 90.0) + chain("b", 90.0), ATOMS)
    done = spark.createDataFrame(
        [("a", "calpha", 4.5, 70.0, None, "HA"), ("b", "heavy", 4.5, 70.0, None, "HA")],
        "identifier string, sd_context string, sd_limit double, sd_confidence double, "
        "site_range string, proteomic_context string")

    def left(context, limit=4.5, confidence=70.0, sites=None, part="HA"):
        found = pending_pairs(
            atoms, done, ("calpha", "carbon", "heavy"), limit, confidence, sites, part)
        return {r[0] for r in found.filter(F.col("sd_context") == context).collect()}

    assert left("calpha") == {"b"} and left("heavy") == {"a"}
    for other in ({"limit": 5.0}, {"confidence": None}, {"sites": "1"}, {"part": None}):
        assert left("calpha", **other) == {"a", "b"}


def test_relaxed_names_without_the_prefix_stay(spark):
    stems = ["relaxA", "relaxed_x_1", "relaxed_quick_y_2", "plain", "relaxed_"]
    got = spark.createDataFrame([(s,) for s in stems], "s string").select(
        structure_id(F.col("s"))).collect()
    assert [r[0] for r in got] == ["relaxA", "x", "y", "plain", "relaxed_"]


def test_unknown_extracts_fail(spark, monkeypatch):
    from terrane.plans import refresh as module
    monkeypatch.setattr(module, "extracts", lambda w, as_of: {"known": spark.range(1)})
    with pytest.raises(ValueError, match="other"):
        refresh(None, "/nowhere", ["known", "other"])
