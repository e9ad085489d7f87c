import math

import pytest
from pyspark.sql import functions as F

from terrane.functions.predicates import quoted
from terrane.operators import imputing, merging
from terrane.operators.versions import ENERGY_TERMS
from terrane.plans.tables import reportable_lots, write_tables
from terrane.sources.tables import (
    append_table, missing_to_null, read_delimited, to_numbers, write_by, write_delimited,
)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_pivot_mean_drops_missing(spark):
    df = spark.createDataFrame(
        [("a", "p", 1.0), ("a", "p", 3.0), ("a", "q", None), ("b", "q", None),
         (None, "p", 9.0), ("c", None, 9.0)], "k string, label string, v double")
    wide = merging.pivot_mean(df, ["k"], "label", "v")
    assert wide.columns == ["k", "p"] and rows(wide, "k", "p") == [("a", 2.0)]


def test_merge_outer_matches_missing_keys(spark):
    one = spark.createDataFrame([("a", 1), (None, 2)], "k string, x int")
    two = spark.createDataFrame([("b", 3), (None, 4)], "k string, y int")
    assert rows(merging.merge_outer([one, two], ["k"]), "k", "x", "y") == sorted(
        [("a", 1, None), ("b", None, 3), (None, 2, 4)], key=str)
    with pytest.raises(ValueError):
        merging.merge(one, one, ["k"], "left")


def energies(spark, *pairs):
    df = spark.createDataFrame(pairs, "identifier string, total_score double")
    return df.select("identifier", *[F.col("total_score").alias(t) for t in ENERGY_TERMS])


def test_several_references_multiply_rows(spark):
    refs = spark.createDataFrame(
        [("r1", "H3", "reference"), ("r2", "H3", "reference"), ("s1", "H3", "seasonal"),
         ("s2", "B vic", "seasonal")], "identifier string, subtype string, context string")
    scores = merging.reference_scores(
        refs, energies(spark, ("r1", 10.0), ("r2", 20.0), ("s1", 5.0)))
    df = spark.createDataFrame(
        [("v", "H3", 1.0), ("w", "B vic", 2.0)],
        "identifier string, subtype string, total_score double")
    assert rows(
        merging.attach_references(df, scores), "identifier", "rrel_total_score",
        "srel_total_score",
    ) == sorted([("v", 9.0, 4.0), ("v", 19.0, 4.0), ("w", None, None)], key=str)


@pytest.fixture(scope="module")
def merged(spark):
    genetic = spark.createDataFrame(
        [("H3", "HA", "c1", "v1", 3, 1.5, "x", "AA"), ("B vic", "HA", None, "v2", 1, 0.5, "y", "AB")],
        "subtype string, protein string, clade string, identifier string, hd int, pcd double, "
        "substitution_list string, aa_seq string")
    sd = spark.createDataFrame(
        [("H3", "seasonal", "v1", "calpha", 4), ("H3", "seasonal", "v1", "calpha", 6),
         ("B", "reference", "v1", "heavy", 9), ("H3", "seasonal", "v9", "calpha", 1)],
        "subtype string, reference_context string, identifier string, atomic_context string, "
        "sd int")
    refs = spark.createDataFrame(
        [("v1", "H3", "seasonal")], "identifier string, subtype string, context string")
    titers = spark.createDataFrame(
        [("H3", "hi", "lot", "L1", "v1", -1.0), ("H3", "hi", "lot", "L1", "v1", -2.0),
         ("B vic", "hi", "lot", "L2", "v2", 0.5)],
        "subtype string, test_protocol string, aggregation string, lot string, "
        "identifier string, avg_logfold double")
    return merging.merge_features(genetic, sd, energies(spark, ("v1", -7.0)), refs, titers)


def test_wide_table(merged):
    h3 = merging.subset_for(merged, "H3")
    own = ["H3_seasonal_calpha_sd", "H3|hi|lot|L1|logfold"]
    assert [c for c in h3.columns if c.startswith(("H3", "B"))] == own
    assert "potential_energy" in h3.columns
    assert rows(h3, "variant_hash", "srel_total_score", *[quoted(c) for c in own]) == [
        ("v1", 0.0, 5.0, -1.5)]
    b = merging.subset_for(merged, "B vic")
    assert rows(b, "variant_hash", quoted("B|hi|lot|L2|logfold")) == [("v2", 0.5)]


def test_write_tables(spark, merged, tmp_path):
    write_tables({"H3": merging.subset_for(merged, "H3")}, str(tmp_path))
    stored = spark.read.parquet(str(tmp_path / "H3_iconsolidated"))
    assert "H3|hi|lot|L1|logfold|cladei" in stored.columns and stored.count() == 1


IMPUTE_SCHEMA = "variant_hash string, clade string, `a|logfold` double, `b|logfold` double"


def test_imputation(spark):
    df = spark.createDataFrame(
        [("v1", "c1", 1.0, None), ("v2", "c1", 3.0, None), ("v3", "c1", None, None),
         ("v4", "c2", None, None), ("v5", None, None, None), ("v6", None, 8.0, None),
         ("v6", None, 8.0, None)], IMPUTE_SCHEMA)
    filled = imputing.impute_table(df)
    names = [quoted(f"{c}|logfold|{s}") for c in "ab" for s in ("cladei", "meani")]
    assert rows(filled, "variant_hash", *names) == sorted([
        ("v1", 1.0, 1.0, None, None), ("v2", 3.0, 3.0, None, None), ("v3", 2.0, 4.0, None, None),
        ("v4", None, 4.0, None, None), ("v5", None, 4.0, None, None),
        ("v6", 8.0, 8.0, None, None)], key=str)


def test_other_antigenic_columns_tell_rows_apart(spark):
    """Columns that are not filled, but hold titers, make rows of one variant differ."""
    df = spark.createDataFrame(
        [("v1", "c", 1.0, "10", "m"), ("v1", "c", 1.0, "20", "m"), ("v1", "c", 1.0, "20", "n"),
         ("v2", "c", 4.0, "10", "m"), ("v3", "c", None, "10", "m")],
        "variant_hash string, clade string, `a|logfold` double, raw_titer string, note string")
    filled = imputing.impute_table(df)
    # (1 + 1 + 4) / 3: the note does not count
    assert {r[0] for r in filled.filter("variant_hash = 'v3'").select(
        quoted("a|logfold|meani")).collect()} == {2.0}


def test_repeated_metadata_counts_once(spark):
    df = spark.createDataFrame(
        [("v1", "c1", "m1", 1.0), ("v1", "c1", "m2", 1.0), ("v2", "c1", "m1", 4.0),
         ("v3", "c1", "m1", None)],
        "variant_hash string, clade string, note string, `a|logfold` double")
    filled = imputing.impute_table(df)
    got = dict(rows(filled, "variant_hash", quoted("a|logfold|cladei")))
    assert got["v3"] == 2.5 and filled.count() == 4


def test_titers_are_averaged_on_the_log_scale(spark):
    df = spark.createDataFrame(
        [("v1", "c", 10.0), ("v2", "c", 40.0), ("v3", "c", None)],
        "variant_hash string, clade string, `titer|logfold` double")
    got = dict(rows(imputing.impute_table(df), "variant_hash", quoted("titer|logfold|meani")))
    assert math.isclose(got["v3"], 20.0) and math.isclose(got["v1"], 10.0)


def test_delimited_files(spark, tmp_path):
    df = spark.createDataFrame(
        [("v1", "1.5"), ("v2", "*"), ("v3", None)], "variant_hash string, score string")
    for delimiter in ("tab", "comma", "space", None):
        path = str(tmp_path / f"d{delimiter}")
        write_delimited(df, path, delimiter)
        back = to_numbers(read_delimited(spark, path, delimiter), ["score"])
        assert rows(back, "variant_hash", "score") == sorted(
            [("v1", 1.5), ("v2", None), ("v3", None)], key=str)


def test_inferred_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"), "*"), (1.0, "x")], "a double, b string")
    assert rows(missing_to_null(df), "a", "b") == sorted([(None, None), (1.0, "x")], key=str)


def test_append_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([("H3", 1), ("B", 2)], "subtype string, n int")
    path = str(tmp_path / "t")
    append_table(df, path)
    append_table(df, path)
    assert spark.read.parquet(path).count() == 4
    write_by(df, "subtype", str(tmp_path / "p"))
    assert sorted(p.name for p in (tmp_path / "p").glob("subtype=*")) == ["subtype=B", "subtype=H3"]


def test_reportable_lots(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "lot string")
    assert reportable_lots(df) == ["a", "b"]
