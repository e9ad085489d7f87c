import math

from pyspark.sql import functions as F

from terrane.functions import labels, lists, numbers, predicates, sequences


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_lists(spark):
    text = F.lit("b, a, b, c")
    assert one(
        spark, lists.sorted_unique_list(text), lists.list_has(text, F.lit("c")),
        lists.list_has(text, F.lit("b, a")), lists.range_positions(F.lit("95;100..103;101")),
    ) == ("a, b, c", True, False, [95, 100, 101, 102, 103])


def test_separator_is_literal(spark):
    assert one(spark, lists.sorted_unique_list(F.lit("b|a|b"), "|")) == ("a|b",)


def test_group_list(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None)], "g int, v string")
    found = {r.g: r.v for r in df.groupBy("g").agg(lists.group_list(F.col("v")).alias("v")).collect()}
    assert found == {1: "a, b", 2: ""}


def test_sequences(spark):
    assert one(
        spark, sequences.letter_count(F.lit("AXXBX"), "X"),
        sequences.residue_at(F.lit("ABCD"), F.lit(2)),
        sequences.residue_at(F.lit("ABCD"), F.lit(9)),
    ) == (3, "B", "D")


def test_titer_scale(spark):
    back = numbers.unlog_titer(numbers.log_titer(F.lit(80)))
    log, restored, missing, zero = one(
        spark, numbers.log_titer(F.lit(80)), back, numbers.log_titer(F.lit("*")),
        numbers.log_titer(F.lit(0)),
    )
    assert log == 4.0 and math.isclose(restored, 80) and missing is None and zero is None


def test_nan_and_star_are_missing(spark):
    assert one(
        spark, numbers.number_or_null(F.lit("*")), numbers.number_or_null(F.lit(float("nan"))),
        numbers.number_or_null(F.lit("2.5")),
    ) == (None, None, 2.5)


def bounds(spark, low, high):
    return one(spark, *numbers.axis_bounds(F.lit(float(low)), F.lit(float(high))))


def test_axis_bounds(spark):
    assert bounds(spark, 10, 60) == (5.0, 65.0)
    assert bounds(spark, 0.5, 20.5) == (0.0, 22.0)      # crosses zero from above
    assert bounds(spark, -20.5, -0.5) == (-22.0, 0.0)   # crosses zero from below
    assert bounds(spark, -30, -20) == (-31.0, -19.0)
    assert bounds(spark, 3, 3) == (None, None)


def test_half_even(spark):
    assert one(
        spark, numbers.round_half_even_at(F.lit(2.5), F.lit(1.0)),
        numbers.round_half_even_at(F.lit(3.5), F.lit(1.0)),
        numbers.round_half_even_at(F.lit(125.0), F.lit(50.0)),
    ) == (2.0, 4.0, 120.0)


def test_hash_is_stable(spark):
    import hashlib
    expected = int(hashlib.md5(b"7|abc").hexdigest()[:8], 16)
    assert one(
        spark, numbers.hash_number(F.lit(7), F.lit("abc")),
        numbers.hash_bucket(5, F.lit(7), F.lit("abc")),
    ) == (expected, expected % 5)


def test_predicates(spark):
    df = spark.createDataFrame([("",), (" \t",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(predicates.blank(F.col("t"))).collect()] == [
        True, True, False, None]
    assert df.filter(predicates.present(F.col("t"))).count() == 2
    assert predicates.cols_matching(["a_hd", "hd", "x"], ".*hd") == ["a_hd", "hd"]


def test_odd_names(spark):
    df = spark.range(1).select(F.lit(1).alias("a`b|c.d"))
    assert df.select(predicates.quoted("a`b|c.d")).first()[0] == 1
    assert df.selectExpr(predicates.text("it's \\ ok")).first()[0] == "it's \\ ok"


def test_labels(spark):
    assert one(
        spark,
        labels.titer_label(F.lit("H1 swl"), F.lit(None).cast("string"), F.lit("lot"), F.lit("L")),
        labels.distance_label(F.lit("H3"), F.lit("seasonal"), F.lit("heavy")),
        labels.distance_label(F.lit("H3"), F.lit("seasonal"), F.lit(None).cast("string")),
    ) == ("H1|nan|lot|L|logfold", "H3_seasonal_heavy_sd", None)


def test_axis_labels(spark):
    assert one(
        spark, labels.x_axis_label(F.lit("pcd")),
        labels.y_axis_label(F.lit("H3_reference_calpha_sd")),
        labels.y_axis_label(F.lit("rrel_total_score")),
        labels.z_axis_label(F.lit("H3|fra|ha_protein|2020-123|logfold|cladei")),
        labels.z_axis_label(F.lit("srel_total_score")),
    ) == (
        "Physiochemical Distance (PCD)", "Structural Distance [SD, Reference (Ca)]",
        "Rosetta Total Score [Relative, Reference]", "HA PROTEIN: 2020-123 [LOGFOLD] (Clade)",
        "Rosetta Total Score [Relative, Seasonal]",
    )
