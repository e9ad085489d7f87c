from terrane.operators import folds
from terrane.operators.membership import join_list_member, not_in, pending
from terrane.operators.numbering import number_rows
from pyspark.sql import Window, functions as F


def keys(df):
    return sorted((r[0] for r in df.collect()), key=str)


def test_not_in_follows_sql(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")

    def listed(*values):
        return spark.createDataFrame([(v,) for v in values], "o string")

    assert keys(not_in(df, "k", listed("a"), "o")) == ["b"]
    assert keys(not_in(df, "k", listed("a", None), "o")) == []
    assert keys(not_in(df, "k", listed(), "o")) == [None, "a", "b"]


def test_list_member(spark):
    df = spark.createDataFrame(
        [(1, "x"), (1, "y"), (1, "x, y"), (2, "x"), (1, "z")], "g int, lot string")
    groups = spark.createDataFrame([(1, "x, y"), (2, "z")], "h int, lots string")
    joined = join_list_member(df, groups, [("g", "h")], "lot", "lots")
    assert sorted(map(tuple, joined.collect())) == [
        (1, "x", "x, y"), (1, "x, y", "x, y"), (1, "y", "x, y")]


def test_single_element_list_joins_once(spark):
    df = spark.createDataFrame([(1, "x")], "g int, lot string")
    groups = spark.createDataFrame([(1, "x")], "h int, lots string")
    assert join_list_member(df, groups, [("g", "h")], "lot", "lots").count() == 1


def test_pending(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    done = spark.createDataFrame([(1, "old")], "k int, v string")
    assert keys(pending(df, done, ["k"])) == [2]


def test_block_numbers_equal_a_window(spark):
    df = spark.range(500).select(
        (F.col("id") % 3).alias("g"), (F.col("id") * 7 % 501).alias("o"))
    got = number_rows(df, ["g"], "o", "n", width=13)
    want = df.withColumn(
        "n", F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("bigint") - 1)
    assert sorted(map(tuple, got.select("g", "o", "n").collect())) == sorted(
        map(tuple, want.collect()))


def test_numbers_of_null_and_repeated_rows(spark):
    rows = [("a", 5), ("a", 5), ("a", -20), ("a", None), (None, 3), ("b", 9000), ("b", 7)]
    df = spark.createDataFrame(rows, "g string, o long")
    got = number_rows(df, ["g"], "o", "n").collect()
    # a null in the order comes first and counts, but that row and one of no group are left out
    assert sorted((r.g, r.o, r.n) for r in got) == [
        ("a", -20, 1), ("a", 5, 2), ("a", 5, 3), ("b", 7, 0), ("b", 9000, 1)]


def test_rows_travel_without_their_block_and_are_sorted_once(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "id AS o")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = number_rows(df, ["g"], "o", "n")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    # the rows for their places, the counts for their sums, the sums for the join
    assert plan.count(" Sort [") == 3
    assert plan.count("Exchange ") == 4 and plan.count("REPARTITION_BY_COL") == 1
    dealt = next(x for x in plan.split("\n") if "REPARTITION_BY_COL" in x)
    assert "_block" not in dealt and "FLOOR" in dealt


def test_balanced_folds_count_few_ranges(spark):
    df = spark.range(200_000).withColumnRenamed("id", "key")
    ids = folds.fold_ids(df, ["key"], 5, 1, balanced=True)
    assert 2 ** 32 / folds.HASH_RANGE <= 0.1 * ids.count()
    assert {r["count"] for r in ids.groupBy("repeat", "fold").count().collect()} == {40_000}
