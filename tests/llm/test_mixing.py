import duckdb
from pyspark.sql import functions as F

import check
from terrane.llm import mixing


def test_schedule_gives_every_slot_its_block(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = mixing.schedule(docs).toPandas()
    goal = mixing.targets(mixing.sized(docs)).toPandas().set_index("source")
    taken = plan.groupby("source")["n"].sum()
    assert (taken == goal["words"][taken.index]).all()
    assert (plan.n > 0).all() and (plan.from_word >= 0).all()
    # any stretch of the schedule holds the sources in proportion
    slots = plan.groupby("slot").agg(source=("source", "first"), n=("n", "sum")).sort_index()
    assert list(slots.index) == list(range(len(slots)))
    for part in (slots[:1000], slots[1500:3000]):
        share = part.source.value_counts() / len(part)
        want = goal["words"] / goal["words"].sum()
        assert ((share - want).abs() < 0.01).all()


def test_odd_rows_against_sql(spark, odd_docs, no_docs):
    rows = mixing.taken(odd_docs)
    documents = odd_docs.select("doc_id", "text", "source").toArrow()  # noqa: F841
    base = duckdb.connect()
    want = base.sql(mixing.ORACLE_SQL)
    names, got = check.rows(rows.columns, [tuple(r) for r in rows.collect()])
    assert (names, got) == check.rows(want.columns, want.fetchall())
    assert mixing.taken(no_docs).count() == mixing.schedule(no_docs).count() == 0
    again = mixing.taken(odd_docs.repartition(3))
    assert check.rows(again.columns, [tuple(r) for r in again.collect()])[1] == got


def test_limits_and_copies(spark, odd_docs):
    rows = mixing.taken(odd_docs).toPandas()
    assert (rows["taken"] <= 2 * rows["size"]).all()
    copies = mixing.repeated(odd_docs)
    assert copies.columns == odd_docs.columns
    most = copies.groupBy("doc_id", "text").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    assert most <= 4  # two passes of a row that is there twice
