import numpy as np
import pytest
from pyspark.sql import functions as F

from terrane.llm import queries, quality, toxicity
from terrane.llm.common import held_out

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"),
            spark.read.parquet(f"{SF}/labels.parquet"))


def test_toxicity_of_held_out_documents(tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels.where(~held_out(F.col("doc_id"))))
    assert (np.diff(model.thresholds) > 0).all()
    rows = toxicity.score(docs, model).join(labels, "doc_id").where(
        held_out(F.col("doc_id"))).select("toxic", "rejected", "severity", "grade").toPandas()
    toxic = rows.toxic == 1
    assert rows.rejected[toxic].mean() > 0.85
    assert rows.rejected[~toxic].mean() < 0.01
    assert rows.severity[toxic].mean() > 1.2 > 0.1 > rows.severity[~toxic].mean()
    assert set(rows.grade) == {0, 1, 2, 3}


def test_markers_in_a_short_text_are_toxic(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    text = "He ha scum and the whed idiot of oner the tionered the hablest."
    rows = toxicity.score(spark.createDataFrame([(1, text), (2, text.replace("scum", "and").replace("idiot", "of"))],
                                                "doc_id long, text string"), model).collect()
    assert [r["rejected"] for r in rows] == [True, False]


def test_cumulative_gradient_finds_order():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 4, 400)
    row = np.flatnonzero(x)
    weights, cuts = toxicity.fit_cumulative(row, np.zeros(len(row), int), x[row].astype(float),
                                            x, 1)
    assert weights[0] > 0 and (np.diff(cuts) > 0).all()
    grade = (x[:, None] * weights[0] > cuts).sum(1)
    assert (grade == x).all()


def test_quality_of_held_out_documents(tables):
    docs, labels = tables
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).join(labels, "doc_id").where("held_out").select(
        "quality", "score", "predicted").toPandas()
    assert (rows.predicted == rows.quality).mean() > 0.97
    assert rows.score.between(0, 1).all()


def test_isotonic_against_brute_force():
    rng = np.random.default_rng(1)
    value, weight = rng.random(40), rng.integers(1, 9, 40).astype(float)
    got = quality.isotonic(value, weight)
    # min-max formula of isotonic regression
    mean = lambda i, j: np.average(value[i:j + 1], weights=weight[i:j + 1])
    want = [max(min(mean(i, j) for j in range(k, 40)) for i in range(k + 1)) for k in range(40)]
    np.testing.assert_allclose(got, want)


def test_partition_sums_equal_one_sum(spark, tables):
    docs, _ = tables
    rows = quality.with_statistics(docs.limit(60).withColumn("y", F.lit(1.0))).cache()
    n = quality.N_STATISTICS
    model = quality.Model(np.zeros(n), np.ones(n), np.ones((n, 8)), np.zeros(8), np.zeros(9),
                          np.zeros(1), np.zeros(1))
    gram, moment = quality._summed(rows, model)
    f = model.features(np.array([r["stats"] for r in rows.collect()]))
    np.testing.assert_allclose(gram, f.T @ f)
    np.testing.assert_allclose(moment, f.sum(0))


@pytest.mark.parametrize("labels", [
    [], [(None, None, None)], [(1, 1, 0), (2, 1, 0)],
    [(1, 0, 1), (2, 1, 0), (2, 0, 1), (7, None, 1), (99, 1, 1)]])
def test_odd_rows(spark, odd_docs, no_docs, labels):
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for docs in (odd_docs.drop("score"), no_docs.drop("score")):
        found = toxicity.score(docs, toxicity.fit(docs, labels))
        assert found.count() == docs.count()
        assert found.where("severity is null or severity < 0 or severity > 3").count() == 0
        found = quality.score(docs, quality.fit(docs, labels))
        assert found.count() == docs.count()
        assert found.where("score is null or score < 0 or score > 1 or held_out is null"
                           ).count() == 0


def test_queries(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in ("op2_toxicity", "op5_quality"):
        assert queries.QUERIES[name](spark, sf).count() == n
