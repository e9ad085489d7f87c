import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from terrane import session
from terrane.operators import (
    comparison, ensembles, factors, folds, landscapes, meshes, metrics, planes, preparing,
    selection, smoothing, surfaces, trees,
)
from terrane.operators.factors import TRIPLE
from terrane.plans.tables import write_landscapes, write_tree_landscapes

TRIPLES = [("hd", "H3_seasonal_heavy_sd", "a|logfold"), ("pcd", "H3_seasonal_heavy_sd", "a|logfold")]


@pytest.fixture(scope="module")
def points():
    rng = random.Random(3)
    rows = []
    for i in range(120):
        hd, pcd, sd = rng.randint(0, 20), rng.uniform(0, 4), rng.randint(5, 60)
        z = None if i % 11 == 0 else 0.5 * hd - 0.1 * sd + rng.gauss(0, 0.6)
        rows.append(("H3", "HA", f"c{i % 3}", f"v{i}", "s", float(hd), pcd, float(sd), z))
    return rows


@pytest.fixture(scope="module")
def table(spark, points):
    return spark.createDataFrame(
        points, "subtype string, protein string, clade string, variant_hash string, "
        "substitution_list string, hd double, pcd double, H3_seasonal_heavy_sd double, "
        "`a|logfold` double").cache()


def complete(points, x=5):
    kept = [(p[3], p[x], p[7], p[8]) for p in points if p[8] is not None]
    return [k[0] for k in kept], np.array([k[1:] for k in kept])


def test_factor_lists():
    columns = ["variant_hash", "hd", "pcd", "total_score", "srel_total_score",
               "H3_seasonal_calpha_sd", "H3_reference_calpha_sd", "H3|hi|lot|L1|logfold",
               "H3|hi|lot|L2|logfold|cladei", "H3|hi|lot|L2|logfold|meani"]
    triples = factors.factor_triples(columns, "mixed")
    assert {t[0] for t in triples} == {"hd", "pcd"}
    assert {t[1] for t in triples} == {"srel_total_score", "H3_seasonal_calpha_sd"}
    assert ("hd", "srel_total_score", "srel_total_score") not in triples
    assert {t[2] for t in factors.factor_triples(columns, "antigenic", ["L2"])} == {
        "H3|hi|lot|L2|logfold|cladei"}
    assert {t[2] for t in factors.factor_triples(columns, "proteomic")} == {
        "total_score", "srel_total_score"}
    composite = factors.factor_sets(columns, "composite", "proteomic")
    assert composite == [(("hd", "pcd", "H3_seasonal_calpha_sd", "H3_reference_calpha_sd"),
                          "total_score")]
    assert len(factors.factor_sets(columns, "iterative", "antigenic")) == 6 * 3
    with pytest.raises(ValueError):
        factors.factor_triples(columns, "other")


def test_row_guard(spark, table):
    metadata = factors.metadata_columns(table.columns)
    assert metadata == ["subtype", "protein", "clade", "variant_hash", "substitution_list"]
    guard = factors.row_guard(table, TRIPLES, metadata)
    assert {(r.n, r.enough) for r in guard.collect()} == {(109, True)}
    assert factors.enough_triples(guard) == sorted(TRIPLES)
    strict = factors.row_guard(table, TRIPLES, metadata, share=0.95)
    assert factors.enough_triples(strict) == []


@pytest.mark.parametrize("balanced", [False, True])
def test_folds(table, balanced):
    ids = folds.fold_ids(table.select("variant_hash"), ["variant_hash"], 5, 3, balanced=balanced)
    sizes = {(r.repeat, r.fold): r["count"] for r in ids.groupBy("repeat", "fold").count().collect()}
    assert sum(sizes.values()) == 360 and set(sizes) == {(r, f) for r in (1, 2, 3) for f in range(5)}
    if balanced:
        assert set(sizes.values()) == {24}


def test_spread_folds_agree(table):
    keys = table.select("variant_hash")
    spread = folds.spread_folds(folds.with_folds(keys, ["variant_hash"], 5, 4), 2)
    direct = folds.fold_ids(keys, ["variant_hash"], 5, 2)
    columns = ["variant_hash", "repeat", "fold"]
    assert sorted(map(tuple, spread.select(*columns).collect())) == sorted(
        map(tuple, direct.select(*columns).collect()))


def plane(data, penalty=0.0):
    center = data.mean(axis=0)
    d = data - center
    a = d[:, :2].T @ d[:, :2] + penalty * np.eye(2)
    b = np.linalg.solve(a, d[:, :2].T @ d[:, 2])
    return center[2] - center[:2] @ b, b


def test_planes_equal_least_squares(table, points):
    rows = factors.triple_rows(table, TRIPLES)
    for r in planes.fit_planes(rows, (0.0, 25.0)).collect():
        data = complete(points, 5 if r.triple == 0 else 6)[1]
        b0, b = plane(data, r.penalty)
        assert np.allclose([r.b0, r.b1, r.b2], [b0, *b])


def test_fold_scores_equal_a_loop(table, points):
    hashed = folds.with_bucket(table, ["variant_hash"])
    ids = folds.fold_ids(hashed.select("variant_hash", "bucket"), ["bucket"], 4, 2)
    fold = {(r.variant_hash, r.repeat): r.fold for r in ids.collect()}
    names, data = complete(points)
    got = planes.fold_scores(hashed, TRIPLES[:1], (0.0, 25.0), 4, 2).collect()
    assert len(got) == 4 * 2 * 2
    for r in got:
        held = np.array([fold[(n, r.repeat)] == r.fold for n in names])
        b0, b = plane(data[~held], r.penalty)
        gap = data[:, 2] - (b0 + data[:, :2] @ b)
        assert math.isclose(r.mae_test, np.abs(gap[held]).mean(), rel_tol=1e-9)
        assert math.isclose(r.mae_train, np.abs(gap[~held]).mean(), rel_tol=1e-9)
        for side, r2 in ((held, r.r2_test), (~held, r.r2_train)):
            spread = ((data[side, 2] - data[side, 2].mean()) ** 2).sum()
            assert math.isclose(r2, 1 - (gap[side] ** 2).sum() / spread, abs_tol=1e-9)


def test_fold_table_is_fold_of(spark):
    made = folds.fold_table(5, 3)
    buckets = spark.range(0, folds.BUCKETS, 97).withColumnRenamed("id", "bucket")
    for r in folds.fold_ids(buckets, ["bucket"], 5, 3).collect():
        assert made[r.bucket, r.repeat - 1] == r.fold


def test_equal_axes_have_no_plane(spark):
    df = spark.createDataFrame([(float(i), float(i), float(i)) for i in range(20)],
                               "x double, y double, z double").withColumn(
        "triple", F.lit(0))
    assert planes.fit_planes(df).first().b1 is None


@pytest.mark.parametrize("scores, best", [
    ([("a", -0.4, -0.6), ("b", -0.3, -0.7), ("c", -0.5, -0.5)], "c"),   # all good: test error
    ([("a", -0.4, -0.9), ("b", -0.6, -0.1), ("c", -0.5, -0.8)], "c"),   # some: among the good
    ([("a", -0.9, -0.1), ("b", -0.7, -0.8), ("c", -0.8, -0.2)], "b"),   # none: train error
    ([("b", -0.4, -0.6), ("a", -0.4, -0.6)], "a"),                      # tie
])
def test_choice_rule(spark, scores, best):
    df = spark.createDataFrame(scores, "model string, mae_train double, mae_test double")
    chosen = selection.choose_model(df.withColumn("t", F.lit(1)), ["t"], ["model"])
    assert [r.model for r in chosen.collect()] == [best]


def test_mesh(spark):
    df = spark.createDataFrame([(0.5, 3.0, 1.0), (20.5, 3.0, 2.0)], "x double, y double, z double")
    flat = df.withColumn("triple", F.lit(0))
    ranges = meshes.axis_ranges(meshes.axis_spans(flat))
    assert ranges.first().reason == "constant axis" and meshes.mesh(ranges).count() == 0
    wide = flat.withColumn("y", F.col("x") - 40)
    grid = meshes.mesh(meshes.axis_ranges(meshes.axis_spans(wide))).collect()
    assert len(grid) == 625
    assert min(r.x for r in grid) == 0.0 and math.isclose(max(r.x for r in grid), 22 * 24 / 25)
    assert min(r.y for r in grid) == -42.0


def test_metrics(spark):
    rng = random.Random(1)
    data = [(rng.uniform(-3, 3), rng.uniform(-3, 3)) for _ in range(50)] + [(0.0, 1.0)]
    df = spark.createDataFrame([(1, *d) for d in data] + [(1, None, 2.0)],
                               "g int, z double, z_predicted double")
    r = metrics.regression_metrics(df, ["g"]).first()
    z, p = np.array(data).T
    assert r.n == 51
    assert math.isclose(r.mae, np.abs(z - p).mean())
    assert math.isclose(r.rmse, np.sqrt(((z - p) ** 2).mean()))
    assert math.isclose(r.r2, 1 - ((z - p) ** 2).sum() / ((z - z.mean()) ** 2).sum())
    assert math.isclose(
        r.rmsle, np.sqrt(((np.log(np.abs(p) + 1) - np.log(np.abs(z) + 1)) ** 2).mean()))
    known = z != 0
    assert math.isclose(r.mape, np.abs((z - p)[known] / z[known]).mean())


def test_r2_matrix_and_pair_fit(table, points):
    _, data = complete(points)
    names = ["hd", "H3_seasonal_heavy_sd", "a|logfold"]
    got = {(r.x, r.y): r.r2 for r in metrics.r2_matrix(table, names).collect()}
    assert len(got) == 6 and got[("hd", "a|logfold")] == got[("a|logfold", "hd")]
    corr = np.corrcoef(data.T)
    assert math.isclose(got[("hd", "a|logfold")], corr[0, 2] ** 2, rel_tol=1e-9)
    fit = metrics.pair_fit(table, "hd", "a|logfold", ["variant_hash"])
    slope, intercept = np.polyfit(data[:, 0], data[:, 2], 1)
    for r in fit.collect():
        assert math.isclose(r.y_fitted, slope * r.x + intercept, rel_tol=1e-8, abs_tol=1e-9)


def test_plane_landscape(spark, table, tmp_path):
    options = dict(penalties=(0.0, 10.0), k=3, search_repeats=2, final_repeats=3)
    result = landscapes.plane_landscape(table, TRIPLES, ["variant_hash"], **options)
    surface = result.mesh.cache()
    assert surface.count() == 2 * 625
    assert result.metrics.count() == 2 * 120
    summary = result.summary.collect()
    assert len(summary) == 2 and all(r.subtype == "H3" and r.mae_test < 0 for r in summary)
    assert landscapes.landscape_summary(surface).count() == 2
    one = surfaces.pick_surface(surface, y="H3_seasonal_heavy_sd")
    assert one.count() == 625 and one.select("x_factor").distinct().collect()[0][0] == "hd"
    grid = surfaces.surface_grid(one)
    assert grid.count() == 25 and len(grid.columns) == len(TRIPLE) + 1 + 25
    assert surfaces.grid_axis(one).count() == 25
    assert surfaces.observed_points(table, *TRIPLES[0]).count() == 109
    done = write_landscapes(table, str(tmp_path), "H3", ["variant_hash"], **options)
    assert done == TRIPLES
    stored = spark.read.parquet(str(tmp_path / "H3_plandscape_summary"))
    assert stored.count() == 2


def _grid(rows, shape):
    n, sums = np.zeros(shape), np.zeros(shape)
    for x, y, z in rows:
        n[int(x), int(y)] += 1
        sums[int(x), int(y)] += z
    return n, sums


def _rows(count=300):
    rng = random.Random(5)
    return [(float(i % 10), float(i % 7), float((i % 10) ** 2 + 3 * rng.random()))
            for i in range(count)]


def test_tree_on_cells_equals_tree_on_rows(spark):
    rows = _rows()
    df = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(
        spark.createDataFrame(rows, "x double, y double, z double"))
    model = DecisionTreeRegressor(labelCol="z", maxDepth=3, seed=1).fit(df)
    tree = ensembles.grow_tree(*_grid(rows, (10, 7)), 3)
    for r in model.transform(df).collect():
        assert math.isclose(tree[int(r.x), int(r.y)], r.prediction, abs_tol=1e-9)


def test_gradient_boosting():
    n, s = _grid(_rows(), (10, 7))
    mean = s.sum() / n.sum()
    slow, = ensembles.gradient_boosting(n, s, 0.0001, [10])
    assert np.abs(slow - mean).max() < 0.1  # starts at the mean and moves by the rate
    one, = ensembles.gradient_boosting(n, s, 1.0, [1])
    assert np.allclose(one, ensembles.grow_tree(n, s))
    few, many = ensembles.gradient_boosting(n, s, 0.3, [3, 40])
    alone, = ensembles.gradient_boosting(n, s, 0.3, [3])
    assert np.allclose(few, alone)
    true = s / n
    assert np.abs(many - true).mean() < np.abs(few - true).mean()


def test_forest():
    n, s = _grid(_rows(), (10, 7))
    n[3, 4] = s[3, 4] = 0  # a cell without rows takes its neighbours' value
    places = [np.arange(10.0), np.arange(7.0)]

    def forest(features, least, steps, seed=1):
        return list(ensembles.random_forest(
            n, s, places, features, least, steps, np.random.default_rng(seed)))

    full = n > 0
    for features in (1, 2):
        for grown in forest(features, 2, [1, 9]):
            assert np.allclose(grown[full], s[full] / n[full]) and np.isfinite(grown).all()
    flat, = forest(2, 1000, [5])
    assert np.allclose(flat, s.sum() / n.sum())
    first, other = forest(1, 60, [1])[0], forest(1, 60, [1], 2)[0]
    assert not np.allclose(first, other)  # cuts are random
    assert np.array_equal(first, forest(1, 60, [1])[0])
    coarse, fine = (np.abs(forest(2, least, [20])[0] - s / np.where(full, n, 1))[full].mean()
                    for least in (100, 20))
    assert fine < coarse


def test_weighted_median():
    def vote(*pairs):
        guesses, votes = zip(*pairs)
        return ensembles.weighted_median(np.array(guesses)[:, None], np.array(votes))[0]

    assert vote((3.0, 1.0), (1.0, 1.0), (2.0, 1.0)) == 2.0
    assert vote((1.0, 0.5), (2.0, 0.4), (9.0, 2.0)) == 9.0
    assert vote((1.0, 1.0), (2.0, 1.0)) == 1.0


def test_adaboost():
    rows = _rows()
    cell = np.array([int(x) * 7 + int(y) for x, y, _ in rows])
    z = np.array([z for *_, z in rows])
    one, many = ensembles.adaboost((10, 7), cell, z, np.ones(len(z)), 1.0, [1, 30])
    assert np.allclose(one, ensembles.grow_tree(*_grid(rows, (10, 7))))
    left = ((many.ravel()[cell] - z) ** 2).sum() / ((z - z.mean()) ** 2).sum()
    assert left < 0.05
    exact, = ensembles.adaboost((2, 1), np.array([0, 1]), np.array([1.0, 2.0]), np.ones(2), 1.0, [9])
    assert exact.ravel().tolist() == [1.0, 2.0]


SMALL = trees.Family("GradientBoostingRegressor()", "gradient", [
    {"n_estimators": n, "learning_rate": 0.5} for n in (2, 4)])


def test_points_of_buckets_with_equal_folds_are_one(spark, monkeypatch):
    """Points are kept per fold and not per bucket, and the joins with the cuts send no rows."""
    kept, plans = {}, {}

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        kept[name] = session.written(df, name)
        return kept[name]

    monkeypatch.setattr(trees, "written", seen)
    rows = spark.range(4000).select(
        F.concat(F.lit("v"), "id").alias("variant_hash"), F.lit("H3").alias("subtype"),
        F.lit("HA").alias("protein"), F.lit("c").alias("clade"),
        F.lit("-").alias("substitution_list"), (F.col("id") % 2).cast("double").alias("hd"),
        (F.col("id") % 3).cast("double").alias("pcd"),
        (F.col("id") % 5).cast("double").alias("a|logfold"))
    trees.tree_landscape(
        rows, [("hd", "pcd", "a|logfold")], ["variant_hash"], (SMALL,), k=2, search_repeats=1,
        final_repeats=2)
    points = kept["cell-points"].collect()
    assert len(points) <= 2 ** 2 * 30  # a point per bucket before, 2,500 and more
    assert sum(r.n for r in points) == 4000
    assert not any("SortMergeJoin" in plans[name] for name in ("cuts", "cell-points"))


def test_equal_folds_of_like_buckets(spark):
    buckets = spark.range(folds.BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    alike = trees.like_buckets(buckets.withColumn("own", F.col("bucket")), 5, 2)
    numbers = F.explode(F.array(F.lit(1), F.lit(2))).alias("repeat")
    pairs = alike.select("*", numbers).filter(
        folds.fold_of(["bucket"], F.col("repeat")) != folds.fold_of(["own"], F.col("repeat")))
    assert pairs.count() == 0 and alike.select("bucket").distinct().count() == 25


def test_lines_with_rows_by_bits_equal_bisection():
    rng = np.random.default_rng(5)
    n = (rng.random((32, 23)) < 0.1).astype(float)
    x0, y0 = rng.integers(0, 32, 500), rng.integers(0, 23, 500)
    box = ensembles._Box(x0, rng.integers(x0, 32) + 1, y0, rng.integers(y0, 23) + 1, 24)
    some = box.inside(ensembles._corner_sums(n).ravel()) > 0
    box = ensembles._Box(*(side[some] for side in box.sides), 24)
    assert 100 < some.sum() < 500
    for axis in (0, 1):
        first, last = ensembles._Occupied(n)(box, axis)
        for at, (a, b, c, d) in enumerate(zip(*box.sides)):
            lines = np.flatnonzero(n[a:b, c:d].any(1 - axis)) + (a, c)[axis]
            assert (first[at], last[at]) == (lines[0], lines[-1])
    wide = np.where(rng.random((60, 9)) < 0.3, 1.0, 0.0)
    wide[0, 0] = 1
    grown = list(ensembles.random_forest(
        wide, 2 * wide, [np.arange(60.0), np.arange(9.0)], 2, 2, [3], np.random.default_rng(1)))
    assert np.allclose(grown[0], 2)


def test_fold_scores_by_rows(spark):
    """Scores from sums equal scores from rows, as every bin here holds one value."""
    rng = random.Random(7)  # values without ties between splits
    rows = [(i, float(i % 8), float(i % 5), rng.choice([0.0, 1.1, 2.7, 4.9, 7.3])) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, x double, y double, z double").withColumns(
        {"triple": F.lit(0), "bucket": F.col("id") % 50})
    spans, cuts = meshes.axis_spans(df), trees.axis_cuts(df)
    got = cuts.first()
    assert got.cuts_x == [i + 0.5 for i in range(7)] and got.cuts_y == [0.5, 1.5, 2.5, 3.5]
    plans = [(SMALL, p) for p in SMALL.grid]
    asked = spark.createDataFrame([(0, 0), (0, 1)], "triple int, plan int")
    scores = trees.fold_scores(trees.cell_points(df, cuts, spans), asked, plans, 3, 2).collect()
    assert len(scores) == 2 * 2 * 3
    folded = {(r.id, r.repeat): r.fold for r in folds.fold_ids(
        df.select("id", "bucket"), ["bucket"], 3, 2).collect()}
    for r in scores:
        train = [v[1:] for v in rows if folded[v[0], r.repeat] != r.fold]
        test = [v[1:] for v in rows if folded[v[0], r.repeat] == r.fold]
        n, s = _grid(train, (8, 5))
        guess, = ensembles.gradient_boosting(n, s, 0.5, [plans[r.plan][1]["n_estimators"]])
        for side, mae, r2 in ((test, r.mae_test, r.r2_test), (train, r.mae_train, r.r2_train)):
            z = np.array([v[2] for v in side])
            p = np.array([guess[int(v[0]), int(v[1])] for v in side])
            assert math.isclose(mae, np.abs(z - p).mean(), rel_tol=1e-9)
            assert math.isclose(r2, 1 - ((z - p) ** 2).sum() / ((z - z.mean()) ** 2).sum(), abs_tol=1e-9)


def test_fits_part_by_part(table, monkeypatch):
    hashed = folds.with_bucket(table, ["variant_hash"]).cache()

    def scores():
        return sorted(
            (r.triple, r.penalty, r.repeat, r.fold, round(r.mae_test, 9), round(r.r2_train, 9))
            for r in planes.fold_scores(hashed, TRIPLES, (0.0, 1.0), 3, 2).collect())

    whole = scores()
    monkeypatch.setattr(planes, "MAX_FITS", 1)
    monkeypatch.setattr(planes, "BLOCK_CELLS", 30)
    assert scores() == whole and len(whole) == 2 * 2 * 2 * 3


def test_triples_with_reasons(table):
    wide = table.withColumns({
        "flat": F.lit(2.0), "rare": F.when(F.col("hd") > 18, F.col("hd")),
        "none": F.lit(None).cast("double")})
    asked = [("hd", axis, "a|logfold") for axis in ("flat", "rare", "none", "pcd")]
    told = landscapes.plane_landscape(
        wide, asked, ["variant_hash"], k=2, search_repeats=1, final_repeats=1).triples.collect()
    assert {r.y_factor: r.reason for r in told} == {
        "flat": "constant axis", "rare": "too few rows", "none": "too few rows", "pcd": None}
    assert {r.y_factor: r.n for r in told}["none"] == 0
    with pytest.raises(ValueError):
        landscapes.plane_landscape(wide, asked[1:3], ["variant_hash"])


def test_outlier_leaves_other_cells(spark):
    df = spark.createDataFrame(
        [(0, float(i % 20), float(i % 4), 1.0) for i in range(200)] + [(0, 1e9, 1.0, 1.0)],
        "triple int, x double, y double, z double")
    cuts = trees.axis_cuts(df, bins=20).first()
    assert len(cuts.cuts_x) >= 18 and cuts.cuts_z == []


def test_tree_landscape(spark, table, tmp_path):
    for _ in range(2):  # a second run leaves the same tables
        write_tree_landscapes(
            table, str(tmp_path), "H3", ["variant_hash"], TRIPLES, (SMALL, trees.Family(
                "ExtraTreesRegressor()", "forest",
                [{"n_estimators": 5, "max_features": 1, "min_samples_split": 4}])),
            k=2, search_repeats=1, final_repeats=1, bins=16)
    surface = spark.read.parquet(str(tmp_path / "H3_plandscape"))
    assert surface.count() == 625 * len(TRIPLES)
    assert surface.filter("z_predicted IS NULL").count() == 0
    for r in spark.read.parquet(str(tmp_path / "H3_plandscape_summary")).collect():
        assert (r.model, r.n_estimators) in {
            ("GradientBoostingRegressor()", 2), ("GradientBoostingRegressor()", 4),
            ("ExtraTreesRegressor()", 5)}
    seen = spark.read.parquet(str(tmp_path / "H3_plandscape_metrics"))
    assert seen.filter("z_predicted IS NULL").count() == 0
    assert seen.groupBy(*TRIPLE).count().filter("count = 120").count() == len(TRIPLES)


def test_compare_models(table):
    ranked = comparison.compare_models(
        table, ["hd", "H3_seasonal_heavy_sd"], "a|logfold", ["variant_hash"], ("lr", "dt"))
    rows = ranked.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2] and rows[0].r2 >= rows[1].r2
    assert rows[0].n == 109 and rows[0].model_abbreviation == "lr"
    few = table.limit(5)
    row = comparison.compare_models(few, ["hd"], "a|logfold", ["variant_hash"], ("lr",)).first()
    assert row.n < 10 and row.model is None


def test_local_regression(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(30)], "x double, z double")
    path = spark.createDataFrame([(4.25,), (17.0,)], "node double")
    got = {r.node: r.z_smoothed for r in smoothing.local_regression(df, path, 3.0).collect()}
    assert math.isclose(got[4.25], 9.5) and math.isclose(got[17.0], 35.0)


def test_prepare(spark):
    rows = [(float(i), 2.0 * i + 1, float(i * 7 % 5)) for i in range(40)] + [(1000.0, 2001.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    same, columns = preparing.prepare(df, ["a", "b", "c"])
    assert same is df and columns == ["a", "b", "c"]
    kept, columns = preparing.prepare(df, ["a", "b", "c"], True, True, True)
    assert columns == ["a", "c"] and kept.count() == 40
    assert math.isclose(kept.agg(F.max("a")).first()[0], math.log1p(39))
