import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrane.operators import comparison, factors, features, gram, levels
from terrane.operators.folds import train_rows

SETS = [(("a", "b"), "z"), (("a", "c"), "z"), (("b", "c"), "y"), (("a", "rare"), "z"),
        (("a", "none"), "z")]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = []
    for i in range(300):
        a, b, c = rng.uniform(-3, 3), float(rng.randint(0, 9)), rng.gauss(0, 1)
        z = None if i % 13 == 0 else 2 * a - 0.3 * b + (rng.gauss(0, 0.5) if i % 20 else 15.0)
        out.append((f"k{i}", a, None if i % 17 == 0 else b, c, i * 1.0 if i < 6 else None, None,
                    z, math.sin(a) + b))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(
        rows, "key string, a double, b double, c double, rare double, none double, z double, "
        "y double").repartition(3).cache()


@pytest.fixture(scope="module")
def split(table):
    return {r.key: r.t for r in table.select("key", train_rows(["key"]).alias("t")).collect()}


def complete(rows, split, xs, z):
    at = {n: i for i, n in enumerate(["key", "a", "b", "c", "rare", "none", "z", "y"])}
    kept = [r for r in rows if all(r[at[c]] is not None for c in (*xs, z))]
    data = np.array([[r[at[c]] for c in (*xs, z)] for r in kept])
    return data, np.array([split[r[0]] for r in kept])


def measured(z, p):
    gap = np.abs(z - p)
    return gap.mean(), (gap ** 2).mean(), 1 - (gap ** 2).sum() / ((z - z.mean()) ** 2).sum()


def test_all_sets_at_once_equal_one_fit_each(table, rows, split):
    got = {(r.x, r.y, r.z, r.model_abbreviation): r
           for r in comparison.survey(table, SETS, ["key"], ("lr", "ridge", "dummy")).collect()}
    for xs, z in SETS[:3]:
        data, train = complete(rows, split, xs, z)
        a = np.column_stack([np.ones(len(data)), data[:, :2]])
        for name, penalty in (("lr", 0.0), ("ridge", 1.0), ("dummy", 1e12)):
            b = np.linalg.solve(
                a[train].T @ a[train] + penalty * np.diag([0, 1, 1]), a[train].T @ data[train, 2])
            r = got[(*xs, z, name)]
            assert r.n == len(data)
            for side, values in ((~train, (r.mae, r.mse, r.r2)),
                                 (train, (r.mae_train, r.mse_train, r.r2_train))):
                want = measured(data[side, 2], a[side] @ b)
                assert np.allclose(values, want, rtol=1e-6, atol=1e-6)
    ranks = [r["rank"] for k, r in got.items() if k[:3] == ("a", "b", "z")]
    assert sorted(ranks) == [1, 2, 3]
    for xs, z, n in ((("a", "rare"), "z", 5), (("a", "none"), "z", 0)):
        r = got[(*xs, z, None)]
        assert r.n == n and r.model is None and r["rank"] is None and r.r2 is None


def test_part_by_part(table, monkeypatch):
    def scores():
        return sorted(
            (r.x, r.y, r.z, str(r.model_abbreviation), None if r.mae is None else round(r.mae, 9))
            for r in comparison.survey(table, SETS, ["key"], ("lr", "huber", "dt")).collect())

    whole = scores()
    monkeypatch.setattr(comparison, "SETS", 2)
    assert scores() == whole and len(whole) == 3 * 3 + 2


def test_best_models(table):
    best = comparison.survey_models(table, SETS, ["key"], ("lr", "dummy")).collect()
    assert {(r.x, r.y, r.z): r.model_abbreviation for r in best} == {
        ("a", "b", "z"): "lr", ("a", "c", "z"): "lr", ("b", "c", "y"): "lr",
        ("a", "rare", "z"): None, ("a", "none", "z"): None}


def test_unknown_regressor(table):
    with pytest.raises(ValueError, match="other"):
        comparison.survey(table, SETS, ["key"], ("lr", "other"))
    with pytest.raises(ValueError, match="no factor sets"):
        comparison.survey(table, [], ["key"])


def test_guard_of_no_triples(table):
    guard = factors.row_guard(table, [])
    assert guard.columns == ["x_factor", "y_factor", "z_factor", "n", "enough"]
    assert guard.count() == 0


def moments(data):
    middle = data.mean(axis=0) + 0.1  # any shift will do
    return gram.Moments(gram.gram(data, middle), middle)


def test_penalised_lines_meet_their_conditions():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 4)) * [1, 2, 3, 1]
    z = x @ [3.0, 0, 1.0, 0.2] + rng.normal(size=200)
    m = moments(np.column_stack([x, z]))
    for line, absolute, squared in ((gram.lasso(m), 1.0, 0.0), (gram.elastic_net(m), 0.5, 0.5)):
        gap = z - gram.guess(line, x)
        pull = (x - x.mean(axis=0)).T @ gap / len(z) - squared * line[1:]
        for w, p in zip(line[1:], pull, strict=True):
            assert abs(p - absolute * np.sign(w)) < 1e-8 if w else abs(p) <= absolute + 1e-8
    one = gram.pursuit(m)
    assert (one[1:] != 0).sum() == 1 and one[1:].argmax() == 0 or one[3] != 0


def test_dependent_axes_have_the_shortest_slopes():
    x = np.arange(20.0)
    m = moments(np.column_stack([x, x, 2 * x + 1]))
    assert np.allclose(gram.least_squares(m), [1, 1, 1])


def test_huber_bends_less_to_outliers(table, rows, split):
    data, train = complete(rows, split, ("a", "b"), "z")
    got = {r.model_abbreviation: r for r in comparison.survey(
        table, SETS[:1], ["key"], ("lr", "huber")).collect()}
    assert got["huber"].mae_train < got["lr"].mae_train
    # the weighted equations of the last pass hold for the same passes in plain numpy
    d = data[train]
    a = np.column_stack([np.ones(len(d)), d[:, :2]])
    b, scale = np.linalg.lstsq(a, d[:, 2], rcond=None)[0], np.inf
    for _ in range(gram.PASSES):
        gap = np.abs(d[:, 2] - a @ b)
        w = np.minimum(1.0, gram.BEND * scale / gap)
        scale = gram.SCALE * gap.mean()
        b = np.linalg.solve(a.T @ (a * w[:, None]), a.T @ (w * d[:, 2]))
    assert math.isclose(got["huber"].mae_train, np.abs(d[:, 2] - a @ b).mean(), rel_tol=1e-9)


def plain_tree(bins, z, depth):
    """Every split of every node tried on the rows themselves."""
    if depth == 0:
        return z.mean()
    best = (0.0, None)
    for axis in range(bins.shape[1]):
        for cut in range(levels.BINS - 1):
            left = bins[:, axis] <= cut
            if left.any() and not left.all():
                gain = z[left].sum() ** 2 / left.sum() + z[~left].sum() ** 2 / (~left).sum() \
                    - z.sum() ** 2 / len(z)
                if gain > best[0] * (1 + 1e-9) + 1e-12:
                    best = (gain, (axis, cut))
    if best[1] is None:
        return z.mean()
    axis, cut = best[1]
    left = bins[:, axis] <= cut
    return (axis, cut, plain_tree(bins[left], z[left], depth - 1),
            plain_tree(bins[~left], z[~left], depth - 1))


def walk(node, row):
    while isinstance(node, tuple):
        axis, cut, low, high = node
        node = low if row[axis] <= cut else high
    return node


def grown(table, depth=3, trees=1, **options):
    both, places = gram.set_table(table, SETS[:3], train_rows(["key"]), F.xxhash64("key"))
    cuts = levels.cuts_of(both, len(both.columns) - 2)
    return levels.grow(both, places, cuts, [0, 2], trees, depth, **options), places, cuts


def test_trees_equal_a_plain_search(table, rows, split):
    made, places, cuts = grown(table)
    for i, (xs, z) in ((0, SETS[0]), (2, SETS[2])):
        data, train = complete(rows, split, xs, z)
        bins = levels.binned(data[:, :2], [cuts[c] for c in places[i][:-1]])
        tree = plain_tree(bins[train], data[train, 2], 3)
        assert np.allclose(made[i][0].guess(bins), [walk(tree, b) for b in bins])
    assert set(made) == {0, 2}


def test_forests_draw_the_same_again(table):
    def state(trees):
        return [(t.axis, t.cut, [round(v, 9) for v in t.value]) for t in trees]

    choice = levels.drawn_splits({0: 2, 2: 2}, True)
    one, other = (grown(table, 3, 4, sample=True, choice=choice)[0] for _ in range(2))
    assert state(one[0]) == state(other[0]) and len({str(s) for s in state(one[0])}) > 1


def test_bootstrap_counts():
    drawn = levels.drawn(np.arange(100_000), 3)
    assert abs(drawn.mean() - 1) < 0.02 and abs(drawn.var() - 1) < 0.03
    assert abs(np.corrcoef(drawn, levels.drawn(np.arange(100_000), 4))[0, 1]) < 0.02


def test_trees_beat_the_mean_where_lines_cannot(spark):
    rng = random.Random(5)
    data = [(f"k{i}", x, rng.random(), 4.0 * (abs(x) < 1) + rng.gauss(0, 0.3))
            for i, x in enumerate(rng.uniform(-3, 3) for _ in range(600))]
    df = spark.createDataFrame(data, "key string, a double, b double, z double")
    got = {r.model_abbreviation: r.r2 for r in comparison.compare_models(
        df, ["a", "b"], "z", ["key"], ("lr", "dt", "rf", "et", "gbr")).collect()}
    assert got["lr"] < 0.1 and got["dt"] > 0.9
    assert got["rf"] > 0.3 and got["et"] > 0.2 and got["gbr"] > 0.7


# Long features


def test_labels_are_bounded_and_marked(spark, monkeypatch):
    long = spark.createDataFrame(
        [("structure", "v", f, None, 1.0) for f in ("B_x_sd", "H1_x_sd", "HB_y_sd", "B yam|z")]
        + [("titer", "v", "B|p|lot|L1|logfold", "L1", 2.0)],
        "kind string, identifier string, feature string, lot string, value double")
    assert features.labels_of(long, "B vic") == ["B_x_sd", "B|p|lot|L1|logfold", "HB_y_sd"]
    lots = spark.createDataFrame([("L1",), (None,), ("L9",)], "lot string")
    assert features.limited_to_lots(long, lots).count() == 5
    assert features.limited_to_lots(long, lots.filter("lot = 'L9'")).count() == 4
    monkeypatch.setattr(features, "MAX_LABELS", 2)
    with pytest.raises(ValueError, match="more than 2"):
        features.labels_of(long, "B vic")
