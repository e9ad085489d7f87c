import numpy as np
import pytest

from terrane.llm import neighbours, topk

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, q_id string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA)


def odd_vectors():
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 360)]  # a very common vector
    rows += [(400, None), (401, [None] * 8), (402, [float("nan")] * 8), (403, [0.0] * 8),
             (404, [float("inf")] + [0.0] * 7), (None, rows[0][1]), (450, [1.0, 2.0]),
             (500, [3.0, 1.0]), (550, []), (20, rows[20][1]), (100, rows[100][1])]
    return rows


def fine(v, zero):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and (
        zero or any(v))


def brute(rows, every, k, score, zero):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and fine(v, zero)]
    out = set()
    for q, qv in {(i, tuple(v)) for i, v in rows if i % every == 0}:
        found = sorted((-score(np.array(qv), v), i) for i, v in rows
                       if i != q and len(v) == len(qv))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])}
    return out


def test_exact_top_k_against_brute_force(spark):
    rows = odd_vectors()
    got = [tuple(r) for r in topk.search(table(spark, rows), 20, 10).collect()]
    want = brute(rows, 20, 10, lambda a, b: int(np.floor(1024 * a) @ np.floor(1024 * b)), True)
    assert set(got) == want and len(got) == len(want)


def test_products_are_exact_beyond_doubles():
    q, v = np.array([[2.0 ** 40, 1.0]]), np.array([[2.0 ** 40, 3.0], [1.0, 0.0]])
    assert topk.products(q, v)[0].tolist() == [2 ** 80 + 3, 2 ** 40]


def test_neighbours_against_brute_force(spark):
    rows = odd_vectors()
    got = [tuple(r) for r in neighbours.search(table(spark, rows), 20, 5).collect()]
    cosine = lambda a, b: a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)
    want = brute(rows, 20, 5, cosine, False)
    near = {(q, i): s for q, _, i, s in brute(rows, 20, 1000, cosine, False)}
    found = {(q, i) for q, _, i, _ in got}
    assert len({(q, i) for q, _, i, _ in want} & found) >= 0.9 * len(want)
    assert {(q, r) for q, r, _, _ in got} == {(q, r) for q, r, _, _ in want}
    for q, _, i, s in got:
        assert s == pytest.approx(near[q, i], abs=1e-12)
    # copies of one vector tie, smaller ids first
    ranks = [i for _, _, i in sorted((q, r, i) for q, r, i, _ in got if q == 340)]
    assert ranks == [7, 300, 301, 302, 303]


def test_recall_on_the_test_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.toPandas()
    unit = np.stack(rows.embedding).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    ids = rows.vec_id.to_numpy()
    got = neighbours.search(vectors, 20, 5).toPandas().groupby("query_id")["vec_id"].agg(set)
    hits = 0
    for at in np.flatnonzero(ids % 20 == 0):
        score = unit @ unit[at]
        score[at] = -2
        hits += len(got[ids[at]] & set(ids[np.argsort(-score)[:5]]))
    assert hits >= 0.9 * 5 * len(got)


def test_empty_tables(spark):
    none = table(spark, [])
    assert topk.search(none, 20, 3).count() == neighbours.search(none, 20, 3).count() == 0


def plain_candidates(unit, query, k):
    """Windows widened from the first round on, every round counted anew."""
    axes = neighbours.directions(unit.shape[1])
    places, centre, m = unit @ axes, query @ axes, axes.shape[1]
    enough = min(len(unit), int(np.ceil(neighbours.SHARE * len(unit))) + k)
    rounds = int(np.ceil(np.log(2.1 / neighbours.WIDTH) / np.log(neighbours.GROWTH))) + 1
    for r, width in enumerate(neighbours.WIDTH * neighbours.GROWTH ** np.arange(rounds)):
        met = ((places >= centre - width) & (places <= centre + width)).sum(axis=1)
        found = np.flatnonzero(met >= int(np.ceil(neighbours.COLLISIONS * m)))
        if len(found) >= enough:
            break
    return found.tolist(), r


@pytest.mark.parametrize("dim, spread", [(1, 1.0), (6, 0.0), (16, 0.3), (64, 1.0)])
def test_candidates_from_any_round_are_those_of_the_first_enough(dim, spread):
    rng = np.random.default_rng(dim)
    unit = rng.normal(size=(4, dim))[rng.integers(0, 4, 200)] + spread * rng.normal(
        size=(200, dim))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    shard = neighbours.Shard(unit)
    for query, low, high in zip(unit[:12], *shard.windows(unit[:12]), strict=True):
        for k in (1, 30, 500):
            want = plain_candidates(unit, query, k)
            for r in (0, 7, len(low) - 1):
                got, ended = shard.candidates(low, high, k, r)
                assert (got.tolist(), ended) == want


def test_a_query_begins_where_the_last_one_ended(monkeypatch):
    unit = np.random.default_rng(5).normal(size=(600, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    counted, count = [], neighbours.Shard.collisions
    monkeypatch.setattr(neighbours.Shard, "collisions",
                        lambda self, *spans: counted.append(1) or count(self, *spans))
    shard, r, rounds = neighbours.Shard(unit), 0, []
    for low, high in zip(*shard.windows(unit[:50]), strict=True):
        _, r = shard.candidates(low, high, 5, r)
        rounds.append(r)
    assert min(rounds) >= 6 and len(counted) <= 50 * 3
