import numpy as np
import pytest

from terrane.llm import negatives

SCHEMA = ("vec_id long, embedding array<double>, label int, id string, v int, which int, "
          "band int, dim string, good string")


def table(spark, rows):
    return spark.createDataFrame([(i, v, x, "i", 1, 2, 3, "d", "g") for i, v, x in rows], SCHEMA)


def odd_rows():
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(4, 6))
    rows = []
    for i in range(260):
        v = centre[i % 4] + rng.normal(size=6) * 0.4
        rows.append((i, (v * rng.choice([0.2, 1, 5])).tolist(), int(i % 3)))
    rows += [(i, rows[10][1], i % 3) for i in range(300, 345)]  # a very common vector
    rows += [(400, None, 1), (401, [None] * 6, 1), (402, [float("nan")] * 6, 0),
             (403, [float("inf")] * 6, 2), (404, [0.0] * 6, 0), (500, [0.0] * 6, 1),
             (None, rows[0][1], 0), (405, rows[0][1], None), (600, [1.0, 2.0], 1),
             (601, [2.0, 1.0], 1), (602, [1.5, 1.5], 2), (700, [], 1), (20, *rows[20][1:]),
             (40, *rows[40][1:]), (800, [1e200] * 6, 1), (801, [1e200] * 6, 2),
             (802, [1e17] * 6, 1)]
    return rows


def whole(v):
    return [int(np.floor(256 * x)) for x in v]


def brute(rows, every):
    limit = 2 ** 63 - 1
    fine = [(i, whole(v), x) for i, v, x in rows
            if i is not None and v is not None and x is not None
            and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for a, av, label in {(i, tuple(v), x) for i, v, x in fine if i % every == 0}:
        found = sorted(
            (-max(-limit, min(limit, sum(p * q for p, q in zip(av, v)))), i, x)
            for i, v, x in fine if len(v) == len(av))
        good = [(s, i) for s, i, x in found if x == label and i != a][:5]
        for ps, p in good:
            bad = [(s, i) for s, i, x in found
                   if x != label and 80 * -ps <= 100 * -s <= 100 * -ps][:5]
            out += [(a, p, r + 1, n, -ps, -s) for r, (s, n) in enumerate(bad)]
    return sorted(out)


@pytest.mark.parametrize("every", [20, 100])
def test_against_brute_force(spark, every):
    rows = odd_rows()
    got = sorted(map(tuple, negatives.mine(table(spark, rows), every).collect()))
    want = brute(rows, every)
    assert got == want and want


def test_many_shards_and_blocks(spark, monkeypatch):
    rows = odd_rows()
    for name, value in (("SHARD_ROWS", 9), ("BLOCK_ROWS", 3), ("FAN", 2)):
        monkeypatch.setattr(negatives, name, value)
    got = sorted(map(tuple, negatives.mine(table(spark, rows), 20).collect()))
    assert got == brute(rows, 20)


def test_feasible_ranges_hold_every_row_that_reaches_the_cosine():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 5))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    for q in vectors[:20]:
        for cosine in (0.3, 0.8, 0.99, 1.0):
            inside = np.ones(len(vectors), bool)
            for f, least, most in negatives.feasible(q, cosine):
                inside &= (vectors[:, f] >= least) & (vectors[:, f] <= most)
            assert inside[vectors @ q >= cosine].all()
    assert negatives.feasible(vectors[0], -0.1) == []


def test_buckets_prune_and_lose_nothing():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(40, 8)) * 100
    rows = np.floor(centre[rng.integers(0, 40, 4000)] * rng.uniform(0.5, 4, (4000, 1))
                    + rng.normal(size=(4000, 8)))
    ids, labels = np.arange(4000), rng.integers(0, 3, 4000)
    held = negatives.buckets(ids, labels, rows)
    seen = []
    for bucket in held:
        take = bucket.candidates

        def counted(ranges, take=take, bucket=bucket):
            picked = take(ranges)
            seen.append(len(bucket.ids) if picked is None else len(picked))
            return picked

        bucket.candidates = counted
    for at in range(0, 4000, 400):
        best = negatives.Best(5)
        negatives.fill([best], rows[at], lambda b, at=at: b.ids != at, held)
        scores = rows @ rows[at]
        order = [i for i in np.lexsort((ids, -scores)) if i != at][:5]
        assert best.ids.tolist() == order
    assert sum(seen) < 0.5 * 10 * 4000


def test_empty_table(spark):
    assert negatives.mine(table(spark, []), 20).count() == 0
