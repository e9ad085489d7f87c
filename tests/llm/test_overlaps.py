import random
from itertools import combinations

import numpy as np

from terrane.llm import nearcopies, overlaps


def sets_of(seed, n):
    """Sorted sets of 64-bit hashes, many of them near copies of others, some hashes frequent."""
    rng = random.Random(seed)
    common = [rng.getrandbits(64) for _ in range(30)]
    found = {}
    while len(found) < n:
        if found and rng.random() < 0.7:
            made = set(rng.choice(list(found.values())))
            made -= set(rng.sample(sorted(made), rng.randrange(len(made) // 5 + 1)))
            made |= {rng.getrandbits(64) for _ in range(rng.randrange(len(made) // 6 + 1))}
        else:
            made = {*rng.sample(common, rng.randrange(25)),
                    *(rng.getrandbits(64) for _ in range(rng.choice([1, 3, 9, 40, 200])))}
        found[frozenset(made)] = made
    return [np.array(sorted(s), np.uint64) for s in found]


def jaccard(a, b):
    shared = len(np.intersect1d(a, b))
    return shared / (len(a) + len(b) - shared)


def test_similar_sets_meet_and_pass_all_bounds():
    sets = sets_of(3, 250)
    counts = np.zeros(1 << overlaps.BITS, np.int64)
    for s in sets:
        np.add.at(counts, (s >> np.uint64(64 - overlaps.BITS)).astype(int), 1)
    rows = [(int(np.uint64(k).view(np.int64)), i, i, len(s), at)
            for i, s in enumerate(sets) for at, k in enumerate(overlaps.prefix(s, counts))]
    rows = np.array(sorted(rows), np.int64)
    met = {tuple(sorted(p)) for n, pairs in overlaps._met(rows[:, 0], rows[:, 1:]) if not n
           for p in pairs.tolist()}
    near = {p for p in combinations(range(len(sets)), 2)
            if jaccard(sets[p[0]], sets[p[1]]) >= 0.8}
    assert len(near) > 100 and near <= met
    maps = [overlaps.bitmap(s).tobytes() for s in sets]
    for a, b in combinations(range(len(sets)), 2):
        assert overlaps.apart(maps[a], maps[b]) <= len(np.setxor1d(sets[a], sets[b]))


def test_a_crowd_gives_the_pairs_of_all_rows(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(7, i, i // 2, rng.randrange(20, 40), rng.randrange(3)) for i in range(90)]
    df = spark.createDataFrame(rows, "key long, id long, root long, size long, place long")

    def pairs(found):
        return {(min(r.a, r.b), max(r.a, r.b)) for r in found.where("n = 0").collect()}

    whole = pairs(overlaps.meet(df))
    array = np.array(rows)[:, 1:]
    assert whole == {
        (int(a[0]), int(b[0])) for a, b in combinations(array, 2)
        if a[1] != b[1] and overlaps._may(a[2], a[3], b[2], b[3])}
    crowded = spark.createDataFrame(
        [(4 * overlaps.CROWD, *r) for r in rows], "n long, a long, b long, c long, d long, e long")
    assert pairs(overlaps.meet(overlaps.blocks(crowded))) == whole


def test_every_pair_at_the_limit_is_in_one_class(spark):
    rng = random.Random(11)
    texts = []
    for _ in range(40):  # new words at the end: many other words, few other shingles
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 300))]
        more = [f"w{rng.randrange(5000)}" for _ in range(int(0.235 * len(words)))]
        texts += [" ".join(words), " ".join(words + more)]
    sets = [nearcopies.shingles_of(t) for t in texts]
    near = [jaccard(sets[i], sets[i + 1]) >= 0.8 for i in range(0, len(texts), 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in nearcopies.deduplicate(docs).collect()}
    assert sum(near) > 20
    assert kept == {*range(0, 80, 2), *(2 * i + 1 for i, x in enumerate(near) if not x)}
