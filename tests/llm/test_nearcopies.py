import random
from itertools import combinations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from terrane.llm import nearcopies


def shingles(text):
    words = text.split()
    return {" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def families(seed, n, edits):
    """Texts of random words, each with copies in which single words are others."""
    rng = random.Random(seed)
    found = []
    for family in range(n):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(80, 400))]
        found.append((family, " ".join(words)))
        for share in edits:
            copy = list(words)
            for at in rng.sample(range(len(words)), max(1, int(share * len(words)))):
                copy[at] = f"w{rng.randrange(5000)}"
            found.append((family, " ".join(copy)))
    return found


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aAbÉé \t\n\x0b.", max_size=80))
def test_prints_see_words_only(text):
    plain = " ".join(text.encode().lower().split()[i].decode() for i in range(
        len(text.encode().split())))
    for a, b in zip(nearcopies.prints_of(text), nearcopies.prints_of(plain), strict=True):
        assert a.tolist() == b.tolist()
    assert plain or not any(map(np.any, nearcopies.prints_of(text)))


def test_chunks_do_not_change_prints(monkeypatch):
    text = families(1, 1, [])[0][1]
    whole = nearcopies.prints_of(text)
    monkeypatch.setattr(nearcopies, "CHUNK", 7)
    assert all((a == b).all() for a, b in zip(whole, nearcopies.prints_of(text), strict=True))


def test_binary_values_come_back_from_slices():
    words = np.arange(40, dtype=np.uint64).reshape(-1, 4)
    made = nearcopies._binary(words)
    assert (nearcopies._words(made.slice(3, 4)) == words[3:7]).all()
    assert (nearcopies._words(pa.concat_arrays([made, made])) == np.vstack([words] * 2)).all()
    assert nearcopies._words(made.slice(0, 0)).shape == (0, 4)


def of_classes(rows):
    """Smallest index that each row reaches over near rows."""
    of = list(range(len(rows)))
    hits = [(a, b) for a, b in combinations(range(len(rows)), 2)
            if nearcopies.bits(rows[a], rows[b]) <= nearcopies.MANY]
    for _ in rows:
        for a, b in hits:
            of[a] = of[b] = min(of[a], of[b])
    return of


def test_joined_groups_are_those_of_all_pairs():
    rng = np.random.default_rng(2)
    rows = [rng.integers(0, 2**63, 4, dtype=np.uint64) for _ in range(8)]
    for _ in range(50):
        bits = np.zeros(256, np.uint8)
        bits[rng.choice(256, rng.integers(10, 60), replace=False)] = 1
        rows.append(rows[rng.integers(len(rows))] ^ np.packbits(bits).view("<u8"))
    f = np.array(rows)
    of = {r.tobytes(): i for i, r in enumerate(f)}
    links = [(of[a.tobytes()], of[b.tobytes()]) for group in nearcopies.joined(f)
             for a, b in zip(*group, strict=True)]
    got = list(range(len(f)))
    for _ in f:
        for a, b in links:
            got[a] = got[b] = min(got[a], got[b])
    assert got == of_classes(f)


def test_every_two_rows_of_a_crowd_meet(spark):
    n = 3 * nearcopies.CROWD
    rows = [(n, 7, i.to_bytes(32, "little")) for i in range(60)]
    made = nearcopies.blocks(spark.createDataFrame(rows, "size long, anchor long, f binary"))
    groups = {}
    for anchor, f in made.collect():
        groups.setdefault(anchor, set()).add(bytes(f))
    pairs = {p for g in groups.values() for p in combinations(sorted(g), 2)}
    assert len(pairs) == 60 * 59 // 2 and max(map(len, groups.values())) < 60


def test_near_copies_go_and_others_stay(spark):
    texts = families(5, 40, [0.005, 0.01, 0.02])
    docs = spark.createDataFrame(
        [(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    kept = {r.doc_id for r in nearcopies.deduplicate(docs).collect()}
    first = {family: i for i, (family, _) in reversed(list(enumerate(texts)))}
    assert set(first.values()) <= kept
    close = [i for i, (family, t) in enumerate(texts)
             if i != first[family] and jaccard(t, texts[first[family]][1]) >= 0.8]
    for i in range(len(texts)):
        assert i in kept or max(
            jaccard(texts[i][1], t) for j, (_, t) in enumerate(texts) if j != i) >= 0.75
    assert len(close) > 100 and sum(i not in kept for i in close) >= 0.9 * len(close)


def test_texts_that_share_a_passage_stay(spark):
    rng = random.Random(8)
    passage = " ".join(f"p{rng.randrange(900)}" for _ in range(100))
    texts = [" ".join([passage, *(f"w{rng.randrange(9000)}" for _ in range(100))])
             for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert nearcopies.deduplicate(docs).count() == 60


def test_odd_rows(spark, odd_docs, no_docs):
    kept = nearcopies.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(8) == 1 and ids.count(None) == 1 and ids.count(1) == 1
    assert not {2, 5, 6} & set(ids) and 4 in ids
    assert nearcopies.deduplicate(no_docs).count() == 0
