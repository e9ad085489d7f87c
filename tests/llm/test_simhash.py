import random
from collections import Counter, defaultdict

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from terrane.llm import queries, simhash
from terrane.llm.components import components


def plain_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    parts = [words] if len(words) < 3 else [words[i:i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64(" ".join(p).encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_of(prints):
    """Smallest index that each print reaches over links of at most 3 bits."""
    of = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 3 and of[j] < of[i]:
                    of[i], changed = of[j], True
    return of


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAbÉé \t\n\x0b.", max_size=80))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_print(text)


def test_close_words_share_an_anchor():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 31, 500)
    words[:5] = [0, 1, (1 << 31) - 1, 5, 6]
    where = defaultdict(set)
    for i, a in zip(*simhash.anchors(words), strict=True):
        assert int(words[i] ^ a).bit_count() <= 2
        where[int(words[i])].add(int(a))
    assert max(map(len, where.values())) <= 16
    for w in words[:100]:
        flipped = w ^ (1 << np.arange(31))
        own = where[int(w)]
        for i, a in zip(*simhash.anchors(flipped), strict=True):
            where[int(flipped[i])].add(int(a))
        assert all(own & where[int(f)] for f in flipped)


def clustered(n, seed):
    rng = random.Random(seed)
    found = [rng.getrandbits(64) for _ in range(n // 6)]
    while len(found) < n:
        x = rng.choice(found)
        for _ in range(rng.randrange(1, 6)):
            x ^= 1 << rng.randrange(64)
        found.append(x)
    return list(dict.fromkeys(found))


def check_classes(spark, prints):
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {r["f"]: r["root"] for r in simhash.classes(
        spark.createDataFrame([(s,) for s in signed], "f long")).collect()}
    want = classes_of(prints)
    pairs = Counter((want[i], got[s]) for i, s in enumerate(signed))
    assert len(pairs) == len(set(want)) == len(set(got.values()))


def test_classes_against_all_pairs(spark):
    check_classes(spark, clustered(400, 1))


def test_crowded_anchors_are_split_exactly(spark, monkeypatch):
    # the workers import the module anew, so the split is tried through its parts
    rng = random.Random(5)
    half = rng.getrandbits(32)
    prints = [half | (x & 0xFFFFFFFF) << 32 for x in clustered(300, 6)]
    keys = np.zeros(len(prints), np.int64)
    f = np.array(prints, np.uint64).view(np.int64)
    monkeypatch.setattr(simhash, "CROWD", 20)
    (kind, _, rows), = [x for x in simhash._links(keys, f) if x[0]]
    assert kind == 1 and set(rows) == set(f)
    finer = [rows[((rows.view(np.uint64) >> np.uint64(32 + 8 * i)) & np.uint64(255)) == v]
             for i in range(4) for v in range(256)]
    pairs = {(min(a, b), max(a, b)) for part in finer for a, b in
             zip(*simhash.star_links(part), strict=True)}
    want = classes_of(prints)
    of = {int(x): int(x) for x in f}
    for _ in range(len(f)):
        for a, b in pairs:
            of[int(a)] = of[int(b)] = min(of[int(a)], of[int(b)])
    assert len({(want[i], of[int(x)]) for i, x in enumerate(f)}) == len(set(want)) == len(
        set(of.values()))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101 + i) for i in range(50)] + [(200, 200)]
    got = {r["node"]: r["root"] for r in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(61)}) == 1
    assert len({got[i] for i in range(100, 151)}) == 1
    assert got[0] != got[100] and 200 not in got


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    docs = sorted(docs, key=lambda r: r["doc_id"])
    prints = [plain_print(r["text"]) for r in docs]
    of = classes_of(prints)
    got = {r["doc_id"]: r for r in queries.op7_simhash(spark, sf).collect()}
    for i, doc in enumerate(docs):
        row = got[doc["doc_id"]]
        assert row["fingerprint"] == f"{prints[i]:016x}"
        assert row["component_id"] == docs[of[i]]["doc_id"]


def test_odd_rows(spark, odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[4]["fingerprint"] == by_id[5]["fingerprint"] == "0" * 16
    assert {by_id[i]["component_id"] for i in (4, 5, 6)} == {4}
    assert by_id[2]["component_id"] == 1
    assert simhash.near_duplicates(no_docs).count() == 0
