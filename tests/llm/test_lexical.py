import math
import re
from collections import Counter

import pytest

from terrane.llm import lexical

ITEMS = "item_id long, text string, doc_id string, score int, item string, terms string"


def plain_terms(text):
    """Runs of ASCII letters and digits and of all characters beyond ASCII."""
    runs = re.findall(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+", text or "")
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in r) for r in runs]


def brute(docs, items, k):
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, length = len(bags), sum(x for _, _, x in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    out = []
    for item, text in items:
        found = []
        for i, b, size in bags:
            m = 10 + 90 * size * n // length
            score = sum(w[t] * (10 ** 9 * b[t] // (1000 * b[t] + 8 * m))
                        for t in set(plain_terms(text)) if t in b)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s)
                for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def items_table(spark, rows):
    return spark.createDataFrame([(i, t, "d", 1, "i", "t") for i, t in rows], ITEMS)


def some_items(docs):
    texts = [t for _, t in docs if t]
    items = [(j, t[:90]) for j, t in enumerate(texts[:6])]
    return items + [(50, None), (51, "no such terms zzz"), (52, "THE river été"), (53, ""),
                    (0, texts[0][:90]), (None, "bridge idiot"), (54, "gnu general public x")]


@pytest.mark.parametrize("k", [1, 4, 50])
def test_against_brute_force(spark, odd_docs, k):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = some_items(docs)
    got = lexical.search(odd_docs, items_table(spark, items), k).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items, k)


def test_many_shards(spark, odd_docs, monkeypatch):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = some_items(docs)
    monkeypatch.setattr(lexical, "SHARD_ROWS", 1)
    monkeypatch.setattr(lexical, "BLOCK_ROWS", 2)
    monkeypatch.setattr(lexical, "FAN", 2)
    got = lexical.search(odd_docs, items_table(spark, items), 3).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items, 3)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01/"
    docs, items = (spark.read.parquet(sf + t) for t in ("documents.parquet", "benchmark.parquet"))
    got = lexical.search(docs, items, 10).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()],
                 [(r.item_id, r.text) for r in items.collect()], 10)
    assert sorted(map(tuple, got), key=str) == want


def shard_of(rows):
    import numpy as np

    columns = list(zip(*rows, strict=True))
    return lexical.Shard(np.array(columns[0]), np.array(columns[0]), np.ones(len(rows), bool),
                         np.array(columns[1]), np.array(columns[2]))


def test_pair_bounds_are_tighter():
    # terms 1 and 2 never meet, 3 and 4 do in document 5
    shard = shard_of([(1, 1, 50), (2, 2, 40), (5, 3, 30), (5, 4, 20), (6, 3, 35)])
    assert shard.bound(1, 2) == 50 and shard.bound(3, 4) == 50
    assert [u[0] for u in shard.units([1, 2, 3, 4])] == [50, 50]
    assert shard.top([1, 2, 3, 4], 3) == [(50, True, 1), (50, True, 5), (40, True, 2)]


def test_skipping_keeps_ties():
    rows = [(d, t, 10) for d in range(40) for t in (1, 2)] + [(39, 3, 1), (7, 3, 1)]
    assert shard_of(rows).top([1, 2, 3], 4) == [
        (21, True, 7), (21, True, 39), (20, True, 0), (20, True, 1)]


def test_empty_tables(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], ITEMS)
    some = items_table(spark, [(1, "the river")])
    assert lexical.search(no_docs, some, 3).count() == 0
    assert lexical.search(odd_docs, none, 3).count() == 0
