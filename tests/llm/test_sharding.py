import random
import zlib

from terrane.llm import sharding


def test_differencing_is_tighter_than_greedy():
    rng = random.Random(1)
    sizes = {i: rng.randrange(1, 5000) for i in range(400)}
    found = sharding.difference(sizes, 7)
    assert set(found) == set(sizes)
    sums = [sum(s for i, s in sizes.items() if found[i] == b) for b in range(7)]
    greedy = [0] * 7
    for s in sorted(sizes.values(), reverse=True):
        greedy[greedy.index(min(greedy))] += s
    assert max(sums) - min(sums) <= max(greedy) - min(greedy)
    assert sharding.difference({}, 3) == {} and sharding.difference({5: 1}, 1) == {5: 0}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = sharding.shards(odd_docs, 3).toPandas()
    text = {r["doc_id"]: r["text"] for r in odd_docs.collect()}
    assert len(rows) == len(odd_docs.collect())
    for r in rows.to_dict("records"):
        t = text[None if r["doc_id"] != r["doc_id"] else int(r["doc_id"])] or ""
        assert r["size"] == len(t.encode()) + 16 and r["text_crc32"] == zlib.crc32(t.encode())
    shard = rows.dropna(subset="doc_id").groupby("doc_id")["shard"].agg(set)
    assert all(len(s) == 1 for s in shard) and shard[1] == shard[2]
    for _, part in rows.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    assert sharding.shards(no_docs, 3).count() == 0


def test_sizes_with_a_hot_group(spark):
    rng = random.Random(4)
    rows = [(i, "hot text " * 20) for i in range(300)]
    rows += [(1000 + i, "x" * rng.randrange(200) + str(i)) for i in range(900)]
    found = sharding.shards(spark.createDataFrame(rows, "doc_id long, text string"), 10).toPandas()
    sums = found.groupby("shard")["size"].sum().sort_values()
    hot = found[found.doc_id < 1000]
    assert hot["shard"].nunique() == 1
    others = sums.drop(hot["shard"].iloc[0])
    assert len(others) == 9 and others.max() - others.min() <= 3
