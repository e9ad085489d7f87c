import tracemalloc
from zlib import crc32

import numpy as np

from terrane.llm import queries
from terrane.llm import word_lm as lm


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def plain_score(model, text):
    """Word by word, each from its own window and its own walk down the tree."""
    counts = {r["word"]: r["n"] for r in model.words.collect()}
    found = lm.tokens(text, lm.Hashes())
    line = [lm.EDGE] * 2 + [(int(t) % 2 ** 64) >> (64 - lm.BITS) for t in found] + [lm.EDGE] * 2
    total = 0.0
    for i, word in enumerate(found):
        sums = sum(model.net[0][line[i + 2 + j]] @ model.net[1][k]
                   for k, j in enumerate(lm.AROUND))
        hidden = np.tanh(model.net[2] + sums)
        node = 1
        for bit in f"{line[i + 2]:0{lm.BITS}b}":
            logit = float(hidden @ model.net[3][node] + model.net[4][node])
            total -= np.log1p(np.exp(-logit if bit == "1" else logit))
            node = 2 * node + int(bit)
        total += np.log((counts.get(int(word), 0) + lm.EXTRA) / model.mass[line[i + 2]])
    return len(found), total


def test_scores_against_single_windows(spark, monkeypatch):
    monkeypatch.setattr(lm, "COMMON", 100)  # most words are joined
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    model = lm.fit(docs, rounds=1)
    got = {r["doc_id"]: r for r in lm.score(docs, model).collect()}
    for doc in docs.limit(5).collect():
        n, total = plain_score(model, doc["text"])
        assert got[doc["doc_id"]]["n_tokens"] == n
        assert abs(got[doc["doc_id"]]["log_likelihood"] - total) < 1e-3 * max(1, n)


def test_all_positions_train_and_all_words_count(spark):
    texts = [f"some text with its own{i} word{i}" for i in range(50)]
    model = lm.fit(docs_of(spark, texts), 1)
    assert model.trained == 300
    assert model.words.count() == 4 + 100
    share = np.zeros(lm.LEAVES)
    for r in model.words.collect():
        leaf = (r["word"] % 2 ** 64) >> (64 - lm.BITS)
        share[leaf] += (r["n"] + lm.EXTRA) / model.mass[leaf]
    assert np.allclose(share + lm.EXTRA / model.mass, 1)


def test_words_of_one_bucket_have_their_own_counts(spark):
    common, bucket = "river", crc32(b"river") % (1 << 16)
    rare = next(w for w in (f"w{i}" for i in range(10 ** 6)) if crc32(w.encode()) % (1 << 16)
                == bucket)
    docs = docs_of(spark, [common] * 400 + [rare])
    got = {r["doc_id"]: r["log_likelihood"] for r in lm.score(docs, lm.fit(docs)).collect()}
    assert got[0] > got[400] + 3


def test_neighbours_of_equal_frequency_tell_words_apart(spark):
    rng = np.random.default_rng(1)
    pairs = [(f"left{i}", f"right{i}") for i in range(200)]
    texts = [" ".join(pairs[i]) for i in rng.permutation(np.repeat(np.arange(200), 60))]
    model = lm.fit(docs_of(spark, texts), 4)
    right = docs_of(spark, [" ".join(p) for p in pairs])
    wrong = docs_of(spark, [f"{pairs[i][0]} {pairs[i - 7][1]}" for i in range(200)])
    mean = [lm.score(x, model).agg({"log_likelihood": "avg"}).first()[0] for x in (right, wrong)]
    assert mean[0] > mean[1] + 2


def test_odd_rows(spark, odd_docs, no_docs):
    found = lm.score(odd_docs, lm.fit(odd_docs)).collect()
    assert len(found) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in found}
    for i in (4, 5, 6):
        assert tuple(by_id[i])[1:] == (0, 0.0, None)
    assert lm.score(no_docs, lm.fit(no_docs)).count() == 0


def test_query_is_whole(spark):
    sf = "/root/testdata/sf0.001"
    assert queries.op4_lm(spark, sf).count() == spark.read.parquet(
        f"{sf}/documents.parquet").count()


def test_a_step_follows_the_slopes_of_single_words():
    rng = np.random.default_rng(4)
    words = rng.integers(-2 ** 63, 2 ** 63 - 1, 60)
    texts = [rng.choice(words[:n], m) for n, m in ((60, 150), (1, 1), (3, 40), (1, 9))]
    line, places = lm._line(texts)
    net = [rng.normal(0, 0.3, x.shape).astype(np.float32) for x in lm._start()]
    slopes = [np.zeros(x.shape) for x in net]
    for at in places:
        around, leaf = [int(line[at + j]) for j in lm.AROUND], int(line[at])
        hidden = np.tanh(net[2] + sum(net[0][w] @ net[1][k] for k, w in enumerate(around)))
        back = np.zeros(lm.HIDDEN)
        for level in range(lm.BITS):
            node = 1 << level | leaf >> (lm.BITS - level)
            error = 1 / (1 + np.exp(-hidden @ net[3][node] - net[4][node]))
            error = (error - (leaf >> (lm.BITS - 1 - level) & 1)) / len(places)
            slopes[3][node] += error * hidden
            slopes[4][node] += error
            back += error * net[3][node]
        back *= 1 - hidden ** 2
        slopes[2] += back
        for k, w in enumerate(around):
            slopes[1][k] += np.outer(net[0][w], back)
            slopes[0][w] += net[1][k] @ back
    own = [*(x.copy() for x in net[:3]), np.column_stack(net[3:])]
    seen = [np.full_like(x, 1e-6) for x in own]
    lm._train(own, seen, lm._span(line, places), len(places))
    for old, new, slope in zip(
            net, [*own[:3], own[3][:, :-1], own[3][:, -1]], slopes, strict=True):
        assert np.allclose(new, old - lm.SPEED * slope / np.sqrt(slope ** 2 + 1e-6), atol=1e-4)


def test_a_step_holds_no_vector_per_word_and_level():
    rng = np.random.default_rng(5)
    line, places = lm._line([rng.integers(-2 ** 63, 2 ** 63 - 1, 300)[rng.zipf(1.3, 1024) % 300]])
    start = lm._start()
    net = [*start[:3], np.column_stack(start[3:])]
    seen = [np.full_like(x, 1e-6) for x in net]
    tracemalloc.start()
    lm._train(net, seen, lm._span(line, places), len(places))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * 4 * lm.BITS * lm.HIDDEN * len(places)


def test_joined_counts_are_dealt_once_by_document(spark, monkeypatch):
    monkeypatch.setattr(lm, "COMMON", 1)
    texts = ["a a a b c " * 20_000, "b d", "new " * 3, None]
    model = lm.fit(docs_of(spark, texts[:2]), rounds=1)
    found = lm.score(docs_of(spark, texts), model)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # one by document after the join, none by document and count
    assert plan.count("Aggregate [doc#") == 1 and "collect_list" not in plan
    got = {r["doc_id"]: r["log_likelihood"] for r in found.collect()}
    for i, text in enumerate(texts[:3]):
        n, total = plain_score(model, text)
        assert abs(got[i] - total) < 1e-4 * n
    assert got[3] == 0


def test_small_trees_lose_what_single_walks_lose():
    rng = np.random.default_rng(6)
    tree = rng.normal(0, 1, (lm.LEAVES, lm.HIDDEN + 1)).astype(np.float32)
    tiers = lm._tiers(tree)
    for leaf in ([0], [lm.LEAVES - 1] * 3, rng.integers(0, lm.LEAVES, 200), [5, 5, 6, 9000]):
        leaf = np.sort(np.array(leaf, np.int16))
        hidden = rng.normal(0, 1, (len(leaf), lm.HIDDEN + 1)).astype(np.float32)
        got = lm._lost(tiers, leaf, hidden)
        for i, at in enumerate(leaf.tolist()):
            lost = 0.0
            for level in range(lm.BITS):
                logit = float(hidden[i] @ tree[1 << level | at >> (lm.BITS - level)])
                bit = at >> (lm.BITS - 1 - level) & 1
                lost += np.log1p(np.exp(-logit if bit else logit))
            assert abs(got[i] - lost) < 1e-3


def test_slopes_of_equal_words_are_summed():
    rng = np.random.default_rng(7)
    for words in (rng.integers(0, 9, 40), np.arange(5), np.zeros(4, int)):
        rows, order = rng.normal(0, 1, (len(words), 3)), np.argsort(words, kind="stable")
        starts, sizes = lm._runs(words[order])
        assert np.allclose(lm._summed(rows, order, starts, sizes),
                           [rows[words == x].sum(0) for x in np.unique(words)])
