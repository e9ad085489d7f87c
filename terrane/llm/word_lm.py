"""Language-model scores by masked pseudo-likelihood, word by word.

A small window network predicts every word from the two words on either side, without seeing
it. A word is known by its 64-bit hash. The network's inputs are words by hash leaf, and its
target is a leaf of a binary tree over the bits of the hash, one learned decision per bit, so
that nothing depends on how frequent words are. Inside a leaf, a word's chance is its share of
the leaf's occurrences. The counts of all words are a Spark table over all documents, which
grows with the corpus and is joined with the words of the documents.

Every position of every document is a training example. Tasks train on their own examples
from the same start, and their networks are averaged by examples, in steps of ``FAN``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from terrane.llm.common import arrow_map, texts_of
from terrane.session import written

#: Bits of the hash that the tree decides, and its leaves.
BITS = 14
LEAVES = 1 << BITS
#: The empty place before the first and after the last word.
EDGE = LEAVES
HIDDEN, ROUNDS, BATCH, SPEED, SEED = 32, 2, 1024, 0.1, 5
AROUND = (-2, -1, 1, 2)
FAN = 8
#: Words that one training task reads, about; a network is some 4 MB whatever it reads.
TASK_WORDS = 4_000_000
#: Most frequent words, whose counts go to every task; the others are joined.
COMMON = 50_000
#: Occurrences that an unseen word of a leaf counts for, and every seen one has on top.
EXTRA = 0.5
MEMORY = 200_000
#: Parts of 1 in which logarithms of joined counts are summed, as whole numbers.
POINT = 1 << 26
#: Upper levels of the tree that are one product in training.
TOP = 5
#: Rows that a step changes at once, so that they stay in a processor's cache.
STEP = 1024
#: Words that are sorted by leaf to be scored, how many of them at once, and the levels of the
#: tree in each product there.
CHUNK, BLOCK = 1 << 16, 1 << 12
TIERS = (5, 5, 4)


class Hashes(dict):
    """Hash of each word met so far, signed."""

    def __missing__(self, word: bytes) -> int:
        found = xxh64_intdigest(word)
        found -= (found >> 63) << 64
        if len(word) <= 64:
            if len(self) >= MEMORY:
                self.clear()
            self[word] = found
        return found


def tokens(text: str, hashes: Hashes) -> np.ndarray:
    words = text.encode().lower().split()
    return np.fromiter(map(hashes.__getitem__, words), np.int64, len(words))


def leaves(ids: np.ndarray) -> np.ndarray:
    return (ids.view(np.uint64) >> np.uint64(64 - BITS)).astype(np.int32)


def tokenized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``tokens``, the hashes as 64-bit numbers; null is the empty text."""
    def run(batch: pa.RecordBatch, hashes: Hashes) -> dict[str, pa.Array]:
        return {"tokens": pa.array(
            [tokens(x, hashes).astype("<i8").tobytes() for x in texts_of(batch)], pa.binary())}

    return arrow_map(docs, run, "tokens binary", Hashes)


@dataclass(frozen=True)
class Model:
    """``net``: word vectors, a matrix per place, the base, and the tree's vectors and bases.
    ``common`` and ``common_n``: sorted hashes and their occurrences; ``mass``: occurrences per
    leaf with the extra ones; ``words``: (word, n) of all words; ``trained``: examples a round."""

    net: list[np.ndarray]
    common: np.ndarray
    common_n: np.ndarray
    mass: np.ndarray
    trained: int
    words: DataFrame = field(repr=False)


def _start() -> list[np.ndarray]:
    rng = np.random.default_rng(SEED)
    return [
        rng.normal(0, 0.2, (LEAVES + 1, HIDDEN)).astype(np.float32),
        rng.normal(0, HIDDEN ** -0.5, (len(AROUND), HIDDEN, HIDDEN)).astype(np.float32),
        np.zeros(HIDDEN, np.float32),
        np.zeros((LEAVES, HIDDEN), np.float32), np.zeros(LEAVES, np.float32)]


def _pack(net: list[np.ndarray]) -> bytes:
    return np.concatenate([x.ravel() for x in net]).astype("<f4").tobytes()


def _unpack(packed: np.ndarray) -> list[np.ndarray]:
    out, at = [], 0
    for like in _start():
        out.append(packed[at:at + like.size].reshape(like.shape).astype(np.float32))
        at += like.size
    return out


def _line(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of the words of some documents in one line, with two empty places before, between,
    and after the documents, and the places of the words."""
    gap = np.full(2, EDGE, np.int16)
    line = np.concatenate([gap, *[x for c in texts for x in (leaves(c).astype(np.int16), gap)]])
    return line, np.flatnonzero(line != EDGE)


def _span(line: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The part of a line from the first to the last of the places ``at``, and two on each side."""
    return line[at[0] - 2:at[-1] + 3]


def _hidden(net: list[np.ndarray], words: np.ndarray) -> np.ndarray:
    """Hidden states of a span whose places have the vectors ``words``, without the outer two."""
    n = len(words) - 4
    total = words[2 + AROUND[0]:2 + AROUND[0] + n] @ net[1][0]
    for j, place in zip(AROUND[1:], net[1][1:], strict=True):
        total += words[2 + j:2 + j + n] @ place
    total += net[2]
    return np.tanh(total, out=total)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal values of a sorted array start, and their sizes."""
    first = np.ones(len(values) + 1, bool)
    np.not_equal(values[1:], values[:-1], out=first[1:-1])
    ends = first.nonzero()[0]
    return ends[:-1], ends[1:] - ends[:-1]


class Paths:
    """The paths to sorted leaves, for products without a copy of a node per word.

    The upper ``TOP`` levels are one dense product. Below them, leaves of one branch share no
    node with the others, so each branch is a small dense product of its words and its distinct
    nodes. ``high`` and ``low`` say where each word's own nodes are in these products, ``bits``
    the turns taken there. The products of the branches stand one after the other in ``flat``.
    """

    def __init__(self, leaf: np.ndarray):
        n, level = len(leaf), np.arange(BITS)[:, None]
        self.bits = (leaf >> (BITS - 1 - level).astype(leaf.dtype)) & 1
        leaf = leaf.astype(np.intp)
        self.high = ((leaf | LEAVES) >> (BITS - level[:TOP])) + (np.arange(n) << TOP)
        runs, times = _runs(leaf)  # all that follows up to ``low`` is for each distinct leaf
        path = (leaf[runs] | LEAVES) >> (BITS - level[TOP:])
        first = np.ones(path.shape, bool)
        np.not_equal(path[:, 1:], path[:, :-1], out=first[:, 1:])
        by_leaf = np.ascontiguousarray(first.T)  # nodes are numbered by leaf, then level
        self.nodes = path.T[by_leaf]
        rank = (by_leaf.cumsum() - 1).reshape(by_leaf.shape).T * first
        np.maximum.accumulate(rank, axis=1, out=rank)
        heads = first[0].nonzero()[0]
        starts, begin = np.append(runs[heads], n), np.append(rank[0, heads], len(self.nodes))
        sizes, kinds = starts[1:] - starts[:-1], begin[1:] - begin[:-1]
        corners = (sizes * kinds).cumsum()
        kind = kinds.repeat(sizes)
        row = np.arange(n) * kind
        row += (corners - starts[1:] * kinds - begin[:-1]).repeat(sizes)
        self.low = rank.repeat(times, axis=1)
        self.low += row
        self.flat = np.empty(corners[-1], np.float32)
        self.parts, at = [], 0
        for a, size, i, kind in zip(*(
                x.tolist() for x in (starts[:-1], sizes, begin[:-1], kinds)), strict=True):
            part = self.flat[at:at + size * kind].reshape(size, kind)
            self.parts.append((part, slice(a, a + size), slice(i, i + kind)))
            at += size * kind

    def logits(self, tree: np.ndarray, own: np.ndarray, hidden: np.ndarray) -> np.ndarray:
        """Logits (BITS, n). ``own``: rows of ``tree`` of the distinct nodes; the last column of
        both is the base, that of ``hidden`` 1."""
        for part, words, nodes in self.parts:
            np.dot(hidden[words], own[nodes].T, out=part)
        found = np.empty(self.bits.shape, np.float32)
        upper = (hidden @ tree[:1 << TOP].T).ravel()
        upper.take(self.high, out=found[:TOP], mode="clip")
        self.flat.take(self.low, out=found[TOP:], mode="clip")
        return found

    def slopes(self, tree: np.ndarray, own: np.ndarray, hidden: np.ndarray,
               error: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slopes of the hidden states, of the upper nodes, and of the distinct nodes below."""
        upper = np.zeros((len(hidden), 1 << TOP), np.float32)
        upper.ravel()[self.high] = error[:TOP]
        self.flat.fill(0)
        self.flat[self.low] = error[TOP:]
        back, to_own = np.empty_like(hidden), np.empty_like(own)
        for part, words, nodes in self.parts:
            np.dot(part, own[nodes], out=back[words])
            np.dot(part.T, hidden[words], out=to_own[nodes])
        back += upper @ tree[:1 << TOP]
        return back[:, :HIDDEN], upper.T @ hidden, to_own


def _sorted(span: np.ndarray, hidden: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ``n`` words of a span by leaf, and their hidden states with a last 1."""
    order = np.argsort(span[2:-2], kind="stable")[:n]  # empty places come last
    out = np.ones((n, HIDDEN + 1), np.float32)
    out[:, :HIDDEN] = hidden.take(order, axis=0)
    return order, out


def _rows(x: np.ndarray) -> np.ndarray:
    """The rows of a table as single items, which are set at places much faster."""
    return x.view(np.dtype((np.void, x.itemsize * x.shape[1])))[:, 0]


def _summed(rows: np.ndarray, order: np.ndarray, starts: np.ndarray,
            sizes: np.ndarray) -> np.ndarray:
    """Sums of ``rows`` in this order, over runs, most of which have one row."""
    out = rows.take(order[starts], axis=0)
    many = (sizes > 1).nonzero()[0]
    if len(many):
        some = rows.take(order[(sizes > 1).repeat(sizes)], axis=0)
        at = sizes[many].cumsum()
        out[many] = np.add.reduceat(some, at - sizes[many], axis=0)
    return out


def _slope(seen: np.ndarray, slope: np.ndarray) -> np.ndarray:
    """The Adagrad step for slopes; ``seen`` takes in their squares. ``slope`` is used up."""
    seen += slope * slope
    slope *= SPEED
    slope /= np.sqrt(seen)
    return slope


def _step(param: np.ndarray, seen: np.ndarray, slope: np.ndarray) -> None:
    """One Adagrad step, in place."""
    param -= _slope(seen, slope)


def _step_at(param: np.ndarray, seen: np.ndarray, at: np.ndarray, old: np.ndarray,
             slope: np.ndarray) -> None:
    """One Adagrad step on the different rows ``at``, which were ``old``, some at a time."""
    params, all_seen = _rows(param), _rows(seen)
    for i in range(0, len(at), STEP):
        some = at[i:i + STEP]
        total, new = seen.take(some, axis=0), old[i:i + STEP]
        new -= _slope(total, slope[i:i + STEP])
        all_seen[some] = _rows(total)
        params[some] = _rows(new)


def _train(net: list[np.ndarray], seen: list[np.ndarray], span: np.ndarray, n: int) -> None:
    """One step on the ``n`` words of a span, in place. ``net`` has the tree's bases as a last
    column of its vectors, ``seen`` the squared slopes so far."""
    words, tree = net[0].take(span, axis=0), net[3]
    order, hidden = _sorted(span, _hidden(net, words), n)
    paths = Paths(span[2:-2][order])
    own = tree.take(paths.nodes, axis=0)
    error = paths.logits(tree, own, hidden)
    np.clip(error, -50, 50, out=error)
    np.exp(np.negative(error, out=error), out=error)
    error += 1
    np.divide(1, error, out=error)
    error -= paths.bits
    error /= n
    back, to_upper, to_own = paths.slopes(tree, own, hidden, error)
    back = back * (1 - hidden ** 2)[:, :HIDDEN]
    placed = np.zeros((len(span) - 4, HIDDEN), np.float32)
    placed[order] = back
    to_words, places = np.zeros_like(words), np.empty_like(net[1])
    for j, at in enumerate(AROUND):
        seen_by = slice(2 + at, 2 + at + len(placed))
        np.dot(words[seen_by].T, placed, out=places[j])
        to_words[seen_by] += placed @ net[1][j].T
    order = np.argsort(span, kind="stable")
    span = span.take(order)
    starts, sizes = _runs(span)
    to_words = _summed(to_words, order, starts, sizes)
    _step_at(tree, seen[3], paths.nodes, own, to_own)
    _step(tree[1:1 << TOP], seen[3][1:1 << TOP], to_upper[1:])
    _step_at(net[0], seen[0], span[starts], words.take(order[starts], axis=0), to_words)
    _step(net[1], seen[1], places)
    _step(net[2], seen[2], np.ones(n, np.float32) @ back)


def _round(rows: DataFrame, net: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """One pass of all tasks over their examples: the average of their networks, and the
    number of examples."""
    shared = rows.sparkSession.sparkContext.broadcast(net)  # about 4 MB

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *own, vectors, bases = (x.copy() for x in shared.value)
        own.append(np.column_stack([vectors, bases]))
        seen = [np.full_like(x, 1e-6) for x in own]
        total = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = batch.column("tokens").slice(at, 256).to_pylist()
                line, places = _line([np.frombuffer(x, "<i8") for x in texts])
                for i in range(0, len(places), BATCH):
                    some = places[i:i + BATCH]
                    _train(own, seen, _span(line, some), len(some))
                total += len(places)
        own[3:] = own[3][:, :HIDDEN], own[3][:, HIDDEN]
        yield pa.RecordBatch.from_arrays(
            [pa.array([float(total)]), pa.array([_pack(own)])], names=["n", "net"])

    def merged(table: pa.Table) -> pa.Table:
        weight = np.array(table.column("n").to_pylist())
        nets = [np.frombuffer(x, "<f4") for x in table.column("net").to_pylist()]
        total = weight.sum()
        share = weight / total if total else np.full(len(weight), 1 / len(weight))
        mean = np.zeros(len(nets[0]))
        for i in np.lexsort(([x[0] for x in nets], weight)):  # does not depend on the arrival
            mean += share[i] * nets[i]
        return pa.table({"n": [float(total)], "net": [mean.astype("<f4").tobytes()]})

    nets = rows.select("tokens").mapInArrow(part, "n double, net binary")
    parts = rows.rdd.getNumPartitions()
    nets = nets.withColumn("at", F.spark_partition_id())
    while parts > 1:
        parts = -(-parts // FAN)
        nets = nets.withColumn("at", F.floor(F.col("at") / FAN).cast("int"))
        nets = nets.groupBy("at").applyInArrow(
            lambda key, t: merged(t.select(["n", "net"])).append_column(
                "at", pa.array([key[0].as_py()], pa.int32())), "n double, net binary, at int")
    got = nets.collect()
    if not got:
        return net, 0
    return _unpack(np.frombuffer(got[0]["net"], "<f4")), int(got[0]["n"])


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n): occurrences of every word in all documents."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = b"".join(batch.column("tokens").to_pylist())
            word, n = np.unique(np.frombuffer(some, "<i8"), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word, pa.int64()), pa.array(n, pa.int64())], names=["word", "n"])

    found = rows.select("tokens").mapInArrow(part, "word long, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model of all texts of ``docs``. Its network does not grow with the data, its word
    table does."""
    return fit_tokens(written(tokenized(docs.select("text")).select("tokens"), "tokens"), rounds)


def fit_tokens(rows: DataFrame, rounds: int = ROUNDS) -> Model:
    """``fit`` on a written table of ``tokenized`` documents."""
    words = written(word_counts(rows), "words")
    leaf = F.shiftrightunsigned("word", 64 - BITS)
    per_leaf = words.groupBy(leaf.cast("int").alias("leaf")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).toPandas()
    mass = np.full(LEAVES, EXTRA)
    mass[per_leaf["leaf"].to_numpy(np.int64)] += (
        per_leaf["n"].to_numpy(float) + EXTRA * per_leaf["words"].to_numpy(float))
    top = words.orderBy(F.desc("n"), "word").limit(COMMON).toPandas().sort_values("word")
    total = int(per_leaf["n"].sum())
    dealt = rows.coalesce(max(1, -(-total // TASK_WORDS)))
    net, trained = _start(), 0
    for _ in range(rounds):
        net, trained = _round(dealt, net)
    return Model(net, top["word"].to_numpy(np.int64), top["n"].to_numpy(float), mass, trained,
                 words)


def _tiers(tree: np.ndarray) -> list[np.ndarray]:
    """The tree as whole small trees: for each of ``TIERS``, those below the ones before, each
    with its nodes numbered like those of the whole tree."""
    out, above = [], 0
    for levels in TIERS:
        node = np.arange(1 << levels)
        depth = np.maximum(np.frexp(node)[1] - 1, 0)
        roots = (1 << above) + np.arange(1 << above)[:, None]
        out.append(tree[(roots << depth) + node - (1 << depth)])
        above += levels
    return out


def _lost(tiers: list[np.ndarray], leaf: np.ndarray, hidden: np.ndarray) -> np.ndarray:
    """-log P of sorted leaves: each small tree is one product with all words that pass it."""
    lost, left = np.zeros(len(leaf)), BITS
    leaf = leaf.astype(np.intp)
    row = np.arange(len(leaf))
    for tier in tiers:
        size = tier.shape[1]
        levels = size.bit_length() - 1
        starts, sizes = _runs(leaf >> left)
        product = np.empty((len(leaf), size), np.float32)
        for a, n, tree in zip(starts.tolist(), sizes.tolist(), (leaf[starts] >> left).tolist(),
                              strict=True):
            np.dot(hidden[a:a + n], tier[tree].T, out=product[a:a + n])
        left -= levels
        own = (leaf >> left) & (size - 1) | size
        row_at = row * size
        for level in range(levels):
            turned = product.ravel().take(row_at + (own >> (levels - level)))
            turned *= 1 - 2 * (own >> (levels - 1 - level) & 1)
            lost += np.maximum(turned, 0) + np.log(1 + np.exp(-np.abs(turned)))
    return lost


def log_likelihoods(net: list[np.ndarray], mass: np.ndarray,
                    texts: list[np.ndarray]) -> np.ndarray:
    """Summed log P(leaf | the words around it) - log mass of the leaf, of each text."""
    sizes = np.array([len(x) for x in texts], np.int64)
    if not sizes.sum():
        return np.zeros(len(texts))
    line, places = _line(texts)
    tiers = _tiers(np.column_stack([net[3], net[4]]))
    found = -np.log(mass)[line[places]]
    for at in range(0, len(places), CHUNK):
        some = places[at:at + CHUNK]
        hidden = np.ones((len(some), HIDDEN + 1), np.float32)
        for i in range(0, len(some), BATCH):
            part = some[i:i + BATCH]
            states = _hidden(net, net[0].take(_span(line, part), axis=0))
            hidden[i:i + BATCH, :HIDDEN] = states.take(part - part[0], axis=0)
        leaf = line[some]
        order = np.argsort(leaf, kind="stable")
        for i in range(0, len(some), BLOCK):
            part = order[i:i + BLOCK]
            found[at + part] -= _lost(tiers, leaf[part], hidden.take(part, axis=0))
    sums = np.zeros(len(texts))
    some = np.flatnonzero(sizes)
    sums[some] = np.add.reduceat(found, (np.cumsum(sizes) - sizes)[some])
    return sums


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, n_tokens, log_likelihood, mean_log_likelihood).

    Null and empty texts have no words: 0, 0.0, and a null mean. Repeated rows are scored
    each; an empty table gives an empty one. Words that the model has not seen count as the
    unseen word of their leaf.
    """
    return score_tokens(tokenized(docs.select("doc_id", "text")), model)


def score_tokens(rows: DataFrame, model: Model) -> DataFrame:
    """``score`` of ``tokenized`` documents (doc_id, tokens)."""
    shared = rows.sparkSession.sparkContext.broadcast(  # about 5 MB
        (model.net, model.mass, model.common, model.common_n))

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        net, mass, common, common_n = shared.value
        texts = [np.frombuffer(x, "<i8") for x in batch.column("tokens").to_pylist()]
        sums = log_likelihoods(net, mass, texts)
        rare, times = [], []
        for i, ids in enumerate(texts):
            word, n = np.unique(ids, return_counts=True)
            at = np.minimum(np.searchsorted(common, word), max(len(common) - 1, 0))
            known = common[at] == word if len(common) else np.zeros(len(word), bool)
            sums[i] += n[known] @ np.log(common_n[at[known]] + EXTRA)
            rare.append(word[~known])
            times.append(n[~known])
        return {"n_tokens": pa.array([len(x) for x in texts], pa.int64()),
                "most": pa.array(sums), "rare": pa.array(rare, pa.list_(pa.int64())),
                "times": pa.array(times, pa.list_(pa.int64()))}

    found = written(
        arrow_map(rows.select("doc_id", "tokens"), run,
                  "n_tokens long, most double, rare array<long>, times array<long>")
        .select(F.monotonically_increasing_id().alias("doc"), "doc_id", "n_tokens", "most",
                "rare", "times"), "scored")
    rare = found.select("doc", F.explode(F.arrays_zip("rare", "times")).alias("w")).select(
        "doc", F.col("w.rare").alias("word"), F.col("w.times").alias("times"))
    # sums of whole numbers have no order, so that reruns agree after one exchange by document
    point = F.round(F.log(F.col("n") + EXTRA) * POINT).cast("long")
    unseen = F.lit(round(math.log(EXTRA) * POINT))
    rest = (
        rare.join(model.words.select("word", point.alias("point")), "word", "left")
        .groupBy("doc").agg(F.sum(F.col("times") * F.coalesce("point", unseen)).alias("rest")))
    both = found.join(rest, "doc", "left")
    total = F.col("most") + F.coalesce("rest", F.lit(0)) / POINT
    return both.select(
        "doc_id", "n_tokens", total.alias("log_likelihood"),
        F.try_divide(total, F.col("n_tokens")).alias("mean_log_likelihood"))
