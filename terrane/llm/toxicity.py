"""Toxicity by cumulative-link ordinal regression on sparse words.

Grades run from 0 (clean) to 3. The labels only say toxic or not, so the grade of a toxic
document in the fit is 1, 2, or 3 by the thirds of its evidence: the sum of 1 + log(count) over
its markers, words that occur in toxic documents more than in others. That is also the value
of a word in the regression. One weight per word serves all
thresholds: P(grade <= j) = sigmoid(threshold_j - weights . x), with ordered thresholds. The
severity is the expected grade.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from terrane.llm.common import arrow_filter, arrow_map, label_sample, texts_of
from terrane.session import written

#: Bound of the labelled rows that the fit reads, chosen by hash of the id.
MAX_ROWS = 20_000
#: Bound of the words in the model, and how surely a word must part the labels: twice the
#: log likelihood ratio, far beyond chance for some 100,000 candidate words.
MAX_WORDS, MIN_EVIDENCE = 4096, 24.0
GRADES = 3
PENALTY, STEPS = 0.005, 1000
TOKEN = re.compile(r"\w+")
#: Similarity of word pairs from which rows are copies, min-hashes taken to find them, and how
#: many must agree; copies with fewer are one in 40 million.
SIMILAR, MARKS, AGREE = 0.8, 16, 4


def pair_hashes(words: list[str]) -> np.ndarray:
    """Distinct 32-bit hashes of neighbouring words; of a single word, or none, that itself."""
    pairs = [" ".join(p) for p in zip(words, words[1:], strict=False)] or [" ".join(words)]
    return np.unique(np.fromiter(map(xxh32_intdigest, pairs), np.uint32, len(pairs))).view(np.int32)


def least_hashes(pairs: np.ndarray) -> np.ndarray:
    """``MARKS`` min-hashes of a set of pairs."""
    rng = np.random.default_rng(MARKS)
    mixed = pairs.view(np.uint32).astype(np.uint64)
    out = np.empty(MARKS, np.int64)
    for i, odd in enumerate(rng.integers(0, 1 << 63, MARKS, np.uint64) * np.uint64(2) + np.uint64(1)):
        value = mixed * odd
        out[i] = ((value ^ (value >> np.uint64(29))) * odd).min().view(np.int64)
    return out


def _suspects(marks: np.ndarray, left: np.ndarray) -> set[tuple[int, int]]:
    """(row, earlier row) of the rows ``left``, in order: at each min-hash a row is held against
    the first one that has it, if ``AGREE`` min-hashes are the same."""
    found = set()
    for i in range(MARKS):
        _, first, group = np.unique(marks[left, i], return_index=True, return_inverse=True)
        leader = left[first[group]]
        same = (marks[left] == marks[leader]).sum(1) >= AGREE
        pick = np.flatnonzero(same & (leader != left))
        found.update(zip(left[pick].tolist(), leader[pick].tolist(), strict=True))
    return found


def without_copies(rows: DataFrame) -> DataFrame:
    """``rows`` (row, doc_id, toxic, pairs, marks, ...) without those whose pairs have a Jaccard
    similarity of at least ``SIMILAR`` with a row that stays and has the same label.

    Of the rows, whose number is bounded, only the min-hashes come to the driver; similarity
    is taken from the whole sets of pairs. A copy stays if at each min-hash that it shares
    with its like another row is the first.
    """
    spark = rows.sparkSession
    got = rows.select("row", "doc_id", "toxic", "marks").toPandas()
    if got.empty:
        return rows
    marks = np.array(got["marks"].tolist(), np.int64)
    order = np.lexsort([*marks.T, got["doc_id"].to_numpy()])
    marks, number = marks[order], got["row"].to_numpy()[order]
    toxic = got["toxic"].to_numpy(bool)[order]
    left, known, dropped = np.arange(len(number)), {}, []
    while True:
        pairs = set().union(*(_suspects(marks, left[toxic[left] == x]) for x in (False, True)))
        new = sorted(pairs - known.keys())
        if new:
            asked = spark.createDataFrame(
                [(a, b, int(number[a]), int(number[b])) for a, b in new],
                "a int, b int, row long, other long")
            # the asked pairs are no more than rows and min-hashes; only their sets are moved
            one = rows.select("row", F.col("pairs").alias("p")).join(F.broadcast(asked), "row")
            other = rows.select(F.col("row").alias("other"), F.col("pairs").alias("q")).join(
                F.broadcast(asked.select("other").distinct()), "other")
            both = F.size(F.array_intersect("p", "q"))
            near = both >= SIMILAR * (F.size("p") + F.size("q") - both)
            known |= {(r["a"], r["b"]): r["near"] for r in one.join(
                other, "other").select("a", "b", near.alias("near")).collect()}
        near = {}
        for a, b in pairs:
            if known[a, b]:
                near.setdefault(a, []).append(b)
        gone = set()
        for a in sorted(near):  # a row that goes itself takes no other with it
            if any(b not in gone for b in near[a]):
                gone.add(a)
        if not gone:
            break
        dropped += gone
        left = np.array([i for i in left if i not in gone], np.int64)
    if not dropped:
        return rows
    away = spark.createDataFrame([(int(number[i]),) for i in dropped], "row long")
    return rows.join(F.broadcast(away), "row", "left_anti")


@dataclass(frozen=True)
class Model:
    """Word indices, their weights, the thresholds below the grades 1, 2, 3, and the sum of
    weights from which a document is rejected."""

    words: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float

    def logits(self, text: str) -> float:
        known = Counter(filter(self.words.__contains__, TOKEN.findall(text.lower())))
        if not known:
            return 0.0
        at = np.fromiter(map(self.words.__getitem__, known), np.int64, len(known))
        counts = np.fromiter(known.values(), float, len(known))
        return float((1 + np.log(counts)) @ self.weights[at])

    def above(self, logits: np.ndarray) -> np.ndarray:
        """P(grade > j) for j = 0, 1, 2."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - logits[:, None], -50, 50)))


def fit_cumulative(
    row: np.ndarray, col: np.ndarray, value: np.ndarray, grade: np.ndarray, n_words: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds that maximise the penalised likelihood, by Adam."""
    n = len(grade)
    share = [np.clip((grade <= j).mean(), 0.5 / n, 1 - 0.5 / n) for j in range(GRADES)]
    start = np.maximum.accumulate(np.log(np.divide(share, np.subtract(1, share))))
    theta = np.r_[np.zeros(n_words), start[0], np.log(np.maximum(np.diff(start), 0.05))]
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    onehot = np.arange(GRADES)[None, :] == grade[:, None]
    before = np.arange(GRADES)[None, :] == grade[:, None] - 1
    for step in range(1, STEPS + 1):
        weights, base, gaps = theta[:n_words], theta[n_words], np.exp(theta[n_words + 1:])
        cuts = base + np.r_[0, np.cumsum(gaps)]
        logits = np.bincount(row, value * weights[col], n)
        under = 1 / (1 + np.exp(np.clip(logits[:, None] - cuts, -50, 50)))
        high = np.where(grade < GRADES, (under * onehot).sum(1), 1.0)
        low = (under * before).sum(1)
        chance = np.maximum(high - low, 1e-12)
        slope = under * (1 - under)
        by_cut = (slope * onehot - slope * before) / chance[:, None]
        to_logit = by_cut.sum(1)  # = -d log p / d logit
        by_cut = -by_cut.sum(0) / n
        grad = np.r_[
            np.bincount(col, value * to_logit[row], n_words) / n + PENALTY * weights / n_words,
            by_cut.sum(), [by_cut[j + 1:].sum() * gaps[j] for j in range(GRADES - 1)]]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad ** 2
        theta = theta - 0.1 * (first / (1 - 0.9 ** step)) / (
            np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return theta[:n_words], theta[n_words] + np.r_[0, np.cumsum(np.exp(theta[n_words + 1:]))]


def best_cut(logits: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the fewest errors, in the middle of the widest gap that has as few."""
    order = np.argsort(logits, kind="stable")
    value, bad = logits[order], toxic[order]
    # a cut below the i-th value misses the toxic ones before it
    errors = np.r_[0, np.cumsum(bad)] + (~bad).sum() - np.r_[0, np.cumsum(~bad)]
    edges = np.r_[value[0] - 1, value, value[-1] + 1]
    width = np.diff(edges)
    errors = np.where(width > 0, errors, len(logits) + 1)
    at = max(np.flatnonzero(errors == errors.min()), key=lambda i: width[i])
    return float((edges[at] + edges[at + 1]) / 2)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """The model of ``labels`` (doc_id, toxic) on the texts of ``docs`` (doc_id, text).

    Reads whole texts of at most ``max_rows`` labelled documents, of which near copies with the
    same label, by verified similarity, count once. Of an id with several texts, the one with
    the least hash is read. Null labels, labels of unknown ids and null ids are passed over;
    without any toxic label nothing is toxic.
    """
    sample = label_sample(labels, "toxic", max_rows)

    def counted(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = [TOKEN.findall(x.lower()) for x in texts_of(batch)]
        found, pairs = [Counter(x) for x in texts], [pair_hashes(x) for x in texts]
        return {"words": pa.array([list(c) for c in found], pa.list_(pa.string())),
                "counts": pa.array([list(c.values()) for c in found], pa.list_(pa.int32())),
                "pairs": pa.array(pairs, pa.list_(pa.int32())),
                "marks": pa.array(map(least_hashes, pairs), pa.list_(pa.int64()))}

    # one text per id, so that repeated ids leave the rows as bounded as the labels
    text = F.coalesce("text", F.lit(""))
    known = docs.select("doc_id", text.alias("text")).join(
        F.broadcast(sample), "doc_id").groupBy("doc_id", "y").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = arrow_map(
        known, counted,
        "words array<string>, counts array<int>, pairs array<int>, marks array<long>").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", (F.col("y") >= 0.5).alias("toxic"),
        "words", "counts", "pairs", "marks")
    # copies would make any of their words look like a sign of their label
    rows = without_copies(written(rows, "toxic-words"))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("toxic").alias("toxic")).first()
    n, n_toxic = size["n"], size["toxic"]
    if not n_toxic:
        return Model({}, np.zeros(0), np.array([9.0, 10.0, 11.0]), np.inf)

    pos, neg = F.col("pos"), F.col("df") - F.col("pos")
    miss_pos, miss_neg = F.lit(n_toxic) - pos, F.lit(n - n_toxic) - neg

    def term(seen, whole, part):
        return F.when(seen > 0, seen * F.log(seen * F.lit(float(n)) / (whole * F.lit(part))))\
            .otherwise(0.0)

    rest = F.lit(n) - F.col("df")
    evidence = 2 * (
        term(pos, F.col("df"), float(n_toxic)) + term(neg, F.col("df"), float(n - n_toxic))
        + term(miss_pos, rest, float(n_toxic)) + term(miss_neg, rest, float(n - n_toxic)))
    chosen = (
        rows.select("toxic", F.explode("words").alias("word"))
        .groupBy("word").agg(F.count(F.lit(1)).alias("df"), F.count_if("toxic").alias("pos"))
        .withColumn("evidence", evidence).where(F.col("evidence") >= MIN_EVIDENCE)
        .orderBy(F.desc("evidence"), "word").limit(MAX_WORDS).collect())
    words = {r["word"]: i for i, r in enumerate(chosen)}
    marks = {r["word"] for r in chosen if r["pos"] * (n - n_toxic) > (r["df"] - r["pos"]) * n_toxic}

    def vectors(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        at, values, marked = [], [], []
        for ws, cs in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(),
                          strict=True):
            own = [(words[w], c) for w, c in zip(ws, cs, strict=True) if w in words]
            at.append([i for i, _ in own])
            values.append([c for _, c in own])
            marked.append(sum(1 + np.log(c) for w, c in zip(ws, cs, strict=True) if w in marks))
        return {"at": pa.array(at, pa.list_(pa.int32())),
                "n_at": pa.array(values, pa.list_(pa.int32())),
                "marked": pa.array(marked, pa.float64())}

    got = (arrow_map(rows, vectors, "at array<int>, n_at array<int>, marked double")
           .select("doc_id", "toxic", "at", "n_at", "marked").toPandas())
    got = got.sort_values(["doc_id", "marked"], kind="stable")
    toxic, marked = got["toxic"].to_numpy(bool), got["marked"].to_numpy()
    cuts = np.quantile(marked[toxic], [1 / 3, 2 / 3])
    grade = np.where(toxic, 1 + (marked[:, None] > cuts).sum(1), 0)
    sizes = got["at"].map(len).to_numpy()
    row = np.repeat(np.arange(len(got)), sizes)
    none = np.zeros(0, np.int64)
    col = np.concatenate([none, *got["at"]]).astype(np.int64)
    value = 1 + np.log(np.concatenate([none, *got["n_at"]]).astype(float))
    weights, thresholds = fit_cumulative(row, col, value, grade, len(words))
    logits = np.bincount(row, value * weights[col], len(got))
    return Model(words, weights, thresholds, best_cut(logits, toxic))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``severity`` (0 to 3), ``grade``, ``p_toxic`` = P(grade > 0), and
    ``rejected``: the sum of weights reaches the model's cut. Null and empty texts hold no words, so they get the score of a text
    without known words. Rows and other columns stay as they are."""
    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        logits = np.array([model.logits(x) for x in texts_of(batch)])
        above = model.above(logits)
        return {"severity": pa.array(above.sum(1)), "p_toxic": pa.array(above[:, 0]),
                "grade": pa.array((above >= 0.5).sum(1).astype(np.int32)),
                "rejected": pa.array(logits >= model.cut)}

    return arrow_map(docs, run, "severity double, p_toxic double, grade int, rejected boolean")


def clean(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` that the model does not reject, as they are; the cases are ``score``'s."""
    def keep(batch: pa.RecordBatch) -> list[bool]:
        return [model.logits(x) < model.cut for x in texts_of(batch)]

    return arrow_filter(docs, keep, ["text"])
