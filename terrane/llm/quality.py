"""Quality by ridge regression on random Fourier features of document statistics.

cos(w . x + b) with random w approximates a Gaussian kernel over the standardised
statistics. Tasks add up their part of the normal equations, the sums meet in two steps, and
one small system is solved. Isotonic regression over a fine histogram of the raw scores turns
them into chances of label 1.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import arrow_filter, arrow_map, held_out, label_sample, texts_of
from terrane.session import written

#: Bound of the labelled rows that the fit reads, chosen by hash of the id.
MAX_ROWS = 40_000
FEATURES, WIDTH, RIDGE, SEED = 512, 3.0, 1e-3, 7
#: Tasks that add up normal equations, and how many of their sums meet at once.
SUMS, FAN = 16, 4
BINS = 1024
CUT = 0.3
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def statistics(text: str) -> list[float]:
    """Shape, repetition, and character statistics of a whole text."""
    raw = text.encode()
    n = len(raw)
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if n else np.zeros(256)
    words, lines = text.split(), text.split("\n")
    nw, nl, size = max(1, len(words)), max(1, len(lines)), max(1, n)
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    counts = Counter(words)
    top = counts.most_common(3)
    pairs = len(set(zip(words, words[1:], strict=False)))
    line_counts = Counter(lines)
    line_sizes = np.fromiter(map(len, lines), float, len(lines))
    upper, lower = bytes_[65:91].sum(), bytes_[97:123].sum()
    share = bytes_[bytes_ > 0] / size
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(nl),
        lengths.mean(), lengths.std(), np.log1p(lengths.max()),
        len(counts) / nw, pairs / nw, top[0][1] / nw if top else 0.0,
        sum(c for _, c in top) / nw, sum(map(eq, words, words[1:])) / nw,
        len(line_counts) / nl, line_counts.most_common(1)[0][1] / nl,
        np.log1p(line_sizes.mean()), np.log1p(line_sizes.std()),
        upper / max(1, upper + lower), bytes_[48:58].sum() / size, bytes_[128:].sum() / size,
        bytes_[PUNCTUATION].sum() / size, bytes_[[33, 63]].sum() / nw, bytes_[124] / nw,
        bytes_[[44, 46]].sum() / nw, bytes_[[32, 9, 10, 13]].sum() / size,
        bytes_[[35, 36, 38, 42, 47, 60, 61, 62, 64, 92, 94, 95, 123, 125, 126]].sum() / size,
        float(-(share * np.log(share)).sum()), sum(map(str.isupper, words)) / nw,
        sum(map(str.istitle, words)) / nw, (lengths <= 2).mean(), (lengths >= 12).mean(),
    ]


N_STATISTICS = len(statistics(""))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    chance: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(x), 1))])

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.features(x) @ self.weights, self.raw, self.chance), 0, 1)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``stats``, an array of doubles; null is the empty text."""
    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"stats": pa.array([statistics(x) for x in texts_of(batch, text)],
                                  pa.list_(pa.float64()))}

    return arrow_map(docs, run, "stats array<double>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("stats").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, N_STATISTICS)


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Non-decreasing values nearest to ``value``, by pooling neighbours that violate."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        blocks.append([v * w, w, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w2, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + w2, blocks[-1][2] + n]
    return np.concatenate([np.full(int(n), s / w) for s, w, n in blocks])


def _summed(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of f f' and f y over (stats, y), added up in tasks and then ``FAN`` at a time."""
    size = len(model.phases) + 1

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            f = model.features(_matrix(batch))
            y = batch.column("y").to_numpy(zero_copy_only=False)
            total += f.T @ np.hstack([f, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["total"])

    def merged(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, float) for x in table.column("total").to_pylist())
        return pa.table({"total": pa.array([total.tobytes()])})

    # the rows are a bounded table, so few tasks read it as it lies, without a shuffle
    sums = rows.select("stats", "y").coalesce(SUMS).mapInArrow(part, "total binary")
    sums = sums.withColumn("group", F.spark_partition_id() % FAN).groupBy("group").applyInArrow(
        lambda t: merged(t.select(["total"])), "total binary")
    total = sum(np.frombuffer(r["total"], float) for r in sums.collect())
    total = np.reshape(total, (size, size + 1))
    return total[:, :size], total[:, size]


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """The model of ``labels`` (doc_id, quality) on whole texts of ``docs`` (doc_id, text).

    Only ids that are not held out teach, at most ``max_rows`` of them. Null labels, null
    ids, and labels of unknown ids are passed over. Without labels every score is 0.5, and
    with one class only it is that class.
    """
    sample = label_sample(labels.where(~held_out(F.col("doc_id"))), "quality", max_rows)
    known = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = written(with_statistics(known).select("doc_id", "y", "stats"), "statistics")
    moments = rows.select(
        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(N_STATISTICS)],
        *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(N_STATISTICS)],
        F.min("y").alias("low"), F.max("y").alias("high")).first()
    rng = np.random.default_rng(SEED)
    directions = rng.normal(size=(N_STATISTICS, FEATURES)) / (
        WIDTH * np.sqrt(N_STATISTICS) / np.sqrt(8))
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    low, high = moments["low"], moments["high"]
    if low is None or low == high:
        flat = 0.5 if low is None else low
        return Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS), directions, phases,
                     np.zeros(FEATURES + 1), np.array([0.0]), np.array([flat]))
    mean = np.array([moments[f"m{i}"] for i in range(N_STATISTICS)])
    scale = np.array([moments[f"s{i}"] for i in range(N_STATISTICS)])
    blank = Model(mean, np.where(scale > 1e-9, scale, 1.0), directions, phases,
                  np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))
    gram, moment = _summed(rows, blank)
    n = gram[-1, -1]
    weights = np.linalg.solve(gram + RIDGE * n / FEATURES * np.eye(len(gram)), moment)
    edges = np.linspace(-0.5, 1.5, BINS + 1)

    def binned(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        raw = blank.features(_matrix(batch)) @ weights
        return {"raw": pa.array(raw),
                "bin": pa.array(np.clip(np.searchsorted(edges, raw) - 1, 0, BINS - 1), pa.int32())}

    bins = (arrow_map(rows, binned, "raw double, bin int").groupBy("bin")
            .agg(F.avg("raw").alias("raw"), F.avg("y").alias("y"),
                 F.count(F.lit(1)).cast("double").alias("n")).toPandas().sort_values("bin"))
    chance = isotonic(bins["y"].to_numpy(), bins["n"].to_numpy())
    return Model(blank.mean, blank.scale, directions, phases, weights,
                 bins["raw"].to_numpy(), chance)


def _scores(batch: pa.RecordBatch, model: Model) -> np.ndarray:
    x = np.array([statistics(t) for t in texts_of(batch)]).reshape(-1, N_STATISTICS)
    return model.predict(x)


def good(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of ``docs`` whose score reaches ``CUT``, as they are; the cases are ``score``'s."""
    return arrow_filter(docs, lambda batch: (_scores(batch, model) >= CUT).tolist(), ["text"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 if score >= ``CUT``), ``held_out``.

    Null and empty texts get the score of an empty text. Rows and other columns stay."""
    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found = _scores(batch, model)
        return {"score": pa.array(found), "predicted": pa.array((found >= CUT).astype(np.int32))}

    return arrow_map(docs, run, "score double, predicted int").withColumn(
        "held_out", held_out(F.col("doc_id")))
