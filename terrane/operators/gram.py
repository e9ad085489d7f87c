"""Sums of many factor sets in one pass, and the linear fits that follow from them.

A set is a list of columns, its z last. Every task reads blocks of rows, takes the complete ones
of each set, and keeps one vector of sums per set: no row is copied per set, and what is
shuffled is one vector per task and set. The matrix of cross sums of a set (its Gram matrix)
is all that least squares, its penalised kin, and a weighted pass need.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions.predicates import quoted

# Penalties of ridge, lasso, and elastic net, and the latter's share of the
# absolute penalty; the bend of the Huber loss in scales, and its passes.
ALPHA = 1.0
L1_SHARE = 0.5
BEND = 1.35
PASSES = 8
# mean absolute deviation of a normal variable with deviation 1, inverted
SCALE = 1.2533141373155003
# Relative size below which a direction of the axes counts as constant.
RANK = 1e-10
SWEEPS, SETTLED = 10_000, 1e-13

Set = tuple[tuple[str, ...], str]
Measure = Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def set_table(df: DataFrame, sets: Sequence[Set], train, number) -> tuple[DataFrame, list[list[int]]]:
    """(train, number, c0, c1, ...): the columns that the sets name, as doubles, and for each
    set the places of its columns in them, z last."""
    names = sorted({c for xs, z in sets for c in (*xs, z)})
    at = {c: i for i, c in enumerate(names)}
    table = df.select(
        train.alias("train"), number.alias("number"),
        *[quoted(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    return table, [[at[c] for c in (*xs, z)] for xs, z in sets]


def blocks_of(batches: Iterator[pa.RecordBatch]):
    """(values, train, number) of each batch; missing values are NaN."""
    for batch in batches:
        if batch.num_rows:
            columns = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[2:]]
            values = np.column_stack(columns) if columns else np.empty((batch.num_rows, 0))
            yield (values, batch.column(0).to_numpy(zero_copy_only=False),
                   batch.column(1).to_numpy(zero_copy_only=False))


def task_sums(table: DataFrame, places: Sequence[Sequence[int]], measure: Measure) -> DataFrame:
    """(set, sums): what ``measure(set, values, train, number)`` gives for the complete rows of
    the set, block by block, added up over all rows. Sets without such a row are absent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for values, train, number in blocks_of(batches):
            known = ~np.isnan(values)
            for i, columns in enumerate(places):
                whole = known[:, columns].all(axis=1)
                if whole.any():
                    got = measure(i, values[np.ix_(whole, columns)], train[whole].astype(bool),
                                  number[whole])
                    totals[i] = totals[i] + got if i in totals else got
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()),
             pa.array(list(totals.values()), pa.list_(pa.float64()))], ["set", "sums"])

    parts = table.mapInArrow(run, "set int, sums array<double>")
    entries = parts.select("set", F.posexplode("sums").alias("at", "value"))
    added = entries.groupBy("set", "at").agg(F.sum("value").alias("value"))
    return added.groupBy("set").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("sums"))


def collected(sums: DataFrame) -> dict[int, np.ndarray]:
    """The sums by set: as many vectors as sets were asked for."""
    return {r["set"]: np.array(r["sums"]) for r in sums.collect()}


def gram(rows: np.ndarray, middle: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Flat cross sums of (1, values less their ``middle``)."""
    a = np.column_stack([np.ones(len(rows)), rows - middle])
    return (a.T @ (a if weights is None else a * weights[:, None])).ravel()


class Moments:
    """Centered cross sums of one set: ``xx``, ``xz``, the means, and the weight."""

    def __init__(self, flat: np.ndarray, middle: np.ndarray):
        g = flat.reshape(len(middle) + 1, -1)
        self.n = g[0, 0]
        mean = g[0, 1:] / self.n
        spread = g[1:, 1:] - self.n * np.outer(mean, mean)
        self.xx, self.xz = spread[:-1, :-1], spread[:-1, -1]
        self.x, self.z = middle[:-1] + mean[:-1], middle[-1] + mean[-1]

    def line(self, slopes: np.ndarray) -> np.ndarray:
        """Intercept and slopes."""
        return np.r_[self.z - slopes @ self.x, slopes]


def mean_only(m: Moments) -> np.ndarray:
    return m.line(np.zeros(len(m.xz)))


def least_squares(m: Moments) -> np.ndarray:
    """The shortest of the best slopes if the axes depend on each other."""
    scale = np.sqrt(np.diag(m.xx))
    scale = np.where(scale > 0, scale, 1.0)
    unit = m.xx / np.outer(scale, scale)
    return m.line(np.linalg.pinv(unit, rcond=RANK, hermitian=True) @ (m.xz / scale) / scale)


def ridge(m: Moments) -> np.ndarray:
    return m.line(np.linalg.solve(m.xx + ALPHA * np.eye(len(m.xz)), m.xz))


def _descent(m: Moments, absolute: float, squared: float) -> np.ndarray:
    """Coordinate descent on mean squared error / 2 + absolute |w| + squared w^2 / 2."""
    xx, xz = m.xx / m.n, m.xz / m.n
    w = np.zeros(len(xz))
    for _ in range(SWEEPS):
        before = w.copy()
        for j in range(len(w)):
            pull = xz[j] - xx[j] @ w + xx[j, j] * w[j]
            size = xx[j, j] + squared
            w[j] = np.sign(pull) * max(abs(pull) - absolute, 0.0) / size if size > 0 else 0.0
        if np.abs(w - before).max(initial=0) <= SETTLED * np.abs(w).max(initial=0):
            break
    return m.line(w)


def lasso(m: Moments) -> np.ndarray:
    return _descent(m, ALPHA, 0.0)


def elastic_net(m: Moments) -> np.ndarray:
    return _descent(m, ALPHA * L1_SHARE, ALPHA * (1 - L1_SHARE))


def pursuit(m: Moments) -> np.ndarray:
    """Least squares on the tenth of the axes, but one at least, that are chosen one by one
    for the greatest correlation with what is left of z."""
    slopes, chosen = np.zeros(len(m.xz)), []
    for _ in range(max(1, len(m.xz) // 10)):
        left = m.xz - m.xx @ slopes
        own = np.diag(m.xx)
        fits = np.where(own > 0, left * left / np.where(own > 0, own, 1.0), -1.0)
        fits[chosen] = -1.0
        if fits.max() <= 0:
            break
        chosen.append(int(fits.argmax()))
        slopes = np.zeros(len(m.xz))
        slopes[chosen] = np.linalg.pinv(
            m.xx[np.ix_(chosen, chosen)], rcond=RANK, hermitian=True) @ m.xz[chosen]
    return m.line(slopes)


def guess(line: np.ndarray, xs: np.ndarray) -> np.ndarray:
    return line[0] + xs @ line[1:]


def huber(
    table: DataFrame, places: Sequence[Sequence[int]], middles: Sequence[np.ndarray],
    start: dict[int, np.ndarray],
) -> dict[int, np.ndarray]:
    """Lines under the Huber loss, by ``PASSES`` weighted passes for all sets at once.

    A residual beyond ``BEND`` scales weighs less, by how far it lies beyond. The scale is
    taken from the mean absolute residual of the pass before; the first pass has none.
    """
    lines, scales = dict(start), dict.fromkeys(start, np.inf)
    for _ in range(PASSES):
        now, width = dict(lines), dict(scales)

        def measure(i, rows, train, number):
            rows = rows[train]
            if i not in now:
                return np.zeros(1)
            gap = np.abs(rows[:, -1] - guess(now[i], rows[:, :-1]))
            far = gap > BEND * width[i]
            weight = np.where(far, BEND * width[i] / np.where(far, gap, 1.0), 1.0)
            return np.r_[len(rows), gap.sum(), gram(rows, middles[i], weight)]

        for i, sums in collected(task_sums(table, places, measure)).items():
            if i in now:
                scales[i] = SCALE * sums[1] / sums[0]
                lines[i] = least_squares(Moments(sums[2:], middles[i]))
    return lines
