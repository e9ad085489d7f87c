"""Approximate nearest neighbours by collision counting on single projections.

A shard keeps, for each of ``PROJECTIONS`` directions, its unit vectors sorted by their
projection. A query's window in each array is centred at its own projection. Windows grow by
``GROWTH`` in every round (virtual rehashing: a wider hash without a new table), and a vector
that lies in the windows of at least ``COLLISIONS`` of the arrays is verified with its exact
cosine. The rounds end when ``SHARE`` of the shard and k more have been verified, or all. As
queries end in rounds near each other, a query's rounds begin where the last query's ended.
Directions come in orthonormal sets, so that they tell as much as possible together.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from terrane.llm.vectors import tiled_top, usable

PROJECTIONS, COLLISIONS, SHARE, SEED = 64, 0.8, 0.1, 11
#: Half width of the first windows, and its factor in each round.
WIDTH, GROWTH = 0.05, 1.15
#: Queries whose windows are looked up together.
WINDOW_ROWS = 16


def directions(dim: int) -> np.ndarray:
    rng = np.random.default_rng([SEED, dim])
    sets = [np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(-(-PROJECTIONS // dim))]
    return np.hstack(sets)[:, :PROJECTIONS]


class Shard:
    """The sorted projections of unit vectors, one direction after the other in memory, so that
    a window is read from one place."""

    def __init__(self, unit: np.ndarray):
        self.axes = directions(unit.shape[1])
        places = (unit @ self.axes).T.copy()
        self.order = np.argsort(places, axis=1, kind="stable")
        self.sorted = np.take_along_axis(places, self.order, axis=1)
        self.n = len(unit)

    def windows(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows of unit vectors begin and end, by query, round, and direction."""
        rounds = int(np.ceil(np.log(2.1 / WIDTH) / np.log(GROWTH))) + 1
        widths = WIDTH * GROWTH ** np.arange(rounds)  # the last window holds every projection
        centres = np.stack([query @ self.axes for query in queries])[:, None, :]
        below, above = centres - widths[:, None], centres + widths[:, None]
        low, high = np.empty(below.shape, np.int64), np.empty(above.shape, np.int64)
        for j, places in enumerate(self.sorted):
            low[:, :, j] = np.searchsorted(places, below[:, :, j])
            high[:, :, j] = np.searchsorted(places, above[:, :, j], "right")
        return low, high

    def collisions(self, *spans: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """How often every row lies in spans of the arrays, given by their begins and ends."""
        parts = [rows[a:b] for begins, ends in spans
                 for rows, a, b in zip(self.order, begins.tolist(), ends.tolist(), strict=True)]
        return np.bincount(np.concatenate(parts), minlength=self.n)

    def candidates(self, low: np.ndarray, high: np.ndarray, k: int, r: int) -> tuple[
            np.ndarray, int]:
        """Rows that collide often enough with the query of these windows, in the first round
        that has enough of them, and that round.

        Windows of a later round hold those of an earlier one, so the rounds may begin at any
        ``r``: they go back while the round before has enough, and on while there are too few.
        """
        need = int(np.ceil(COLLISIONS * self.axes.shape[1]))
        enough = min(self.n, int(np.ceil(SHARE * self.n)) + k)
        counts = self.collisions((low[r], high[r]))
        if np.count_nonzero(counts >= need) >= enough:
            while r > 0:
                fewer = counts - self.collisions((low[r], low[r - 1]), (high[r - 1], high[r]))
                if np.count_nonzero(fewer >= need) < enough:
                    break
                counts, r = fewer, r - 1
        else:
            while r + 1 < len(low) and np.count_nonzero(counts >= need) < enough:
                r += 1
                counts += self.collisions((low[r], low[r - 1]), (high[r - 1], high[r]))
        return np.flatnonzero(counts >= need), r


def search(vectors: DataFrame, every: int, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` vectors found with the largest cosine.

    Queries are the ids divisible by ``every``; candidates of a query are all rows with another
    vec_id and as many components. Rows with a null id and vectors that are null, zero, or hold
    a null or non-finite component take no part. Every row is indexed and every candidate that
    collides is verified; ties go to smaller ids. Repeated rows are candidates each; a repeated
    query counts once. Fewer candidates give fewer rows, an empty table none.
    """
    rows = usable(vectors, zero=False)

    def per_tile(own, queries, ids, held):
        # scaled by the largest component, so that no square overflows or vanishes
        held = held / np.abs(held).max(axis=1, keepdims=True)
        queries = queries / np.abs(queries).max(axis=1, keepdims=True)
        norms = np.sqrt((held * held).sum(axis=1))
        shard = Shard(held / norms[:, None])
        out, r = [], 0
        for start in range(0, len(own), WINDOW_ROWS):
            some = queries[start:start + WINDOW_ROWS]
            sizes = np.array([np.sqrt((query * query).sum()) for query in some])
            windows = shard.windows(some / sizes[:, None])
            for q, query, norm, low, high in zip(
                    own[start:start + WINDOW_ROWS], some, sizes, *windows, strict=True):
                # one more for each row of the query's own id, which is no candidate; queries
                # end in rounds near each other, so the next begins where this one ended
                at, r = shard.candidates(low, high, k + int(np.count_nonzero(ids == q)), r)
                at = at[ids[at] != q]
                cosine = (held[at] * query).sum(axis=1) / (norms[at] * norm)
                pick = np.lexsort((ids[at], -cosine))[:k]
                out.append([(float(cosine[i]), int(ids[at[i]])) for i in pick])
        return out

    return tiled_top(rows, every, k, per_tile, "double")
