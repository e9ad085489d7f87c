"""Exact top-k search by integer inner product.

Queries and candidates meet in tiles; a tile is one matrix product, of which each query keeps
its best, and the lists of the tiles are merged as a tree.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from terrane.llm.vectors import tiled_top, usable

GRID = 1024
#: Queries of one matrix product.
STEP = 128


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers held as doubles, without any rounding."""
    top = max(1.0, np.abs(queries).max(initial=0)) * max(1.0, np.abs(vectors).max(initial=0))
    if top * max(1, vectors.shape[1]) < 2.0 ** 53:
        return queries @ vectors.T
    whole = [[int(x) for x in row] for row in vectors]
    return np.array([[sum(int(a) * b for a, b in zip(q, v, strict=True)) for v in whole]
                     for q in queries], object).reshape(len(queries), len(vectors))


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple]:
    """The ``k`` greatest with ties to smaller ids; ``ids`` ascend."""
    if len(ids) > k:
        least = np.partition(scores, len(ids) - k)[len(ids) - k]
        sure = np.flatnonzero(scores > least)
        tied = np.flatnonzero(scores == least)[:k - len(sure)]
        pick = np.r_[sure, tied]
    else:
        pick = np.arange(len(ids))
    pick = sorted(pick, key=lambda i: (-scores[i], ids[i]))
    limit = 2 ** 63
    return [(max(-limit, min(limit - 1, int(scores[i]))), int(ids[i])) for i in pick]


def search(vectors: DataFrame, every: int, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` greatest inner products of floor(1024 x).

    ``vectors`` has vec_id and embedding; queries are the ids divisible by ``every``.
    Candidates of a query are all rows with another vec_id and as many components. Rows with a null id, a
    null vector, or a null or non-finite component take no part; empty vectors score 0.
    Repeated rows are candidates each; a repeated query counts once. Scores beyond a long are
    set to its limit after ranking within a tile. Fewer candidates give fewer rows.
    """
    rows = usable(vectors, zero=True)

    def per_tile(own, queries, ids, held):
        held, queries = np.floor(GRID * held), np.floor(GRID * queries)
        out = []
        for at in range(0, len(own), STEP):
            scores = products(queries[at:at + STEP], held)
            for row, q in zip(scores, own[at:at + STEP], strict=True):
                other = ids != q
                out.append(best_of(row[other], ids[other], k))
        return out

    return tiled_top(rows, every, k, per_tile, "bigint")


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
r AS (
  SELECT query_id, row_number() OVER (
    PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 10
"""
