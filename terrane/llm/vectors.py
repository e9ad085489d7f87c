"""Vectors in tiles: every block of queries meets every shard of the candidates once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import tasks

#: Most candidates of a shard and queries of a block, on average; a tile's memory follows.
SHARD_ROWS, BLOCK_ROWS = 4096, 1024
#: Top lists that meet at once.
FAN = 16
BETTER = ("(a, b) -> case when a.score > b.score then -1 when a.score < b.score then 1 "
          "when a.id < b.id then -1 when a.id > b.id then 1 else 0 end")


def usable(vectors: DataFrame, zero: bool, also: Sequence[str] = ()) -> DataFrame:
    """(id, v, dim) of rows with an id whose vector has no null or non-finite component, and,
    unless ``zero``, a component other than 0; columns ``also`` stay."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("embedding").cast("array<double>").alias("v"), *also,
    ).where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(~bad)
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    return rows.withColumn("dim", F.size("v"))


def matrix(table: pa.Table, name: str, dim: int) -> np.ndarray:
    """Rows of an array column whose arrays all have ``dim`` components."""
    flat = table.column(name).combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(table.num_rows, dim)


def tiled_top(
    rows: DataFrame, every: int, k: int,
    per_tile: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list],
    score_type: str,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best of every query, an id that
    ``every`` divides, in ``rows`` (id, v, dim).

    ``per_tile(query ids, queries, ids, vectors)`` returns for each query a list of (score,
    id), best first, greater scores before smaller ones, ties by id. Only vectors with as many
    components are compared. A tile holds one block of queries and one shard, both bounded;
    lists are merged ``FAN`` at a time, so that nothing grows with the number of shards.
    """
    spark = rows.sparkSession
    queries = rows.where(F.col("id") % every == 0).select(
        "id", "v", "dim", F.xxhash64("v").alias("which")).distinct()
    n, n_queries = rows.count(), queries.count()
    shards = max(tasks(spark), -(-n // SHARD_ROWS))
    blocks = max(1, -(-n_queries // BLOCK_ROWS))
    asked = queries.select(
        "dim", F.col("id").alias("q_id"), "which", F.col("v").alias("q"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("id", "which"), F.lit(blocks)).cast("int").alias("block"))
    held = rows.select(
        "dim", "id", "v",
        F.pmod(F.xxhash64("id", F.xxhash64("v")), F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    best = f"array<struct<score: {score_type}, id: bigint>>"

    def tile(key, asked: pa.Table, held: pa.Table) -> pa.Table:
        dim, shard = key[0].as_py(), key[1].as_py()
        own = asked.column("q_id").to_numpy()
        lists = [[]] * len(own)
        if len(own) and held.num_rows:
            order = np.argsort(held.column("id").to_numpy(), kind="stable")
            lists = per_tile(own, matrix(asked, "q", dim),
                             held.column("id").to_numpy()[order], matrix(held, "v", dim)[order])
        return pa.table({
            "query_id": asked.column("q_id"), "which": asked.column("which"),
            "at": pa.array(np.full(len(own), shard, np.int64)),
            "best": pa.array([[{"score": s, "id": i} for s, i in x] for x in lists],
                             pa.list_(pa.struct([("score", pa.int64() if score_type == "bigint"
                                                  else pa.float64()), ("id", pa.int64())])))})

    keys = ["dim", "shard", "block"]
    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(
        tile, f"query_id long, which long, at long, best {best}")
    merged = F.expr(f"slice(array_sort(flatten(collect_list(best)), {BETTER}), 1, {k})")
    while shards > 1:
        shards = -(-shards // FAN)
        found = found.groupBy("query_id", "which", F.floor(F.col("at") / FAN).alias("at")).agg(
            merged.alias("best"))
    return found.select("query_id", F.posexplode("best").alias("i", "x")).select(
        "query_id", (F.col("i") + 1).cast("int").alias("rank"),
        F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))

