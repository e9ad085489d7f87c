"""Shards of nearly equal bytes by Karmarkar-Karp differencing of indivisible groups.

Equal texts are one group and stay together. Groups above a 1/``BUNDLES`` share of all bytes
are items of their own, of which there are at most ``BUNDLES``; the others are put into
``BUNDLES`` bundles by hash. So the differencing sees at most 2 * ``BUNDLES`` items, whatever
the data, and a bundle is a small part of a shard.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import sum_before
from terrane.session import written

BUNDLES = 8192
#: Bytes that a row counts besides its text.
OVERHEAD = 16
#: Rows of a bucket, in which a shard's rows are numbered, on average.
BUCKET_ROWS = 1000


def difference(sizes: dict[int, int], n: int) -> dict[int, int]:
    """Item to shard: the partial partitions with the largest spread are combined, the larger
    parts of one with the smaller parts of the other, until one partition is left."""
    heap = []
    for at, (item, size) in enumerate(sorted(sizes.items(), key=lambda x: (-x[1], x[0]))):
        parts = [(size, item), *[(0, None)] * (n - 1)]
        heap.append((-size if n > 1 else 0, at, parts))
    heapq.heapify(heap)
    at = len(heap)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        parts = [(a + b, (x, y) if x is not None and y is not None else x if y is None else y)
                 for (a, x), (b, y) in zip(one, reversed(two), strict=True)]
        parts.sort(key=lambda p: -p[0])
        heapq.heappush(heap, (parts[-1][0] - parts[0][0], at, parts))
        at += 1
    found: dict[int, int] = {}
    for shard, (_, tree) in enumerate(heap[0][2] if heap else []):
        left = [tree]
        while left:
            node = left.pop()
            if isinstance(node, tuple):
                left += node
            elif node is not None:
                found[node] = shard
    return found


def shards(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of ``docs``.

    Null texts have no bytes and are a group of their own; empty texts are another. Repeated
    rows are rows each, in the same shard. A group larger than a shard's part stays whole and
    the other shards share the rest. ``slot`` counts a shard's rows from 0. An empty table
    gives an empty one; columns besides doc_id and text are not read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = written(docs.select(
        "doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64("text").alias("text_hash"),
    ), "sized")
    whole = rows.agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).first()
    groups = rows.groupBy("text_hash").agg(F.sum("size").alias("size"))
    # items: -1 - i is the i-th large group, other numbers are bundles
    large = sorted(groups.where(F.col("size") * BUNDLES > F.lit(whole["size"] or 0)).collect())
    spark = docs.sparkSession
    own = spark.createDataFrame(
        [(g["text_hash"], -1 - i) for i, g in enumerate(large)], "text_hash long, own int")
    item = F.coalesce(
        "own", F.pmod(F.xxhash64("text_hash"), F.lit(BUNDLES)).cast("int")).alias("item")
    placed = rows.join(F.broadcast(own), "text_hash", "left").select(
        "doc_id", "size", "text_crc32", "text_hash", item)
    sizes = {r["item"]: r["size"] for r in
             placed.groupBy("item").agg(F.sum("size").alias("size")).collect()}
    to_shard = spark.createDataFrame(list(difference(sizes, n).items()), "item int, shard int")
    buckets = max(1, -(-whole["n"] // (n * BUCKET_ROWS)))
    dealt = placed.join(F.broadcast(to_shard), "item").withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets))).withColumn(
        "one", F.lit(1))
    order = [F.asc("doc_id"), F.asc("text_hash")]
    return sum_before(dealt, ["shard"], "bucket", order, "one", "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
