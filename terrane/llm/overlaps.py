"""All pairs of sets with a Jaccard similarity of at least a limit, by their prefixes.

Each set is put in one order of all hashes, the rarest first. Two sets that share a part
``SIMILARITY`` of their union then share a hash among the first n - ceil(SIMILARITY * n) + 1
of each, so sets meet at the hashes of their prefixes, and none is lost. How rare a hash is,
is known by counts of 2 ** ``BITS`` cells of hashes; any counts give all pairs, good ones give
few others.

Bounds that no similar pair fails thin out what meets: by the sizes and the places of the
hash, and by a bitmap of the parities of the hashes per cell, which differ in at most as many
bits as the sets differ in hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import arrow_map, tasks, texts_of

#: A set is similar to another if it shares OVER / UNDER of their union, compared in integers.
OVER, UNDER = 4, 5
SIMILARITY = OVER / UNDER
#: Bits of a hash that name its cell.
BITS = 16
#: Smallest bitmap; a larger set has the next power of two above its size, in bits.
NARROW = 256
#: Rows of a hash that one task compares; larger groups are cut into blocks.
CROWD = 20_000
#: Groups up to this size are compared row by row together with others.
SMALL = 8
#: Pairs of a group that are compared at once.
STEP = 1 << 18
#: Pairs that a task hands on at once.
PAIRS = 1 << 16

Sets = Callable[[str], np.ndarray]


def cells(docs: DataFrame, sets: Sets) -> np.ndarray:
    """Occurrences of the hashes of all texts per cell: 2 ** ``BITS`` numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for text in texts_of(batch):
                at, n = np.unique(sets(text) >> np.uint64(64 - BITS), return_counts=True)
                counts[at.astype(np.int64)] += n
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["at", "n"])

    found = docs.select("text").mapInArrow(run, "at long, n long")
    total = found.groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << BITS, np.int64)
    counts[total["at"].to_numpy(np.int64)] = total["n"].to_numpy(np.int64)
    return counts


def prefix(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first hashes of a set (sorted and distinct), the rarest first."""
    n = len(hashes)
    order = np.argsort(counts[(hashes >> np.uint64(64 - BITS)).astype(np.int64)], kind="stable")
    return hashes[order[:n - (-(-OVER * n // UNDER)) + 1 if n else 0]]


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Bytes whose bits are the parities of the hashes per cell; halves of a wide bitmap make,
    by XOR, the one of half its width."""
    width = max(NARROW, 1 << (max(1, len(hashes)) - 1).bit_length())
    counts = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((counts & 1).astype(bool), bitorder="little")


def apart(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ: at most the hashes that are in one set only."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def prefixes(
    docs: DataFrame, sets: Sets, name: Callable[[np.ndarray], int], counts: np.ndarray,
) -> DataFrame:
    """(id, size, keys, map) of each text of ``docs``: the name of its set, a 64-bit number, the
    size, the hashes of the prefix, and the bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # half a MB, whatever the data

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found = [sets(x) for x in texts_of(batch)]
        keys = [prefix(h, shared.value).view(np.int64) for h in found]
        return {"id": pa.array([name(h) for h in found], pa.int64()),
                "size": pa.array([len(h) for h in found], pa.int64()),
                "keys": pa.array(keys, pa.list_(pa.int64())),
                "map": pa.array([bitmap(h).tobytes() for h in found], pa.binary())}

    return arrow_map(docs.select("text"), run,
                     "id long, size long, keys array<long>, map binary").drop("text")


def _may(n: np.ndarray, at: np.ndarray, m: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Whether different sets of n and m hashes whose first common one is at these places may
    be similar: they share no more than what is left from there in either, and not all."""
    shared = np.minimum(np.minimum(n - at, m - to), np.maximum(n, m) - 1)
    return (OVER + UNDER) * shared >= OVER * (n + m)


def _group(rows: np.ndarray) -> Iterator[np.ndarray]:
    """(a, b) of rows (id, root, size, place) of one hash that may be similar."""
    rows = rows[np.argsort(rows[:, 2], kind="stable")]
    size = rows[:, 2]
    ends = np.searchsorted(size * OVER, size * UNDER, side="right")  # the largest that may be
    start = 0
    while start < len(rows):
        stop, widest = start + 1, max(1, ends[start] - start)
        while stop < len(rows) and (stop + 1 - start) * (ends[stop] - start) <= STEP:
            stop += 1
            widest = ends[stop - 1] - start
        some, others = rows[start:stop, None], rows[None, start:start + widest]
        hit = _may(some[..., 2], some[..., 3], others[..., 2], others[..., 3])
        hit &= some[..., 1] != others[..., 1]
        i, j = np.nonzero(np.triu(hit, 1))
        for at in range(0, len(i), PAIRS):
            yield np.stack([rows[start + i[at:at + PAIRS], 0],
                            rows[start + j[at:at + PAIRS], 0]], axis=1)
        start = stop


def _met(keys: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(0, pairs), or (group size, rows with their key first) of crowded groups, of rows (id,
    root, size, place) sorted by key."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    left = np.repeat(starts + sizes, sizes) - np.arange(len(keys))  # rows to the group's end
    left[np.repeat(sizes > SMALL, sizes)] = 0
    for lag in range(1, SMALL):
        i = np.flatnonzero(left > lag)
        a, b = rows[i], rows[i + lag]
        hit = _may(a[:, 2], a[:, 3], b[:, 2], b[:, 3]) & (a[:, 1] != b[:, 1])
        yield 0, np.stack([a[hit, 0], b[hit, 0]], axis=1)
    for k in np.flatnonzero(sizes > SMALL):
        part = slice(starts[k], starts[k] + sizes[k])
        if sizes[k] > CROWD:
            yield int(sizes[k]), np.c_[keys[part], rows[part]]
        else:
            yield from ((0, pairs) for pairs in _group(rows[part]))


COLUMNS = ["id", "root", "size", "place"]


def meet(rows: DataFrame) -> DataFrame:
    """(n, a, b, c, d, e) of rows (key, id, root, size, place): n = 0 is a pair (a, b) of ids
    that may be similar, a larger n marks a row of a crowded key, with its columns.

    Rows are dealt by key and sorted by Spark; a task holds the key it is at.
    """
    def made(keys: list[np.ndarray], parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for n, found in _met(np.concatenate(keys), np.concatenate(parts)):
            if len(found):
                wide = np.zeros((len(found), 5), np.int64)
                wide[:, :found.shape[1]] = found
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), n)), *map(pa.array, wide.T.copy())],
                    names=["n", *"abcde"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, parts = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column("key").to_numpy(zero_copy_only=False)
            r = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in COLUMNS], axis=1)
            cut = int(np.searchsorted(k, k[-1]))  # the last key may go on
            if keys and (cut or keys[-1][-1] != k[0]):
                yield from made([*keys, k[:cut]], [*parts, r[:cut]])
                keys, parts = [], []
            elif cut:
                yield from made([k[:cut]], [r[:cut]])
            keys.append(k[cut:])
            parts.append(r[cut:])
        if keys:
            yield from made(keys, parts)

    return (rows.select("key", *COLUMNS).repartition(tasks(rows.sparkSession), "key")
            .sortWithinPartitions("key")
            .mapInArrow(run, "n long, a long, b long, c long, d long, e long"))


def blocks(crowded: DataFrame) -> DataFrame:
    """Rows of crowded keys (as ``meet`` marks them) under new keys, so that every two rows of a
    key meet in a group of about ``CROWD`` rows: by hash into blocks, two blocks a group."""
    own = F.pmod(F.xxhash64("b"), F.col("parts"))
    return (
        crowded.withColumn("parts", F.ceil(F.col("n") * 4 / F.lit(CROWD)).cast("long"))
        .withColumn("own", own).withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)")))
        .select(F.xxhash64("a", F.least("own", "other"), F.greatest("own", "other")).alias("key"),
                F.col("b").alias("id"), F.col("c").alias("root"), F.col("d").alias("size"),
                F.col("e").alias("place")))


def thinned(pairs: DataFrame, maps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose bitmaps in ``maps`` (id, size, map) allow them to be similar."""
    def named(side: str) -> DataFrame:
        return maps.select(F.col("id").alias(side), F.col("size").alias(f"n{side}"),
                           F.col("map").alias(f"m{side}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = sum(batch.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb"))
            bits = np.fromiter(
                map(apart, batch.column("ma").to_pylist(), batch.column("mb").to_pylist()),
                np.int64, batch.num_rows)
            # J >= s means that at most (1 - s) / (1 + s) of both sizes are in one set only
            keep = (OVER + UNDER) * bits <= (UNDER - OVER) * total
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    both = pairs.join(named("a"), "a").join(named("b"), "b")
    return both.select("a", "b", "na", "nb", "ma", "mb").mapInArrow(run, "a long, b long")
