"""Near-duplicate documents by SimHash, linked through anchor points of a covering code.

Two fingerprints of 64 bits with at most 3 differing bits have a half with at most 1. In each
half, the 31 low bits are a word of the perfect Hamming code's space: its code words, the
anchors, cover every word within radius 1. A fingerprint goes to every anchor within the
covering radius plus the threshold, 1 + 1, of each half: at most 16 anchors a half. A pair
meets at the anchor that is nearest to either of them, and is compared there on all 64 bits.
(Leaving out the last bit of a half never raises a distance, so no pair is lost.)

Work is done on distinct fingerprints, so copies cost nothing. At an anchor, only links that
keep its linked fingerprints together are returned, never all pairs. An anchor with more than
``CROWD`` fingerprints is split by the bytes of the other half, of which a linked pair shares
at least one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from terrane.llm.common import arrow_map, texts_of
from terrane.llm.components import components
from terrane.session import written

SHINGLE = 3
SEED = 42
#: Bits by which linked fingerprints may differ. The halves and the code follow from it.
THRESHOLD = 3
CROWD = 50_000
#: Groups up to this size are compared row by row together with others.
SMALL = 8
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str) -> int:
    """SimHash of the word shingles of a text; 0 for a text without words.

    Words are parted by ASCII white space and only A-Z are lower-cased, which is what
    ``bytes.split`` and ``bytes.lower`` do.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    parts = [words[i:] for i in range(SHINGLE)] if len(words) >= SHINGLE else None
    shingles = map(b" ".join, zip(*parts, strict=False)) if parts else iter([b" ".join(words)])
    n = max(1, len(words) - SHINGLE + 1)
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        part = hashes[at:at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", out: str = "f") -> DataFrame:
    """``docs`` with a signed 64-bit fingerprint; null is the empty text."""
    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found = np.array([fingerprint(x) for x in texts_of(batch, text)], np.uint64)
        return {out: pa.array(found.view(np.int64))}

    return arrow_map(docs, run, f"`{out}` long")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """XOR of the positions, 1 to 31, of the set bits of 31-bit words."""
    found = np.zeros(len(words), np.int64)
    for i in range(31):
        found ^= ((words >> i) & 1) * (i + 1)
    return found


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For 31-bit words: indices, and the code words at distance 2 or less of each."""
    syndrome = _syndromes(words)
    at = [np.arange(len(words))]
    flip = np.where(syndrome > 0, 1 << np.maximum(syndrome - 1, 0), 0)
    found = [words ^ flip]
    for i in range(1, 32):
        j = i ^ syndrome
        pick = np.flatnonzero((syndrome > 0) & (j > i))
        at.append(pick)
        found.append(words[pick] ^ (1 << (i - 1)) ^ (1 << (j[pick] - 1)))
    return np.concatenate(at), np.concatenate(found)


def at_anchors(prints: DataFrame) -> DataFrame:
    """Rows (anchor, f): each fingerprint at each of its anchors of both halves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = batch.column("f").to_numpy(zero_copy_only=False)
            for half in (0, 1):
                at, words = anchors((f >> (32 * half)) & 0x7FFFFFFF)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words | (half << 40)), pa.array(f[at])], names=["anchor", "f"])

    return prints.select("f").mapInArrow(run, "anchor long, f long")


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= THRESHOLD


def star_links(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the linked fingerprints of one group: each to the first found."""
    left, a, b = f, [], []
    while len(left):
        root, left, front = left[0], left[1:], left[:1]
        while len(front) and len(left):
            hit = np.zeros(len(left), bool)
            step = max(1, (1 << 20) // len(left))
            for i in range(0, len(front), step):
                open_ = np.flatnonzero(~hit)
                hit[open_] = _near(front[i:i + step, None], left[None, open_]).any(axis=0)
            front, left = left[hit], left[~hit]
            a.append(np.full(len(front), root))
            b.append(front)
    none = np.empty(0, np.int64)
    return np.concatenate(a or [none]), np.concatenate(b or [none])


def _links(keys: np.ndarray, f: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Links, or the rows of crowded keys, in rows sorted by key whose groups are whole."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    size_of = np.repeat(sizes, sizes)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(keys))  # rows to the group's end
    for lag in range(1, SMALL):
        i = np.flatnonzero((size_of <= SMALL) & (left > lag))
        i = i[_near(f[i], f[i + lag])]
        yield 0, f[i], f[i + lag]
    for k in np.flatnonzero(sizes > SMALL):
        rows = slice(starts[k], starts[k] + sizes[k])
        if sizes[k] > CROWD:
            yield 1, keys[rows], f[rows]
        else:
            yield 0, *star_links(f[rows])


def compare(rows: DataFrame, split: bool) -> DataFrame:
    """(kind, a, b) of rows (anchor, f): kind 0 is a link, kind 1 a row of a crowded anchor.

    Rows are dealt by anchor and sorted by Spark; a task holds one Arrow batch and the
    anchor that reaches into the next. Without ``split`` no anchor counts as crowded.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys, f):
            for kind, a, b in _links(keys, f):
                if kind and not split:
                    kind, (a, b) = 0, star_links(b)
                if len(a):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)],
                        names=["kind", "a", "b"])

        keys, prints = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            k, f = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "f"))
            cut = int(np.searchsorted(k, k[-1]))  # the last anchor may go on
            if cut or (keys and keys[-1][-1] != k[0]):
                done_k, done_f = np.concatenate([*keys, k[:cut]]), np.concatenate([*prints, f[:cut]])
                if len(done_k):
                    yield from out(done_k, done_f)
                keys, prints = [], []
            keys.append(k[cut:])
            prints.append(f[cut:])
        if keys:
            yield from out(np.concatenate(keys), np.concatenate(prints))

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(tasks, "anchor").sortWithinPartitions("anchor")
            .mapInArrow(run, "kind int, a long, b long"))


def links(prints: DataFrame) -> DataFrame:
    """(a, b) of distinct fingerprints ``f``: links that connect exactly what pairs with at
    most ``THRESHOLD`` differing bits connect."""
    found = written(compare(at_anchors(prints), split=True), "anchor-links")
    near = found.where("kind = 0").select("a", "b")
    crowded = found.where("kind = 1").select(F.col("a").alias("anchor"), F.col("b").alias("f"))
    if crowded.isEmpty():
        return near
    other = F.when(F.shiftrightunsigned("anchor", 40) == 0, 32).otherwise(0)
    byte = F.expr("shiftrightunsigned(f, other + 8 * i) & 255")
    finer = (
        crowded.withColumn("other", other)
        .withColumn("i", F.explode(F.array(*map(F.lit, range(4)))))
        .select(F.xxhash64("anchor", "i", byte).alias("anchor"), "f")
    )
    return near.union(compare(finer, split=False).select("a", "b"))


def classes(prints: DataFrame) -> DataFrame:
    """(f, root) of every fingerprint in ``prints`` (f, distinct): the class it belongs to."""
    rooted = components(links(prints)).select(F.col("node").alias("f"), "root")
    return prints.select("f").join(rooted, "f", "left").select(
        "f", F.coalesce("root", "f").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id, f) for each row of ``docs`` (doc_id, text).

    Null and empty texts have fingerprint 0 and are linked like any other. Repeated rows
    stay. ``component_id`` is the smallest doc_id reached; null ids are passed over, and
    where a class has no other, it is null. An empty table gives an empty one. Columns
    besides doc_id and text are not read.
    """
    rows = written(
        with_fingerprints(docs.select("doc_id", "text")).select("doc_id", "f"), "fingerprints")
    per_print = rows.groupBy("f").agg(F.min("doc_id").alias("least"))
    with_root = per_print.join(classes(written(per_print.select("f"), "prints")), "f")
    least = with_root.groupBy("root").agg(F.min("least").alias("component_id"))
    per_print = with_root.join(least, "root").select("f", "component_id")
    return rows.join(per_print, "f").select(
        "doc_id", F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"), "component_id", "f")
