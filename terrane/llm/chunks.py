"""Context-triggered piecewise hashing.

A hash that rolls over seven bytes sets boundaries where its low bits are all zero, so a
boundary depends on what stands there and not on how much stands before it. Every chunk between
boundaries becomes one symbol of two characters. A fingerprint has the signature at its block
size, the smallest power of two that gives at most ``MOST`` chunks, and at twice this size.
Two fingerprints are compared by the edit distance of signatures of the same block size.

``compared`` needs the following document of each. Documents are cut into ranges of (id, hash
of the text); the first document of a range also goes to the range before it. Whole texts are
shuffled once and read in order, so a task holds two of them.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import OUT_ROWS, _small_batches, arrow_map, tasks, texts_of

WINDOW = 7
#: Most chunks of a signature, and the smallest block size as a power of two.
MOST, LEAST_POWER = 64, 1
#: Bytes hashed at a time.
SEGMENT = 1 << 18
#: Rows of a range, on average, and ranges per task at least.
RANGE_ROWS, RANGES = 65_536, 4
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
SYMBOLS = [a + b for a in ALPHABET for b in ALPHABET]

_STEP = np.uint32(0x01000193)
_MIX = np.uint32(0x9E3779B1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_ROLL = [np.uint32(pow(int(_STEP), WINDOW - 1 - i, 1 << 32)) for i in range(WINDOW)]
with np.errstate(over="ignore"):
    _POWERS, _BACKS = (
        np.concatenate([[np.uint64(1)], np.full(SEGMENT - 1, x, np.uint64)]).cumprod()
        for x in (_BASE, _BACK))


def _rolled(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte of ``data`` from the seventh on, its bits mixed."""
    n = len(data) - WINDOW + 1
    wide = data.astype(np.uint32)
    out = np.zeros(n, np.uint32)
    for i, factor in enumerate(_ROLL):
        out += wide[i:i + n] * factor
    out ^= out >> np.uint32(15)
    out *= _MIX
    return out >> np.uint32(8)


def _boundaries(data: np.ndarray, power: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of chunks at block size 2^power, and the hash at each."""
    ends, hashes = [], []
    mask = np.uint32((1 << power) - 1)
    for at in range(0, len(data) - WINDOW + 1, SEGMENT):
        rolled = _rolled(data[at:at + SEGMENT + WINDOW - 1])
        hit = np.flatnonzero((rolled & mask) == 0)
        ends.append(hit + at + WINDOW)
        hashes.append(rolled[hit])
    if not ends:
        return np.empty(0, np.int64), np.empty(0, np.uint32)
    return np.concatenate(ends), np.concatenate(hashes)


def _symbols(data: np.ndarray, ends: np.ndarray) -> str:
    """One symbol per chunk; the last chunk ends with the text."""
    if not len(data):
        return ""
    starts = np.r_[0, ends[ends < len(data)]]
    total = np.zeros(len(starts), np.uint64)
    for at in range(0, len(data), SEGMENT):
        part = data[at:at + SEGMENT].astype(np.uint64) + np.uint64(1)
        part *= _POWERS[:len(part)]
        # chunks of this segment; the first may have begun before it
        first = np.searchsorted(starts, at, "right") - 1
        last = np.searchsorted(starts, at + len(part), "left")
        sums = np.add.reduceat(part, np.maximum(starts[first:last] - at, 0))
        total[first:last] += sums * np.uint64(pow(_BASE, at, 1 << 64))
    total *= _BACKS[starts % SEGMENT]
    if len(data) > SEGMENT:
        total *= np.array([pow(_BACK, int(s), 1 << 64) for s in starts // SEGMENT * SEGMENT],
                          np.uint64)
    total ^= total >> np.uint64(32)
    total *= np.uint64(_BASE)
    return "".join([SYMBOLS[x] for x in (total >> np.uint64(52)).tolist()])


def fingerprint(text: str) -> str:
    """``power:signature:signature``: at block sizes 2^power and 2^(power + 1)."""
    data = np.frombuffer(text.encode(), np.uint8)
    with np.errstate(over="ignore"):
        # far fewer chunks than MOST are never expected at this size; if so, begin at the least
        power = max(LEAST_POWER, (len(data) // MOST).bit_length() - 2)
        ends, hashes = _boundaries(data, power)
        if len(ends) <= MOST and power > LEAST_POWER:
            power = LEAST_POWER
            ends, hashes = _boundaries(data, power)
        while len(ends) >= MOST:
            power += 1
            hit = (hashes & np.uint32((1 << power) - 1)) == 0
            if power > 24:  # beyond the bits of the hash: one chunk
                hit[:] = False
            ends, hashes = ends[hit], hashes[hit]
        twice = ends[(hashes & np.uint32((1 << power + 1) - 1)) == 0]
        return f"{power}:{_symbols(data, ends)}:{_symbols(data, twice)}"


def common_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, with one bit per symbol of ``a``."""
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        match = row & places.get(x, 0)
        row = (row + match | row - match) & full
    return len(a) - row.bit_count()


def _near(a: str, b: str) -> float:
    """1 less the edit distance (put in, leave out) as a share of both lengths."""
    x, y = ([s[i:i + 2] for i in range(0, len(s), 2)] for s in (a, b))
    return 2 * common_length(x, y) / (len(x) + len(y)) if x or y else 1.0


def likeness(a: str, b: str) -> float:
    """0 to 1: 1 for equal fingerprints, 0 if no block size is the same; else the greatest
    likeness of two signatures of one block size."""
    if a == b:
        return 1.0
    (p, *own), (q, *other) = a.split(":"), b.split(":")
    sizes = {int(p): own[0], int(p) + 1: own[1]}
    both = [(sizes[int(q) + i], other[i]) for i in (0, 1) if int(q) + i in sizes]
    return max((_near(*pair) for pair in both), default=0.0)


def fingerprints(docs: DataFrame, out: str = "fingerprint") -> DataFrame:
    """``docs`` and the fingerprint of each whole ``text`` as column ``out``.

    Null counts as the empty text, whose signatures are empty. Equal texts have equal
    fingerprints. All columns and rows stay; ``out`` must not be one of them (ValueError).
    """
    if out in docs.columns:
        raise ValueError(f"column {out} is there already")
    return arrow_map(
        docs, lambda part: {out: pa.array([fingerprint(t) for t in texts_of(part)], pa.string())},
        f"`{out}` string")


def likenesses(a: Column, b: Column) -> Column:
    """``likeness`` of two columns of fingerprints; null where either is null."""
    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else likeness(p, q)
                          for p, q in zip(x, y, strict=True)], dtype="float64")

    return run(a, b)


def _bounds(keys: DataFrame, ranges: int) -> list[tuple]:
    """The first (known, id, hash) of each range of the keys, ascending; their number is at
    most ``ranges``."""
    cut = keys.repartitionByRange(ranges, "known", "id", "h")
    firsts = cut.groupBy(F.spark_partition_id().alias("part")).agg(
        F.min(F.struct("known", "id", "h")).alias("first"))
    return sorted(tuple(r.first) for r in firsts.select("first").collect())


def _ranged(rows: DataFrame, bounds: list[tuple]) -> DataFrame:
    """Rows with ``place`` (range, edge): their own range, and for the first document of a
    range also the range before it, as an edge; the first of all follows the last."""
    at = {first: i for i, first in enumerate(bounds)}

    @F.pandas_udf("array<struct<range: int, edge: boolean>>")
    def places(known: pd.Series, ids: pd.Series, hashes: pd.Series) -> pd.Series:
        out = []
        for key in zip(known.tolist(), ids.tolist(), hashes.tolist(), strict=True):
            mine = [{"range": bisect_right(bounds, key) - 1, "edge": False}]
            if key in at:
                mine.append({"range": (at[key] - 1) % len(bounds), "edge": True})
            out.append(mine)
        return pd.Series(out)

    return rows.withColumn("place", F.explode(places("known", "id", "h"))).select(
        "known", "id", "h", "text", "place.range", "place.edge")


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def _result(text: str, own: str, following: str, after: str) -> tuple:
    cut = len(text) - len(text) // 4
    edited = text[:cut] + following[:len(text) - cut]
    mark = fingerprint(edited)
    return (len(text), hashlib.sha256(edited.encode()).hexdigest(), own, mark,
            likeness(own, mark), likeness(own, after))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of sorted ranges: a document waits until the next one of its range is read; of
    equal documents only the number waits."""
    names = [f.split(" ")[0] for f in RESULT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
             pa.float64()]
    held, waiting = [], None  # (range, id, text, fingerprint, number of equal ones)

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for part in batches:
        columns = [part.column(c) for c in ("range", "edge", "id", "text")]
        for i in range(part.num_rows):
            where, edge, own_id, text = (c[i].as_py() for c in columns)
            known = waiting is not None and waiting[0] == where
            if known and not edge and waiting[1:3] == (own_id, text):
                waiting = (*waiting[:4], waiting[4] + 1)
                continue
            if edge and not known:
                continue  # a further copy of the range's edge
            mark = waiting[3] if known and waiting[2] == text else fingerprint(text)
            if known:
                row = (waiting[1], *_result(waiting[2], waiting[3], text, mark))
                for at in range(0, waiting[4], OUT_ROWS):
                    held += [row] * min(OUT_ROWS, waiting[4] - at)
                    while len(held) >= OUT_ROWS:
                        yield batch(held[:OUT_ROWS])
                        held = held[OUT_ROWS:]
            waiting = None if edge else (where, own_id, text, mark, 1)
    if held:
        yield batch(held)


def compared(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    of every row of ``docs`` (doc_id, text; other columns are not read).

    The edited text is the text with its last floor(n_chars / 4) code points replaced by the
    first as many of the next document's, or all if there are fewer. The next document is the
    one that follows by (doc_id, hash of the text, text), null ids first; rows alike in id and text
    are one document and get the same result each. After the last comes the first, so a single
    document follows itself. Null counts as the empty text, whose edited text is empty; two
    empty texts have likeness 1. An empty table gives no row.
    """
    _small_batches(docs)
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"),
                       F.col("doc_id").cast("long").alias("key")).select(
        F.col("key").isNotNull().alias("known"), F.coalesce("key", F.lit(0)).alias("id"),
        F.xxhash64("text").alias("h"), "text")
    keys = rows.select("known", "id", "h")
    ranges = max(RANGES * tasks(docs.sparkSession), -(-docs.count() // RANGE_ROWS))
    bounds = _bounds(keys, ranges)
    if not bounds:
        return docs.sparkSession.createDataFrame([], RESULT)
    order = ["range", "edge", "known", "id", "h", "text"]
    ready = _ranged(rows, bounds).repartition("range").sortWithinPartitions(*order).select(
        "range", "edge", F.when(F.col("known"), F.col("id")).alias("id"), "text")
    return ready.mapInArrow(_pairs, RESULT)
