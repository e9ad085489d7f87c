"""Near copies: texts whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more,
found by SimHash and the anchors of a covering code, and verified on the sets. What SimHash
leaves apart is joined exactly, by the prefixes of the sets (``overlaps``), so every two texts
at or above the limit are in one class.

A SimHash of 256 bits over the shingles estimates the similarity: at 0.8 the cosine of two sets
is about 0.89, so 39 bits differ on average, with a standard deviation of 6. Pairs with at most
``FEW`` = 20 are taken as links, three deviations from the limit; pairs with up to ``MANY`` = 46
are links if their sets say so.

No part of a fingerprint with so many differing bits is nearly equal in both texts. Therefore
anchors are chosen by a second SimHash of 256 bits, over the distinct words of a text, which an
edit changes five times less. Each of its eight halves of 64-bit words goes to all code words of
the perfect Hamming code of 31 bits within covering radius plus threshold, 1 + 1, so texts meet
where a half differs in at most 1 bit; there they are compared on the bits of their shingles. An
anchor does not return all its pairs, but those of a breadth-first search: each text with
the first that reaches it. Pairs that this misses, as their halves or fingerprints differ by
more, or a pair of the search is no link, are those between two classes of SimHash. The join by
prefixes returns all of these, and skips the pairs within a class.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from terrane.llm import overlaps
from terrane.llm.common import arrow_map, packed, tasks, texts_of, unpacked
from terrane.llm.components import components
from terrane.llm.simhash import anchors
from terrane.session import written

SHINGLE = 5
SEED = 42
#: 64-bit words of a fingerprint.
WIDTH = 4
#: Differing bits of the 64 * WIDTH up to which pairs are links, and links if verified.
FEW, MANY = 20, 46
#: Fingerprints of one anchor that one task compares; larger groups are cut into blocks.
CROWD = 20_000
#: Groups up to this size are compared row by row together with others.
SMALL = 8
#: Hashes whose bits are counted at once.
CHUNK = 1 << 16


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit words of 64-bit words."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    x = (x ^ (x >> np.uint64(28))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _majority(hashes: np.ndarray) -> np.ndarray:
    """Bits that over half of the hashes have, ``WIDTH`` words made of each hash."""
    counts = np.zeros((WIDTH, 64), np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK]
        for k in range(WIDTH):
            words = _mixed(part + np.uint64(k + 1)).astype("<u8").view(np.uint8).reshape(-1, 8)
            counts[k] += np.unpackbits(words, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts.ravel() > len(hashes), bitorder="little").view("<u8")


def hashes_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the words and of the shingles of a text.

    Words are parted by ASCII white space and A-Z lower-cased. A text of fewer words than a
    shingle is one shingle; a text without words has none.
    """
    words = text.encode().lower().split()
    h = np.fromiter(map(xxh64_intdigest, words, repeat(SEED)), np.uint64, len(words))
    size = min(SHINGLE, len(h))
    n = len(h) - size + 1 if size else 0
    shingles = np.full(n, size, np.uint64)
    for i in range(size):
        shingles = _mixed(shingles) + h[i:i + n]
    return np.unique(h), np.unique(shingles)


def prints_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the words and of the shingles of a text; zeros without words."""
    words, shingles = hashes_of(text)
    return _majority(words), _majority(shingles)


def _binary(words: np.ndarray) -> pa.Array:
    """Rows of ``WIDTH`` words as binary values."""
    ends = np.arange(len(words) + 1, dtype=np.int32) * (8 * WIDTH)
    data = np.ascontiguousarray(words, "<u8")
    return pa.Array.from_buffers(
        pa.binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _words(column: pa.Array) -> np.ndarray:
    """The inverse of ``_binary``, for columns without nulls."""
    if not len(column):
        return np.empty((0, WIDTH), np.uint64)
    start = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], "<u8", WIDTH * len(column), start).reshape(-1, WIDTH)


def shingles_of(text: str) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    return hashes_of(text)[1]


def name_of(shingles: np.ndarray) -> int:
    """A signed 64-bit number that names a set of shingles."""
    found = xxh64_intdigest(shingles.tobytes(), SEED)
    return found - (found >> 63 << 64)


def with_prints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with binary fingerprints ``w`` (words) and ``f`` (shingles), and ``id``, the
    name of the set of shingles; null is empty."""
    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        sets = [hashes_of(x) for x in texts_of(batch, text)]
        return {"w": _binary(np.array([_majority(w) for w, _ in sets]).reshape(-1, WIDTH)),
                "f": _binary(np.array([_majority(s) for _, s in sets]).reshape(-1, WIDTH)),
                "id": pa.array([name_of(s) for _, s in sets], pa.int64())}

    return arrow_map(docs, run, "w binary, f binary, id long")


def at_anchors(prints: DataFrame) -> DataFrame:
    """Rows (anchor, f): each f at each anchor of every half of its w."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, f = _words(batch.column("w")), batch.column("f")
            for half in range(2 * WIDTH):
                part = (w[:, half // 2] >> np.uint64(32 * (half % 2))) & np.uint64(0x7FFFFFFF)
                at, words = anchors(part.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words | (half << 40)), f.take(pa.array(at))], names=["anchor", "f"])

    return prints.select("w", "f").mapInArrow(run, "anchor long, f binary")


def bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def joined(f: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of at most ``MANY`` differing bits that join the rows of one group: breadth first,
    each row with the first that reaches it."""
    left = f
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            by = np.full(len(left), -1)
            step = max(1, (1 << 18) // len(left))
            for i in range(0, len(front), step):
                open_ = np.flatnonzero(by < 0)
                hits = bits(front[i:i + step, None], left[None, open_]) <= MANY
                by[open_] = np.where(hits.any(axis=0), i + hits.argmax(axis=0), -1)
            reached = by >= 0
            if reached.any():
                yield front[by[reached]], left[reached]
            front, left = left[reached], left[~reached]


def _links(keys: np.ndarray, f: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(0, a, b) pairs, or (group size, keys, f) of crowded groups, of rows sorted by key."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    left = np.repeat(starts + sizes, sizes) - np.arange(len(keys))  # rows to the group's end
    left[np.repeat(sizes > SMALL, sizes)] = 0
    for lag in range(1, SMALL):
        i = np.flatnonzero(left > lag)
        i = i[bits(f[i], f[i + lag]) <= MANY]
        yield 0, f[i], f[i + lag]
    for k in np.flatnonzero(sizes > SMALL):
        rows = slice(starts[k], starts[k] + sizes[k])
        if sizes[k] > CROWD:
            yield int(sizes[k]), keys[rows], f[rows]
        else:
            for a, b in joined(f[rows]):
                yield 0, a, b


def compare(rows: DataFrame) -> DataFrame:
    """(size, anchor, a, b) of rows (anchor, f): size 0 is a pair (a, b) with its differing bits
    as anchor, a larger one marks a row a of a crowded anchor, whose number of rows it is.

    Rows are dealt by anchor and sorted by Spark; a task holds the anchor it is at.
    """
    def made(keys: list[np.ndarray], prints: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for size, a, b in _links(np.concatenate(keys), np.concatenate(prints)):
            if len(a):
                anchor = a if size else bits(a, b)
                first, second = (b, b) if size else (a, b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(a), size)), pa.array(anchor),
                     _binary(first), _binary(second)], names=["size", "anchor", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column("anchor").to_numpy(zero_copy_only=False)
            f = _words(batch.column("f"))
            cut = int(np.searchsorted(k, k[-1]))  # the last anchor may go on
            if keys and (cut or keys[-1][-1] != k[0]):
                yield from made([*keys, k[:cut]], [*prints, f[:cut]])
                keys, prints = [], []
            elif cut:
                yield from made([k[:cut]], [f[:cut]])
            keys.append(k[cut:])
            prints.append(f[cut:])
        if keys:
            yield from made(keys, prints)

    return (rows.repartition(tasks(rows.sparkSession), "anchor").sortWithinPartitions("anchor")
            .mapInArrow(run, "size long, anchor long, a binary, b binary"))


def blocks(crowded: DataFrame) -> DataFrame:
    """(anchor, f) of rows (size, anchor, f) of crowded anchors, dealt so that every two rows of
    an anchor meet in a group of about ``CROWD`` rows: by hash into blocks, two blocks a group.
    """
    n = F.ceil(F.col("size") * 4 / F.lit(CROWD)).cast("long")
    own = F.pmod(F.xxhash64("f"), F.col("n"))
    return (
        crowded.withColumn("n", n).withColumn("own", own)
        .withColumn("other", F.explode(F.expr("sequence(0L, n - 1)")))
        .select(F.xxhash64("anchor", F.least("own", "other"), F.greatest("own", "other"))
                .alias("anchor"), "f"))


def candidates(prints: DataFrame) -> DataFrame:
    """(a, b, bits) of distinct (w, f): pairs that join what meets and is near enough."""
    found = written(compare(at_anchors(prints)), "copy-pairs")
    pairs = found.where("size = 0")
    crowded = found.where("size > 0").select("size", "anchor", F.col("a").alias("f"))
    if not crowded.isEmpty():
        pairs = pairs.union(compare(blocks(crowded)).where("size = 0"))
    return written(
        pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                                     F.col("anchor").alias("bits")).distinct(), "candidates")


def with_sets(docs: DataFrame) -> DataFrame:
    """``docs`` (text and others) with ``s``, the hashes of the shingles."""
    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        sets = [shingles_of(x).view(np.int64) for x in texts_of(batch)]
        return {"s": pa.array(sets, pa.list_(pa.int64()))}

    return arrow_map(docs, run, "s array<long>")


def verified(pairs: DataFrame, first: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) of names whose sets are similar. ``first`` (name, doc_id, h) has a row of
    ``docs`` for each name, by id and hash of the text."""
    needed = pairs.select(F.col("a").alias("name")).union(pairs.select("b")).distinct()
    texts = (
        docs.select(F.col("doc_id").alias("_id"), "text", F.xxhash64("text").alias("_h"))
        .join(written(first.join(needed, "name"), "needed"), F.expr("_id <=> doc_id and _h = h"))
        .select("name", "text"))
    sets = written(with_sets(texts).select("name", "s").dropDuplicates(["name"]), "sets")
    both = (
        pairs.join(sets.select(F.col("name").alias("a"), F.col("s").alias("sa")), "a")
        .join(sets.select(F.col("name").alias("b"), F.col("s").alias("sb")), "b"))
    either = F.size("sa") + F.size("sb") - F.col("shared")
    return both.withColumn("shared", F.size(F.array_intersect("sa", "sb"))).where(
        overlaps.UNDER * F.col("shared") >= overlaps.OVER * either).select("a", "b")


def classes(prints: DataFrame, first: DataFrame, docs: DataFrame) -> DataFrame:
    """(f, root) of every f in ``prints`` (w, f): the class that SimHash finds for it, an f.
    ``first`` and ``docs`` are those of ``verified``."""
    pairs = candidates(prints)
    links = pairs.where(F.col("bits") <= FEW).select("a", "b").union(
        verified(pairs.where(F.col("bits") > FEW).select("a", "b"), first, docs))
    rooted = components(links).select(F.col("node").alias("f"), "root")
    return prints.select("f").distinct().join(rooted, "f", "left").select(
        "f", F.coalesce("root", "f").alias("root"))


def links_between(roots: DataFrame, first: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of ``roots`` (id, root; both numbers), such that sets
    are similar only within what they join. ``first`` (id, doc_id, h) is as for ``verified``.
    """
    found = overlaps.prefixes(docs, shingles_of, name_of, overlaps.cells(docs, shingles_of))
    sets = written(found.dropDuplicates(["id"]).join(roots, "id"), "prefixes")
    rows = sets.select("id", "root", "size", F.posexplode("keys").alias("place", "key")).select(
        "key", "id", "root", "size", F.col("place").cast("long").alias("place"))
    met = written(overlaps.meet(rows), "met")
    pairs, crowded = met.where("n = 0"), met.where("n > 0")
    if not crowded.isEmpty():
        pairs = pairs.union(overlaps.meet(overlaps.blocks(crowded)).where("n = 0"))
    pairs = pairs.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    near = written(overlaps.thinned(pairs, sets), "near")
    similar = verified(near, first.withColumnRenamed("id", "name"), docs)
    return (
        similar.join(roots.select(F.col("id").alias("a"), F.col("root").alias("ra")), "a")
        .join(roots.select(F.col("id").alias("b"), F.col("root").alias("rb")), "b")
        .select(F.col("ra").alias("a"), F.col("rb").alias("b")))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class of near copies: that of the smallest doc_id (null
    last). Of rows with the same id and text one stays.

    All columns are kept, whatever their names. Null and empty texts are one class. An empty
    table gives an empty one.
    """
    key = [F.col("doc_id"), F.xxhash64("text").alias("h")]
    rows = written(
        with_prints(docs.select("doc_id", "text")).select(*key, "w", "f", "id"), "prints")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")
    per_set = written(rows.groupBy("id").agg(
        F.min("f").alias("f"), F.min(first).alias("first")), "first-rows")
    per_print = per_set.groupBy("f").agg(F.min("first").alias("first"))
    distinct = written(rows.select("w", "f").distinct(), "distinct-prints")
    found = classes(distinct, per_print.select(
        F.col("f").alias("name"), "first.doc_id", "first.h"), docs)
    roots = written(
        per_set.join(found, "f").select("id", F.xxhash64("root").alias("root"), "first"), "roots")
    joined_to = components(links_between(
        roots.select("id", "root"), per_set.select("id", "first.doc_id", "first.h"), docs))
    kept = roots.join(joined_to.select("node", F.col("root").alias("to")),
                      F.col("root") == F.col("node"), "left").groupBy(
        F.coalesce("to", "root").alias("root")).agg(F.min("first").alias("first"))
    again = rows.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n"))
    kept = written(
        kept.select("root", "first.doc_id", "first.h").alias("k")
        .join(again.alias("r"), F.expr("k.doc_id <=> r.doc_id and k.h = r.h"))
        .select("k.root", "k.doc_id", "k.h", "r.n"), "kept")
    both = packed(docs, docs.doc_id.alias("_id"), F.xxhash64(docs.text).alias("_h"))
    both = both.join(kept, F.expr("_id <=> doc_id and _h = h"))
    single, repeated = both.where("n = 1"), both.where("n > 1")
    out = unpacked(single, docs.columns)
    if kept.where("n > 1").isEmpty():
        return out
    return out.union(unpacked(repeated.dropDuplicates(["root"]), docs.columns))
