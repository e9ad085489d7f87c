"""Hard negatives by coordinate pruning in length buckets.

Rows are kept by descending length in buckets that hold, for every coordinate of the unit
vectors, a sorted list. For an anchor and a score that a row has to reach, the longest row of a
bucket gives the least cosine; the cosine gives, for the anchor's focus coordinates (its
largest), the range of values that a row can have there. The rows in these ranges are
intersected, and only what remains is verified by the exact inner product. Buckets whose
longest row is too short are left out with all shorter ones.

Two searches use it: the best rows of the anchor's own label (its positives), and for every
positive the best rows of other labels whose score lies in a share of the positive's.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.topk import products
from terrane.llm.vectors import matrix, usable
from terrane.session import written

#: Rows of a shard and anchors of a block, on average; the memory of a task follows.
SHARD_ROWS, BLOCK_ROWS = 4096, 1024
#: Rows of a length bucket, and coordinates of an anchor whose ranges are intersected.
BUCKET, FOCUS = 512, 4
#: Ratio of the greatest to the least length in a shard.
BAND = 1.25
#: Lists that meet at once when they are merged.
FAN = 16
LIMIT = 2 ** 63 - 1
#: Room for rounding in the ranges of unit vectors; it only lets more rows be verified.
SLACK = 1e-9
BEST = "array<struct<neg: bigint, id: bigint>>"


def feasible(unit: np.ndarray, cosine: float) -> list[tuple[int, float, float]]:
    """(coordinate, least, greatest): where a unit vector can lie at the focus coordinates of
    ``unit`` if its inner product with it is at least ``cosine``."""
    if cosine <= 0:
        return []
    reach = math.acos(min(1.0, cosine))
    out = []
    for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
        angle = math.acos(max(-1.0, min(1.0, unit[f])))
        least = math.cos(min(math.pi, angle + reach)) - SLACK
        out.append((int(f), least, math.cos(max(0.0, angle - reach)) + SLACK))
    return out


class Bucket:
    """Rows of similar length with one sorted list per coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, lengths: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.longest = float(lengths[0])
        self.unit = rows / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.order = np.argsort(self.unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.unit, self.order, 0)

    def candidates(self, ranges: Iterable[tuple[int, float, float]]) -> np.ndarray | None:
        """Rows inside all ranges; None if that is every row."""
        cuts = []
        for f, least, most in ranges:
            column = self.sorted[:, f]
            a, b = np.searchsorted(column, least, "left"), np.searchsorted(column, most, "right")
            if b - a < len(column):
                cuts.append((b - a, f, a, b, least, most))
        if not cuts:
            return None
        cuts.sort()
        _, f, a, b, _, _ = cuts[0]
        picked = self.order[a:b, f]
        for _, g, _, _, least, most in cuts[1:]:
            at = self.unit[picked, g]
            picked = picked[(at >= least) & (at <= most)]
        return picked


def buckets(ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> list[Bucket]:
    """All rows, longest first, ``BUCKET`` of them at a time."""
    lengths = np.sqrt((rows * rows).sum(axis=1))
    order = np.lexsort((ids, -lengths))
    ids, labels, rows, lengths = ids[order], labels[order], rows[order], lengths[order]
    return [Bucket(ids[i:i + BUCKET], labels[i:i + BUCKET], rows[i:i + BUCKET],
                   lengths[i:i + BUCKET]) for i in range(0, len(ids), BUCKET)]


def _scores(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products, set to the limits of a long beyond them."""
    raw = products(q[None, :], rows)[0]
    if raw.dtype == object:
        return np.array([max(-LIMIT, min(LIMIT, int(s))) for s in raw], np.int64)
    return raw.astype(np.int64)


class Best:
    """The ``k`` best of the rows seen whose score is from ``least`` to ``most``."""

    def __init__(self, k: int, least: int | None = None, most: int | None = None):
        self.k, self.least, self.most = k, least, most
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = np.ones(len(ids), bool)
        floor = self.needed()
        if floor is not None:
            keep &= scores >= floor
        if self.most is not None:
            keep &= scores <= self.most
        if keep.any():
            scores, ids = np.r_[self.scores, scores[keep]], np.r_[self.ids, ids[keep]]
            first = np.lexsort((ids, -scores))[:self.k]
            self.scores, self.ids = scores[first], ids[first]

    def needed(self) -> int | None:
        """The score that a further row has to reach at least; None if any will do."""
        return int(self.scores[-1]) if len(self.ids) == self.k else self.least

    def rows(self) -> list[dict]:
        return [{"neg": -int(s), "id": int(i)} for s, i in zip(self.scores, self.ids, strict=True)]


def fill(bests: list[Best], q: np.ndarray, wanted, held: list[Bucket]) -> None:
    """Give every list of ``bests`` its rows of ``held``; ``wanted(bucket)`` masks the rows that
    may take part."""
    length = float(np.sqrt(q @ q))
    unit = q / length if length > 0 else q
    for bucket in held:
        needs = [b.needed() for b in bests]
        cosine = -1.0
        if None not in needs and min(needs) > 0:
            reach = length * bucket.longest
            if reach * (1 + SLACK) < min(needs):
                return  # and so are all shorter rows
            cosine = min(needs) / reach if math.isfinite(reach) else 0.0
        picked = bucket.candidates(feasible(unit, cosine))
        mask = wanted(bucket)
        if picked is None or len(picked) > BUCKET // 2:
            scores = _scores(q, bucket.rows)
            picked = mask if picked is None else picked[mask[picked]]
            scores, ids = scores[picked], bucket.ids[picked]
        else:
            picked = picked[mask[picked]]
            scores, ids = _scores(q, bucket.rows[picked]), bucket.ids[picked]
        for best in bests:
            best.add(scores, ids)


def _cells(rows: DataFrame, anchors: DataFrame, by: list[str]) -> DataFrame:
    """(by, band, parts, blocks): into how many shards each band of lengths is cut, and into
    how many blocks the anchors that meet them."""
    held = rows.groupBy(*by, "band").agg(
        F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("parts"))
    asked = anchors.groupBy(*by).agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    return held.join(asked, by)


def _merged(found: DataFrame, keys: list[str], k: int, lists: int) -> DataFrame:
    """One list of the ``k`` best per ``keys`` out of at most about ``lists``, as a tree."""
    best = F.expr(f"slice(array_sort(flatten(collect_list(best))), 1, {k})").alias("best")
    while lists > 1:
        lists = -(-lists // FAN)
        found = found.withColumn("at", F.pmod("at", F.lit(lists))).groupBy(*keys, "at").agg(best)
    return found


def _searched(rows: DataFrame, anchors: DataFrame, by: list[str], k: int, per_anchor) -> DataFrame:
    """(id, which, turn, best): for every anchor the lists that ``per_anchor(anchor, label,
    buckets)`` fills, over all shards that agree with the anchor in ``by``."""
    cells = written(_cells(rows, anchors, by), "cells")
    lists = cells.groupBy(*by).agg(F.sum("parts").alias("n")).agg(F.max("n")).first()[0] or 0
    up_to = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = anchors.join(cells, by).select(
        *[F.col(c).alias(c) for c in anchors.columns], "band", "blocks",
        up_to("parts").alias("part")).withColumn(
        "block", F.pmod(F.xxhash64("id", "which"), "blocks").cast("int")).drop("blocks")
    held = rows.join(cells, [*by, "band"]).withColumn(
        "part", F.pmod(F.xxhash64("id", "which"), "parts").cast("int")).select(
        "id", "v", "dim", "label", "band", "part", up_to("blocks").alias("block"))
    keys = [*by, "band", "part", "block"]

    def tile(asked: pa.Table, held: pa.Table) -> pa.Table:
        made = {"id": [], "which": [], "turn": [], "at": [], "best": []}
        if asked.num_rows and held.num_rows:
            dim = asked.column("dim")[0].as_py()
            index = buckets(held.column("id").to_numpy(), held.column("label").to_numpy(),
                            matrix(held, "v", dim))
            queries = matrix(asked, "v", dim)
            band, part = asked.column("band")[0].as_py(), asked.column("part")[0].as_py()
            rest = asked.drop_columns(["v"]).to_pylist()
            for q, row in zip(queries, rest, strict=True):
                for turn, best in enumerate(per_anchor(q, row, index)):
                    if len(best.ids):
                        for name, value in (("id", row["id"]), ("which", row["which"]),
                                            ("turn", turn), ("at", abs(band * 7919 + part)),
                                            ("best", best.rows())):
                            made[name].append(value)
        kinds = {"id": pa.int64(), "which": pa.int64(), "turn": pa.int32(), "at": pa.int64(),
                 "best": pa.list_(pa.struct([("neg", pa.int64()), ("id", pa.int64())]))}
        return pa.table({name: pa.array(made[name], kind) for name, kind in kinds.items()})

    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(
        tile, f"id long, which long, turn int, at long, best {BEST}")
    return _merged(found, ["id", "which", "turn"], k, int(lists))


def mine(
    vectors: DataFrame, every: int, positives: int = 5, negatives: int = 5,
    low: int = 80, high: int = 100, grid: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has vec_id, embedding, and label; other columns are not read. Components become
    floor(grid x), and a row's score is its inner product with the anchor, an id divisible by
    ``every``. Positives are the anchor's ``positives`` best rows of its label with another id,
    negatives of a positive the ``negatives`` best rows of other labels whose score is from
    ``low`` to ``high`` percent of the positive's. Better is the greater score, then the
    smaller id. Only vectors with as many components are compared.

    Rows with a null id, label, or vector, or a component that is null or not finite, before or
    after it is multiplied, take no part. Empty vectors and those of zeros score 0. Repeated
    rows are candidates each; a repeated anchor counts once. A positive of negative score has
    no negatives. Scores beyond a long count as its limit. An empty table gives no row.
    """
    fine = usable(vectors.where(F.col("label").isNotNull()), zero=True, also=["label"])
    # floor() makes a long; doubles from 2^53 on are whole numbers
    whole = lambda x: F.when(F.abs(x) >= 2.0 ** 53, x).otherwise(F.floor(x).cast("double"))
    length = F.least(
        F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)), F.lit(1e300))
    rows = written(
        fine.select("id", F.transform("v", lambda x: whole(x * grid)).alias("v"), "dim",
                    F.col("label").cast("long").alias("label"))
        .where(~F.exists("v", lambda x: F.abs(x) == float("inf")))
        .withColumn("which", F.xxhash64("v", "label"))
        .withColumn("band", F.when(length > 0, F.floor(F.log(length) / math.log(BAND)))
                    .otherwise(-10_000).cast("int")), "vectors")
    anchors = rows.where(F.col("id") % every == 0).select(
        "id", "which", "v", "dim", "label").distinct()

    def own_label(q, row, index):
        best = Best(positives)
        fill([best], q, lambda bucket: bucket.ids != row["id"], index)
        return [best]

    keys = ["id", "which"]
    good = _searched(rows, anchors, ["label", "dim"], positives, own_label).select(
        *keys, F.col("best").alias("good"))
    with_good = anchors.join(written(good, "positives"), keys)

    def other_label(q, row, index):
        bests = []
        for x in row["good"]:
            score = -x["neg"]
            least, most = -(-low * score // 100), high * score // 100
            bests.append(Best(negatives, least, most))
        fill(bests, q, lambda bucket: bucket.labels != row["label"], index)
        return bests

    found = _searched(rows, with_good, ["dim"], negatives, other_label)
    return found.join(good_of(with_good), [*keys, "turn"]).select(
        F.col("id").alias("anchor_id"), "positive_id", "positive_score",
        F.posexplode("best").alias("at", "x")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"),
        F.col("x.id").alias("negative_id"), "positive_score",
        (-F.col("x.neg")).alias("negative_score"))


def good_of(anchors: DataFrame) -> DataFrame:
    """(id, which, turn, positive_id, positive_score) of the anchors' lists ``good``."""
    return anchors.select("id", "which", F.posexplode("good").alias("turn", "x")).select(
        "id", "which", "turn", F.col("x.id").alias("positive_id"),
        (-F.col("x.neg")).alias("positive_score"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id,
    list_sum(list_transform(list_zip(a.e, r.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v AS a JOIN v AS r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
      ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5
"""
