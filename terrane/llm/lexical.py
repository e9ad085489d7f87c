"""Ranked lexical search by MaxScore with pair bounds.

The terms that items ask for are looked up in all documents; their postings are written once.
Documents are dealt into shards. In a shard each term's list has a maximum impact, and pairs of
an item's terms have an intersection list with the maximum of their joint impact. What a pair
can add to a document is at most the greatest of the joint maximum and the two single ones,
which is less than their sum wherever the two do not meet. An item's terms are taken in the
order of these bounds. As soon as the bounds of the rest add up to less than the score of the
k-th best document so far, only documents that can still reach it are looked up in the rest of
the lists, and their number falls with every list. Lists of shards are merged as a tree.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import arrow_map, tasks, texts_of
from terrane.session import written

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Documents of a shard and items of a block, on average.
SHARD_ROWS, BLOCK_ROWS = 16_384, 1024
#: Lists that meet at once when they are merged.
FAN = 16
#: Fixed values of the weighting.
LENGTH_SHARE, TOP, UNIT, PENALTY = 90, 1_000_000_000, 1000, 8
BEST = "array<struct<neg: bigint, place: struct<known: boolean, doc: bigint>>>"


def terms(text: str) -> list[str]:
    """Terms of a text, A-Z in lower case."""
    return TERM.findall(text.translate(SMALL))


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` and _n (its terms), _terms (different ones), _tf (how often each occurs)."""
    def count(part: pa.RecordBatch) -> dict[str, pa.Array]:
        bags = [Counter(terms(t)) for t in texts_of(part)]
        return {
            "_n": pa.array([sum(b.values()) for b in bags], pa.int64()),
            "_terms": pa.array([list(b) for b in bags], pa.list_(pa.string())),
            "_tf": pa.array([list(b.values()) for b in bags], pa.list_(pa.int64())),
        }

    return arrow_map(docs, count, "_n long, _terms array<string>, _tf array<long>")


def wanted_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term): each term of an item once; ``item`` numbers the rows of items."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    return counted(rows).select("item", "item_id", F.explode("_terms").alias("term"))


def postings(docs: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, int, int]:
    """(row, doc_id, n, term_id, tf) of the terms in ``vocabulary`` (term, term_id), the number
    of documents with a term, and the number of all their terms."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), "text")
    bags = counted(rows).drop("text")
    each = bags.select(
        "row", "doc_id", F.col("_n").alias("n"),
        F.posexplode(F.arrays_zip("_terms", "_tf")).alias("at", "x"))
    # the first entry of each document counts it, whether its term is asked for or not
    found = each.select(
        "row", "doc_id", "n", F.col("x._terms").alias("term"), F.col("x._tf").alias("tf"),
        (F.col("at") == 0).alias("first")).join(vocabulary, "term", "left").where(
        F.col("first") | F.col("term_id").isNotNull())
    kept = written(found.drop("term"), "postings")
    n_docs, length = kept.where("first").agg(
        F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return kept.where(F.col("term_id").isNotNull()).drop("first"), int(n_docs), int(length)


def impacts(posts: DataFrame, weights: DataFrame, n_docs: int, length: int) -> DataFrame:
    """(row, doc_id, term_id, impact) of every posting, in whole numbers."""
    share = (F.lit(LENGTH_SHARE).cast("decimal(38,0)") * F.col("n")).cast("decimal(38,0)")
    longer = F.expr("share * n_docs div length").cast("long")
    return (
        posts.join(weights, "term_id")
        .withColumn("share", share)
        .withColumn("n_docs", F.lit(n_docs).cast("decimal(19,0)"))
        .withColumn("length", F.lit(length).cast("decimal(19,0)"))
        .withColumn("m", F.lit(100 - LENGTH_SHARE).cast("long") + longer)
        .select("row", "doc_id", "term_id", F.expr(
            f"w * (({TOP}L * tf) div ({UNIT}L * tf + {PENALTY}L * m))").alias("impact")))


class Shard:
    """Postings of one shard: a list of (documents, impacts) per term, and pair bounds."""

    def __init__(self, rows: np.ndarray, docs: np.ndarray, known: np.ndarray,
                 term_ids: np.ndarray, impact: np.ndarray):
        own, first, at = np.unique(rows, return_index=True, return_inverse=True)
        # documents in the order that parts ties: known ids ascending, unknown ones last
        order = np.lexsort((own, docs[first], ~known[first]))
        place = np.empty(len(own), np.int64)
        place[order] = np.arange(len(own))
        self.docs, self.known = docs[first][order], known[first][order]
        at = place[at]
        order = np.lexsort((at, term_ids))
        at, term_ids, impact = at[order], term_ids[order], impact[order]
        cuts = np.flatnonzero(np.diff(term_ids)) + 1
        starts, ends = np.r_[0, cuts], np.r_[cuts, len(term_ids)]
        self.lists = {int(term_ids[a]): (at[a:b], impact[a:b], int(impact[a:b].max()))
                      for a, b in zip(starts, ends, strict=True)} if len(term_ids) else {}
        self.joint: dict[tuple[int, int], int] = {}

    def bound(self, a: int, b: int) -> int:
        """The most that terms ``a`` and ``b`` add to one document."""
        if (a, b) not in self.joint:
            (x, u, top_a), (y, v, top_b) = self.lists[a], self.lists[b]
            if len(x) > len(y):
                (x, u), (y, v) = (y, v), (x, u)
            at = np.searchsorted(y, x)
            both = y[np.minimum(at, len(y) - 1)] == x
            joint = int((u[both] + v[at[both]]).max()) if both.any() else 0
            self.joint[a, b] = max(joint, top_a, top_b)
        return self.joint[a, b]

    def units(self, term_ids: list[int]) -> list[tuple[int, list[int]]]:
        """(bound, terms): neighbours by maximum impact paired, greatest bounds first."""
        here = sorted((t for t in term_ids if t in self.lists),
                      key=lambda t: (-self.lists[t][2], t))
        pairs = [here[i:i + 2] for i in range(0, len(here), 2)]
        made = [(self.bound(*p) if len(p) == 2 else self.lists[p[0]][2], p) for p in pairs]
        return sorted(made, key=lambda u: (-u[0], u[1]))

    def top(self, term_ids: list[int], k: int) -> list[tuple[int, bool, int]]:
        """(score, known, doc_id) of the ``k`` best documents with a score above 0."""
        units = self.units(term_ids)
        rest = sum(bound for bound, _ in units)
        score = np.zeros(len(self.docs), np.int64)
        some = None  # documents that can still be among the best; None is all
        for bound, pair in units:
            rest -= bound
            for t in pair:
                at, impact, _ = self.lists[t]
                if some is None:
                    score[at] += impact
                elif len(some):
                    found = np.searchsorted(at, some)
                    hit = at[np.minimum(found, len(at) - 1)] == some
                    score[some[hit]] += impact[found[hit]]
            among = score if some is None else score[some]
            if len(among) > k:
                least = np.partition(among, len(among) - k)[len(among) - k]
                if least > rest:
                    # a document that has nothing yet reaches at most ``rest``
                    able = among + rest >= least
                    some = np.flatnonzero(able) if some is None else some[able]
        some = np.arange(len(score)) if some is None else some
        some = some[score[some] > 0]
        first = some[np.lexsort((some, -score[some]))[:k]]
        return [(int(score[i]), bool(self.known[i]), int(self.docs[i])) for i in first]


def search(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item, best first.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not read. A
    document's score sums over the item's terms, once each, w * (10^9 tf div (1000 tf + 8 m));
    w and m are those of the query's contract. Only scores above 0 count, ties go to the
    smaller doc_id, null ids last. Null and empty texts have no terms: such documents are not
    counted, such items have no row. Repeated documents are documents each, repeated items are
    answered each. Without documents or items there is no row.
    """
    spark = docs.sparkSession
    wanted = written(wanted_terms(items), "wanted")
    vocabulary = written(wanted.select("term").distinct().select(
        "term", F.monotonically_increasing_id().alias("term_id")), "vocabulary")
    posts, n_docs, length = postings(docs, vocabulary)
    # written, so that its size is known and postings of a common term stay where they are
    weights = written(posts.groupBy("term_id").agg(F.count(F.lit(1)).alias("df")).select(
        "term_id", F.floor(UNIT * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
        .alias("w")), "weights")
    shards = max(tasks(spark), -(-n_docs // SHARD_ROWS))
    n_items = wanted.select("item").distinct().count()
    blocks = max(1, -(-n_items // BLOCK_ROWS))
    up_to = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = wanted.join(vocabulary, "term").groupBy("item", "item_id").agg(
        F.sort_array(F.collect_list("term_id")).alias("terms")).select(
        "item", "terms", up_to(shards).alias("shard"),
        F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block"))
    held = impacts(posts, weights, n_docs, max(length, 1)).where("impact > 0").select(
        F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"),
        up_to(blocks).alias("block"), "row", F.coalesce("doc_id", F.lit(0)).alias("doc"),
        F.col("doc_id").isNotNull().alias("known"), "term_id", "impact")

    def answer(asked: pa.Table, held: pa.Table) -> pa.Table:
        made = {"item": [], "at": [], "best": []}
        if asked.num_rows and held.num_rows:
            columns = [held.column(c).to_numpy()
                       for c in ("row", "doc", "known", "term_id", "impact")]
            shard = Shard(*columns)
            for row in asked.to_pylist():
                best = shard.top(row["terms"], k)
                if best:
                    made["item"].append(row["item"])
                    made["at"].append(row["shard"])
                    made["best"].append([{"neg": -s, "place": {"known": not known, "doc": doc}}
                                         for s, known, doc in best])
        place = pa.struct([("known", pa.bool_()), ("doc", pa.int64())])
        return pa.table({
            "item": pa.array(made["item"], pa.int64()), "at": pa.array(made["at"], pa.int64()),
            "best": pa.array(made["best"], pa.list_(
                pa.struct([("neg", pa.int64()), ("place", place)])))})

    found = asked.groupBy("shard", "block").cogroup(held.groupBy("shard", "block")).applyInArrow(
        answer, f"item long, at long, best {BEST}")
    merged = F.expr(f"slice(array_sort(flatten(collect_list(best))), 1, {k})").alias("best")
    while shards > 1:
        shards = -(-shards // FAN)
        found = found.withColumn("at", F.pmod("at", F.lit(shards))).groupBy("item", "at").agg(
            merged)
    ids = wanted.select("item", "item_id").distinct()
    return found.join(ids, "item").select(
        "item_id", F.posexplode("best").alias("at", "x")).select(
        "item_id", (F.col("at") + 1).cast("int").alias("rank"),
        F.when(~F.col("x.place.known"), F.col("x.place.doc")).alias("doc_id"),
        (-F.col("x.neg")).alias("score"))


_BAG = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE_SQL = rf"""
WITH bags AS (SELECT doc_id, {_BAG} AS bag FROM documents WHERE text IS NOT NULL),
d AS (SELECT doc_id, len(bag)::BIGINT AS n, bag FROM bags WHERE len(bag) > 0),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
p AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, n, unnest(bag) AS term FROM d) GROUP BY ALL),
q AS (SELECT DISTINCT item_id, unnest({_BAG}) AS term FROM benchmark WHERE text IS NOT NULL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), c),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (
    100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), c GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 10
"""
