"""Reproducible folds and splits, from hashes of a row key."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions.numbers import hash_bucket, hash_number
from terrane.functions.predicates import quoted
from terrane.operators.numbering import number_rows

# Folds, repeats of the search and of the final check, seed, share.
FOLDS = 5
SEARCH_REPEATS = 20
FINAL_REPEATS = 200
SEED = 12345678
TRAIN_SHARE = 75
# Hash buckets of rows that share their folds in every repeat.
BUCKETS = 4096
# Width of the hash ranges that balanced folds are numbered in: 2 ** 14 ranges. Every task counts
# each range it meets, so ranges are few beside its rows; the counts of a repeat, and the rows of
# a range, meet in one window.
HASH_RANGE = 1 << 18


def fold_of(key: Sequence[str], repeat: Column, k: int = FOLDS, seed: int = SEED) -> Column:
    """0-based fold of a row in one repeat; near-equal sizes, no shuffle."""
    return hash_bucket(k, F.lit(seed), repeat, *[F.col(c) for c in key])


def with_bucket(df: DataFrame, key: Sequence[str], seed: int = SEED) -> DataFrame:
    """Rows with the hash bucket whose folds they share: one number per row, whatever the
    number of repeats."""
    return df.withColumn("bucket", hash_bucket(BUCKETS, F.lit(seed), *[F.col(c) for c in key]))


def fold_table(k: int = FOLDS, repeats: int = SEARCH_REPEATS, seed: int = SEED) -> np.ndarray:
    """The fold of every (bucket, repeat): ``fold_of`` of the bucket, as a small table."""
    def fold(bucket: int, repeat: int) -> int:
        digest = hashlib.md5(f"{seed}|{repeat}|{bucket}".encode()).hexdigest()
        return int(digest[:8], 16) % k

    return np.array(
        [[fold(b, r) for r in range(1, repeats + 1)] for b in range(BUCKETS)], np.int16
    ).reshape(BUCKETS, repeats)


def with_folds(
    df: DataFrame, key: Sequence[str], k: int = FOLDS, repeats: int = SEARCH_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """Rows with the array ``folds``: their fold in repeat 1, 2, ... Made before a row
    is widened per triple, so that each row is hashed once per repeat."""
    numbers = F.sequence(F.lit(1), F.lit(repeats))
    return df.withColumn("folds", F.transform(numbers, lambda r: fold_of(key, r, k, seed)))


def spread_folds(df: DataFrame, repeats: int | None = None) -> DataFrame:
    """One row per repeat with its fold, for the first ``repeats`` of the array."""
    chosen = F.col("folds") if repeats is None else F.slice("folds", 1, repeats)
    kept = [c for c in df.columns if c != "folds"]
    spread = df.select(*[quoted(c) for c in kept], F.posexplode(chosen).alias("_at", "fold"))
    return spread.withColumn("repeat", F.col("_at") + 1).drop("_at")


def fold_ids(
    df: DataFrame, key: Sequence[str], k: int = FOLDS, repeats: int = SEARCH_REPEATS,
    seed: int = SEED, balanced: bool = False,
) -> DataFrame:
    """Every row once per repeat, with its fold.

    ``balanced`` makes the folds of a repeat equal in size to within one row, by row
    numbers in hash order; it costs a shuffle.
    """
    if not balanced:
        return spread_folds(with_folds(df, key, k, repeats, seed))
    rows = df.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    order = hash_number(F.lit(seed), F.col("repeat"), *[F.col(c) for c in key])
    placed = number_rows(
        rows.withColumn("_order", order), ["repeat"], "_order", "_place", HASH_RANGE, key
    )
    return placed.withColumn("fold", F.pmod("_place", F.lit(k)).cast("int")).drop(
        "_order", "_place"
    )


def train_rows(key: Sequence[str], share: int = TRAIN_SHARE, seed: int = SEED) -> Column:
    """True for about ``share`` percent of the rows."""
    return hash_bucket(100, F.lit(seed), F.lit("split"), *[F.col(c) for c in key]) < share
