"""Joins on membership: lists in strings, NOT IN with NULLs, finished inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions.lists import list_items


def join_list_member(
    df: DataFrame,
    groups: DataFrame,
    on: Sequence[tuple[str, str]],
    item: str,
    list_col: str,
    sep: str = ", ",
) -> DataFrame:
    """Inner join where the ``on`` pairs are equal and ``item`` equals the list text
    or one of its elements.

    The lists are exploded to one row per element, which turns the condition into a
    plain equi join. The whole text stays an element, and equal elements count once.
    """
    members = F.array_distinct(
        F.concat(list_items(F.col(list_col), sep), F.array(F.col(list_col)))
    )
    flat = groups.withColumn("_member", F.explode(members))
    renamed = flat.select(
        *[F.col(r).alias(f"_k{i}") for i, (_, r) in enumerate(on)],
        "_member",
        *[c for c in groups.columns if c not in {r for _, r in on}],
    )
    condition = F.col(item) == F.col("_member")
    for i, (left, _) in enumerate(on):
        condition = condition & (F.col(left) == F.col(f"_k{i}"))
    joined = df.join(renamed, condition, "inner")
    return joined.drop("_member", *[f"_k{i}" for i in range(len(on))])


def not_in(df: DataFrame, key: str, others: DataFrame, other_key: str) -> DataFrame:
    """``key NOT IN (SELECT other_key ...)`` with SQL's rules for NULL.

    A NULL among the others empties the result, a NULL key is dropped unless the
    list is empty. The NULL test is a one-row scalar subquery and the rest a plain
    anti join, so the list may be larger than any broadcast.
    """
    # 0: empty list, every key passes; 1: known keys pass; 2: a NULL, none pass
    need = F.when(F.count(F.lit(1)) == 0, 0).when(F.bool_or(F.col(other_key).isNull()), 2)
    required = others.agg(need.otherwise(1).alias("need")).scalar()
    listed = others.select(F.col(other_key).alias("_listed"))
    known = F.col(key).isNotNull().cast("int")
    return df.filter(known >= required).join(
        listed, F.col(key) == F.col("_listed"), "left_anti"
    )


def pending(inputs: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inputs without a finished result."""
    return inputs.join(done.select(*on), list(on), "left_anti")
