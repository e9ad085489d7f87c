"""Row numbers within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096


@dataclass(frozen=True)
class Blocks:
    """Rows that fall into blocks of the order column, and the rows before each block."""

    rows: DataFrame
    starts: DataFrame
    keys: list[str]
    order: list[str]
    block: Column

    def number(self, starts: DataFrame | None = None, out: str = "_number") -> DataFrame:
        """Rows with their 0-based number in the group; other columns of ``starts`` stay.

        Rows are dealt out by their block and cut into blocks on arrival, so no block number
        travels with them. They are sorted once, for their places in the block, and that order
        serves the join.
        """
        blocks = (starts if starts is not None else self.starts).drop("_first")
        inside = Window.partitionBy(*self.keys, "_block").orderBy(*self.order)
        placed = (
            self.rows.repartition(*self.keys, self.block).withColumn("_block", self.block)
            .withColumn("_inside", F.row_number().over(inside))
        )
        return (
            placed.join(blocks, [*self.keys, "_block"])
            .withColumn(out, F.col("_before") + F.col("_inside") - 1)
            .drop("_block", "_before", "_inside")
        )


def block_numbers(
    df: DataFrame, keys: Sequence[str], order: str, width: int = BLOCK,
    ties: Sequence[str] = (),
) -> Blocks:
    """Prepare row numbers by a whole-number order column; ``ties`` order its ties.

    A block spans ``width`` consecutive values of the order. Blocks are counted, with
    a partial aggregate, and only the counts of a group meet in one task; the rows of
    a group are sorted block by block in different tasks.
    """
    keys = list(keys)
    block = F.floor(F.col(order) / F.lit(width))
    counts = df.groupBy(*keys, block.alias("_block")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first")
    )
    earlier = (
        Window.partitionBy(*keys).orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counts.withColumn(
        "_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    ).drop("_n")
    return Blocks(df, starts, keys, [order, *ties], block)


def number_rows(
    df: DataFrame, keys: Sequence[str], order: str, out: str, width: int = BLOCK,
    ties: Sequence[str] = (),
) -> DataFrame:
    """0-based row numbers per group in the order of a whole-number column."""
    return block_numbers(df, keys, order, width, ties).number(out=out)
