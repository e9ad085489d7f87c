"""Choice of one model per triple."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: a mean absolute training error up to this counts as good.
GOOD_TRAIN_ERROR = 0.5


def choose_model(
    scores: DataFrame, by: Sequence[str], tie: Sequence[str], limit: float = GOOD_TRAIN_ERROR
) -> DataFrame:
    """The best row of ``scores`` per group.

    Models with a good training error come first, by test error; without any, all are
    ranked by training error. The sign of the errors does not matter, and ties fall to
    the ``tie`` columns. A group has one row per model, so its window is small.
    """
    train, test = F.abs("mae_train"), F.abs("mae_test")
    group = Window.partitionBy(*by)
    any_good = F.max((train <= limit).cast("int")).over(group) == 1
    ranked = scores.withColumn("_any", any_good).withColumn(
        "_place",
        F.row_number().over(group.orderBy(
            (train <= limit).desc(), F.when(F.col("_any"), test).otherwise(train), *tie
        )),
    )
    return ranked.filter(F.col("_place") == 1).drop("_any", "_place")


def best_of(
    scores: DataFrame, by: Sequence[str], measure: str, tie: Sequence[str], largest: bool = True
) -> DataFrame:
    """The row with the best measure per group."""
    value = F.col(measure)
    order = value.desc_nulls_last() if largest else value.asc_nulls_last()
    ranked = scores.withColumn(
        "_place", F.row_number().over(Window.partitionBy(*by).orderBy(order, *tie))
    )
    return ranked.filter(F.col("_place") == 1).drop("_place")
