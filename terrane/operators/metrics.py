"""Regression scores, pairwise fits, and cross-validation summaries."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions.predicates import quoted, text, ticked

PAIRS_PER_BLOCK = 15


def r_squared(actual: Column, predicted: Column) -> Column:
    """Aggregate: 1 - SSE / SST. With a constant actual value it is 1 for an exact
    prediction and 0 otherwise."""
    gap = actual - predicted
    errors = F.sum(gap * gap)
    spread = F.var_pop(actual) * F.count(actual)
    return F.when(spread > 0, 1 - errors / spread).otherwise(
        F.when(errors == 0, 1.0).otherwise(0.0)
    )


def regression_metrics(
    df: DataFrame, by: Sequence[str], actual: str = "z", predicted: str = "z_predicted"
) -> DataFrame:
    """Count, MAE, MSE, RMSE, R2, RMSLE, and MAPE per group in one aggregation.

    RMSLE takes absolute values before the logarithm; MAPE leaves out actual zeros.
    Rows without an actual or a predicted value are left out.
    """
    a, p = F.col(actual), F.col(predicted)
    gap = a - p
    log_gap = F.log1p(F.abs(p)) - F.log1p(F.abs(a))
    return df.filter(a.isNotNull() & p.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(gap)).alias("mae"),
        F.avg(gap * gap).alias("mse"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        r_squared(a, p).alias("r2"),
        F.sqrt(F.avg(log_gap * log_gap)).alias("rmsle"),
        F.avg(F.when(a != 0, F.abs(gap / a))).alias("mape"),
    )


def r2_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """R2 of the straight line between every two columns, as rows (x, y, r2) in both
    directions. Rows count for a pair when both values are present.

    One scan: a row gives one short row per block of ``PAIRS_PER_BLOCK`` pairs, and the
    blocks are aggregated together with a partial aggregate. All pairs as columns of
    one aggregate would outgrow what the JVM compiles.
    """
    pairs = list(combinations(columns, 2))
    slots = range(PAIRS_PER_BLOCK)
    blocks = [pairs[i:i + PAIRS_PER_BLOCK] for i in range(0, len(pairs), PAIRS_PER_BLOCK)]

    def value(block: list, slot: int, side: int) -> str:
        return ticked(block[slot][side]) if slot < len(block) else "NULL"

    wide = ", ".join(
        "named_struct(" + ", ".join([f"'block', {i}"] + [
            f"'{name}{s}', CAST({value(block, s, side)} AS DOUBLE)"
            for s in slots for side, name in enumerate("xy")
        ]) + ")"
        for i, block in enumerate(blocks)
    )
    sums = df.select(F.expr(f"inline(array({wide}))")).groupBy("block").agg(
        F.array(*[F.expr(f"regr_r2(y{s}, x{s})") for s in slots]).alias("r2")
    )
    names = ", ".join(
        "array(" + ", ".join(
            f"named_struct('x', {text(a)}, 'y', {text(b)}, 'slot', {s})"
            for s, (x, y) in enumerate(block) for a, b in ((x, y), (y, x))
        ) + ")"
        for block in blocks
    )
    named = sums.select("r2", F.expr(f"inline(element_at(array({names}), block + 1))"))
    return named.select("x", "y", F.get("r2", F.col("slot")).alias("r2"))


def pair_fit(df: DataFrame, x: str, y: str, keep: Sequence[str] = ()) -> DataFrame:
    """The points of two columns with the fitted value of their straight line."""
    xs, ys = quoted(x).cast("double"), quoted(y).cast("double")
    line = df.agg(
        F.struct(F.regr_slope(ys, xs).alias("slope"), F.regr_intercept(ys, xs).alias("intercept"))
        .alias("line")
    ).scalar()
    return df.filter(xs.isNotNull() & ys.isNotNull()).select(
        *[quoted(c) for c in keep], xs.alias("x"), ys.alias("y"),
        (line.getField("slope") * xs + line.getField("intercept")).alias("y_fitted"),
    )


def cv_summary(
    scores: DataFrame, by: Sequence[str], measures: Sequence[str], digits: int = 3
) -> DataFrame:
    """Mean and median over folds and repeats of each measure, rounded."""
    return scores.groupBy(*by).agg(*[
        F.round(statistic(m), digits).alias(f"cv_{m}_{name}")
        for m in measures
        for name, statistic in (("mean", F.avg), ("median", F.median))
    ])
