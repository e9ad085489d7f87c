"""Optional preparation of rows before a model comparison; every step is off by default."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions.predicates import quoted
from terrane.operators.metrics import r2_matrix

# Correlation above which two columns count as one, and the distance from
# the mean, in deviations, beyond which a row is an outlier.
COLLINEAR = 0.9
OUTLIER = 3.0


def independent_columns(
    df: DataFrame, columns: Sequence[str], limit: float = COLLINEAR
) -> list[str]:
    """The columns without those that correlate beyond the limit with an earlier kept
    one: a choice of names from the small matrix of all pairs."""
    close = {
        (r.x, r.y) for r in r2_matrix(df, columns).filter(F.col("r2") > limit * limit).collect()
    } if len(columns) > 1 else set()
    kept: list[str] = []
    for name in columns:
        if not any((name, other) in close for other in kept):
            kept.append(name)
    return kept


def drop_outliers(
    df: DataFrame, columns: Sequence[str], deviations: float = OUTLIER
) -> DataFrame:
    """Rows whose values all lie within so many deviations of the column's mean. Means
    and deviations are one aggregate, used as a scalar subquery."""
    limits = df.agg(F.struct(*[
        part for i, c in enumerate(columns) for part in (
            F.avg(quoted(c)).alias(f"m{i}"), F.stddev_samp(quoted(c)).alias(f"s{i}"))
    ]).alias("limits")).scalar()
    for i, c in enumerate(columns):
        far = F.abs(quoted(c) - limits.getField(f"m{i}")) > deviations * limits.getField(f"s{i}")
        df = df.filter(~F.coalesce(far, F.lit(False)))
    return df


def log_scaled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Signed log(1 + |v|) of the columns, which evens out long tails."""
    return df.withColumns({
        c: F.signum(quoted(c)) * F.log1p(F.abs(quoted(c))) for c in columns
    })


def prepare(
    df: DataFrame, columns: Sequence[str], collinear: bool = False, outliers: bool = False,
    transform: bool = False,
) -> tuple[DataFrame, list[str]]:
    """The rows and the columns that a comparison should use."""
    kept = independent_columns(df, columns) if collinear else list(columns)
    if outliers:
        df = drop_outliers(df, kept)
    if transform:
        df = log_scaled(df, kept)
    return df, kept
