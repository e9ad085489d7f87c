"""Replicate collapse and group statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def replicate_mean(
    df: DataFrame,
    unit: Sequence[str],
    replicate: str,
    value: str,
    weight: Column | None = None,
    where: dict[str, Column] | None = None,
) -> DataFrame:
    """Mean per (unit, replicate), then the mean of those means per unit.

    ``weight`` stands for the number of copies a row would have after a join that
    multiplies it. ``where`` names several conditions; each gives its own mean
    column, all in the same two aggregations. Both aggregations combine before
    their shuffle, so one large unit does not load one task.
    """
    where = where or {value: F.lit(True)}
    copies = F.lit(1) if weight is None else weight
    inner = []
    for name, condition in where.items():
        kept = F.when(condition & F.col(value).isNotNull(), copies)
        inner.append((F.sum(kept * F.col(value)) / F.sum(kept)).alias(name))
    tests = df.groupBy(*unit, replicate).agg(*inner)
    return tests.groupBy(*unit).agg(*[F.avg(name).alias(name) for name in where])


def distinct_values(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """One row per distinct non-null value among ``columns``: a set union of the
    columns without a shuffle, because they already share a row."""
    values = F.array_distinct(F.array_compact(F.array(*[F.col(c) for c in columns])))
    keep = [c for c in df.columns if c not in columns]
    return df.select(*keep, F.explode(values).alias(out))


def fanout_stats(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    prefix: str,
    matches: DataFrame,
    on: tuple[str, str],
    dedupe: bool = False,
) -> DataFrame:
    """Minimum, maximum, mean, sample deviation, and count of a value per group of ``df`` inner
    joined to ``matches``, without the join's rows.

    ``on`` is (column of ``by``, column of ``matches``). Every row of a group meets
    the same m matches, so the minimum, maximum, and mean stay as they are, the
    count is n * m, and the deviation follows from the population variance. The
    rows of ``matches`` are counted first and meet the groups, not the data.
    ``dedupe`` counts every row once.
    """
    left, right = on
    v = F.col(value)
    groups = df.groupBy(*by).agg(
        F.min(v).cast("double").alias(f"min_{prefix}"),
        F.max(v).cast("double").alias(f"max_{prefix}"),
        F.avg(v).cast("double").alias(f"avg_{prefix}"),
        F.var_pop(v).alias("_var"),
        F.count(v).alias("_n"),
    )
    counts = (
        matches.filter(F.col(right).isNotNull())
        .groupBy(F.col(right).alias("_match"))
        .agg(F.count(F.lit(1)).alias("_m"))
    )
    total = F.col("_n") if dedupe else F.col("_n") * F.col("_m")
    deviation = F.when(total > 1, F.sqrt(F.col("_var") * total / (total - 1)))
    return groups.join(counts, F.col(left) == F.col("_match"), "inner").select(
        *by,
        f"min_{prefix}",
        f"max_{prefix}",
        f"avg_{prefix}",
        deviation.alias(f"sd_{prefix}"),
        total.cast("int").alias(f"{prefix}_count"),
    )
