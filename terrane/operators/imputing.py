"""Filling of missing values with the mean of a group or of the whole column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions.numbers import log_titer, number_or_null, unlog_titer
from terrane.functions.predicates import cols_matching, quoted

# Which columns are filled, which of them are log-scaled, and the keys.
FILLED = r".*logfold"
LOG_SCALED = r".*titer"
BASIS = r".*(clade|log|titer|ag_cdc_id|ag_isolate_id|variant_hash).*"
GROUP_SUFFIX = "|cladei"
COLUMN_SUFFIX = "|meani"


def _scaled(name: str, scaled: Sequence[str]) -> Column:
    value = number_or_null(quoted(name))
    return log_titer(value) if name in scaled else value


def _restored(value: Column, name: str, scaled: Sequence[str]) -> Column:
    return unlog_titer(value) if name in scaled else value


def _means(cols: Sequence[str], scaled: Sequence[str]) -> list[Column]:
    return [F.avg(_scaled(c, scaled)).alias(f"_m{i}") for i, c in enumerate(cols)]


def impute_by_group(
    df: DataFrame, by: str, cols: Sequence[str], scaled: Sequence[str] = (),
    basis: DataFrame | None = None, suffix: str = GROUP_SUFFIX,
) -> DataFrame:
    """Add each column with its gaps filled by the group mean.

    Gaps stay where the group has no value or the row has no group. The means are
    aggregated first and joined by group, so a large group is not sorted in one task.
    ``basis`` holds the rows the means are taken of, ``df`` itself by default.
    """
    means = (df if basis is None else basis).groupBy(quoted(by).alias("_by")).agg(
        *_means(cols, scaled)
    )
    joined = df.join(means, quoted(by) == F.col("_by"), "left")
    filled = {
        c + suffix: _restored(F.coalesce(_scaled(c, scaled), F.col(f"_m{i}")), c, scaled)
        for i, c in enumerate(cols)
    }
    return joined.withColumns(filled).drop("_by", *[f"_m{i}" for i in range(len(cols))])


def impute_by_column(
    df: DataFrame, cols: Sequence[str], scaled: Sequence[str] = (),
    basis: DataFrame | None = None, suffix: str = COLUMN_SUFFIX,
) -> DataFrame:
    """Add each column with its gaps filled by the mean of the column: a one-row
    aggregate, used as a scalar subquery."""
    means = (df if basis is None else basis).agg(*_means(cols, scaled))
    packed = means.select(F.struct(*means.columns).alias("m")).scalar()
    filled = {
        c + suffix: _restored(
            F.coalesce(_scaled(c, scaled), packed.getField(f"_m{i}")), c, scaled)
        for i, c in enumerate(cols)
    }
    return df.withColumns(filled)


def impute_table(df: DataFrame, by: str = "clade") -> DataFrame:
    """Both fills of every titer column, after equal rows are dropped.

    The means are taken of the distinct combinations of keys and antigenic columns, filled or
    not, so a variant that repeats with other metadata counts once.
    """
    rows = df.dropDuplicates()
    cols = cols_matching(rows, FILLED)
    scaled = [c for c in cols if c in cols_matching(rows, LOG_SCALED)]
    basis = rows.select(*[quoted(c) for c in cols_matching(rows, BASIS)]).dropDuplicates()
    filled = impute_by_group(rows, by, cols, scaled, basis)
    return impute_by_column(filled, cols, scaled, basis)
