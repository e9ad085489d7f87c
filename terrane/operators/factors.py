"""Which columns form the axes, and the rows of every axis triple."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions.predicates import cols_matching, quoted, text, ticked
from terrane.operators.gram import set_table, task_sums
from terrane.operators.merging import ENERGIES, RELATIVE

# Axis patterns, least rows of a comparison, least share of a landscape.
X_PATTERN = r"(.*_)?(hd|pcd)$"
Y_PATTERN = r".*(srel|seasonal).*(sd|total_score).*"
TITER_PATTERN = r".*(logfold)($|\|cladei$)"
ANY_TITER_PATTERN = r".*(log).*"
COMPARE_X_PATTERN = r"(.*_)?(hd|pcd|sd)$"
METADATA_PATTERN = r"(variant|clade|subtype|protein|substitution).*"
METADATA_COUNT = 5
MIN_ROWS = 10
MIN_SHARE = 0.25

Triple = tuple[str, str, str]
TRIPLE = ["x_factor", "y_factor", "z_factor"]
BY_TRIPLE = ("triple",)


def limit_factors(columns: Sequence[str], lots: Sequence[str]) -> list[str]:
    """Columns whose name holds one of the lots."""
    return [c for c in columns if any(lot in c for lot in lots)]


def z_factors(
    columns: Sequence[str], context: str, lots: Sequence[str] | None = None
) -> list[str]:
    titers = cols_matching(columns, TITER_PATTERN)
    if lots is not None:
        titers = limit_factors(titers, lots)
    scores = ["total_score", *RELATIVE, *[e for e in ENERGIES if e != "total_score"]]
    chosen = {
        "all": scores + titers,
        "antigenic": titers,
        "mixed": ["srel_total_score", *titers],
        "proteomic": scores,
    }
    if context not in chosen:
        raise ValueError(f"context is one of {sorted(chosen)}, not {context!r}")
    return [c for c in chosen[context] if c in columns]


def factor_triples(
    columns: Sequence[str], context: str = "mixed", lots: Sequence[str] | None = None
) -> list[Triple]:
    """Axis triples of three different columns: names only, no data is read."""
    xs = cols_matching(columns, X_PATTERN)
    ys = cols_matching(columns, Y_PATTERN)
    zs = z_factors(columns, context, lots)
    return [t for t in product(xs, ys, zs) if len(set(t)) == 3]


def factor_sets(
    columns: Sequence[str], mode: str = "composite", context: str = "all"
) -> list[tuple[tuple[str, ...], str]]:
    """(x columns, z column) sets of a model comparison: all x columns at once, or
    every unordered pair of them."""
    xs = cols_matching(columns, COMPARE_X_PATTERN)
    titers = cols_matching(columns, ANY_TITER_PATTERN)
    energies = [e for e in ENERGIES if e in columns]
    zs = {"all": energies + titers, "antigenic": titers, "proteomic": energies}[context]
    if mode == "composite":
        return [(tuple(xs), z) for z in zs]
    if mode == "iterative":
        return [(pair, z) for pair in combinations(xs, 2) for z in zs]
    raise ValueError(f"mode is 'composite' or 'iterative', not {mode!r}")


def metadata_columns(columns: Sequence[str]) -> list[str]:
    return cols_matching(columns, METADATA_PATTERN)[:METADATA_COUNT]


def _long(
    df: DataFrame, tuples: Sequence[tuple[str, ...]], axes: str, number: str,
    keep: Sequence[str],
) -> DataFrame:
    """One row per source row and column tuple whose values are all present, with the
    number of the tuple.

    The tuples are a constant of the plan, one expression for all of them, so rows are
    widened in place; the aggregates that follow combine before their shuffle.
    """
    cells = ", ".join(
        "named_struct(" + ", ".join([f"'{number}', {i}"] + [
            f"'{a}', CAST({ticked(c)} AS DOUBLE)" for a, c in zip(axes, columns)
        ]) + ")"
        for i, columns in enumerate(tuples)
    )
    rows = df.select(*[quoted(c) for c in keep], F.expr(f"inline(array({cells}))"))
    return rows.dropna(subset=list(axes))


def triple_rows(
    df: DataFrame, triples: Sequence[Triple], keep: Sequence[str] = ()
) -> DataFrame:
    """Long form of x, y, and z: the complete rows of every triple. Groups are keyed by
    the number of the triple; ``named`` gives the names back."""
    return _long(df, triples, "xyz", "triple", keep)


def pair_rows(
    df: DataFrame, triples: Sequence[Triple], keep: Sequence[str] = ()
) -> DataFrame:
    """Long form of x and y for the distinct axis pairs of the triples."""
    pairs = sorted({t[:2] for t in triples})
    rows = _long(df, pairs, "xy", "_pair", keep)
    return _with_names(rows, pairs, TRIPLE[:2], "_pair").drop("_pair")


def named(df: DataFrame, triples: Sequence[Triple]) -> DataFrame:
    """``df`` with the names of its triples in the place of their number."""
    table = _with_names(df, triples, TRIPLE, "triple").drop("triple")
    return table.select(*TRIPLE, *[quoted(c) for c in table.columns if c not in TRIPLE])


def _with_names(
    df: DataFrame, tuples: Sequence[tuple[str, ...]], columns: Sequence[str], number: str
) -> DataFrame:
    return df.withColumns({
        c: F.expr(f"element_at(array({', '.join(text(t[i]) for t in tuples)}), {number} + 1)")
        for i, c in enumerate(columns)
    })


def row_guard(
    df: DataFrame, triples: Sequence[Triple], need: Sequence[str] = (),
    share: float = MIN_SHARE, least: int = 0,
) -> DataFrame:
    """Rows per triple with all values and all ``need`` columns present, and whether
    there is one, and they reach the share of all rows of ``df`` and the least count.

    One pass: every task counts its complete rows of all triples, so what is shuffled depends
    on the triples and tasks, and not on how many patterns of missing values there are.
    """
    if not triples:
        return df.sparkSession.createDataFrame(
            [], f"{', '.join(f'{c} string' for c in TRIPLE)}, n bigint, enough boolean")
    whole = F.lit(True)
    for c in need:
        whole = whole & quoted(c).isNotNull()
    table, places = set_table(df, [((x, y), z) for x, y, z in triples], whole, F.lit(0))
    found = task_sums(table, places, lambda i, rows, known, number: np.array([float(known.sum())]))
    every = df.sparkSession.range(len(triples)).select(F.col("id").cast("int").alias("triple"))
    counts = every.join(found.withColumnRenamed("set", "triple"), "triple", "left").select(
        "triple", F.coalesce(F.get("sums", F.lit(0)), F.lit(0.0)).cast("bigint").alias("n"))
    bound = df.agg(F.ceil(F.count(F.lit(1)) * F.lit(share)).alias("bound")).scalar()
    return named(counts, triples).withColumn(
        "enough", (F.col("n") >= bound) & (F.col("n") >= least) & (F.col("n") > 0))


def enough_triples(guard: DataFrame) -> list[Triple]:
    """The triples that passed: at most as many names as were asked for."""
    return [tuple(r) for r in guard.filter("enough").select(*TRIPLE).sort(*TRIPLE).collect()]


def set_counts(
    df: DataFrame, sets: Sequence[tuple[tuple[str, ...], str]], least: int = MIN_ROWS
) -> DataFrame:
    """Complete rows per factor set, in one scan, and whether they reach the least."""
    names = ["+".join(xs) for xs, _ in sets]
    counts = df.agg(*[
        F.expr("count_if(" + " AND ".join(f"{ticked(c)} IS NOT NULL" for c in (*xs, z)) + ")")
        .alias(f"_{i}")
        for i, (xs, z) in enumerate(sets)
    ])
    cells = ", ".join(
        f"named_struct('x', {text(x)}, 'z', {text(z)}, 'n', _{i}, 'enough', _{i} >= {least})"
        for i, (x, (_, z)) in enumerate(zip(names, sets))
    )
    return counts.select(F.expr(f"inline(array({cells}))"))
