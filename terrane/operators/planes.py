"""Linear and ridge surfaces z = a + b x + c y of all triples at once.

A plane follows from ten sums over its rows. Rows of one hash bucket share their folds, so the
sums are taken once per (triple, bucket), with a partial aggregate whose size does not depend
on the repeats. Which buckets are in a fold is a small matrix of zeros and ones: its product
with a triple's sums gives the sums of every fold of every repeat, and the training sums are
the total less the fold's own. All fits and their R2 follow from these sums; the rows are read
once more for the absolute errors, as blocks of rows times the matrix of coefficients.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.operators.factors import BY_TRIPLE, Triple, triple_rows
from terrane.operators.folds import FOLDS, fold_table
from terrane.operators.gram import set_table, task_sums
from terrane.operators.meshes import axis_spans
from terrane.session import written

# Fixed value: below this share of Sxx * Syy the two axes count as one.
SINGULAR = 1e-12
# Most fits whose coefficients a task holds at once; more triples are scored part by part.
MAX_FITS = 1_000_000
# Rows of a block that meets the coefficients, so that rows x fits stays in some MB.
BLOCK_CELLS = 500_000

_TERMS = {
    "n": lambda x, y, z: F.lit(1.0),
    "x": lambda x, y, z: x,
    "y": lambda x, y, z: y,
    "z": lambda x, y, z: z,
    "xx": lambda x, y, z: x * x,
    "xy": lambda x, y, z: x * y,
    "yy": lambda x, y, z: y * y,
    "xz": lambda x, y, z: x * z,
    "yz": lambda x, y, z: y * z,
    "zz": lambda x, y, z: z * z,
}
_AT = {name: i for i, name in enumerate(_TERMS)}


def plane_sums(
    rows: DataFrame, middle: DataFrame, extra: Sequence[str] = (), by: Sequence[str] = BY_TRIPLE
) -> DataFrame:
    """The sums of values less their means in ``middle``, per triple and per ``extra``
    columns. Sums of centered values do not cancel."""
    joined = rows.join(middle.select(*by, "mx", "my", "mz"), list(by))
    x, y, z = (F.col(v) - F.col(f"m{v}") for v in "xyz")
    return joined.groupBy(*by, "mx", "my", "mz", *extra).agg(
        *[F.sum(term(x, y, z)).alias(f"s_{name}") for name, term in _TERMS.items()]
    )


def solve(sums: DataFrame, penalties: Sequence[float] = (0.0,)) -> DataFrame:
    """Coefficients ``b0 b1 b2`` per row of sums and penalty. The intercept is not
    penalised. Rows without a unique solution keep NULL coefficients."""
    s = {name: F.col(f"s_{name}") for name in _TERMS}
    df = sums.withColumn("penalty", F.explode(F.array(*[F.lit(float(p)) for p in penalties])))

    def spread(pair: str) -> Column:
        return s[pair] - s[pair[0]] * s[pair[1]] / s["n"]

    df = df.select(
        *[c for c in df.columns if not c.startswith("s_")], F.col("s_n").cast("bigint").alias("n"),
        (spread("xx") + F.col("penalty")).alias("_xx"),
        (spread("yy") + F.col("penalty")).alias("_yy"),
        spread("xy").alias("_xy"), spread("xz").alias("_xz"), spread("yz").alias("_yz"),
        *[(F.col(f"m{v}") + s[v] / s["n"]).alias(f"_{v}") for v in "xyz"],
    )
    det = F.col("_xx") * F.col("_yy") - F.col("_xy") * F.col("_xy")
    det = F.when(det > F.lit(SINGULAR) * F.col("_xx") * F.col("_yy"), det)
    df = df.withColumns({
        "b1": (F.col("_yy") * F.col("_xz") - F.col("_xy") * F.col("_yz")) / det,
        "b2": (F.col("_xx") * F.col("_yz") - F.col("_xy") * F.col("_xz")) / det,
    })
    return df.withColumn(
        "b0", F.col("_z") - F.col("b1") * F.col("_x") - F.col("b2") * F.col("_y")
    ).drop("_xx", "_yy", "_xy", "_xz", "_yz", "_x", "_y", "_z", "mx", "my", "mz")


def plane_value(x: Column, y: Column) -> Column:
    return F.col("b0") + F.col("b1") * x + F.col("b2") * y


def fit_planes(
    rows: DataFrame, penalties: Sequence[float] = (0.0,), by: Sequence[str] = BY_TRIPLE
) -> DataFrame:
    """One plane per triple and penalty from all rows."""
    return solve(plane_sums(rows, axis_spans(rows, by), (), by), penalties)


def whole_fits(sums: DataFrame, penalties: Sequence[float] = (0.0,)) -> DataFrame:
    """The same planes from the sums of buckets."""
    whole = sums.groupBy("triple", "mx", "my", "mz").agg(
        *[F.sum(f"s_{name}").alias(f"s_{name}") for name in _TERMS])
    return solve(whole, penalties)


def _solved(s: np.ndarray, penalty: float) -> np.ndarray:
    """(c, b1, b2) of centered sums along the last axis; NaN without a unique solution."""
    n, x, y, z = (s[..., _AT[name]] for name in ("n", "x", "y", "z"))
    with np.errstate(divide="ignore", invalid="ignore"):
        def spread(pair):
            return s[..., _AT[pair]] - s[..., _AT[pair[0]]] * s[..., _AT[pair[1]]] / n

        xx, yy, xy = spread("xx") + penalty, spread("yy") + penalty, spread("xy")
        det = xx * yy - xy * xy
        det = np.where(det > SINGULAR * xx * yy, det, np.nan)
        b1 = (yy * spread("xz") - xy * spread("yz")) / det
        b2 = (xx * spread("yz") - xy * spread("xz")) / det
        return np.stack([(z - b1 * x - b2 * y) / n, b1, b2], axis=-1)


def _r2(s: np.ndarray, c: np.ndarray) -> np.ndarray:
    """R2 on the rows that the sums ``s`` are of; NaN without rows."""
    a, b1, b2 = c[..., 0], c[..., 1], c[..., 2]
    n, x, y, z, xx, xy, yy, xz, yz, zz = (s[..., i] for i in range(len(_AT)))
    errors = zz + n * a * a + b1 * b1 * xx + b2 * b2 * yy + 2 * (
        a * b1 * x + a * b2 * y + b1 * b2 * xy - a * z - b1 * xz - b2 * yz)
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = zz - z * z / n
        # a constant z leaves rounding only
        flat = ~(spread > 1e-12 * zz)
        r2 = np.where(flat, np.where(errors <= 1e-12 * zz, 1.0, 0.0), 1 - errors / spread)
    return np.where(n > 0, r2, np.nan)


def fold_fits(
    sums: DataFrame, folds: np.ndarray, k: int, penalties: DataFrame | Sequence[float] = (0.0,)
) -> DataFrame:
    """One row per triple: its ``penalties``, and for every (penalty, repeat, held-out fold) in
    this order the coefficients on centered values ``c``, both R2, and both counts of rows.

    ``sums`` are those of buckets, at most as many rows of a triple as there are buckets;
    ``folds`` is the fold of (bucket, repeat). ``penalties`` may differ by triple
    (triple, penalty).
    """
    if isinstance(penalties, DataFrame):
        lists = penalties.groupBy("triple").agg(F.sort_array(F.collect_list("penalty")).alias("penalties"))
        work = sums.join(lists, "triple")
    else:
        work = sums.withColumn("penalties", F.array(*[F.lit(float(p)) for p in penalties]))
    names = [f"s_{name}" for name in _TERMS]

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bucket")
        own = group[names].to_numpy()
        at = folds[group["bucket"].to_numpy()].T
        test = np.stack([(at == h).astype(float) @ own for h in range(k)], axis=1)
        train = own.sum(axis=0) - test
        first = group.iloc[0]
        lists = [float(p) for p in first["penalties"]]
        c = np.stack([_solved(train, p) for p in lists])
        shape = c.shape[:-1]
        made = {
            "c": c, "r2_test": _r2(np.broadcast_to(test, (len(lists), *test.shape)), c),
            "r2_train": _r2(np.broadcast_to(train, (len(lists), *train.shape)), c),
            "n_test": np.broadcast_to(test[..., 0], shape),
            "n_train": np.broadcast_to(train[..., 0], shape)}
        return pd.DataFrame({
            "triple": [int(first["triple"])], "mx": first["mx"], "my": first["my"],
            "mz": first["mz"], "penalties": [lists], **{n: [v.ravel()] for n, v in made.items()}})

    lists = ", ".join(f"{n} array<double>" for n in (
        "penalties", "c", "r2_test", "r2_train", "n_test", "n_train"))
    return work.groupBy("triple").applyInPandas(
        fit, f"triple int, mx double, my double, mz double, {lists}")


SCORES = ["mae_test", "r2_test", "mae_train", "r2_train"]


def fold_errors(
    table: DataFrame, places: Sequence[Sequence[int]], fits: DataFrame, folds: np.ndarray,
    k: int, train: bool = True,
) -> DataFrame:
    """Test and, if asked, train MAE and R2 per triple, penalty, repeat, and fold.

    ``table`` and ``places`` are those of ``set_table`` with the bucket as number. The
    coefficients of at most ``MAX_FITS`` fits go to the tasks at once, which add up the errors
    of all their rows in one vector per triple.
    """
    repeats = folds.shape[1]
    sizes = {r["triple"]: r["n"] for r in fits.select("triple", F.size("penalties").alias("n"))
             .collect()}
    parts, held = [[]], 0
    for triple in sorted(sizes):
        number = sizes[triple] * repeats * k
        if parts[-1] and held + number > MAX_FITS:
            parts.append([])
            held = 0
        parts[-1].append(triple)
        held += number
    result = None
    for part in parts:
        scored = _part_errors(table, places, fits.filter(F.col("triple").isin(part)), folds, k, train)
        result = scored if result is None else result.unionByName(scored)
    return result if train else result.drop("mae_train", "r2_train")


def _part_errors(table, places, fits, folds, k, train):
    repeats = folds.shape[1]
    held = [r.asDict() for r in fits.sort("triple").collect()]
    for r in held:
        shape = (len(r["penalties"]), repeats, k)
        for name in ("r2_test", "r2_train", "n_test", "n_train"):
            r[name] = np.array(r[name], float).reshape(shape)
        r["c"] = np.array(r["c"], float).reshape(*shape, 3)
        r["middle"] = np.array([r["mx"], r["my"], r["mz"]])
    own = [places[r["triple"]] for r in held]

    def measure(i, rows, _, bucket):
        c = held[i]["c"]
        shape = c.shape[:-1]
        flat = c.reshape(-1, 3).T
        test, every = np.zeros(shape), np.zeros(shape)
        step = max(1, BLOCK_CELLS // flat.shape[1])
        for at in range(0, len(rows), step):
            block = rows[at:at + step] - held[i]["middle"]
            a = np.column_stack([np.ones(len(block)), block[:, :2]])
            gap = np.abs(a @ flat - block[:, 2:]).reshape(len(block), *shape)
            fold = folds[bucket[at:at + step]]
            mine = np.take_along_axis(gap, fold[:, None, :, None].astype(np.int64), 3)[..., 0]
            for h in range(k):
                test[:, :, h] += np.where((fold == h)[:, None, :], mine, 0.0).sum(axis=0)
            if train:
                every += gap.sum(axis=0)
        return np.concatenate([test.ravel(), every.ravel()])

    columns = ["triple", "penalty", "repeat", "fold", *SCORES]
    kinds = [pa.int32(), pa.float64(), pa.int32(), pa.int32(), *[pa.float64()] * len(SCORES)]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fit = held[row["set"]]
                test, every = np.array(row["sums"]).reshape(2, *fit["n_test"].shape)
                with np.errstate(divide="ignore", invalid="ignore"):
                    values = [test / fit["n_test"], fit["r2_test"],
                              (every - test) / fit["n_train"], fit["r2_train"]]
                good = ~np.isnan(fit["c"]).any(axis=-1).ravel()
                p, r, h = (x.ravel()[good] for x in np.indices(fit["n_test"].shape))
                made = [np.full(good.sum(), fit["triple"]), np.array(fit["penalties"])[p], r + 1, h]
                made += [v.ravel()[good] for v in values]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, kind, from_pandas=True)
                     for v, kind in zip(made, kinds, strict=True)], columns)

    return task_sums(table, own, measure).mapInArrow(
        rows_of, "triple int, penalty double, repeat int, fold int, "
        + ", ".join(f"{s} double" for s in SCORES))


def fold_scores(
    df: DataFrame, triples: Sequence[Triple], penalties: Sequence[float] = (0.0,),
    k: int = FOLDS, repeats: int = 1,
) -> DataFrame:
    """Scores of all triples of rows that carry their ``bucket``: sums, fits, and errors."""
    rows = triple_rows(df, triples, ["bucket"])
    sums = plane_sums(rows, written(axis_spans(rows), "spans"), ["bucket"])
    folds = fold_table(k, repeats)
    fits = written(fold_fits(sums, folds, k, penalties), "fold-fits")
    table, places = set_table(
        df, [((x, y), z) for x, y, z in triples], F.lit(True), F.col("bucket"))
    return fold_errors(table, places, fits, folds, k)


def mean_scores(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Means over folds and repeats. Errors carry a minus sign: greater is better."""
    return scores.groupBy(*by).agg(
        (-F.avg("mae_test")).alias("mae_test"), (-F.avg("mae_train")).alias("mae_train"),
        F.avg("r2_test").alias("r2_test"), F.avg("r2_train").alias("r2_train"),
    )
