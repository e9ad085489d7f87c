"""Comparison of regressors on factor sets, best first: all sets and regressors at once.

The rows are read a fixed number of times, whatever the number of sets: for the sums that the
linear fits follow from, for the weighted passes and the levels of trees, and for the errors of
all fits. See ``gram`` for how a pass sums many sets without a row per set.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrane.functions.predicates import quoted, text
from terrane.operators import gram, levels
from terrane.operators.factors import MIN_ROWS
from terrane.operators.folds import train_rows
from terrane.operators.gram import Moments, Set, collected, set_table, task_sums
from terrane.session import written

MEASURES = ["mae", "mse", "rmse", "r2", "rmsle", "mape"]
SIDES = ["", "_train"]
#: Sets whose sums a task holds at once; more are compared part by part.
SETS = 2048

# abbreviation -> (name, fit from the cross sums of a set)
LINEAR = {
    "dummy": ("Dummy Regressor", gram.mean_only),
    "lr": ("Linear Regression", gram.least_squares),
    "ridge": ("Ridge Regression", gram.ridge),
    "lasso": ("Lasso Regression", gram.lasso),
    "en": ("Elastic Net", gram.elastic_net),
    "omp": ("Orthogonal Matching Pursuit", gram.pursuit),
}
OTHERS = {
    "huber": "Huber Regressor",
    "dt": "Decision Tree Regressor",
    "rf": "Random Forest Regressor",
    "et": "Extra Trees Regressor",
    "gbr": "Gradient Boosting Regressor",
}
REGRESSORS = {**{k: v[0] for k, v in LINEAR.items()}, **OTHERS}


def _guesses(names, lines, trees, middle, wide):
    """A function (set, xs) -> one guess per regressor and row."""
    def guesses(i: int, xs: np.ndarray) -> list[np.ndarray]:
        bins = levels.binned(xs, wide[i]) if i in wide else None
        out = []
        for name in names:
            if name in lines:
                out.append(gram.guess(lines[name][i], xs))
            elif name == "gbr":
                out.append(middle[i] + levels.RATE * sum(t.guess(bins) for t in trees[name][i]))
            else:
                out.append(np.mean([t.guess(bins) for t in trees[name][i]], axis=0))
        return out

    return guesses


def _errors(z: np.ndarray, p: np.ndarray) -> list[float]:
    gap = np.abs(z - p)
    logs = np.log1p(np.abs(p)) - np.log1p(np.abs(z))
    share = np.divide(gap, np.abs(z), out=np.zeros(len(z)), where=z != 0)
    return [gap.sum(), (gap * gap).sum(), (logs * logs).sum(), share.sum()]


def _measures(sums: np.ndarray, models: int) -> list[list[float | None]]:
    """Per regressor the six measures of one side from its sums."""
    n, z, zz, nonzero = sums[:4]
    out = []
    for gap, square, logs, share in sums[4:].reshape(models, 4):
        if n == 0:
            out.append([None] * len(MEASURES))
            continue
        spread = zz - z * z / n
        # what is left of a constant z after centering is rounding
        r2 = 1 - square / spread if spread > 1e-12 * zz else float(square == 0)
        out.append([gap / n, square / n, float(np.sqrt(square / n)), r2,
                    float(np.sqrt(logs / n)), share / nonzero if nonzero else None])
    return out


def _part(table: DataFrame, places, means: np.ndarray, cuts, names, least: int) -> DataFrame:
    """(set, n, model, measures) of the sets ``places``; sets with fewer than ``least`` rows
    have one row with the count and no model."""
    middles = [means[p] for p in places]

    def first(i, rows, train, number):
        return np.r_[len(rows), train.sum(), gram.gram(rows[train], middles[i])]

    sums = collected(task_sums(table, places, first))
    enough = [i for i, s in sums.items() if s[0] >= least and s[1] >= 2]
    moments = {i: Moments(sums[i][2:], middles[i]) for i in enough}
    lines = {name: {i: LINEAR[name][1](moments[i]) for i in enough}
             for name in names if name in LINEAR}
    if "huber" in names:
        lines["huber"] = gram.huber(
            table, places, middles, {i: gram.least_squares(moments[i]) for i in enough})
    trees, middle = {}, {i: moments[i].z for i in enough}
    wide = {i: [cuts[c] for c in places[i][:-1]] for i in enough} if cuts else {}
    p_of = {i: len(places[i]) - 1 for i in enough}
    for name, count, sample, narrow in (
            ("dt", 1, False, None), ("rf", levels.TREES, True, False),
            ("et", levels.TREES, False, True)):
        if name in names:
            choice = None if narrow is None else levels.drawn_splits(p_of, narrow)
            trees[name] = levels.grow(
                table, places, cuts, enough, count, levels.DEPTH, sample, choice)
    if "gbr" in names:
        trees["gbr"] = levels.boosted(table, places, cuts, enough, middle)
    guesses = _guesses(names, lines, trees, middle, wide)

    def last(i, rows, train, number):
        if i not in moments:
            return np.array([len(rows)], float)
        own = guesses(i, rows[:, :-1])
        out = [len(rows)]
        for side in (~train, train):
            z = rows[side, -1]
            c = z - middles[i][-1]
            out += [len(z), c.sum(), (c * c).sum(), (z != 0).sum()]
            for p in own:
                out += _errors(z, p[side])
        return np.array(out, float)

    columns = [f"{m}{side}" for side in SIDES for m in MEASURES]
    n_models = len(names)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = {"set": [], "n": [], "model_abbreviation": [], **{c: [] for c in columns}}
        for batch in batches:
            for row in batch.to_pylist():
                sums = np.array(row["sums"])
                if len(sums) == 1:
                    found = [(None, [None] * len(columns))]
                else:
                    test, train = np.split(sums[1:], 2)
                    sides = zip(_measures(test, n_models), _measures(train, n_models), strict=True)
                    found = [(name, a + b) for name, (a, b) in zip(names, sides, strict=True)]
                for name, values in found:
                    made["set"].append(row["set"])
                    made["n"].append(int(sums[0]))
                    made["model_abbreviation"].append(name)
                    for c, v in zip(columns, values, strict=True):
                        made[c].append(v)
        kinds = [pa.int32(), pa.int64(), pa.string(), *[pa.float64()] * len(columns)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(made.values(), kinds, strict=True)], list(made))

    return task_sums(table, places, last).mapInArrow(
        rows_of, "set int, n long, model_abbreviation string, "
        + ", ".join(f"`{c}` double" for c in columns))


def survey(
    df: DataFrame, sets: Sequence[Set], key: Sequence[str],
    regressors: Sequence[str] = tuple(REGRESSORS), sort: str = "r2", least: int = MIN_ROWS,
) -> DataFrame:
    """(x, z, n, model_abbreviation, model, test measures, train measures, rank): every
    regressor on every set (x columns, z column), ranked within its set by the test measure
    ``sort``; measures alike to nine decimals tie, and ties go by abbreviation. If all sets are
    pairs of x columns, their names are ``x`` and ``y``, else one name with plus signs.

    A set's rows are those with all its values; three quarters of them, by a hash of ``key``,
    train. A set with fewer than ``least`` rows (or two that train) has one row without a
    model, also if it has none at all. A measure is missing without rows of its side, and the
    relative error without a z other than 0.
    """
    if not sets:
        raise ValueError("no factor sets")
    unknown = set(regressors) - set(REGRESSORS)
    if unknown:
        raise ValueError(f"no such regressors: {sorted(unknown)}")
    spark = df.sparkSession
    table, places = set_table(
        df, sets, train_rows(key), F.xxhash64(*[quoted(k).cast("string") for k in key]))
    table = written(table, "survey")
    width = len(table.columns) - 2
    middle = table.agg(*[F.avg(F.nanvl(f"c{i}", F.lit(None))) for i in range(width)]).first()
    means = np.array([m if m is not None else 0.0 for m in middle], float)
    cuts = levels.cuts_of(table, width) if set(regressors) & {"dt", "rf", "et", "gbr"} else None
    parts = []
    for at in range(0, len(sets), SETS):
        part = _part(table, places[at:at + SETS], means, cuts, list(regressors), least)
        parts.append(part.withColumn("set", F.col("set") + at))
    scores = parts[0]
    for part in parts[1:]:
        scores = scores.unionByName(part)
    every = spark.range(len(sets)).select(F.col("id").cast("int").alias("set"))
    named = every.join(written(scores, "scores"), "set", "left").withColumn(
        "n", F.coalesce("n", F.lit(0)))
    pick = lambda values: F.expr(
        f"element_at(array({', '.join(text(v) for v in values)}), set + 1)")
    titles = F.create_map(*[F.lit(v) for item in REGRESSORS.items() for v in item])
    value = F.round(sort, 9)
    order = value.desc_nulls_last() if sort == "r2" else value.asc_nulls_last()
    rank = F.row_number().over(Window.partitionBy("set").orderBy(order, "model_abbreviation"))
    pairs = all(len(xs) == 2 for xs, _ in sets)
    axes = [pick([xs[i] for xs, _ in sets]).alias(a) for i, a in enumerate("xy")] if pairs else [
        pick(["+".join(xs) for xs, _ in sets]).alias("x")]
    return named.select(
        *axes, pick([z for _, z in sets]).alias("z"), "n", "model_abbreviation", titles[F.col("model_abbreviation")].alias("model"),
        *[m + side for side in SIDES for m in MEASURES],
        F.when(F.col("model_abbreviation").isNotNull(), rank).alias("rank"))


def compare_models(
    df: DataFrame, xs: Sequence[str], z: str, key: Sequence[str],
    regressors: Sequence[str] = tuple(REGRESSORS), sort: str = "r2", least: int = MIN_ROWS,
) -> DataFrame:
    """The ranking of one set."""
    return survey(df, [(tuple(xs), z)], key, regressors, sort, least)


def best_models(scores: DataFrame) -> DataFrame:
    """The top row of each factor set, also of those without a model."""
    return scores.filter(F.coalesce("rank", F.lit(1)) == 1).drop("rank")


def survey_models(
    df: DataFrame, sets: Sequence[Set], key: Sequence[str],
    regressors: Sequence[str] = tuple(REGRESSORS), sort: str = "r2",
) -> DataFrame:
    """The best model of every factor set."""
    return best_models(survey(df, sets, key, regressors, sort))
