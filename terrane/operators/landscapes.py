"""Landscape tables: mesh predictions, predictions at observed points, summaries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions.predicates import quoted
from terrane.operators.factors import (
    TRIPLE, Triple, enough_triples, metadata_columns, named, pair_rows, row_guard,
    triple_rows,
)
from terrane.operators.folds import (
    FINAL_REPEATS, FOLDS, SEARCH_REPEATS, fold_table, with_bucket,
)
from terrane.operators.gram import set_table
from terrane.operators.meshes import axis_ranges, axis_spans, mesh
from terrane.operators.metrics import cv_summary
from terrane.operators.planes import (
    fold_errors, fold_fits, mean_scores, plane_sums, plane_value, whole_fits,
)
from terrane.operators.selection import choose_model
from terrane.session import spread, written

# Columns of the landscape table in order, and what a family lacks.
HYPERPARAMETERS = {
    "n_estimators": "int", "learning_rate": "double", "max_features": "int",
    "min_samples_split": "int",
}
SCORES = ["mae_test", "mae_train", "r2_test", "r2_train"]
CV_SCORES = ["cv_mae_mean", "cv_mae_median", "cv_r2_mean", "cv_r2_median"]
PREDICTED = ["x_predicted", "y_predicted", "z_predicted"]
PENALTIES = (0.0, 0.1, 1.0, 10.0)


@dataclass(frozen=True)
class Landscape:
    """``mesh`` has one row per mesh point, ``metrics`` one per observed row, ``summary``
    one per fitted triple, and ``triples`` one per asked triple, with the ``reason`` why it
    has no model or no mesh."""

    mesh: DataFrame
    metrics: DataFrame
    summary: DataFrame
    triples: DataFrame


def triple_reasons(guard: DataFrame, spans: DataFrame, passed: Sequence[Triple]) -> DataFrame:
    """The guard's rows with a ``reason``: too few rows, a constant axis, or NULL."""
    ranges = named(axis_ranges(spans), passed) if passed else guard.withColumn(
        "reason", F.lit(None).cast("string"))
    few = F.when(~F.col("enough"), F.lit("too few rows"))
    return guard.join(ranges.select(*TRIPLE, "reason"), TRIPLE, "left").withColumn(
        "reason", F.coalesce(few, "reason"))


def guarded(
    df: DataFrame, triples: Sequence[Triple], metadata: Sequence[str]
) -> tuple[DataFrame, list[Triple]]:
    """The written guard and the triples that pass it. Without any, nothing can be fitted."""
    guard = written(row_guard(df, triples, metadata), "guard")
    passed = enough_triples(guard)
    if not passed:
        raise ValueError("no triple has enough rows; row_guard tells their numbers")
    return guard, passed


def observed_rows(
    df: DataFrame, triples: Sequence[Triple], metadata: Sequence[str], model: DataFrame
) -> DataFrame:
    """Distinct (metadata, x, y) of every triple of ``model``, whether z is known or
    not. Rows are made distinct per axis pair, before they meet the z of each triple."""
    known = df.dropna(subset=list(metadata))
    points = pair_rows(known, triples, metadata).distinct()
    return points.join(model, ["x_factor", "y_factor"])


def plane_landscape(
    df: DataFrame,
    triples: Sequence[Triple],
    key: Sequence[str],
    penalties: Sequence[float] = PENALTIES,
    k: int = FOLDS,
    search_repeats: int = SEARCH_REPEATS,
    final_repeats: int = FINAL_REPEATS,
) -> Landscape:
    """Landscapes of all triples from linear (penalty 0) and ridge surfaces.

    The search scores every penalty, the choice rule picks one per triple, and the
    chosen one is cross-validated again. ``key`` identifies a row of ``df`` for the
    folds. The penalty takes the place of a learning rate in the tables.
    """
    metadata = metadata_columns(df.columns)
    guard, passed = guarded(df, triples, metadata)
    axes = sorted({name for triple in passed for name in triple})
    narrow = spread(df.select(*[quoted(c) for c in [*key, *axes]]), key)
    hashed = written(with_bucket(narrow, key).drop(*key), "hashed-rows")
    rows = triple_rows(hashed, passed, ["bucket"])
    spans = written(axis_spans(rows.drop("bucket")), "spans")
    sums = written(plane_sums(rows, spans, ["bucket"]), "bucket-sums")
    # the repeats of the search are the first of the final check
    folds = fold_table(k, max(search_repeats, final_repeats))
    table, places = set_table(
        hashed, [((x, y), z) for x, y, z in passed], F.lit(True), F.col("bucket"))

    def scored(repeats: int, of, train: bool) -> DataFrame:
        own = folds[:, :repeats]
        fits = written(fold_fits(sums, own, k, of), "fold-fits")
        return fold_errors(table, places, fits, own, k, train)

    means = mean_scores(
        scored(search_repeats, penalties, True), ["triple", "penalty"]).withColumn(
        "model", F.when(F.col("penalty") == 0, F.lit("linear")).otherwise(F.lit("ridge"))
    )
    chosen = written(choose_model(means, ["triple"], ["penalty"]), "chosen-models")
    final = scored(final_repeats, chosen.select("triple", "penalty"), False)
    checked = cv_summary(
        final.select("triple", (-F.col("mae_test")).alias("mae"), F.col("r2_test").alias("r2")),
        ["triple"], ["mae", "r2"],
    )
    model = written(
        chosen.withColumn("learning_rate", F.col("penalty"))
        .join(checked, "triple")
        .join(whole_fits(sums, penalties).drop("n"), ["triple", "penalty"]).drop("penalty"),
        "surface-models",
    )
    names = named(model, passed)
    predicted = plane_value(F.col("x"), F.col("y"))
    points = mesh(axis_ranges(spans)).join(model, "triple").withColumn("z", predicted)
    return assemble(
        df, metadata, names, named(points, passed),
        observed_rows(df, passed, metadata, names.select(*TRIPLE, "b0", "b1", "b2"))
        .withColumn("z_predicted", predicted),
        triple_reasons(guard, spans, passed),
    )


def assemble(
    df: DataFrame, metadata: Sequence[str], model: DataFrame, points: DataFrame,
    observed: DataFrame, triples: DataFrame,
) -> Landscape:
    """The tables in their published columns.

    ``model`` has one row per triple with scores; ``points`` and ``observed`` carry
    predictions. Subtype and protein are those of the table, which holds one of each.
    """
    labels = df.agg(F.struct(
        F.min("subtype").alias("subtype"), F.min("protein").alias("protein")).alias("l")).scalar()
    missing = {
        name: F.lit(None).cast(kind) for name, kind in HYPERPARAMETERS.items()
        if name not in model.columns
    }
    head = ["subtype", "protein", *TRIPLE, "model", *HYPERPARAMETERS, *SCORES, *CV_SCORES]

    def labelled(table: DataFrame) -> DataFrame:
        return table.withColumns({
            "subtype": labels.getField("subtype"), "protein": labels.getField("protein"), **missing
        })

    surface = labelled(points).select(
        *head, "ix", "iy", *[F.col(v).alias(f"{v}_predicted") for v in "xyz"]
    )
    return Landscape(
        mesh=surface,
        metrics=observed.select(
            *[quoted(c) for c in metadata], *TRIPLE, "x", "y", "z_predicted"),
        summary=labelled(model).select(*head),
        triples=triples,
    )


def landscape_summary(surface: DataFrame) -> DataFrame:
    """One row per triple from a stored mesh."""
    return surface.drop(*PREDICTED, "ix", "iy").distinct()
