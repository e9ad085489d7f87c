"""Queries and oracles of the factor, fold, metric, and landscape operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrane.bindings.model_table import KEY, TITERS, model_sql, model_table
from terrane.bindings.star import star
from terrane.functions.predicates import quoted
from terrane.operators import (
    factors, folds, landscapes, meshes, metrics, planes, selection, surfaces,
)
from terrane.operators.factors import TRIPLE
from terrane.session import spread, written

METADATA = ["subtype", "protein", "clade", "variant_hash", "substitution_list"]
COLUMNS = [*METADATA, "hd", "pcd", "total_score", "srel_total_score", "H3_seasonal_calpha_sd",
           "H3_seasonal_heavy_sd", *TITERS]
TRIPLES = factors.factor_triples(COLUMNS, "mixed")
PENALTIES = (0.0, 100.0, 10000.0)
K = 5
SEARCH, FINAL = 20, 200
NAMES = ", ".join(TRIPLE)
X, Y, Z = "hd", "H3_seasonal_calpha_sd", TITERS[0]


def rounded(df, digits=6, skip=()):
    numbers = [c for c, kind in df.dtypes if kind == "double" and c not in skip]
    return df.withColumns({c: F.round(quoted(c), digits) for c in numbers})


def triples_sql(source: str = "model", need_z: bool = True, keep: str = KEY) -> str:
    """Long rows of all triples."""
    return "\nUNION ALL\n".join(
        f"SELECT {keep}, '{x}' AS x_factor, '{y}' AS y_factor, '{z}' AS z_factor, "
        f"\"{x}\" AS x, \"{y}\" AS y, \"{z}\" AS z FROM {source} "
        f"WHERE \"{x}\" IS NOT NULL AND \"{y}\" IS NOT NULL"
        + (f" AND \"{z}\" IS NOT NULL" if need_z else "")
        for x, y, z in TRIPLES
    )


KNOWN = " AND ".join(f"{c} IS NOT NULL" for c in METADATA)
BASE = f"""
{model_sql()},
long AS MATERIALIZED ({triples_sql()}),
guard AS (
  SELECT {NAMES}, COUNT({KEY}) AS n,
         COUNT({KEY}) >= (SELECT CEIL(COUNT(*) * 0.25) FROM model) AS enough
  FROM (VALUES {", ".join(map(str, TRIPLES))}) AS asked({NAMES})
  LEFT JOIN ({triples_sql(f"(SELECT * FROM model WHERE {KNOWN})")}) USING ({NAMES})
  GROUP BY {NAMES})
"""


def row_guard(spark, sf):
    return factors.row_guard(model_table(spark, sf), TRIPLES, METADATA)


GUARD_SQL = f"WITH {BASE} SELECT * FROM guard"

# A constant axis, an axis with few values, and the usual ones.
ASKED = [("hd", "flat", Z), ("hd", "rare", Z), (X, Y, Z), ("hd", "total_score", TITERS[1])]


def skipped_triples(spark, sf):
    table = model_table(spark, sf).withColumns({
        "flat": F.lit(1.0), "rare": F.when(F.col("hd") > 45, F.col("total_score"))})
    guard, passed = landscapes.guarded(table, ASKED, METADATA)
    spans = meshes.axis_spans(factors.triple_rows(table, passed))
    return landscapes.triple_reasons(guard, spans, passed)


SKIPPED_SQL = f"""
WITH {model_sql()},
wide AS (SELECT *, 1.0e0 AS flat, CASE WHEN hd > 45 THEN total_score END AS rare FROM model),
bound AS (SELECT CEIL(COUNT(*) * 0.25) AS least FROM model),
counts AS (""" + "\nUNION ALL\n".join(f"""
  SELECT '{x}' AS x_factor, '{y}' AS y_factor, '{z}' AS z_factor,
         COUNT(*) FILTER (WHERE {KNOWN}) AS n, MIN("{x}") = MAX("{x}") OR MIN("{y}") = MAX("{y}") AS flat
  FROM wide WHERE "{x}" IS NOT NULL AND "{y}" IS NOT NULL AND "{z}" IS NOT NULL"""
    for x, y, z in ASKED) + """)
SELECT x_factor, y_factor, z_factor, n, n >= least AS enough,
       CASE WHEN n < least THEN 'too few rows' WHEN flat THEN 'constant axis' END AS reason
FROM counts, bound
"""


def factor_set_counts(spark, sf):
    table = model_table(spark, sf)
    sets = factors.factor_sets(table.columns, "composite", "all")
    sets += factors.factor_sets(table.columns, "iterative", "antigenic")
    return factors.set_counts(table, sets)


SETS = factors.factor_sets(COLUMNS, "composite", "all") + factors.factor_sets(
    COLUMNS, "iterative", "antigenic")
SETS_SQL = f"WITH {model_sql()} " + "\nUNION ALL\n".join(
    f"SELECT '{'+'.join(xs)}' AS x, '{z}' AS z, COUNT(*) AS n, COUNT(*) >= 10 AS enough FROM model "
    "WHERE " + " AND ".join(f'"{c}" IS NOT NULL' for c in (*xs, z))
    for xs, z in SETS
)

HASH = "('0x' || SUBSTR(MD5(CONCAT_WS('|', {parts})), 1, 8))::BIGINT"
# rows of a bucket share their folds
BUCKET = f"{HASH.format(parts='12345678, variant_hash')} % {folds.BUCKETS}"
FOLD = f"CAST({HASH.format(parts='12345678, repeat, bucket')} % {K} AS INT)"


def kfold_ids(spark, sf):
    orders = star(spark, sf, "orders").select("o_orderkey")
    return folds.fold_ids(orders, ["o_orderkey"], K, 3)


KFOLD_SQL = f"""
SELECT o_orderkey, repeat,
       CAST({HASH.format(parts="12345678, repeat, o_orderkey")} % {K} AS INT) AS fold
FROM (SELECT o_orderkey, CAST(UNNEST(range(1, 4)) AS INT) AS repeat FROM orders)
"""


def kfold_ids_balanced(spark, sf):
    orders = star(spark, sf, "orders").select("o_orderkey")
    return folds.fold_ids(orders, ["o_orderkey"], K, 3, balanced=True)


KFOLD_BALANCED_SQL = f"""
SELECT o_orderkey, repeat,
       CAST((ROW_NUMBER() OVER (
         PARTITION BY repeat
         ORDER BY {HASH.format(parts="12345678, repeat, o_orderkey")}, o_orderkey) - 1)
         % {K} AS INT) AS fold
FROM (SELECT o_orderkey, CAST(UNNEST(range(1, 4)) AS INT) AS repeat FROM orders)
"""


def train_split(spark, sf):
    return star(spark, sf, "customer").select(
        "c_custkey", folds.train_rows(["c_custkey"]).alias("train")
    )


SPLIT_SQL = f"""
SELECT c_custkey, {HASH.format(parts="12345678, 'split', c_custkey")} % 100 < 75 AS train
FROM customer
"""


def regression_metrics(spark, sf):
    lines = star(spark, sf, "lineitem").select(
        "l_returnflag", "l_linestatus",
        F.col("l_extendedprice").alias("z"),
        (F.col("l_quantity") * 1800.0 + 4000.0).alias("z_predicted"),
    )
    scores = metrics.regression_metrics(lines, ["l_returnflag", "l_linestatus"])
    return rounded(scores.withColumn("mse", F.col("mse") / 1e6))


METRICS_SQL = """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n,
       ROUND(AVG(ABS(z - p)), 6) AS mae, ROUND(AVG((z - p) ** 2) / 1e6, 6) AS mse,
       ROUND(SQRT(AVG((z - p) ** 2)), 6) AS rmse,
       ROUND(1 - SUM((z - p) ** 2) / (VAR_POP(z) * COUNT(*)), 6) AS r2,
       ROUND(SQRT(AVG((LN(1 + ABS(p)) - LN(1 + ABS(z))) ** 2)), 6) AS rmsle,
       ROUND(AVG(CASE WHEN z <> 0 THEN ABS((z - p) / z) END), 6) AS mape
FROM (SELECT l_returnflag, l_linestatus, l_extendedprice AS z,
             l_quantity * 1800.0e0 + 4000.0e0 AS p FROM lineitem)
GROUP BY l_returnflag, l_linestatus
"""

R2_COLUMNS = ["hd", "pcd", "total_score", "srel_total_score", "H3_seasonal_calpha_sd",
              "H3_seasonal_heavy_sd", *TITERS]


def r2_matrix(spark, sf):
    return rounded(metrics.r2_matrix(model_table(spark, sf), R2_COLUMNS), 8)


R2_SQL = f"WITH {model_sql()} " + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS x, '{b}' AS y, ROUND(REGR_R2(\"{b}\", \"{a}\"), 8) AS r2 FROM model"
    for a in R2_COLUMNS for b in R2_COLUMNS if a != b
)


def pair_fit(spark, sf):
    return rounded(metrics.pair_fit(model_table(spark, sf), Y, Z, [KEY]))


PAIR_SQL = f"""
WITH {model_sql()},
line AS (SELECT REGR_SLOPE("{Z}", "{Y}") AS slope, REGR_INTERCEPT("{Z}", "{Y}") AS intercept
         FROM model)
SELECT {KEY}, ROUND("{Y}", 6) AS x, ROUND("{Z}", 6) AS y,
       ROUND(slope * "{Y}" + intercept, 6) AS y_fitted
FROM model, line WHERE "{Y}" IS NOT NULL AND "{Z}" IS NOT NULL
"""


def guarded(spark, sf):
    """The model table and the triples that pass the guard."""
    table = written(model_table(spark, sf), "model-table")
    return table, factors.enough_triples(factors.row_guard(table, TRIPLES, METADATA))


def guarded_rows(spark, sf):
    table, passed = guarded(spark, sf)
    return factors.triple_rows(table, passed), passed


def scores(spark, sf, repeats):
    table, passed = guarded(spark, sf)
    hashed = written(folds.with_bucket(spread(table, [KEY]), [KEY]), "hashed-rows")
    return planes.fold_scores(hashed, passed, PENALTIES, K, repeats), passed


def plane_folds(spark, sf):
    return rounded(factors.named(*scores(spark, sf, SEARCH)))


def scores_sql(name: str, repeats: int, only: str = "") -> str:
    """Fits on the rows of the other folds, from variances and covariances of those
    rows, and errors on either side."""
    penalties = ", ".join(str(p) for p in PENALTIES)
    return f"""
{name}_rows AS MATERIALIZED (
  SELECT *, {FOLD} AS fold FROM (
    SELECT l.*, {BUCKET} AS bucket, CAST(UNNEST(range(1, {repeats + 1})) AS INT) AS repeat
    FROM long l JOIN (SELECT {NAMES} FROM guard WHERE enough) USING ({NAMES}))),
{name}_moments AS (
  SELECT {NAMES}, repeat, held, COUNT(*) AS n, AVG(x) AS ax, AVG(y) AS ay, AVG(z) AS az,
         VAR_POP(x) * COUNT(*) AS xx, VAR_POP(y) * COUNT(*) AS yy,
         COVAR_POP(x, y) * COUNT(*) AS xy, COVAR_POP(x, z) * COUNT(*) AS xz,
         COVAR_POP(y, z) * COUNT(*) AS yz
  FROM {name}_rows, (SELECT CAST(UNNEST(range(0, {K})) AS INT) AS held)
  WHERE fold <> held GROUP BY {NAMES}, repeat, held),
{name}_slopes AS (
  SELECT *, ((yy + penalty) * xz - xy * yz) / ((xx + penalty) * (yy + penalty) - xy * xy) AS b1,
         ((xx + penalty) * yz - xy * xz) / ((xx + penalty) * (yy + penalty) - xy * xy) AS b2
  FROM {name}_moments, (SELECT UNNEST([{penalties}])::DOUBLE AS penalty)),
{name}_fits AS (
  SELECT {NAMES}, repeat, held, penalty, az - b1 * ax - b2 * ay AS b0, b1, b2
  FROM {name}_slopes {only}),
{name}_errors AS (
  SELECT r.*, f.held, f.penalty, r.fold = f.held AS test, f.b0 + f.b1 * r.x + f.b2 * r.y AS p
  FROM {name}_rows r JOIN {name}_fits f USING ({NAMES}, repeat)),
{name}_folds AS (
  SELECT {NAMES}, penalty, repeat, held AS fold,
         AVG(ABS(z - p)) FILTER (WHERE test) AS mae_test,
         1 - SUM((z - p) ** 2) FILTER (WHERE test)
           / (VAR_POP(z) FILTER (WHERE test) * COUNT(z) FILTER (WHERE test)) AS r2_test,
         AVG(ABS(z - p)) FILTER (WHERE NOT test) AS mae_train,
         1 - SUM((z - p) ** 2) FILTER (WHERE NOT test)
           / (VAR_POP(z) FILTER (WHERE NOT test) * COUNT(z) FILTER (WHERE NOT test)) AS r2_train
  FROM {name}_errors GROUP BY {NAMES}, penalty, repeat, held)
"""


PLANE_FOLDS_SQL = f"""
WITH {BASE}, {scores_sql("search", SEARCH)}
SELECT {NAMES}, penalty, repeat, fold, ROUND(mae_test, 6) AS mae_test,
       ROUND(r2_test, 6) AS r2_test, ROUND(mae_train, 6) AS mae_train,
       ROUND(r2_train, 6) AS r2_train
FROM search_folds
"""

CHOSEN_SQL = f"""
search_means AS (
  SELECT {NAMES}, penalty, -AVG(mae_test) AS mae_test, -AVG(mae_train) AS mae_train,
         AVG(r2_test) AS r2_test, AVG(r2_train) AS r2_train
  FROM search_folds GROUP BY {NAMES}, penalty),
good AS (
  SELECT *, ABS(mae_train) <= 0.5 AS fine,
         COUNT(*) FILTER (WHERE ABS(mae_train) <= 0.5) OVER (PARTITION BY {NAMES}) AS n_fine
  FROM search_means),
chosen AS (
  SELECT * EXCLUDE (fine, n_fine) FROM good
  WHERE fine OR n_fine = 0
  QUALIFY ROW_NUMBER() OVER (
    PARTITION BY {NAMES}
    ORDER BY CASE WHEN n_fine > 0 THEN ABS(mae_test) ELSE ABS(mae_train) END, penalty) = 1)
"""


def choose_model(spark, sf):
    table, passed = scores(spark, sf, SEARCH)
    means = planes.mean_scores(table, ["triple", "penalty"])
    chosen = selection.choose_model(means, ["triple"], ["penalty"])
    return rounded(factors.named(chosen, passed))


CHOOSE_SQL = f"""
WITH {BASE}, {scores_sql("search", SEARCH)}, {CHOSEN_SQL}
SELECT {NAMES}, penalty, ROUND(mae_test, 6) AS mae_test, ROUND(mae_train, 6) AS mae_train,
       ROUND(r2_test, 6) AS r2_test, ROUND(r2_train, 6) AS r2_train FROM chosen
"""


def cv_summary(spark, sf):
    table, passed = scores(spark, sf, SEARCH)
    summary = metrics.cv_summary(
        table.withColumnsRenamed({"mae_test": "mae", "r2_test": "r2"}),
        ["triple", "penalty"], ["mae", "r2"], 6,
    )
    return factors.named(summary, passed)


CV_SQL = f"""
WITH {BASE}, {scores_sql("search", SEARCH)}
SELECT {NAMES}, penalty, ROUND(AVG(mae_test), 6) AS cv_mae_mean,
       ROUND(MEDIAN(mae_test), 6) AS cv_mae_median, ROUND(AVG(r2_test), 6) AS cv_r2_mean,
       ROUND(MEDIAN(r2_test), 6) AS cv_r2_median
FROM search_folds GROUP BY {NAMES}, penalty
"""

# Bounds rounded half to even at the leading digit of a tenth of the range.
MESH_SQL = f"""
spans AS (
  SELECT {NAMES}, MIN(x) AS lx, MAX(x) AS hx, MIN(y) AS ly, MAX(y) AS hy
  FROM long JOIN (SELECT {NAMES} FROM guard WHERE enough) USING ({NAMES}) GROUP BY {NAMES}),
tenths AS (
  SELECT *, ABS(hx - lx) / 10 AS gx, ABS(hy - ly) / 10 AS gy FROM spans),
powers AS (
  SELECT *, POW(10.0, -FLOOR(LOG10(gx))) AS px, POW(10.0, -FLOOR(LOG10(gy))) AS py FROM tenths
  WHERE gx > 0 AND gy > 0),
edges AS (
  SELECT *, ROUND_EVEN((lx - gx) * px, 0) / px AS ax, ROUND_EVEN((hx + gx) * px, 0) / px AS bx,
         ROUND_EVEN((ly - gy) * py, 0) / py AS ay, ROUND_EVEN((hy + gy) * py, 0) / py AS "by"
  FROM powers),
bounds AS (
  SELECT {NAMES},
         CASE WHEN lx > 0 AND ax <= 0 THEN 0.0 ELSE ax END AS ax,
         CASE WHEN NOT (lx > 0 AND ax <= 0) AND hx < 0 AND hx + gx > 0 THEN 0.0 ELSE bx END AS bx,
         CASE WHEN ly > 0 AND ay <= 0 THEN 0.0 ELSE ay END AS ay,
         CASE WHEN NOT (ly > 0 AND ay <= 0) AND hy < 0 AND hy + gy > 0 THEN 0.0 ELSE "by" END AS "by"
  FROM edges),
mesh AS (
  SELECT {NAMES}, ix, iy, ax + ix * ((bx - ax) / 25.0e0) AS x, ay + iy * (("by" - ay) / 25.0e0) AS y
  FROM bounds, (SELECT CAST(UNNEST(range(0, 25)) AS INT) AS ix),
       (SELECT CAST(UNNEST(range(0, 25)) AS INT) AS iy))
"""


def mesh_grid(spark, sf):
    rows, passed = guarded_rows(spark, sf)
    points = meshes.mesh(meshes.axis_ranges(meshes.axis_spans(rows)))
    return rounded(factors.named(points, passed))


MESH_GRID_SQL = f"""
WITH {BASE}, {MESH_SQL}
SELECT {NAMES}, ix, iy, ROUND(x, 6) AS x, ROUND(y, 6) AS y FROM mesh
"""


def landscape(spark, sf):
    return landscapes.plane_landscape(
        written(model_table(spark, sf), "model-table"), TRIPLES, [KEY], PENALTIES, K, SEARCH, FINAL
    )


LANDSCAPE_CTES = f"""
WITH {BASE}, {scores_sql("search", SEARCH)}, {CHOSEN_SQL},
{scores_sql("final", FINAL, f"SEMI JOIN chosen USING ({NAMES}, penalty)")}, {MESH_SQL},
checked AS (
  SELECT {NAMES}, ROUND(AVG(-mae_test), 3) AS cv_mae_mean,
         ROUND(MEDIAN(-mae_test), 3) AS cv_mae_median, ROUND(AVG(r2_test), 3) AS cv_r2_mean,
         ROUND(MEDIAN(r2_test), 3) AS cv_r2_median
  FROM final_folds GROUP BY {NAMES}),
whole AS (
  SELECT {NAMES}, AVG(x) AS ax, AVG(y) AS ay, AVG(z) AS az,
         VAR_POP(x) * COUNT(*) AS xx, VAR_POP(y) * COUNT(*) AS yy,
         COVAR_POP(x, y) * COUNT(*) AS xy, COVAR_POP(x, z) * COUNT(*) AS xz,
         COVAR_POP(y, z) * COUNT(*) AS yz
  FROM long GROUP BY {NAMES}),
slopes AS (
  SELECT *, ((yy + penalty) * xz - xy * yz) / ((xx + penalty) * (yy + penalty) - xy * xy) AS b1,
         ((xx + penalty) * yz - xy * xz) / ((xx + penalty) * (yy + penalty) - xy * xy) AS b2
  FROM whole JOIN chosen USING ({NAMES})),
summary AS (
  SELECT {NAMES}, penalty, mae_test, mae_train, r2_test, r2_train, cv_mae_mean, cv_mae_median,
         cv_r2_mean, cv_r2_median, az - b1 * ax - b2 * ay AS b0, b1, b2
  FROM slopes JOIN checked USING ({NAMES}))
"""
SUMMARY_COLUMNS = f"""
       'H3' AS subtype, 'HA' AS protein, {NAMES},
       CASE WHEN penalty = 0 THEN 'linear' ELSE 'ridge' END AS model,
       CAST(NULL AS INT) AS n_estimators, penalty AS learning_rate,
       CAST(NULL AS INT) AS max_features, CAST(NULL AS INT) AS min_samples_split,
       ROUND(mae_test, 6) AS mae_test, ROUND(mae_train, 6) AS mae_train,
       ROUND(r2_test, 6) AS r2_test, ROUND(r2_train, 6) AS r2_train,
       cv_mae_mean, cv_mae_median, cv_r2_mean, cv_r2_median
"""


def landscape_mesh(spark, sf):
    return rounded(landscape(spark, sf).mesh)


LANDSCAPE_MESH_SQL = f"""
{LANDSCAPE_CTES}
SELECT {SUMMARY_COLUMNS}, ix, iy, ROUND(x, 6) AS x_predicted, ROUND(y, 6) AS y_predicted,
       ROUND(b0 + b1 * x + b2 * y, 6) AS z_predicted
FROM mesh JOIN summary USING ({NAMES})
"""


def landscape_summary(spark, sf):
    return landscapes.landscape_summary(rounded(landscape(spark, sf).mesh))


LANDSCAPE_SUMMARY_SQL = f"{LANDSCAPE_CTES} SELECT {SUMMARY_COLUMNS} FROM summary"


def landscape_metrics(spark, sf):
    return rounded(landscape(spark, sf).metrics)


LANDSCAPE_METRICS_SQL = f"""
{LANDSCAPE_CTES},
observed AS (
  SELECT DISTINCT * EXCLUDE (z) FROM (
    {triples_sql(f"(SELECT * FROM model WHERE {KNOWN})", need_z=False, keep=", ".join(METADATA))}))
SELECT {", ".join(METADATA)}, {NAMES}, ROUND(x, 6) AS x, ROUND(y, 6) AS y,
       ROUND(b0 + b1 * x + b2 * y, 6) AS z_predicted
FROM observed JOIN summary USING ({NAMES})
"""


def full_mesh(spark, sf):
    """Mesh predictions of the plain planes, the input of the surface operators."""
    rows, passed = guarded_rows(spark, sf)
    spans = written(meshes.axis_spans(rows), "spans")
    fits = planes.solve(planes.plane_sums(rows, spans))
    points = meshes.mesh(meshes.axis_ranges(spans)).join(fits, "triple")
    return factors.named(points, passed).select(
        *TRIPLE, "ix", "iy", F.col("x").alias("x_predicted"), F.col("y").alias("y_predicted"),
        planes.plane_value(F.col("x"), F.col("y")).alias("z_predicted"),
    )


SURFACE_CTES = f"""
WITH {BASE}, {MESH_SQL},
whole AS (
  SELECT {NAMES}, AVG(x) AS ax, AVG(y) AS ay, AVG(z) AS az,
         VAR_POP(x) AS xx, VAR_POP(y) AS yy, COVAR_POP(x, y) AS xy,
         COVAR_POP(x, z) AS xz, COVAR_POP(y, z) AS yz
  FROM long GROUP BY {NAMES}),
planes AS (
  SELECT *, (yy * xz - xy * yz) / (xx * yy - xy * xy) AS b1,
         (xx * yz - xy * xz) / (xx * yy - xy * xy) AS b2 FROM whole),
surface AS (
  SELECT {NAMES}, ix, iy, x AS x_predicted, y AS y_predicted,
         az + b1 * (x - ax) + b2 * (y - ay) AS z_predicted
  FROM mesh JOIN planes USING ({NAMES}))
"""


def pick_surface(spark, sf):
    return rounded(surfaces.pick_surface(full_mesh(spark, sf), z=Z))


PICK_SQL = f"""
{SURFACE_CTES}
SELECT {NAMES}, ix, iy, ROUND(x_predicted, 6) AS x_predicted, ROUND(y_predicted, 6) AS y_predicted,
       ROUND(z_predicted, 6) AS z_predicted
FROM surface
WHERE z_factor = '{Z}' AND x_factor = (SELECT MIN(x_factor) FROM surface)
  AND y_factor = (SELECT MIN(y_factor) FROM surface
                  WHERE x_factor = (SELECT MIN(x_factor) FROM surface))
"""


def surface_grid(spark, sf):
    return rounded(surfaces.surface_grid(full_mesh(spark, sf)))


GRID_SQL = f"""
{SURFACE_CTES}
SELECT {NAMES}, ROUND(y_predicted, 6) AS y_predicted,
       {", ".join(f"ROUND(AVG(z_predicted) FILTER (WHERE ix = {i}), 6) AS x{i}" for i in range(25))}
FROM surface GROUP BY {NAMES}, y_predicted
"""


def grid_axis(spark, sf):
    return rounded(surfaces.grid_axis(full_mesh(spark, sf)))


AXIS_SQL = f"""
{SURFACE_CTES}
SELECT DISTINCT {NAMES}, ix, ROUND(x_predicted, 6) AS x_predicted FROM surface
"""


def observed_points(spark, sf):
    return rounded(surfaces.observed_points(model_table(spark, sf), X, Y, Z))


POINTS_SQL = f"""
WITH {model_sql()}
SELECT {KEY}, ROUND("{X}", 6) AS x, ROUND("{Y}", 6) AS y, ROUND("{Z}", 6) AS z FROM model
WHERE "{X}" IS NOT NULL AND "{Y}" IS NOT NULL AND "{Z}" IS NOT NULL
"""


def axis_labels(spark, sf):
    return surfaces.axis_labels(row_guard(spark, sf).filter("enough").select(*TRIPLE))


LABELS_SQL = f"""
WITH {BASE}
SELECT {NAMES},
  CASE x_factor WHEN 'hd' THEN 'Hamming Distance (HD)' ELSE 'Physiochemical Distance (PCD)' END
    AS x_label,
  CASE y_factor WHEN 'srel_total_score' THEN 'Rosetta Total Score [Relative, Seasonal]'
    WHEN 'H3_seasonal_calpha_sd' THEN 'Structural Distance [SD, Seasonal (Ca)]'
    ELSE 'Structural Distance [SD, Seasonal (Heavy)]' END AS y_label,
  CASE WHEN z_factor LIKE '%logfold' THEN 'LOT:  [LOGFOLD] '
    ELSE 'Rosetta Total Score [Relative, Seasonal]' END AS z_label
FROM guard WHERE enough
"""

QUERIES = {
    "row_guard": row_guard,
    "skipped_triples": skipped_triples,
    "factor_set_counts": factor_set_counts,
    "kfold_ids": kfold_ids,
    "kfold_ids_balanced": kfold_ids_balanced,
    "train_split": train_split,
    "regression_metrics": regression_metrics,
    "r2_matrix": r2_matrix,
    "pair_fit": pair_fit,
    "plane_folds": plane_folds,
    "choose_model": choose_model,
    "cv_summary": cv_summary,
    "mesh_grid": mesh_grid,
    "landscape_mesh": landscape_mesh,
    "landscape_summary": landscape_summary,
    "landscape_metrics": landscape_metrics,
    "pick_surface": pick_surface,
    "surface_grid": surface_grid,
    "grid_axis": grid_axis,
    "observed_points": observed_points,
    "axis_labels": axis_labels,
}

ORACLES = {
    "row_guard": GUARD_SQL,
    "skipped_triples": SKIPPED_SQL,
    "factor_set_counts": SETS_SQL,
    "kfold_ids": KFOLD_SQL,
    "kfold_ids_balanced": KFOLD_BALANCED_SQL,
    "train_split": SPLIT_SQL,
    "regression_metrics": METRICS_SQL,
    "r2_matrix": R2_SQL,
    "pair_fit": PAIR_SQL,
    "plane_folds": PLANE_FOLDS_SQL,
    "choose_model": CHOOSE_SQL,
    "cv_summary": CV_SQL,
    "mesh_grid": MESH_GRID_SQL,
    "landscape_mesh": LANDSCAPE_MESH_SQL,
    "landscape_summary": LANDSCAPE_SUMMARY_SQL,
    "landscape_metrics": LANDSCAPE_METRICS_SQL,
    "pick_surface": PICK_SQL,
    "surface_grid": GRID_SQL,
    "grid_axis": AXIS_SQL,
    "observed_points": POINTS_SQL,
    "axis_labels": LABELS_SQL,
}
