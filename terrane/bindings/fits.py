"""Queries of the tree families, the preparation, and the smoothing.

Tree fits have no SQL counterpart and are checked in the tests; the smoothing has one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from terrane.bindings.model_table import KEY, model_sql, model_table
from terrane.bindings.models import TRIPLES as TREE_TRIPLES, X, Y, rounded
from terrane.bindings.star import star
from terrane.operators import preparing, smoothing, trees
from terrane.session import written


# every parameter value, with fewer repeats than the defaults
REPEATS = {"k": 5, "search_repeats": 1, "final_repeats": 2}


def landscape(*families):
    def run(spark, sf):
        table = written(model_table(spark, sf), "model-table")
        return trees.tree_landscape(table, TREE_TRIPLES, [KEY], families, **REPEATS).mesh
    return run


PREPARED = [X, Y, "H3_seasonal_heavy_sd", "total_score", "pcd"]


def prepared_rows(spark, sf):
    """Part price and total score fall together, so one of the two columns is left out."""
    table = model_table(spark, sf).select(KEY, *PREPARED)
    rows, kept = preparing.prepare(table, PREPARED, True, True, True)
    return rounded(rows.select(KEY, *kept))


def _prepared_sql() -> str:
    kept = PREPARED[:-1]
    means = ", ".join(f'AVG("{c}") AS m{i}, STDDEV_SAMP("{c}") AS s{i}' for i, c in enumerate(kept))
    near = " AND ".join(
        f'COALESCE(ABS("{c}" - m{i}) <= 3.0e0 * s{i}, TRUE)' for i, c in enumerate(kept))
    scaled = ", ".join(f'ROUND(SIGN("{c}") * LN(1 + ABS("{c}")), 6) AS "{c}"' for c in kept)
    return (f"WITH {model_sql()}, limits AS (SELECT {means} FROM model) "
            f"SELECT {KEY}, {scaled} FROM model, limits WHERE {near}")


def local_regression(spark, sf):
    """Price along the quantity axis, by return flag, at every half step of the path."""
    lines = star(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("z"))
    path = lines.select("l_returnflag", (F.col("x") + 0.5).alias("node"))
    return rounded(smoothing.local_regression(lines, path, 6.0, ["l_returnflag"]), 4)


LOCAL_SQL = """
WITH lines AS (SELECT l_returnflag, l_quantity AS x, l_extendedprice AS z FROM lineitem),
nodes AS (SELECT DISTINCT l_returnflag, x + 0.5e0 AS node FROM lines),
near AS (
  SELECT l_returnflag, node, x - node AS u, z, (1 - ABS((x - node) / 6.0e0) ** 3) ** 3 AS w
  FROM lines JOIN nodes USING (l_returnflag) WHERE ABS(x - node) < 6),
sums AS (
  SELECT l_returnflag, node, COUNT(*) AS n, SUM(w) AS s, SUM(w * u) AS su, SUM(w * u * u) AS suu,
         SUM(w * z) AS sz, SUM(w * u * z) AS suz
  FROM near GROUP BY ALL)
SELECT l_returnflag, node, n,
       ROUND((suu * sz - su * suz) / (s * suu - su * su), 4) AS z_smoothed
FROM sums
"""

QUERIES = {
    "gradient_landscape": landscape(trees.GRADIENT_BOOSTING),
    "forest_landscape": landscape(trees.EXTRA_TREES),
    "adaboost_landscape": landscape(trees.ADABOOST),
    "tree_landscape": landscape(*trees.FAMILIES),
    "prepared_rows": prepared_rows,
    "local_regression": local_regression,
}

ORACLES = {
    "prepared_rows": _prepared_sql(),
    "local_regression": LOCAL_SQL,
}
