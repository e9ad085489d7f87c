"""A wide table for the modelling operators, derived from parts and their order lines.

One row per part, as a variant. Values that have no order line are missing, so the
table has gaps without any being made. Two of the six supplier lots share a column. The
expressions serve both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.bindings.star import star
from terrane.functions.predicates import quoted

GROUP_COLUMN = "clade"
KEY = "variant_hash"

PART_COLUMNS = {
    "subtype": "'H3'",
    "protein": "'HA'",
    "clade": "CASE WHEN p_size = 50 THEN NULL ELSE p_brand END",
    "variant_hash": "CONCAT('v', CAST(p_partkey AS STRING))",
    "substitution_list": "p_type",
    "hd": "CAST(p_size AS DOUBLE)",
    "pcd": "FLOOR(p_retailprice / 8) / 16",
    "total_score": "-FLOOR(p_retailprice) / 4",
}
PROTOCOL_FLAGS = {"hi_protocol": "R", "fra_protocol": "A", "hint_protocol": "N"}
TITER_VALUE = "FLOOR(l_extendedprice / 5000) / 4 - 3"
LINE_COLUMNS = {
    "srel_total_score": "AVG(CASE WHEN l_linestatus = 'F' THEN FLOOR(l_extendedprice / 1000) / 8 END)",
    "H3_seasonal_calpha_sd": "AVG(CASE WHEN l_linenumber < 3 THEN l_quantity END)",
    "H3_seasonal_heavy_sd": "AVG(CASE WHEN l_quantity > 25 THEN l_linenumber * 1.0e0 END)",
    **{
        f"H3|{protocol}|lot|L{lot}|logfold":
            f"AVG(CASE WHEN l_returnflag = '{flag}' AND FLOOR((l_suppkey % 6) / 2) = {lot} "
            f"THEN {TITER_VALUE} END)"
        for protocol, flag in PROTOCOL_FLAGS.items() for lot in range(3)
    },
}
TITERS = [c for c in LINE_COLUMNS if c.endswith("|logfold")]


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        *[F.expr(text).alias(name) for name, text in LINE_COLUMNS.items()]
    )
    parts = star(spark, sf_dir, "part")
    return parts.join(lines, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        *[F.expr(text).alias(name) for name, text in PART_COLUMNS.items()],
        *[quoted(name) for name in LINE_COLUMNS],
    )


def model_sql() -> str:
    lines = ", ".join(f'{text} AS "{name}"' for name, text in LINE_COLUMNS.items())
    parts = ", ".join(f"{text} AS {name}" for name, text in PART_COLUMNS.items())
    kept = ", ".join(f'"{name}"' for name in LINE_COLUMNS)
    return (
        f"lines AS (SELECT l_partkey, {lines} FROM lineitem GROUP BY l_partkey),\n"
        f"model AS MATERIALIZED (SELECT {parts}, {kept} FROM part "
        f"LEFT JOIN lines ON l_partkey = p_partkey)"
    )
