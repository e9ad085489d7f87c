"""Queries and oracles of the readers and writers: every one writes a whole derived
table to the shared folder and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from terrane.bindings.star import ctes, derive, star
from terrane.session import shared_dir
from terrane.sources import tables


def _folder(spark, name):
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delimited_round_trip(delimiter):
    def run(spark, sf):
        """Customers as text with ``*`` for a missing balance, one folder per segment."""
        path = _folder(spark, "customers")
        rows = star(spark, sf, "customer").select(
            "c_custkey", "c_name", "c_mktsegment",
            F.when(F.col("c_nationkey") == 3, F.lit("*"))
            .when(F.col("c_nationkey") != 4, F.col("c_acctbal").cast("string")).alias("balance"),
        )
        tables.write_delimited(rows, path, delimiter, ["c_mktsegment"])
        read = tables.read_delimited(
            spark, path, delimiter,
            "c_custkey bigint, c_name string, balance string, c_mktsegment string",
        )
        return tables.to_numbers(read, ["balance"])
    return run


DELIMITED_SQL = """
SELECT c_custkey, c_name, c_mktsegment,
       CASE WHEN c_nationkey NOT IN (3, 4) THEN c_acctbal END AS balance
FROM customer
"""


def append_round_trip(spark, sf):
    """Order lines appended in two halves, then read as one table."""
    path = _folder(spark, "lines")
    lines = star(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_linestatus")
    for status in ("F", "O"):
        tables.append_table(lines.filter(F.col("l_linestatus") == status), path)
    return spark.read.schema(lines.schema).parquet(path).groupBy("l_partkey", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))


APPEND_SQL = """
SELECT l_partkey, l_linestatus, COUNT(*) AS n,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem GROUP BY l_partkey, l_linestatus
"""


def write_by_subtype(spark, sf):
    """The genetic summary, one folder per subtype, read back as one table."""
    path = _folder(spark, "genetic")
    tables.write_by(derive(spark, sf, "genetic_summary"), "subtype", path)
    return spark.read.parquet(path).select(
        "subtype", "protein", "clade", "identifier", "hd", "pcd")


WRITE_BY_SQL = f"""
WITH {ctes("genetic_summary")}
SELECT subtype, protein, clade, identifier, hd, pcd FROM genetic_summary
"""

QUERIES = {
    "delimited_tab": delimited_round_trip("tab"),
    "delimited_comma": delimited_round_trip("comma"),
    "append_round_trip": append_round_trip,
    "write_by_subtype": write_by_subtype,
}

ORACLES = {
    "delimited_tab": DELIMITED_SQL,
    "delimited_comma": DELIMITED_SQL,
    "append_round_trip": APPEND_SQL,
    "write_by_subtype": WRITE_BY_SQL,
}
