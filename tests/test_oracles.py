"""Registered queries against their SQL on the smallest test tables.

``check.py`` compares all of them at any scale; here are the quick ones.
"""

import os

import duckdb
import pytest

import __spark_entry__ as spec
import check

SF_DIR = "/root/testdata/sf0.001"
SLOW = {
    "titer_summary_deduped", "structural_distance_sites", "structural_distance_relaxed",
    "structure_files", "wide_features_individual", "choose_model", "cv_summary",
    "landscape_summary", "landscape_metrics", "grid_axis", "surface_grid",
}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


@pytest.fixture(scope="module")
def connection():
    base = duckdb.connect()
    for table in check.TABLES:
        base.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return base


@pytest.mark.parametrize("name", sorted(set(spec.oracle_sql()) - SLOW))
def test_equals_sql(spark, connection, name):
    line, good = check.compare(
        spark, connection, SF_DIR, name, spec.queries()[name], spec.oracle_sql()[name])
    assert good, line


def test_registry():
    assert set(spec.oracle_sql()) <= set(spec.queries())


def test_entry(spark):
    assert spec.entry(spark).count() > 0
