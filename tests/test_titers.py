"""Summaries on hand-made tables: expected values, and the SQL oracle on the same rows."""

import datetime as dt
import math

import duckdb
import pytest

from terrane.bindings.titers import ELIGIBLE, ISOLATE_VALUES
from terrane.operators import titers
from terrane.operators.antisera import reportable_sera
from terrane.operators.eligibility import Warehouse, eligible_tests
from terrane.operators.versions import ENERGY_TERMS, energy_summary

TEST_COLUMNS = (
    "test_subtype string, test_protocol string, test_id string, "
    "test_hint_calculation_method string, ag_cdc_id string, ag_isolate_id string, "
    "ag_sequenced_isolate_id string, ag_variant_hash string, ag_entry_error string, "
    "ag_type string, ag_passage string, sr_lot string, sr_variant_hash string, "
    "ag_back_titer double, titer_logfold double, titer_error boolean, titer_reportable boolean"
)


def a_test(**changes):
    row = dict(
        test_subtype="H3", test_protocol="hi_protocol", test_id="t1",
        test_hint_calculation_method=None, ag_cdc_id="s1", ag_isolate_id="i1",
        ag_sequenced_isolate_id="i1", ag_variant_hash="v1", ag_entry_error="", ag_type="test",
        ag_passage="S1", sr_lot="L1", sr_variant_hash="a1", ag_back_titer=4.0,
        titer_logfold=1.0, titer_error=False, titer_reportable=True,
    )
    row.update(changes)
    return tuple(row.values())


TESTS = [
    # i1 on L1: two values in t1 and one in t2, so the mean of means is not the mean
    a_test(titer_logfold=1.0), a_test(titer_logfold=3.0), a_test(test_id="t2", titer_logfold=8.0),
    a_test(sr_lot="L2", titer_logfold=5.0),                      # same mean as L1: counts once
    a_test(sr_lot="HUMAN9", titer_logfold=2.0),
    a_test(ag_isolate_id="i2", ag_sequenced_isolate_id="i2", titer_logfold=-1.0),
    a_test(ag_isolate_id="i2", ag_sequenced_isolate_id="i2", sr_lot="L2", titer_logfold=-3.0),
    # hint with a back titer of 4 passes both rules
    a_test(test_protocol="hint_protocol", test_hint_calculation_method="AFLUT",
           titer_logfold=0.5),
    a_test(test_protocol="hint_protocol", test_hint_calculation_method="AFLUT",
           titer_logfold=1.5, titer_reportable=False),
    a_test(test_protocol="fra_protocol", ag_back_titer=None, titer_logfold=0.25),
    # left out, each for one reason
    a_test(ag_entry_error=None, titer_logfold=90.0), a_test(ag_entry_error="x", titer_logfold=91.0),
    a_test(ag_passage="E1", titer_logfold=92.0), a_test(titer_error=None, titer_logfold=93.0),
    a_test(titer_error=True, titer_logfold=94.0), a_test(titer_reportable=None, titer_logfold=95.0),
    a_test(ag_back_titer=3.9, titer_logfold=96.0), a_test(ag_type="reference", titer_logfold=97.0),
    a_test(ag_variant_hash=None, titer_logfold=98.0), a_test(titer_logfold=None),
    a_test(test_subtype="H5", titer_logfold=99.0), a_test(sr_lot="EGG", titer_logfold=89.0),
    a_test(sr_lot="UNSURE", titer_logfold=88.0),
    a_test(ag_cdc_id="s2", ag_isolate_id="i3", titer_logfold=87.0),       # research
    a_test(ag_cdc_id="s3", ag_isolate_id="i4", titer_logfold=86.0),       # empty strain name
    a_test(ag_isolate_id="i5", titer_logfold=85.0),                       # pair variant
    a_test(ag_sequenced_isolate_id="i6", titer_logfold=84.0),             # ambiguous NA
    a_test(ag_sequenced_isolate_id="i7", titer_logfold=83.0),             # minor variant
    a_test(ag_variant_hash="v9", titer_logfold=82.0),                     # no genetic group
    # two clean NA alignments of i8 double its row
    a_test(ag_isolate_id="i8", ag_sequenced_isolate_id="i8", titer_logfold=4.0),
    a_test(ag_isolate_id="i8", ag_sequenced_isolate_id="i1", titer_logfold=1.0),
    # without a structure, and not reported
    a_test(ag_variant_hash="v2", titer_logfold=7.0),
    a_test(ag_cdc_id="s4", ag_isolate_id="i9", titer_logfold=6.0),
]

TABLES = {
    "antigenic_tests": (TESTS, TEST_COLUMNS),
    "archive_serum_ref": ([
        ("L1", "H3", "hi_protocol", "a1", "A", "S2", "NH", 2020, False),
        ("L1", "H3", "hi_protocol", "a1", "A", "S2", "NH", 2021, False),
        ("L2", "H3", "hi_protocol", "a1", "A", "S2", "SH", 2020, False),
        ("HUMAN9", "H3", "hi_protocol", "a1", "A", "S2", "SH", 2019, False),
        ("L1", "H3", "hint_protocol", "a1", "A", "S2", "NH", 2020, False),
        ("L1", "H3", "fra_protocol", "a1", "A", "S2", "NH", 2020, False),
        ("EGG", "H3", "hi_protocol", "a1", "A", "E3", "NH", 2021, True),
        ("UNSURE", "H3", "hi_protocol", "a1", "A", "E3", "NH", 2021, None),
    ], "lot string, subtype string, test_protocol string, variant_hash string, "
       "strain_name string, passage string, hemisphere string, season int, egg_vaccine boolean"),
    "specimen": ([
        ("s1", "surveillance", "A/1"), ("s2", "research", "A/2"), ("s3", "surveillance", ""),
        ("s4", "surveillance", "A/4"),
    ], "cdc_id string, reason_for_submission string, strain_name string"),
    "isolate": ([
        *[(f"i{n}", "s1", dt.date(2024, 1, 1)) for n in (1, 2, 5, 8)],
        ("i1", "s1", None), ("i3", "s2", dt.date(2024, 1, 1)), ("i4", "s3", dt.date(2024, 1, 1)),
        ("i9", "s4", None),
    ], "isolate_id string, cdc_id string, date_report date"),
    "hiserum": ([
        ("L1", "f1"), ("L1", "f2"), ("L2", "f3"), ("HUMAN9", "h1"),
    ], "lot string, animal_id string"),
    "variant_taxonomy": ([
        ("v1", "3C"), ("v2", "3C"), ("v9", ""), ("v1", "3C.2"),
    ], "variant_hash string, variant_genetic_group string"),
    "isolate_pair_variants": ([("i5",)], "isolate_id string"),
    "alignments": ([
        ("i6", "NA", "AXA"), ("i1", "HA", "XXX"), ("i8", "NA", "AAA"), ("i8", "NA", "CCC"),
    ], "isolate_id string, protein string, aa_aln string"),
    "aligned_proteins": ([("p1", "R", "ABC")], "variant_hash string, reference_id string, "
                                              "aa_aln string"),
    "variants_filtered": ([
        ("i7", "q1", "p1", "R", "Minority", "HA", "Z", 2, 2),
        ("i1", "q1", "p1", "R", "Minority", "HA", "C", 9, 9),   # last residue: no difference
        ("i2", "q1", "p1", "R", "Consensus", "HA", "Z", 2, 2),
    ], "isolate_id string, flu_sequence_id string, variant_hash string, reference_id string, "
       "allele_type string, protein string, residue string, position_aa int, position_disc int"),
    "relaxed_structural_distance": ([
        ("HA", s, r, "v1", c, 4.5, 70.0, 0.0, None, 5)
        for s in ("B", "H1", "H3") for r in ("reference", "seasonal")
        for c in ("calpha", "carbon", "heavy")
    ] + [("HA", "H5", "reference", "v2", "calpha", 4.5, 70.0, 0.0, None, 5)],
        "protein string, subtype string, reference_context string, variant_hash string, "
        "atomic_context string, atomic_distance double, site_confidence double, "
        "range_limit double, site_range string, sd int"),
    "relaxed_rosetta_energy_rmsd": ([
        (*[float(i)] * 14, variant, version) for i, (variant, version) in enumerate(
            [("v1", "r1"), ("v1", "r2"), ("v1", "r2"), ("v2", "r3"), ("v1", None)])
    ], ", ".join(f"{t} double" for t in ENERGY_TERMS) + ", variant_hash string, version string"),
}


@pytest.fixture(scope="module")
def warehouse(spark):
    return Warehouse(**{
        name: spark.createDataFrame(rows, schema) for name, (rows, schema) in TABLES.items()
    })


@pytest.fixture(scope="module")
def summary(warehouse):
    return titers.titer_summary(warehouse).cache()


def pick(df, **where):
    rows = [r for r in df.collect() if all(r[k] == v for k, v in where.items())]
    assert len(rows) == 1, rows
    return rows[0]


def test_lot_summary(summary):
    # isolate means on L1: i1 (2 + 8) / 2 = 5, i2 -1, i8 (2 * 4 + 1) / 3 = 3
    row = pick(summary, lot="L1", aggregation="lot", test_protocol="hi_protocol")
    assert (row.min_logfold, row.max_logfold) == (-1.0, 5.0)
    assert math.isclose(row.avg_logfold, 7 / 3)
    assert row.logfold_count == 3 * 18


def test_fan_out_shrinks_the_deviation(warehouse, summary):
    values = [5.0, -1.0, 3.0]
    mean = sum(values) / 3
    square = sum((v - mean) ** 2 for v in values)
    row = pick(summary, lot="L1", aggregation="lot", test_protocol="hi_protocol")
    assert math.isclose(row.sd_logfold, math.sqrt(18 * square / (18 * 3 - 1)))
    once = pick(titers.titer_summary(warehouse, dedupe=True), lot="L1", aggregation="lot",
                test_protocol="hi_protocol")
    assert math.isclose(once.sd_logfold, math.sqrt(square / 2)) and once.logfold_count == 3


def test_single_value_has_zero_deviation_only_by_fan_out(warehouse, summary):
    where = dict(lot="HUMAN9", aggregation="lot", test_protocol="hi_protocol")
    assert pick(summary, **where).sd_logfold == 0.0
    assert pick(titers.titer_summary(warehouse, dedupe=True), **where).sd_logfold is None


def test_rules_overlap(summary):
    # rule 1 sees 0.5, rule 2 the mean of 0.5 and 1.5: two values of one isolate
    row = pick(summary, aggregation="lot", test_protocol="hint_protocol")
    assert (row.min_logfold, row.max_logfold, row.logfold_count) == (0.5, 1.0, 2 * 18)


def test_protein_summary_pools_lots(summary):
    # i1: L1 and L2 both 5 count once, HUMAN9 2 -> 3.5; i2: -1 and -3 -> -2; i8: 3
    row = pick(summary, aggregation="ha_protein", test_protocol="hi_protocol")
    assert row.lot == "HUMAN9, L1, L2"
    assert (row.min_logfold, row.max_logfold) == (-2.0, 3.5)
    assert math.isclose(row.avg_logfold, 1.5) and row.logfold_count == 3 * 18


def test_species_can_stay_apart(warehouse):
    means = titers.isolate_means(eligible_tests(warehouse))
    apart = titers.isolate_values_by_protein(warehouse, means, keep_species=True)
    found = sorted(
        (r.inoculated_species, r.titer_logfold) for r in apart.collect()
        if r.ag_isolate_id == "i1" and r.test_protocol == "hi_protocol"
        and r.ag_variant_hash == "v1")
    assert found == [("ferret", 5.0), ("non-ferret", 2.0)]


def test_variant_without_structure_is_absent(summary):
    assert {r.identifier for r in summary.collect()} == {"v1"}


def test_individual_summary(warehouse):
    rows = titers.individual_summary(warehouse).collect()
    found = {
        (r.ag_isolate_id, r.lot, r.aggregation): r.avg_logfold
        for r in rows if r.test_protocol == "hi_protocol"
    }
    assert found[("i1", "L1", "lot")] == 5.0
    assert found[("i1", "HUMAN9, L1, L2", "ha_protein")] == 3.5
    assert len([r for r in rows if r.test_protocol == "hint_protocol"
                and r.aggregation == "lot"]) == 2


def test_null_in_the_exclusion_list_empties_the_result(spark, warehouse):
    from dataclasses import replace
    nulls = spark.createDataFrame([("i5",), (None,)], "isolate_id string")
    assert titers.titer_summary(replace(warehouse, isolate_pair_variants=nulls)).count() == 0


def test_against_sql(warehouse, summary):
    connection = duckdb.connect()
    for name in Warehouse.__dataclass_fields__:
        frame = getattr(warehouse, name).toPandas()
        for column, kind in getattr(warehouse, name).dtypes:
            if kind == "boolean":
                frame[column] = frame[column].astype("boolean")
        connection.register(f"{name}_frame", frame)
        casts = ", ".join(
            f"CAST({c} AS {k}) AS {c}" for c, k in getattr(warehouse, name).dtypes)
        connection.sql(f"CREATE TABLE {name} AS SELECT {casts} FROM {name}_frame")
    rows = connection.sql(f"""
        WITH {ELIGIBLE}, {ISOLATE_VALUES}
        SELECT test_protocol, lot, 'lot' AS aggregation, ROUND(AVG(value), 6)
        FROM lot_values WHERE ag_variant_hash = 'v1' GROUP BY ALL
        UNION ALL
        SELECT test_protocol, lot, 'ha_protein', ROUND(AVG(value), 6)
        FROM protein_values WHERE ag_variant_hash = 'v1' GROUP BY ALL""").fetchall()
    got = [(r.test_protocol, r.lot, r.aggregation, round(r.avg_logfold, 6))
           for r in summary.collect()]
    assert sorted(got) == sorted(rows)


@pytest.mark.parametrize("day, lots", [
    (dt.date(2021, 1, 31), {"L1", "L2"}),          # seasons since 2020
    (dt.date(2021, 4, 30), {"L1", "L2"}),
    (dt.date(2021, 5, 1), {"L1", "L2"}),
    (dt.date(2021, 10, 1), {"L1"}),                # 2021NH, 2021SH, 2020NH
    (dt.date(2020, 10, 1), {"L1", "L2"}),          # 2020NH, 2020SH, 2019NH
    (dt.date(2023, 1, 1), set()),
])
def test_reportable_sera(warehouse, day, lots):
    assert {r.lot for r in reportable_sera(warehouse.archive_serum_ref, day).collect()} == lots


def test_energy_summary_keeps_ties_of_the_newest(warehouse):
    rows = energy_summary(
        warehouse.relaxed_rosetta_energy_rmsd, warehouse.relaxed_structural_distance).collect()
    assert sorted((r.identifier, r.version, r.total_score) for r in rows) == [
        ("v1", "r2", 1.0), ("v1", "r2", 2.0)]
