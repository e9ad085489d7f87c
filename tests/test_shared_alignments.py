import duckdb

from terrane.bindings import titers
from terrane.bindings.star import SCHEMAS, ctes, derived_sql

SF = "/root/testdata/sf0.01"


def test_summaries_join_every_alignment_and_its_copies():
    connection = duckdb.connect()
    for name in SCHEMAS:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    own = derived_sql("alignments")
    few = own.replace("CAST(doc_id AS STRING)", "CAST(doc_id % 700 AS STRING)")
    assert few != own
    sizes = []
    for table in (own, few):
        sql = titers.ORACLES["eligible_tests"]
        assert derived_sql("shared_alignments") in sql
        lacking = connection.sql(
            f"{table} EXCEPT ALL ({derived_sql('shared_alignments')})").fetchall()
        assert not lacking  # every row that either mapping joins is there
        sql = sql.replace(derived_sql("shared_alignments"), table)
        sizes.append(connection.sql(f"SELECT SUM(n) FROM ({sql})").fetchall()[0][0])
    total = connection.sql(f"SELECT SUM(n) FROM ({titers.ORACLES['eligible_tests']})").fetchall()[0][0]
    assert total > max(sizes)
    for name in ("titer_summary", "titer_summary_deduped", "individual_summary"):
        assert derived_sql("shared_alignments") in titers.ORACLES[name]
    assert derived_sql("shared_alignments") not in titers.ORACLES["ambiguity_count"]
    assert own in ctes("alignments")
