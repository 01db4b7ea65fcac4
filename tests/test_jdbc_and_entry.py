import pytest

from helpers import SF
from quayside.sinks.jdbc import replace_statements, upsert_statement


def test_upsert_statement_postgres():
    sql = upsert_statement("t", "t_stage", ["k", "v", "created_at"], ["k"])
    assert sql == ('INSERT INTO t ("k", "v", "created_at", "updated_at") SELECT "k", "v", CURRENT_TIMESTAMP, '
                   'CURRENT_TIMESTAMP FROM t_stage ON CONFLICT ("k") DO UPDATE SET "v" = EXCLUDED."v"')


def test_replace_statements_text():
    stmts = replace_statements("r", "s", ["k", "v"], ["k"], audit=False)
    assert stmts == ['DELETE FROM r WHERE EXISTS (SELECT 1 FROM s s WHERE s."k" = r."k")',
                     'INSERT INTO r ("k", "v") SELECT "k", "v" FROM s']


def test_merge_statement_shape():
    sql = upsert_statement("t", "s", ["k", "v"], ["k"], dialect="merge")
    assert sql.startswith('MERGE INTO t t USING s s ON (t."k" = s."k") WHEN MATCHED THEN UPDATE SET "v" = s."v"')


def test_a_relational_table_is_the_target_of_a_journal_load(spark, scratch, monkeypatch):
    import os

    from quayside.landing import land_bytes
    from quayside.plans.flows import run_journal
    from quayside.sinks import jdbc
    from quayside.spec import TableSpec

    said = []
    table = jdbc.JdbcTable(spark, "jdbc:none", "refs")
    monkeypatch.setattr(table, "read", lambda: spark.createDataFrame([], "k string, v string, extra string"))
    monkeypatch.setattr(jdbc, "run_statements", lambda df, url, statements, props=None: said.append((sorted(map(tuple, df.collect())), list(statements))))
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.jdbc", lambda self, url, name, mode=None, properties=None: said.append((name, mode)))
    landing = os.path.join(scratch, "landing")
    land_bytes(spark, landing, "j1.csv", b"k;v\n1;a\n1;b\n2;NA\n", mtime="2024-01-01")
    spec = TableSpec("refs", "j*", (("k", "k"), ("v", "v")), ("k",), delimiter=";")
    run_journal(spark, spec, landing, table, as_of="2024-01-02", now="2024-01-02")
    assert said[0] == ("refs__staging", "overwrite")
    rows, statements = said[1]
    assert rows == [("1", "b", "-"), ("2", "-", "-")]      # one row a key, the last, filled
    assert statements[0].startswith('INSERT INTO refs ("k", "v", "extra", "created_at", "updated_at")')
    assert statements[-1] == "DROP TABLE refs__staging"


def test_entry_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.columns == ["table_name", "status", "final_count"]
    assert {r.table_name for r in df.collect()} == {"claims_normal", "claims_repeated"}


@pytest.mark.parametrize("name", [
    "claims_files_rows", "claims_flagship", "claims_normal_rows", "claims_repeated_rows", "journal_flow", "journal_two_part_key", "load_report", "publish_snapshot",
    "read_split_multiline", "routed_claims_rows", "skip_empty_report", "snapshot_at_rows", "stream_ingest", "stream_journal", "stream_replace_rows", "stream_reuploads",
    "stream_settled_files", "tick_rows"])
def test_queries_name_the_roots_of_their_tables(spark, monkeypatch, name):
    import __spark_entry__ as e

    # a cluster session refuses a table without a root
    monkeypatch.setattr(spark.sparkContext, "master", "spark://driver:7077")
    assert e.queries()[name](spark, SF).count() > 0
