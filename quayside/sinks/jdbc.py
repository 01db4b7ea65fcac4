"""Keyed writes into a relational target over JDBC, set-based.

The rows travel in parallel from the executors into a staging table
(``DataFrame.write.jdbc``), then ONE statement per operation runs on the
database inside one transaction: ``INSERT … SELECT … ON CONFLICT`` (PostgreSQL)
or ``MERGE`` (ANSI), instead of one statement per row.  Both statements reject
two source rows for one key, so an upsert first fills missing values and keeps
the last row of each key.  :class:`JdbcTable` stands in for a versioned table as
the target of a journal load.

Only the statement text is exercised by the tests here: this environment
has no database driver and no database (embedded or served) may be started
for a test, so the JDBC round trip itself is unverified.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.tokens import AUDIT_COLUMNS
from ..operators.mapping import drop_audit, fill_sentinel
from ..operators.merge import POS, dedupe_last


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def upsert_statement(table: str, staging: str, columns: Sequence[str], keys: Sequence[str],
                     dialect: str = "postgresql", audit: bool = True, touch_updated_at: bool = False) -> str:
    """The one statement that applies a staged batch as an upsert."""
    cols = [c for c in columns if c.lower() not in AUDIT_COLUMNS]
    keys = list(keys)
    missing = [k for k in keys if k not in cols]
    if missing:
        raise ValueError(f"key column(s) not in the batch: {missing}")
    setc = [c for c in cols if c not in keys]
    ins_cols = [*cols, *(AUDIT_COLUMNS if audit else ())]
    if dialect == "postgresql":
        sel = [_q(c) for c in cols] + (["CURRENT_TIMESTAMP", "CURRENT_TIMESTAMP"] if audit else [])
        sets = [f"{_q(c)} = EXCLUDED.{_q(c)}" for c in setc]
        if audit and touch_updated_at:
            sets.append(f"{_q('updated_at')} = CURRENT_TIMESTAMP")
        action = f"DO UPDATE SET {', '.join(sets)}" if sets else "DO NOTHING"
        return (f"INSERT INTO {table} ({', '.join(_q(c) for c in ins_cols)}) "
                f"SELECT {', '.join(sel)} FROM {staging} "
                f"ON CONFLICT ({', '.join(_q(k) for k in keys)}) {action}")
    if dialect == "merge":
        on = " AND ".join(f"t.{_q(k)} = s.{_q(k)}" for k in keys)
        sets = [f"{_q(c)} = s.{_q(c)}" for c in setc]
        if audit and touch_updated_at:
            sets.append(f"{_q('updated_at')} = CURRENT_TIMESTAMP")
        vals = [f"s.{_q(c)}" for c in cols] + (["CURRENT_TIMESTAMP", "CURRENT_TIMESTAMP"] if audit else [])
        matched = f" WHEN MATCHED THEN UPDATE SET {', '.join(sets)}" if sets else ""
        return (f"MERGE INTO {table} t USING {staging} s ON ({on}){matched} "
                f"WHEN NOT MATCHED THEN INSERT ({', '.join(_q(c) for c in ins_cols)}) VALUES ({', '.join(vals)})")
    raise ValueError(f"unknown dialect {dialect!r}")


def replace_statements(table: str, staging: str, columns: Sequence[str], keys: Sequence[str],
                       audit: bool = True) -> list[str]:
    """Delete every stored row whose key is staged, then insert all staged rows."""
    cols = [c for c in columns if c.lower() not in AUDIT_COLUMNS]
    on = " AND ".join(f"s.{_q(k)} = {table}.{_q(k)}" for k in keys)
    ins_cols = [*cols, *(AUDIT_COLUMNS if audit else ())]
    sel = [_q(c) for c in cols] + (["CURRENT_TIMESTAMP", "CURRENT_TIMESTAMP"] if audit else [])
    return [f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {staging} s WHERE {on})",
            f"INSERT INTO {table} ({', '.join(_q(c) for c in ins_cols)}) SELECT {', '.join(sel)} FROM {staging}"]


def run_statements(df: DataFrame, url: str, statements: Sequence[str], properties: dict | None = None) -> None:
    """Run statements in one transaction on the driver's JDBC connection."""
    jvm = df.sparkSession.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        conn.setAutoCommit(False)
        st = conn.createStatement()
        for sql in statements:
            st.executeUpdate(sql)
        conn.commit()
        st.close()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()


def applicable(df: DataFrame, keys: Sequence[str], strategy: str) -> DataFrame:
    """The rows to stage: missing values filled, audit columns dropped, and for
    an upsert the last row of each key."""
    df = fill_sentinel(drop_audit(df))
    df = dedupe_last(df, keys) if strategy == "upsert" else df
    return df.drop(POS)


class JdbcTable:
    """A relational target for :func:`quayside.plans.flows.run_journal`."""

    buckets = None

    def __init__(self, spark, url: str, table: str, dialect: str = "postgresql", properties: dict | None = None,
                 label: str | None = None, num_partitions: int | None = None):
        self.spark, self.url, self.table, self.dialect = spark, url, table, dialect
        self.properties, self.num_partitions, self.label = properties, num_partitions, label or table

    def exists(self) -> bool:
        return True

    def read(self) -> DataFrame:
        return self.spark.read.jdbc(self.url, self.table, properties=dict(self.properties or {}))

    def apply(self, batch: DataFrame, keys: Sequence[str], strategy: str) -> None:
        jdbc_upsert(batch, self.url, self.table, keys, self.dialect, self.properties, strategy=strategy,
                    num_partitions=self.num_partitions)


def jdbc_upsert(df: DataFrame, url: str, table: str, keys: Sequence[str], dialect: str = "postgresql",
                properties: dict | None = None, staging: str | None = None, strategy: str = "upsert",
                num_partitions: int | None = None) -> None:
    """Stage ``df`` (filled; for an upsert one row a key, the last) in parallel,
    then apply it with one set-based statement."""
    df = applicable(df, keys, strategy)
    staging = staging or f"{table}__staging"
    props = dict(properties or {})
    if num_partitions:
        # the JDBC writer coalesces to this many connections (no shuffle)
        props["numPartitions"] = str(num_partitions)
    df.write.jdbc(url, staging, mode="overwrite", properties=props)
    if strategy == "upsert":
        stmts = [upsert_statement(table, staging, df.columns, keys, dialect)]
    elif strategy == "replace":
        stmts = replace_statements(table, staging, df.columns, keys)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    run_statements(df, url, [*stmts, f"DROP TABLE {staging}"], properties)
