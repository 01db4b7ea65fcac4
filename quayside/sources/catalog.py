"""Target-table metadata: required columns and table health."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.tokens import AUDIT_COLUMNS

VARCHAR_META = "__CHAR_VARCHAR_TYPE_STRING"

HEALTH_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("ok", T.BooleanType(), False),
    T.StructField("n_rows", T.LongType(), True),
])


def table_columns(spark: SparkSession, table: str, kind: str = "string") -> list[str]:
    """Names of the text columns of ``table`` (the columns a loader must fill).

    ``kind="string"``: every ``StringType`` column (plain Parquet has no
    varchar); ``kind="varchar"``: only columns declared ``varchar(n)``, which
    Spark keeps in field metadata.  Raises when none qualify."""
    schema = spark.table(table).schema
    out = []
    for f in schema.fields:
        declared = (f.metadata or {}).get(VARCHAR_META, "")
        if kind == "varchar":
            if declared.lower().startswith("varchar"):
                out.append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType)):
            out.append(f.name)
    if not out:
        raise ValueError(f"table {table} has no {kind} columns")
    return out


def text_columns(schema: T.StructType) -> list[str]:
    """Text columns of a stored table's schema, audit columns left out."""
    return [f.name for f in schema.fields
            if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType)) and f.name.lower() not in AUDIT_COLUMNS]


def table_columns_frame(spark: SparkSession, table: str, kind: str = "string") -> DataFrame:
    schema = T.StructType([T.StructField("column_name", T.StringType(), False)])
    return spark.createDataFrame([(c,) for c in table_columns(spark, table, kind)], schema)


def table_health(spark: SparkSession, tables: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """One row per table: ``ok`` and its row count.  A missing or unreadable
    table is reported (``ok = false``), not fatal.  Each count is a job of its
    own, answered from Parquet footers where possible.
    ``tables`` may map the reported name to the catalog name."""
    if not tables:
        raise ValueError("no tables to check")
    named = dict(tables) if isinstance(tables, Mapping) else {t: t for t in tables}
    rows: list[tuple[str, bool, int | None]] = []
    for label, t in named.items():
        # each table is counted by itself: a file that cannot be read fails its own count only
        try:
            if not spark.catalog.tableExists(t):
                raise LookupError(t)
            rows.append((label, True, spark.table(t).count()))
        except Exception:  # noqa: BLE001 - an unreadable table is a finding, not a failure
            rows.append((label, False, None))
    return spark.createDataFrame(rows, HEALTH_SCHEMA)


def jdbc_table_columns(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                       data_type: str = "character varying") -> list[str]:
    """Text columns of a relational target, from its ``information_schema``
    (one small query pushed to the database; the result is the column list).
    Not exercised here: no JDBC driver is installed and no database may run."""
    query = ("SELECT column_name FROM information_schema.columns "
             f"WHERE table_name = '{table}' AND data_type = '{data_type}' ORDER BY ordinal_position")
    reader = spark.read.format("jdbc").option("url", url).option("query", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    cols = [r[0] for r in reader.load().collect()]
    if not cols:
        raise ValueError(f"table {table} has no {data_type} columns")
    return cols
