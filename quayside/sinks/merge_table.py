"""Upsert / replace into a catalog table that supports row-level changes.

Where a v2 table format with row-level operations is configured (a lakehouse
catalog), ``MERGE INTO`` rewrites only the files holding touched keys,
instead of a new full version.  Spark refuses it for plain Parquet tables;
then :class:`quayside.sinks.snapshot.VersionedTable` with
:func:`quayside.operators.merge.upsert` is the way.  The batch must already be
prepared (filled, de-duplicated on the keys).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.tokens import AUDIT_COLUMNS


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def merge_statement(table: str, source_view: str, columns: Sequence[str], keys: Sequence[str], now: str,
                    touch_updated_at: bool = False, audit: bool = True) -> str:
    cols = [c for c in columns if c.lower() not in AUDIT_COLUMNS]
    keys = list(keys)
    on = " AND ".join(f"t.{_q(k)} = s.{_q(k)}" for k in keys)
    sets = [f"t.{_q(c)} = s.{_q(c)}" for c in cols if c not in keys]
    stamp = f"CAST('{now}' AS TIMESTAMP)"
    if audit and touch_updated_at:
        sets.append(f"t.{_q('updated_at')} = {stamp}")
    ins = [*cols, *(AUDIT_COLUMNS if audit else ())]
    vals = [f"s.{_q(c)}" for c in cols] + ([stamp, stamp] if audit else [])
    matched = f" WHEN MATCHED THEN UPDATE SET {', '.join(sets)}" if sets else ""
    return (f"MERGE INTO {table} t USING {source_view} s ON {on}{matched} "
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(_q(c) for c in ins)}) VALUES ({', '.join(vals)})")


def merge_upsert(batch: DataFrame, table: str, keys: Sequence[str], now: str, touch_updated_at: bool = False,
                 audit: bool = True) -> None:
    """Apply ``batch`` to ``table`` with one ``MERGE INTO``."""
    view = f"quayside_batch_{uuid.uuid4().hex[:10]}"
    batch.createOrReplaceTempView(view)
    try:
        batch.sparkSession.sql(merge_statement(table, view, batch.columns, keys, now, touch_updated_at, audit))
    finally:
        batch.sparkSession.catalog.dropTempView(view)


def merge_replace(batch: DataFrame, table: str, keys: Sequence[str], now: str, audit: bool = True) -> None:
    """Delete the stored rows of every batch key, then append the batch."""
    from pyspark.sql import functions as F

    view = f"quayside_batch_{uuid.uuid4().hex[:10]}"
    batch.select(*keys).distinct().createOrReplaceTempView(view)
    spark = batch.sparkSession
    try:
        on = " AND ".join(f"t.{_q(k)} = s.{_q(k)}" for k in keys)
        spark.sql(f"MERGE INTO {table} t USING {view} s ON {on} WHEN MATCHED THEN DELETE")
    finally:
        spark.catalog.dropTempView(view)
    out = batch
    if audit:
        out = batch.withColumns({a: F.lit(now).cast("timestamp") for a in AUDIT_COLUMNS})
    out.writeTo(table).append()
