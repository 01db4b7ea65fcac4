"""Projection operators: rename/project by a mapping, complete and fill columns.

Every operator here is one ``select``/``withColumns`` of native expressions,
so a chain of them collapses into a single projection inside whole-stage
codegen and column pruning reaches the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import qcol
from ..functions.tokens import AUDIT_COLUMNS, SENTINEL

MappingLike = Mapping[str, str] | Sequence[tuple[str, str]]


def _pairs(mapping: MappingLike) -> list[tuple[str, str]]:
    return list(mapping.items()) if isinstance(mapping, Mapping) else [tuple(p) for p in mapping]


def map_strict(df: DataFrame, mapping: MappingLike) -> DataFrame:
    """Rename source → target and keep exactly the mapped columns, in mapping
    order.  A batch that already carries a target name passes as that column.
    Raises ``ValueError`` naming every mapped column that is absent."""
    cols, missing = [], []
    present = set(df.columns)
    for src, dst in _pairs(mapping):
        if src in present:
            cols.append(qcol(src).alias(dst))
        elif dst in present:
            cols.append(qcol(dst).alias(dst))
        else:
            missing.append(src)
    if missing:
        raise ValueError(f"mapped column(s) missing from the batch: {missing}")
    return df.select(*cols)


def map_lenient(df: DataFrame, mapping: MappingLike) -> DataFrame:
    """Rename only the mapped columns that are present; keep everything else."""
    present = set(df.columns)
    renames = {src: dst for src, dst in _pairs(mapping) if src in present and src != dst}
    return df.withColumnsRenamed(renames) if renames else df


def missing_columns(df: DataFrame, mapping: MappingLike | Iterable[str]) -> list[str]:
    """Mapped source columns absent from the batch (mapping order)."""
    if isinstance(mapping, Mapping) or (isinstance(mapping, Sequence) and mapping
                                        and isinstance(next(iter(mapping)), tuple)):
        names = [s for s, _ in _pairs(mapping)]
    else:
        names = list(mapping)
    present = set(df.columns)
    return [n for n in names if n not in present]


def missing_columns_frame(spark: SparkSession, df: DataFrame, mapping) -> DataFrame:
    """:func:`missing_columns` as a one-column report ``missing_column``."""
    schema = T.StructType([T.StructField("missing_column", T.StringType(), False)])
    return spark.createDataFrame([(n,) for n in missing_columns(df, mapping)], schema)


def fill_missing_required(df: DataFrame, required: Iterable[str], default: str = SENTINEL,
                          exclude: Iterable[str] = ("is_complex",)) -> DataFrame:
    """Add every required column the batch lacks, as the constant ``default``."""
    skip = set(exclude)
    present = set(df.columns)
    add = {c: F.lit(default) for c in required if c not in present and c not in skip}
    return df.withColumns(add) if add else df


def fill_sentinel(df: DataFrame, value: str = SENTINEL, subset: Iterable[str] | None = None) -> DataFrame:
    """Every missing string cell becomes ``value`` (key columns too).  Non-string
    columns are left alone, as a string fill would."""
    names = set(subset) if subset is not None else None
    out = []
    for f in df.schema.fields:
        c = qcol(f.name)
        if isinstance(f.dataType, T.StringType) and (names is None or f.name in names):
            out.append(F.coalesce(c, F.lit(value)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def drop_audit(df: DataFrame, audit: Iterable[str] = AUDIT_COLUMNS) -> DataFrame:
    """Drop audit columns the loader stamps itself (case-insensitive)."""
    lowered = {a.lower() for a in audit}
    drop = [c for c in df.columns if c.lower() in lowered]
    return df.drop(*drop) if drop else df


def incremental_window(df: DataFrame, start_col: str, change_col: str, as_of) -> DataFrame:
    """Rows whose start is in the year of ``as_of`` and that changed since the
    day before ``as_of``.  ``as_of`` is a date/datetime/ISO string, never now().
    Both bounds are literals, so the filter is pushed to the Parquet scan."""
    import datetime as _dt

    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    year_start = _dt.datetime(as_of.year, 1, 1)
    yesterday = _dt.datetime.combine(as_of - _dt.timedelta(days=1), _dt.time())
    t_start = df.schema[start_col].dataType
    t_change = df.schema[change_col].dataType
    return df.filter((qcol(start_col) >= _lit(year_start, t_start))
                     & (qcol(change_col) >= _lit(yesterday, t_change)))


def _lit(value, dtype) -> Column:
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit(value.isoformat(sep=" ") if hasattr(value, "hour") else value.isoformat()).cast(dtype)
    return F.lit(value).cast(dtype)


def as_strings(df: DataFrame) -> DataFrame:
    """Every column cast to string (what a text reader would have produced)."""
    return df.select(*[qcol(c).cast("string").alias(c) for c in df.columns])
