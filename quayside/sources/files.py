"""Landed files as a table: discover, classify, pick, route, plan.

A folder listing becomes a *manifest* ``DataFrame(path, name, mtime, length)``
read through the ``binaryFile`` source without its ``content`` column (the
bytes are never read).  Every decision over it is a column expression,
aggregate or join, so a landing area with millions of files is planned in
parallel like any other table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import qcol
from ..functions.globs import glob_match

MANIFEST_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("mtime", T.TimestampType(), True),
    T.StructField("length", T.LongType(), True),
])

LEDGER_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("mtime", T.TimestampType(), True),
    T.StructField("length", T.LongType(), True),
    T.StructField("run_key", T.StringType(), True),
    T.StructField("run_status", T.StringType(), True),
])

FILE_ID = ("name", "mtime", "length")


def discover_files(spark: SparkSession, folder: str, recursive: bool = False,
                   require_files: bool = True) -> DataFrame:
    """Manifest of a folder.  A missing folder raises; an empty one raises when
    ``require_files`` (a LIMIT-1 probe, not a count)."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(folder).select(
        F.col("path"),
        F.regexp_extract(F.col("path"), r"([^/]*)$", 1).alias("name"),
        F.col("modificationTime").alias("mtime"),
        F.col("length"),
    )
    if require_files and df.isEmpty():
        raise FileNotFoundError(f"no files in {folder}")
    return df


def _ts_literal(value, dtype: T.DataType) -> Column:
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(value).cast(dtype)


def cutoff_column(manifest: DataFrame, as_of, min_age_seconds: float, time_col: str = "mtime") -> Column:
    """``time_col <= as_of - min_age`` (file old enough to be complete)."""
    dtype = manifest.schema[time_col].dataType
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    return qcol(time_col) <= _ts_literal(as_of - _dt.timedelta(seconds=min_age_seconds), dtype)


def classify_files(manifest: DataFrame, pattern: str, as_of, min_age_seconds: float = 60,
                   time_col: str = "mtime", out: str = "state") -> DataFrame:
    """``state``: ``invalid`` (name does not match), ``valid`` (matches and is
    at least ``min_age_seconds`` old at ``as_of``) or ``young``."""
    return manifest.withColumn(
        out,
        F.when(~glob_match(qcol("name"), pattern), F.lit("invalid"))
         .when(cutoff_column(manifest, as_of, min_age_seconds, time_col), F.lit("valid"))
         .otherwise(F.lit("young")))


def latest_by_name(manifest: DataFrame, by: Sequence[str] = (), extra: Sequence[str] = ()) -> DataFrame:
    """Greatest name per group (code-point order); ``extra`` columns (e.g.
    ``path``) come from the same row.  A partial aggregate: no sort, no window."""
    by = list(by)
    if not extra:
        return manifest.groupBy(*[qcol(b) for b in by]).agg(F.max(qcol("name")).alias("name"))
    best = F.max(F.struct(qcol("name").alias("name"), *[qcol(c).alias(c) for c in extra])).alias("__qs_b")
    g = manifest.groupBy(*[qcol(b) for b in by]).agg(best)
    return g.select(*[qcol(b) for b in by], *[F.col("__qs_b").getField(c).alias(c) for c in ["name", *extra]])


def latest_by_time(manifest: DataFrame, by: Sequence[str] = (), time_col: str = "mtime",
                   tie: Sequence[str] = ("name",), keep: Sequence[str] | None = None) -> DataFrame:
    """Newest row per group by ``time_col`` (ties by ``tie``, greatest wins);
    returns ``by`` + ``keep`` columns.  Partial aggregate of one struct."""
    by = list(by)
    keep = [c for c in (keep if keep is not None else manifest.columns) if c not in by]
    order = [time_col, *tie]
    best = F.max(F.struct(*[qcol(c).alias(f"o{i}") for i, c in enumerate(order)],
                          F.struct(*[qcol(c).alias(c) for c in keep]).alias("row"))).alias("__qs_b")
    g = manifest.groupBy(*[qcol(b) for b in by]).agg(best)
    return g.select(*[qcol(b) for b in by], *[F.col("__qs_b").getField("row").getField(c).alias(c) for c in keep])


def route_files(manifest: DataFrame, routes: Sequence[tuple[str, str, bool]] | Sequence,
                all_matches: bool = False) -> DataFrame:
    """Match files against an ordered list of ``(table_name, pattern, registered)``
    routes (TableSpec objects are accepted too).  Unregistered routes are
    skipped.  By default only the first route (config order) that matches any
    file is returned, with its greatest file name; ``all_matches`` returns
    every matched route.  The route list is config-sized, so each file is
    tested against it with one array expression: no join, no broadcast.
    Result: ``pos, table_name, name, path``."""
    norm = []
    for r in routes:
        if hasattr(r, "name_pattern"):
            norm.append((r.table_name, r.name_pattern, True))
        else:
            norm.append(tuple(r))
    live = [(pos, t, p) for pos, (t, p, reg) in enumerate(norm) if reg]
    if not live:
        raise ValueError("no registered route")
    hits = F.array(*[F.when(glob_match(qcol("name"), p), F.lit(pos)) for pos, _, p in live])
    hits = F.filter(hits, lambda x: x.isNotNull())
    names = F.create_map(*[x for pos, t, _ in live for x in (F.lit(pos), F.lit(t))])
    cols = ["name"] + (["path"] if "path" in manifest.columns else [])
    matched = manifest.select(*[qcol(c) for c in cols], F.explode(hits).alias("pos"))
    best = F.max(F.struct(*[qcol(c).alias(c) for c in cols])).alias("__qs_b")
    per_route = matched.groupBy("pos").agg(best).select(
        "pos", names[F.col("pos")].alias("table_name"),
        *[F.col("__qs_b").getField(c).alias(c) for c in cols])
    if all_matches:
        return per_route
    # the feature: "first registered route with a file wins"
    return per_route.orderBy("pos").limit(1)


def plan_file_actions(manifest: DataFrame, ledger: DataFrame, on: Sequence[str] = FILE_ID,
                      stale_before=None) -> DataFrame:
    """Per landed file: ``launch`` (never seen), ``wait`` (running, or a run
    whose outcome is unknown), ``retire`` (succeeded), ``relaunch`` (failed).
    A file is identified by (name, mtime, length): a re-upload under the same
    name is a new file; several ledger rows for one file give one action.  One
    partial aggregate and one left join; the ledger side is measured by AQE.

    By default a waiting file waits for ever, as in the reference.  With
    ``stale_before`` (and a ledger ``started_at`` column) a run started before
    it that is still running or unknown is relaunched instead."""
    on = list(on)
    extra = ["started_at"] if (stale_before is not None and "started_at" in ledger.columns) else []
    # several attempts at one file leave several rows; one status stands for
    # them: success is final, else a run that is under way, else the failure
    state = F.upper(F.col("run_status"))
    rank = F.when(state == "SUCCESS", 3).when(state == "FAILURE", 1).otherwise(2)
    latest = ledger.groupBy(*[qcol(c) for c in on]).agg(
        F.max(F.struct(rank.alias("rank"), *[F.col(c) for c in extra], F.col("run_status"))).alias("__qs_run"))
    led = latest.select(*[qcol(c) for c in on], *[F.col("__qs_run")[c].alias(c) for c in ["run_status", *extra]],
                        F.lit(True).alias("__qs_seen"))
    j = manifest.join(led, on=on, how="left")
    status = F.upper(F.col("run_status"))
    action = (F.when(F.col("__qs_seen").isNull(), F.lit("launch"))
               .when(status == "SUCCESS", F.lit("retire"))
               .when(status == "FAILURE", F.lit("relaunch")))
    if extra:
        cut = _ts_literal(stale_before if not isinstance(stale_before, str)
                          else _dt.datetime.fromisoformat(stale_before), ledger.schema["started_at"].dataType)
        action = action.when(F.col("started_at") < cut, F.lit("relaunch"))
    action = action.otherwise(F.lit("wait"))
    return j.select(*[qcol(c) for c in manifest.columns], F.col("run_status"), action.alias("action"))
