"""Retiring landed files: ledger rows, and an archive move for files read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fs_for


def retire_files(classified: DataFrame, state_col: str = "state") -> DataFrame:
    """Ledger rows for a classified manifest: files that do not match the
    pattern are ``QUARANTINED``, valid (settled) files ``RETIRED``; young
    files are left alone.  Nothing is deleted: the rows are the record."""
    state = F.col(state_col)
    keep = [c for c in ("name", "path", "mtime", "length") if c in classified.columns]
    return classified.where(state.isin("invalid", "valid")).select(
        *keep, F.when(state == "invalid", F.lit("QUARANTINED")).otherwise(F.lit("RETIRED")).alias("run_status"))


def archive_files(spark: SparkSession, paths: Sequence[str], archive_dir: str) -> list[str]:
    """Move files that were actually read into ``archive_dir`` (metadata-only
    renames on the files' own file system; the list is the file list of one
    load, not data).  A name that is taken in the archive gets the file's
    modification time and length, so every upload under one name is kept.  A
    file that is already gone is left out; one that cannot be moved is an
    error that names it."""
    jvm = spark.sparkContext._jvm
    moved, stuck = [], []
    for p in paths:
        fs, src = fs_for(spark, p)
        if not fs.exists(src):
            continue
        adir = jvm.org.apache.hadoop.fs.Path(archive_dir)
        fs.mkdirs(adir)
        dst = jvm.org.apache.hadoop.fs.Path(adir, src.getName())
        if fs.exists(dst):
            st = fs.getFileStatus(src)
            stem, dot, ext = src.getName().rpartition(".")
            mark = f"{st.getModificationTime()}-{st.getLen()}"
            name = f"{stem}.{mark}.{ext}" if dot else f"{ext}.{mark}"
            dst = jvm.org.apache.hadoop.fs.Path(adir, name)
        if not fs.exists(dst) and fs.rename(src, dst):
            moved.append(str(dst.toString()))
        else:
            stuck.append(p)
    if stuck:
        raise OSError(f"could not archive to {archive_dir}: {stuck}")
    return moved
