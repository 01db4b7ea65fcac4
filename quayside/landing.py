"""Land exports as files in a landing folder (used by the flows' queries and tests).

``land`` writes a DataFrame as delimited text with Spark (one file per
partition, in parallel), then gives each part a landed-file name and a
modification time with driver-side file-system metadata calls (a rename per
part; no data passes through the driver).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from .session import fs_for, work_path
from .sources.delimited import write_delimited


def _millis(ts) -> int:
    if isinstance(ts, str):
        ts = _dt.datetime.fromisoformat(ts)
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=_dt.timezone.utc)
    return int(ts.timestamp() * 1000)


def land(df: DataFrame, landing: str, prefix: str, mtime=None, delimiter: str = ";",
         encoding: str = "utf-8", suffix: str = ".csv", overwrite: bool = False) -> list[str]:
    """Write ``df`` as ``<landing>/<prefix>_<part>.csv`` files; returns their
    paths.  ``overwrite``: a second upload under the same names."""
    spark = df.sparkSession
    staging = work_path(spark, "staging")
    write_delimited(df, staging, delimiter, encoding)
    fs, sdir = fs_for(spark, staging)
    jvm = spark.sparkContext._jvm
    _, ldir = fs_for(spark, landing)
    fs.mkdirs(ldir)
    parts = sorted(str(st.getPath().getName()) for st in fs.listStatus(sdir)
                   if st.getPath().getName().startswith("part-"))
    out = []
    for i, name in enumerate(parts):
        dst = jvm.org.apache.hadoop.fs.Path(ldir, f"{prefix}_{i:05d}{suffix}")
        if overwrite and fs.exists(dst):
            fs.delete(dst, False)
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(sdir, name), dst):
            raise OSError(f"could not land {name} as {dst}")
        if mtime is not None:
            fs.setTimes(dst, _millis(mtime), -1)
        out.append(str(dst.toString()))
    return out


def land_bytes(spark: SparkSession, landing: str, name: str, data: bytes, mtime=None) -> str:
    """One small landed file with exact bytes (fixtures: junk, edge cases)."""
    fs, ldir = fs_for(spark, landing)
    fs.mkdirs(ldir)
    dst = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ldir, name)
    stream = fs.create(dst, True)
    stream.write(bytearray(data))
    stream.close()
    if mtime is not None:
        fs.setTimes(dst, _millis(mtime), -1)
    return str(dst.toString())
