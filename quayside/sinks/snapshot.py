"""Versioned Parquet tables with an all-or-nothing publish.

Each write goes to a fresh version directory ``<root>/v=<n>``; Spark's commit
protocol leaves ``_SUCCESS`` only when every task committed.  Publishing then
marks the version ``_PUBLISHED`` and moves the catalog pointer (``ALTER TABLE
… SET LOCATION``): readers see the old version or the new one, never half of
one, and a failed write, or a load that stopped between writing and
publishing its tables, leaves orphan directories that no reader ever opens.
A session whose catalog does not know the table yet picks the highest
published version.

The layout belongs to the version, not to the caller: its marker holds the
keys and bucket count it was written with, and a reader registers it with
those.  A writer that asks for another layout rewrites the table in it.

A commit is refused (:class:`~quayside.sinks.commits.LostUpdate`) if another
writer published a version after this one read the table.  With a ``log``
(:class:`~quayside.sinks.commits.CommitLog`) that several tables share, their
versions become visible by one record, all or none.

A version also keeps how far each stream that writes the table has come (its
last micro-batch), so that a micro-batch which is run again is recognised.

With ``keys`` and ``buckets`` the versions are written bucketed and sorted on
the keys (one file per bucket, because the rows are hash-partitioned on the
same keys first).  A later upsert/replace joining on those keys then reads
the target without an exchange: only the batch is shuffled.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import qcol
from ..session import fs_for, work_path
from .commits import CommitLog, LostUpdate

_VERSION = re.compile(r"^v=(\d+)$")
# Fixed value: the marker a version gets when it is published (after every
# table of its load was written); Spark's own _SUCCESS only says "written".
PUBLISHED = "_PUBLISHED"


@dataclass
class Staged:
    """A written version that is not visible yet, and the one it was made from."""
    version: int
    path: str
    schema: T.StructType
    base: int | None
    progress: tuple[str, int] | None = None
    at: str | None = None


def stamp(at) -> str:  # noqa: ANN001
    """A time as its text in a snapshot's name: ``20240131_235959``."""
    at = _dt.datetime.fromisoformat(at) if isinstance(at, str) else at
    at = at if isinstance(at, _dt.datetime) else _dt.datetime(at.year, at.month, at.day)
    return at.strftime("%Y%m%d_%H%M%S")


class VersionedTable:
    def __init__(self, spark: SparkSession, name: str, root: str | None = None,
                 keys: Sequence[str] = (), buckets: int | None = None, label: str | None = None, log: CommitLog | None = None):
        if not re.match(r"^[A-Za-z_][A-Za-z0-9_]*$", name):
            raise ValueError(f"table name must be an identifier: {name!r}")
        self.spark = spark
        self.name = name
        self.label = label or name
        if root is None and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"table {name}: name its root folder; the work folder ends with the session")
        self.root = (root or work_path(spark, "tables", name, unique=False)).rstrip("/")
        self.keys = list(keys)
        self.buckets = buckets if (buckets and self.keys) else None
        self.log = log
        self._seen: list[int | None] = []  # the version that was read last

    # -- versions ---------------------------------------------------------
    def _list_versions(self, committed: bool) -> list[int]:
        fs, root = fs_for(self.spark, self.root)
        if not fs.exists(root):
            return []
        out = []
        for st in fs.listStatus(root):
            m = _VERSION.match(st.getPath().getName())
            if not m or not st.isDirectory():
                continue
            if committed and not fs.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
                    st.getPath(), PUBLISHED)):
                continue
            out.append(int(m.group(1)))
        return sorted(out)

    def versions(self) -> list[int]:
        """Published versions, oldest first (a staged version whose load did not
        reach its publish step is never listed)."""
        return self.log.versions(self.name) if self.log is not None else self._list_versions(committed=True)

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def version_path(self, version: int) -> str:
        return f"{self.root}/v={version:08d}"

    def exists(self) -> bool:
        return self.current_version() is not None

    def _marker(self, version: int) -> dict:
        fs, marker = fs_for(self.spark, f"{self.version_path(version)}/{PUBLISHED}")
        stream = fs.open(marker)
        try:
            raw = bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()
        return json.loads(raw) if raw else {}

    def layout(self, version: int) -> tuple[list[str], int | None]:
        """(keys, buckets) that a published version was written with."""
        held = self._marker(version)
        return list(held.get("keys", [])), held.get("buckets")

    def snapshots(self) -> dict[int, str]:
        """Published version: its name, ``<label>_<time of its load>`` (versions
        published without a time have none)."""
        times = {v: self._marker(v).get("at") for v in self.versions()}
        return {v: f"{self.label}_{t}" for v, t in times.items() if t}

    def read_at(self, at) -> DataFrame:  # noqa: ANN001
        """The table as the last load up to ``at`` left it."""
        limit = f"{self.label}_{stamp(at)}"
        known = [v for v, name in self.snapshots().items() if name <= limit]
        if not known:
            raise FileNotFoundError(f"table {self.name} has no version of {at} or before")
        return self.read(max(known))

    def progress(self, stream: str) -> int | None:
        """The last micro-batch of ``stream`` whose rows the table has."""
        cur = self.current_version()
        return self._marker(cur).get("streams", {}).get(stream) if cur is not None else None

    def drop_old_versions(self, keep: int = 1) -> list[int]:
        """Delete all but the last ``keep`` published versions, and unpublished
        ones older than the current; the current version is never deleted.
        Returns the versions dropped.  Only this call ever deletes data."""
        kept = self.versions()[-max(1, keep):]
        if not kept:
            return []
        gone = [v for v in self._list_versions(committed=False) if v < kept[-1] and v not in kept]
        if self.log is not None:
            self.log.forget(self.name, gone)
        for v in gone:
            fs, path = fs_for(self.spark, self.version_path(v))
            fs.delete(path, True)
        return gone

    # -- reading ----------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        if version is not None:
            return self.spark.read.parquet(self.version_path(version))
        cur = self.current_version()
        if cur is None:
            raise FileNotFoundError(f"table {self.name} has no committed version under {self.root}")
        self._seen = [cur]
        if not self._registered(self.version_path(cur)):
            self._register(self.version_path(cur), self.spark.read.parquet(self.version_path(cur)).schema,
                           *self.layout(cur))
        return self.spark.table(self.name)

    def _registered(self, path: str) -> bool:
        """Whether the catalog's table of this name is this very version: a name
        used by another root, or a view, is not."""
        if any(t.name == self.name and t.isTemporary for t in self.spark.catalog.listTables(pattern=self.name)):
            raise ValueError(f"{self.name} is a temporary view in this session; it hides the table")
        if not self.spark.catalog.tableExists(self.name):
            return False
        rows = self.spark.sql(f"DESCRIBE FORMATTED {self.name}").where("col_name = 'Location'").collect()
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return bool(rows) and jpath(rows[0]["data_type"]).toUri().getPath() == jpath(path).toUri().getPath()

    def read_or_empty(self, schema: T.StructType) -> DataFrame:
        if self.exists():
            return self.read()
        self._seen = [None]
        return self.spark.createDataFrame([], schema)

    # -- writing ----------------------------------------------------------
    def publish(self, df: DataFrame, progress: tuple[str, int] | None = None, at=None) -> int:  # noqa: ANN001
        """Write ``df`` as the next version and make it current.  Returns the version."""
        return self.commit(self.stage(df, progress=progress, at=at))

    def stage(self, df: DataFrame, repartition: bool | None = None, progress: tuple[str, int] | None = None, at=None) -> Staged:  # noqa: ANN001
        """Write ``df`` into the next version directory without publishing it,
        so several tables can be written before any becomes visible.

        Bucketed tables: the first version is hash-partitioned on the keys so
        that each task writes one bucket file.  Later versions come from a join
        with the bucketed current version, whose output is already split by
        the same hash into the same buckets, so by default they are written
        as they are: no second shuffle of the whole table (``repartition``
        forces either way).  ``progress`` is the (stream, micro-batch) that this
        version holds the rows of, ``at`` the time of its load."""
        base = self._seen[0] if self._seen else self.current_version()
        existing = self._list_versions(committed=False)
        version = (existing[-1] + 1) if existing else 1
        path = self.version_path(version)
        if self.buckets:
            staged = f"{self.name}__v{version:08d}"
            if repartition is None:
                cur = self.current_version()
                repartition = cur is None or self.layout(cur) != (self.keys, self.buckets)
            out = df.repartition(self.buckets, *[qcol(k) for k in self.keys]) if repartition else df
            (out.write.format("parquet").mode("errorifexists")
               .bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
               .option("path", path).saveAsTable(staged))
            # the staged entry only described the files; the pointer below is the table
            self.spark.sql(f"DROP TABLE IF EXISTS {staged}")
        else:
            df.write.mode("errorifexists").parquet(path)
        return Staged(version, path, df.schema, base, progress, None if at is None else stamp(at))

    def commit(self, staged: Staged) -> int:
        """Publish a staged version: mark it, then move the catalog pointer."""
        now = self.current_version()
        if now != staged.base:
            raise LostUpdate(f"table {self.name}: version {now} was published by another writer (this load read {staged.base})")
        self.mark(staged)
        if self.log is not None:
            self.log.commit({self.name: staged.version}, {self.name: staged.base})
        return self.show(staged)

    def mark(self, staged: Staged) -> None:
        """Write a version's marker: its layout and the streams' progress."""
        streams = dict(self._marker(staged.base).get("streams", {})) if staged.base is not None else {}
        if staged.progress is not None:
            streams[staged.progress[0]] = staged.progress[1]
        held = {"keys": self.keys, "buckets": self.buckets, **({"streams": streams} if streams else {}), **({"at": staged.at} if staged.at else {})}
        fs, jpath = fs_for(self.spark, staged.path)
        marker = fs.create(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(jpath, PUBLISHED), True)
        marker.write(bytearray(json.dumps(held).encode("utf-8")))
        marker.close()

    def show(self, staged: Staged) -> int:
        """Move this session's catalog pointer to a version that is committed."""
        self._seen = [staged.version]
        self._register(staged.path, staged.schema, self.keys, self.buckets)
        return staged.version

    def _register(self, path: str, schema: T.StructType, keys: Sequence[str], buckets: int | None) -> None:
        spark = self.spark
        if spark.catalog.tableExists(self.name):
            cur = spark.table(self.name).schema
            described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {self.name}").collect()}
            same_buckets = str(described.get("Num Buckets", "")) == (str(buckets) if buckets else "")
            same_keys = described.get("Bucket Columns", "") == ("[" + ", ".join(f"`{k}`" for k in keys) + "]" if buckets else "")
            if same_buckets and same_keys and [(f.name, f.dataType) for f in cur.fields] == [(f.name, f.dataType) for f in schema.fields]:
                spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{path}'")
                spark.catalog.refreshTable(self.name)
                return
            spark.sql(f"DROP TABLE {self.name}")
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        bucket = ""
        if buckets:
            ks = ", ".join(f"`{k}`" for k in keys)
            bucket = f" CLUSTERED BY ({ks}) SORTED BY ({ks}) INTO {buckets} BUCKETS"
        spark.sql(f"CREATE TABLE {self.name} ({cols}) USING parquet{bucket} LOCATION '{path}'")

    def count(self) -> DataFrame:
        return self.read().agg(F.count(F.lit(1)).alias("final_count"))


def publish_snapshot(df: DataFrame, table: VersionedTable) -> DataFrame:
    """Publish ``df`` as the next version of ``table`` and return the table."""
    table.publish(df)
    return table.read()
