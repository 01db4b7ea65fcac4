"""Keyed Parquet tables of which a load rewrites only the touched partitions.

Rows are dealt to ``partitions`` by a hash of the keys.  A version is a manifest:
a small JSON file that names, per partition, the folder holding its rows.  A load
that touches k of N partitions reads and writes those k and refers to the
other N - k folders as they are; publishing is one file creation, so readers see
the old manifest or the new one.  The partition count is the table's own, kept
in the manifest.

Only the partition numbers of a batch (at most N) come to the driver.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import qcol
from ..session import fs_for
from .commits import LostUpdate
from .snapshot import stamp

PART = "__qs_part"
_MANIFEST = re.compile(r"^v=(\d+)\.json$")


class PartitionedTable:
    buckets = None

    def __init__(self, spark: SparkSession, name: str, root: str, keys: Sequence[str], partitions: int = 64,
                 label: str | None = None):
        if not keys:
            raise ValueError(f"table {name}: a partitioned table needs its keys")
        self.spark, self.name, self.label, self.root = spark, name, label or name, root.rstrip("/")
        self.keys, self._wanted = list(keys), int(partitions)
        self._seen: list[int | None] = []  # the version that was read last

    # -- versions -----------------------------------------------------------
    def _entries(self, folder: str) -> list[str]:
        fs, path = fs_for(self.spark, f"{self.root}/{folder}")
        return sorted(st.getPath().getName() for st in fs.listStatus(path)) if fs.exists(path) else []

    def versions(self) -> list[int]:
        return sorted(int(m.group(1)) for m in map(_MANIFEST.match, self._entries("_manifests")) if m)

    def exists(self) -> bool:
        return bool(self.versions())

    def manifest(self, version: int | None = None) -> dict:
        """{schema, keys, partitions, folders: {partition: folder}} of a version."""
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"table {self.name} has no published version under {self.root}")
        fs, path = fs_for(self.spark, f"{self.root}/_manifests/v={version or known[-1]:08d}.json")
        stream = fs.open(path)
        try:
            held = json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()
        if held["keys"] != self.keys:
            raise ValueError(f"table {self.name} is keyed by {held['keys']}, not {self.keys}")
        return held

    def current_version(self) -> int | None:
        known = self.versions()
        return known[-1] if known else None

    @property
    def partitions(self) -> int:
        return self.manifest()["partitions"] if self.exists() else self._wanted

    def part(self) -> Column:
        return F.pmod(F.xxhash64(*[qcol(k).cast("string") for k in self.keys]), F.lit(self.partitions)).cast("int")

    # -- reading ------------------------------------------------------------
    def _folders(self, held: dict, only: Sequence[int] | None) -> list[str]:
        folders = held["folders"]
        return [folders[p] for p in (sorted(folders, key=int) if only is None else map(str, only)) if p in folders]

    def read(self, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        if version is None:
            self._seen = [self.current_version()]
        held = self.manifest(version)
        schema = T.StructType.fromJson(held["schema"])
        folders = [f"{self.root}/{f}" for f in self._folders(held, only)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def read_or_empty(self, schema: T.StructType, only: Sequence[int] | None = None) -> DataFrame:
        if self.exists():
            return self.read(only=only)
        self._seen = [None]
        return self.spark.createDataFrame([], schema)

    def progress(self, stream: str) -> int | None:
        """The last micro-batch of ``stream`` whose rows the table has."""
        return self.manifest().get("streams", {}).get(stream) if self.exists() else None

    def touched(self, *batches: DataFrame) -> list[int]:
        """The partitions that hold, or will hold, keys of these batches."""
        rows = None
        for b in batches:
            part = b.select(self.part().alias(PART))
            rows = part if rows is None else rows.unionByName(part)
        return sorted(r[0] for r in rows.distinct().collect())

    # -- writing ------------------------------------------------------------
    def stage(self, df: DataFrame, only: Sequence[int] | None = None, progress: tuple[str, int] | None = None, at=None) -> tuple[str, dict]:  # noqa: ANN001
        """Write the rows of partitions ``only`` (all, if not given) to a fresh
        folder; nothing is visible until :meth:`commit`.  ``progress`` is the
        (stream, micro-batch) that this version holds the rows of, ``at`` the
        time of its load."""
        base = self._seen[0] if self._seen else self.current_version()
        stored = self.manifest(base) if base is not None else {}
        n = stored.get("partitions", self._wanted)
        folder = f"data/{uuid.uuid4().hex}"
        schema = df.schema
        # a partition is one task's unless AQE finds it large and splits it
        (df.withColumn(PART, self.part()).hint("rebalance", F.col(PART)).write.mode("errorifexists").partitionBy(PART)
           .parquet(f"{self.root}/{folder}"))
        held = dict(stored["folders"]) if stored and only is not None else {}
        for p in only or ():
            held.pop(str(p), None)
        for name in self._entries(folder):
            if name.startswith(f"{PART}="):
                held[name.partition("=")[2]] = f"{folder}/{name}"
        streams = {**stored.get("streams", {}), **({progress[0]: progress[1]} if progress else {})}
        return folder, {"schema": json.loads(schema.json()), "keys": self.keys, "partitions": n, "folders": held, "base": base, "streams": streams, **({"at": stamp(at)} if at is not None else {})}

    def commit(self, staged: tuple[str, dict]) -> int:
        base = staged[1]["base"]
        if self.current_version() != base:
            raise LostUpdate(f"table {self.name}: version {self.current_version()} was published by another writer (this load read {base})")
        version = (base or 0) + 1
        fs, path = fs_for(self.spark, f"{self.root}/_manifests/v={version:08d}.json")
        draft = path.suffix(f".{uuid.uuid4().hex}.tmp")
        stream = fs.create(draft, False)
        stream.write(bytearray(json.dumps(staged[1]).encode("utf-8")))
        stream.close()
        if fs.exists(path) or not fs.rename(draft, path):
            raise LostUpdate(f"table {self.name}: version {version} was published by another writer")
        self._seen = [version]
        return version

    def publish(self, df: DataFrame, only: Sequence[int] | None = None, progress: tuple[str, int] | None = None) -> int:
        return self.commit(self.stage(df, only, progress))

    def drop_old_versions(self, keep: int = 1) -> list[int]:
        """Forget all but the last ``keep`` versions and delete the folders that
        none of those refers to; what the current version uses always stays."""
        known = self.versions()
        kept, gone = known[-max(1, keep):], known[: -max(1, keep)]
        used = {f for v in kept for f in self.manifest(v)["folders"].values()}
        old = {f for v in gone for f in self.manifest(v)["folders"].values()} - used
        for f in [*sorted(old), *[f"_manifests/v={v:08d}.json" for v in gone]]:
            fs, path = fs_for(self.spark, f"{self.root}/{f}")
            fs.delete(path, True)
        return gone
