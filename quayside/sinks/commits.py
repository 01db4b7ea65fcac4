"""One commit for several tables.

A :class:`CommitLog` is a folder of small records, ``c=<n>.json``, each naming the
version of every table that it knows.  Tables that share a log are visible at the
versions of the last record only: the tables of a load (normal, repeated, bad
rows, files handled) are written first, each into its next version folder, and
become visible together with the creation of one file.  A load that stops before
that shows none of them.

A commit is refused if one of its tables was committed by another writer since
the load read it.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ..session import fs_for

_RECORD = re.compile(r"^c=(\d+)\.json$")


class LostUpdate(OSError):
    """Another writer committed since this load read the table."""


class CommitLog:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _numbers(self) -> list[int]:
        fs, path = fs_for(self.spark, self.root)
        names = [st.getPath().getName() for st in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(m.group(1)) for m in map(_RECORD.match, names) if m)

    def _read(self, number: int) -> dict[str, list[int]]:
        fs, path = fs_for(self.spark, f"{self.root}/c={number:08d}.json")
        stream = fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()

    def tables(self) -> dict[str, list[int]]:
        """Per table its committed versions, oldest first."""
        numbers = self._numbers()
        return self._read(numbers[-1]) if numbers else {}

    def versions(self, table: str) -> list[int]:
        return self.tables().get(table, [])

    def forget(self, table: str, versions: Sequence[int]) -> None:
        """Leave versions out from here on (their data is about to be deleted)."""
        gone = set(versions)
        self._append(lambda held: held | {table: [v for v in held.get(table, []) if v not in gone]})

    def commit(self, versions: dict[str, int], base: dict[str, int | None]) -> int:
        """Make ``versions`` the current ones, unless a table of them is not at
        its ``base`` version any more."""
        def step(held: dict[str, list[int]]) -> dict[str, list[int]]:
            for name, known in base.items():
                now = held.get(name, [])
                if (now[-1] if now else None) != known:
                    raise LostUpdate(f"table {name}: version {now[-1] if now else None} was committed by another writer (this load read {known})")
            return held | {name: [*held.get(name, []), v] for name, v in versions.items()}

        return self._append(step)

    def _append(self, step) -> int:  # noqa: ANN001
        while True:
            numbers = self._numbers()
            held = step(self._read(numbers[-1]) if numbers else {})
            number = (numbers[-1] if numbers else 0) + 1
            fs, path = fs_for(self.spark, f"{self.root}/c={number:08d}.json")
            draft = path.suffix(f".{uuid.uuid4().hex}.tmp")
            stream = fs.create(draft, False)
            stream.write(bytearray(json.dumps(held).encode("utf-8")))
            stream.close()
            if not fs.exists(path) and fs.rename(draft, path):
                return number
            fs.delete(draft, False)  # a writer of other tables was first: look again


def commit_together(staged: Sequence[tuple]) -> None:
    """Commit (table, staged version) pairs: in one record, if the tables share a
    log, else one after the other."""
    logs = {id(t.log): t.log for t, _ in staged if getattr(t, "log", None) is not None}
    if len(logs) == 1 and all(getattr(t, "log", None) is not None for t, _ in staged):
        (log,) = logs.values()
        for table, st in staged:
            table.mark(st)
        log.commit({t.name: st.version for t, st in staged}, {t.name: st.base for t, st in staged})
        for table, st in staged:
            table.show(st)
        return
    for table, st in staged:
        table.commit(st)
