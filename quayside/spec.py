"""Table specs: how a landed file maps onto a keyed target table.

The JSON layout accepted by :func:`load_specs` is the one journal exports are
described with::

    {"tables": {"<table>": {"file": {"file_pattern": "Справки*", "file_format": "csv"},
                            "mapping_fields": {"<source header>": "<target column>", ...},
                            "column_check": ["<key>", ...],
                            "encoding": "cp1251", "delimiter": ";"}}}

Specs are loaded once on the driver; operators take plain arguments.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any


@dataclass(frozen=True)
class TableSpec:
    table_name: str
    file_pattern: str
    mapping: tuple[tuple[str, str], ...]
    keys: tuple[str, ...]
    file_format: str = "csv"
    encoding: str = "utf-8"
    delimiter: str = ","
    strategy: str = "upsert"          # "upsert" | "replace" (run_journal) | "split" (run_claims_files)
    multiline: bool | str = "auto"    # True: parse files whole; False: split by lines

    @property
    def name_pattern(self) -> str:
        """The full file-name pattern: ``<file_pattern>.<file_format>``."""
        return f"{self.file_pattern}.{self.file_format}" if self.file_format else self.file_pattern

    @property
    def mapping_dict(self) -> dict[str, str]:
        return dict(self.mapping)

    @property
    def targets(self) -> list[str]:
        return [t for _, t in self.mapping]

    def validate(self) -> "TableSpec":
        targets = self.targets
        if len(set(targets)) != len(targets):
            raise ValueError(f"{self.table_name}: a target column is mapped twice")
        if not self.keys:
            raise ValueError(f"{self.table_name}: no key columns (column_check)")
        missing = [k for k in self.keys if k not in targets]
        if missing:
            raise ValueError(f"{self.table_name}: key column(s) not mapped: {missing}")
        if self.strategy not in ("upsert", "replace", "split"):
            raise ValueError(f"{self.table_name}: unknown strategy {self.strategy!r}")
        return self


def spec_from_dict(name: str, entry: dict[str, Any], **overrides: Any) -> TableSpec:
    file = entry.get("file", {})
    spec = TableSpec(
        table_name=name,
        file_pattern=file.get("file_pattern", "*"),
        file_format=file.get("file_format", "csv"),
        mapping=tuple((str(s), str(t)) for s, t in entry.get("mapping_fields", {}).items()),
        keys=tuple(entry.get("column_check", [])),
        encoding=entry.get("encoding", "utf-8"),
        delimiter=entry.get("delimiter", ","),
        **{k: v for k, v in entry.items() if k in ("strategy", "multiline")},
    )
    if overrides:
        spec = TableSpec(**{**spec.__dict__, **overrides})
    return spec.validate()


def load_specs(source: str | dict[str, Any]) -> dict[str, TableSpec]:
    """Specs in file order (order matters for routing: first match wins)."""
    if isinstance(source, str):
        with open(source, encoding="utf-8") as fh:
            source = json.load(fh)
    tables = source.get("tables", {})
    if not tables:
        raise ValueError("mapping has no tables")
    return {name: spec_from_dict(name, entry) for name, entry in tables.items()}
