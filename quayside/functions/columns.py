"""Column-name helpers: headers may contain dots, spaces and brackets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def qcol(name: str) -> Column:
    """A column by its literal name (backticks so dots are not struct access)."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_not_null(names: Iterable[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & qcol(n).isNotNull()
    return cond


def any_null(names: Iterable[str]) -> Column:
    return ~all_not_null(names)


def require_columns(df: DataFrame, names: Iterable[str], what: str = "column") -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing {what}(s): {', '.join(missing)}")
