"""Flag and split rows whose key repeats within a batch.

Plan shape (see ``explain``): a partial+final ``groupBy(keys).count()`` keeps
only the repeated keys, and the batch is joined back to that (small) set.
Compared with ``count(*) OVER (PARTITION BY keys)`` this never sorts a whole
key group inside one task: a key that holds a third of the batch is reduced
map-side to one count per task, and the join back is eligible for AQE's
runtime broadcast (the set of repeated keys is measured, not assumed) or for
AQE's skew-split of the batch side.

Rows with a null key part are never "repeated" (a grouping that drops null
keys).  They skip the join: a per-row spread value is added to the join key
so that they do not all hash into the partition of NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import all_not_null, qcol, require_columns

SPREAD = "__qs_spread"
NULL_SPREAD_BUCKETS = 1024


def _zero_from(key: str):
    # a computed zero, not a literal: a literal would be folded out of the join
    # keys into the join condition, and the spread of null keys would be lost
    return F.least(F.length(qcol(key).cast("string")), F.lit(0)).cast("int")


def flag_repeated(df: DataFrame, keys: Sequence[str], out: str = "is_complex") -> DataFrame:
    """Add boolean ``out``: true when the (non-null) key occurs more than once."""
    keys = list(keys)
    require_columns(df, keys, "key column")
    base = df.drop(out) if out in df.columns else df
    spread = F.when(all_not_null(keys), F.lit(0)).otherwise(
        F.pmod(F.monotonically_increasing_id(), F.lit(NULL_SPREAD_BUCKETS)).cast("int"))
    left = base.withColumn(SPREAD, spread)
    # grouped on (keys, zero) so the counts come out partitioned as the join needs
    right = (base.where(all_not_null(keys))
                 .groupBy(*[qcol(k) for k in keys], _zero_from(keys[0]).alias(SPREAD))
                 .agg(F.count(F.lit(1)).alias("__qs_n"))
                 .where(F.col("__qs_n") > 1)
                 .select(*[qcol(k) for k in keys], F.col(SPREAD), F.lit(True).alias(out)))
    joined = left.join(right, on=[*keys, SPREAD], how="left")
    return joined.select(*[qcol(c) for c in base.columns],
                         F.coalesce(qcol(out), F.lit(False)).alias(out))


def split_repeated(df: DataFrame, keys: Sequence[str], out: str = "is_complex",
                   flagged: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(normal, repeated) halves of a batch; both keep the flag column."""
    f = flagged if flagged is not None else flag_repeated(df, keys, out)
    return f.where(~qcol(out)), f.where(qcol(out))


def split_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``n_rows, n_normal, n_complex`` straight from key-group sizes
    (one partial aggregation, no join)."""
    keys = list(keys)
    g = (df.groupBy(*[qcol(k) for k in keys])
           .agg(F.count(F.lit(1)).alias("n"))
           .withColumn("rep", (F.col("n") > 1) & all_not_null(keys)))
    return g.agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(~F.col("rep"), F.col("n"))), F.lit(0)).cast("bigint").alias("n_normal"),
        F.coalesce(F.sum(F.when(F.col("rep"), F.col("n"))), F.lit(0)).cast("bigint").alias("n_complex"),
    )


def count_flagged(flagged: DataFrame, out: str = "is_complex") -> DataFrame:
    """The same three counts from an already flagged batch."""
    flag: Column = qcol(out)
    return flagged.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_if(~flag).cast("bigint").alias("n_normal"),
        F.count_if(flag).cast("bigint").alias("n_complex"),
    )
