"""Keyed writes as set operations: last-row-wins, upsert, replace-by-key.

The reference applies one SQL statement per row.  Here each is one join:

* ``dedupe_last``  – ``groupBy(keys).agg(max(struct(order, row)))``: a partial
  aggregate, so a hot key is reduced map-side and never gathered into one
  task; deterministic on ties (the whole row breaks them).
* ``upsert``       – ``target FULL OUTER JOIN batch USING (keys)`` with a
  batch-presence flag choosing per column (a NULL in the batch still wins).
  Batch keys are unique after ``dedupe_last`` and target keys are unique by
  construction, so the join has no skew.  The dedupe and the join hash on the
  same keys: the batch side is shuffled once.
* ``replace_by_key`` – ``target LEFT ANTI JOIN distinct(batch keys)`` then
  ``UNION ALL batch``.  The distinct keys are measured at run time by AQE
  (broadcast when small, shuffled otherwise); the target is never
  re-grouped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import qcol, require_columns
from ..functions.tokens import AUDIT_COLUMNS, SOURCE_FILE
from .mapping import drop_audit

POS = "_pos"
PRESENT = "__qs_present"
BPFX = "__qs_b_"
HASHED = "__qs_hash"


def dedupe_last(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one with the greatest ``order_cols`` (file order
    captured at read, so "last row wins").  Without ``order_cols`` the
    ``_pos`` column is used when present, else the greatest row."""
    keys = list(keys)
    require_columns(df, keys, "key column")
    if order_cols is None:
        order_cols = [POS] if POS in df.columns else []
    order_cols = list(order_cols)
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*[qcol(k) for k in keys]).distinct()
    parts = [qcol(c).alias(f"o{i}") for i, c in enumerate(order_cols)]
    row = F.struct(*[qcol(c).alias(c) for c in payload]).alias("row")
    best = F.max(F.struct(*parts, row)).alias("__qs_best")
    g = df.groupBy(*[qcol(k) for k in keys]).agg(best)
    cols = {k: qcol(k) for k in keys}
    for c in payload:
        cols[c] = F.col("__qs_best").getField("row").getField(c).alias(c)
    return g.select(*[cols[c].alias(c) if c in keys else cols[c] for c in df.columns])


def _now_literal(now, dtype: T.DataType | None) -> Column:
    if now is None:
        raise ValueError("pass `now` explicitly (a timestamp or its text); results must repeat")
    lit = F.lit(now.isoformat(sep=" ") if hasattr(now, "isoformat") and hasattr(now, "hour") else now)
    return lit.cast(dtype) if dtype is not None else lit.cast("timestamp")


def target_schema_for(batch: DataFrame, audit: bool = True) -> T.StructType:
    fields = [f for f in drop_audit(batch).schema.fields if f.name != POS]
    if audit:
        fields += [T.StructField(a, T.TimestampType(), True) for a in AUDIT_COLUMNS]
    return T.StructType(fields)


def with_bookkeeping(target: DataFrame, batch: DataFrame) -> DataFrame:
    """``target`` with the bookkeeping column that ``batch`` brings: a table
    first loaded without it gets it, NULL for the rows it has."""
    if SOURCE_FILE in batch.columns and SOURCE_FILE not in target.columns:
        audit = [c for c in target.columns if c in AUDIT_COLUMNS]
        rest = [qcol(c) for c in target.columns if c not in audit]
        return target.select(*rest, F.lit(None).cast("string").alias(SOURCE_FILE), *[qcol(c) for c in audit])
    return target


# Most bits of a key bitmap: 2^21 words of 16 bytes, 32 MB as a broadcast relation.
BITMAP_BITS = 1 << 27
# Bits for each batch row: at most one stored row in so many is shuffled for nothing.
BITS_A_ROW = 16


def bitmap_bits(rows: int) -> int | None:
    """Bits of a key bitmap for a batch of ``rows``; None where the largest one
    would not keep most of the stored rows out."""
    bits = 1 << max(10, (BITS_A_ROW * max(1, rows) - 1).bit_length())
    return min(bits, BITMAP_BITS) if rows * 4 <= BITMAP_BITS else None


def divide_by_bitmap(target: DataFrame, batch: DataFrame, keys: Sequence[str], bits: int) -> tuple[DataFrame, DataFrame]:
    """(stored rows whose key's bit is set by a key of the batch, the others).
    The bitmap is a table of words of 64 bits, at most ``bits`` / 64 of them, made by
    a partial aggregate and broadcast under that bound; the stored rows are
    divided where they are scanned."""
    if bits > BITMAP_BITS:
        raise ValueError(f"a key bitmap has at most {BITMAP_BITS} bits")
    types = {f.name: f.dataType for f in target.schema.fields}
    place = F.pmod(F.xxhash64(*[qcol(k).cast(types[k]) for k in keys]), F.lit(bits))
    one = lambda p: F.expr(f"shiftleft(1L, cast({p} % 64 as int))")
    words = batch.select(place.alias("__qs_p")).select(F.floor(F.col("__qs_p") / 64).alias("__qs_w"), one("__qs_p").alias("__qs_m"))
    words = words.groupBy("__qs_w").agg(F.bit_or("__qs_m").alias("__qs_bits"))
    marked = target.withColumn("__qs_p", place).withColumn("__qs_w", F.floor(F.col("__qs_p") / 64))
    marked = marked.join(F.broadcast(words), "__qs_w", "left")
    met = F.coalesce(F.col("__qs_bits").bitwiseAND(one("__qs_p")) != 0, F.lit(False))
    columns = [qcol(c) for c in target.columns]
    return marked.where(met).select(*columns), marked.where(~met).select(*columns)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], now,
           order_cols: Sequence[str] | None = None, touch_updated_at: bool = False,
           dedupe: bool = True, guard_cols: Sequence[str] = (),
           insert_defaults: dict[str, object] | None = None,
           broadcast_batch: bool = False, bitmap: int | None = None, gives_way: Column | None = None) -> DataFrame:
    """``INSERT … ON CONFLICT (keys) DO UPDATE SET <batch non-key columns>`` as
    one full outer join.  Returns the new table content (target schema).

    * matched rows: batch columns overwrite (NULL included), target-only
      columns keep their value, audit stamps stay (``touch_updated_at``
      refreshes ``updated_at``);
    * new rows: batch columns, target-only columns NULL (or their value in
      ``insert_defaults``), both stamps ``now``;
    * target rows without a batch row: unchanged;
    * with ``guard_cols`` a matched row is overwritten only when the batch
      row's guard is not older than the stored one, so replaying an old
      batch (a re-run micro-batch) changes nothing; a stored row for which
      ``gives_way`` (a condition on its columns) holds is overwritten
      whatever its guard is.

    Plan: a full outer join (both sides hashed on the keys; a bucketed target
    is read in place).  When the caller has checked that the batch is small
    (``broadcast_batch``) it is broadcast and the target is never shuffled:
    ``target LEFT JOIN batch`` gives matched and untouched rows in one scan,
    and the new rows are the batch without the target keys that a key-only
    scan finds in it.  A batch too large for that, into a target that is not
    bucketed, can have a key ``bitmap`` of so many bits: stored rows that no key
    of the batch can meet are then not shuffled either.
    """
    keys = list(keys)
    batch = drop_audit(batch)
    target = with_bookkeeping(target, batch)
    require_columns(batch, keys, "key column")
    require_columns(target, keys, "key column")
    extra = [c for c in batch.columns if c not in target.columns and c != POS]
    if extra:
        raise ValueError(f"batch column(s) not in the target: {extra}")
    if dedupe:
        batch = dedupe_last(batch, keys, order_cols)
    batch = batch.drop(POS) if POS in batch.columns else batch
    nonkey = [c for c in batch.columns if c not in keys]
    b = batch.select(*[qcol(k) for k in keys], *[qcol(c).alias(BPFX + c) for c in nonkey],
                     F.lit(True).alias(PRESENT))
    untouched = None
    if bitmap and not broadcast_batch:
        whole = target
        target, untouched = divide_by_bitmap(target, batch, keys, bitmap)
    t = target.withColumn("__qs_t", F.lit(True)) if (guard_cols or insert_defaults or broadcast_batch) else target
    if broadcast_batch:
        names = [qcol(k) for k in keys]
        stored = t.join(F.broadcast(b), on=keys, how="left")
        # target keys found in the batch: no more than the batch has
        found = target.select(*names).join(F.broadcast(b.select(*names)), on=keys, how="left_semi")
        new = b.join(F.broadcast(found), on=keys, how="left_anti")
        joined = stored.unionByName(new, allowMissingColumns=True)
    else:
        joined = t.join(b, on=keys, how="full_outer")
    present = F.coalesce(F.col(PRESENT), F.lit(False))
    if guard_cols:
        newer = (F.struct(*[F.col(BPFX + g) for g in guard_cols])
                 >= F.struct(*[qcol(g) for g in guard_cols]))
        # a stored row without a guard (loaded before there was one) gives way
        unguarded = F.array_min(F.array(*[qcol(g).isNull() for g in guard_cols]))
        if gives_way is not None:
            unguarded = unguarded | F.coalesce(gives_way, F.lit(False))
        present = present & (F.col("__qs_t").isNull() | unguarded | F.coalesce(newer, F.lit(False)))
    in_target = set(nonkey)
    out = []
    for f in target.schema.fields:
        c = f.name
        if c in keys:
            out.append(qcol(c))
        elif c == "created_at":
            out.append(F.coalesce(qcol(c), _now_literal(now, f.dataType)).alias(c))
        elif c == "updated_at":
            stamp = _now_literal(now, f.dataType)
            v = F.coalesce(qcol(c), stamp)
            if touch_updated_at:
                v = F.when(present, stamp).otherwise(qcol(c))
            out.append(v.alias(c))
        elif c in in_target:
            out.append(F.when(present, F.col(BPFX + c)).otherwise(qcol(c)).cast(f.dataType).alias(c))
        elif insert_defaults and c in insert_defaults:
            default = F.lit(insert_defaults[c]).cast(f.dataType)
            out.append(F.when(present & F.col("__qs_t").isNull(), default).otherwise(qcol(c)).alias(c))
        else:
            out.append(qcol(c))
    if untouched is None:
        return joined.select(*out)
    stamps = {f.name: _now_literal(now, f.dataType) for f in whole.schema.fields if f.name in ("created_at", "updated_at")}
    if touch_updated_at:
        stamps.pop("updated_at", None)
    rest = untouched.select(*[F.coalesce(qcol(c), stamps[c]).alias(c) if c in stamps else qcol(c) for c in whole.columns])
    return joined.select(*out).unionByName(rest)


def replace_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str], now=None,
                   stamp: bool = True, broadcast_batch: bool = False, bucketed: bool = False) -> DataFrame:
    """Delete every stored row whose key occurs in the batch, insert all batch
    rows.  New rows get both audit stamps = ``now`` when ``stamp`` and the
    target carries audit columns.  The distinct batch keys are broadcast when
    the caller has checked the batch's size (``broadcast_batch``).  Otherwise the join
    also hashes the keys' own hash, so that both sides get an exchange of their
    own and AQE can split a stored key that holds much of the table; a
    ``bucketed`` target is joined in place instead."""
    keys = list(keys)
    batch = drop_audit(batch)
    batch = batch.drop(POS) if POS in batch.columns else batch
    target = with_bookkeeping(target, batch)
    require_columns(batch, keys, "key column")
    require_columns(target, keys, "key column")
    extra = [c for c in batch.columns if c not in target.columns]
    if extra:
        raise ValueError(f"batch column(s) not in the target: {extra}")
    batch_keys = batch.select(*[qcol(k) for k in keys]).distinct()
    if broadcast_batch or bucketed:
        kept = target.join(F.broadcast(batch_keys) if broadcast_batch else batch_keys, on=keys, how="left_anti")
    else:
        types = {f.name: f.dataType for f in target.schema.fields}
        hashed = F.xxhash64(*[qcol(k).cast(types[k]) for k in keys])
        kept = target.withColumn(HASHED, hashed).join(batch_keys.withColumn(HASHED, hashed), on=[HASHED, *keys],
                                                      how="left_anti").drop(HASHED)
    types = {f.name: f.dataType for f in target.schema.fields}
    add = {}
    for a in AUDIT_COLUMNS:
        if a in types:
            add[a] = _now_literal(now, types[a]) if stamp else F.lit(None).cast(types[a])
    new = batch.withColumns(add) if add else batch
    new = new.select(*[(qcol(c) if c in new.columns else F.lit(None)).cast(types[c]).alias(c)
                       for c in target.columns])
    return kept.select(*[qcol(c) for c in target.columns]).unionByName(new)
