"""End-to-end loads users call: journal files → keyed table, claims → split tables.

Each flow builds one lazy plan per target from the scan to the join and runs
it when the new version is written; the only driver-side values are the file
list and the reports.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import any_null, qcol
from ..functions.tokens import SENTINEL, SOURCE_FILE
from ..operators.mapping import drop_audit, fill_missing_required, fill_sentinel, map_strict
from ..operators.merge import POS, bitmap_bits, replace_by_key, target_schema_for, upsert
from ..operators.split import flag_repeated, split_repeated
from ..sinks.commits import commit_together
from ..sinks.jdbc import JdbcTable
from ..sinks.partitioned import PartitionedTable
from ..sinks.report import load_report, skipped_report
from ..sinks.snapshot import VersionedTable
from ..sources.catalog import text_columns
from ..sources.delimited import RECORD, null_tokens, read_delimited, read_delimited_split
from ..sources.files import LEDGER_SCHEMA, classify_files, discover_files, latest_by_name
from ..spec import TableSpec


# A cached batch of at most this many bytes is broadcast into an upsert (its
# size is that of the filled cache, never an estimate).
BROADCAST_BATCH_BYTES = 32 << 20


def small_enough(cached: DataFrame, table: VersionedTable) -> bool:
    """Bucketing and broadcasting are two ways of not shuffling the stored
    table: a bucketed table is joined in place (and rewritten one file per
    bucket), an unbucketed one takes a batch by broadcast whose filled cache
    (call this after the count that fills it) is small in bytes."""
    return not table.buckets and cached_bytes(cached) <= BROADCAST_BATCH_BYTES


def cached_bytes(cached: DataFrame) -> int:
    """Bytes that the filled cache of a persisted frame takes."""
    return int(str(cached._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def touched_rows(table, schema: T.StructType, *batches: DataFrame) -> tuple[DataFrame, dict]:
    """The stored rows that a load of ``batches`` can change, and what to pass to
    the table's write so that the rest stays as it is."""
    if isinstance(table, PartitionedTable):
        only = table.touched(*batches)
        return table.read_or_empty(schema, only), {"only": only}
    return table.read_or_empty(schema), {}


@dataclass
class FlowResult:
    report: DataFrame           # table_name, status, final_count
    ledger: DataFrame | None    # name, mtime, length, run_key, run_status of the files handled
    files: list[str]            # the paths read, in apply order


def _mapped(spec: TableSpec) -> list[tuple[str, str]]:
    """Per mapped column, the names a landed header may carry it under."""
    return [(src, dst) for src, dst in spec.mapping]


def prepare_batch(df: DataFrame, spec: TableSpec, required: Sequence[str] = ()) -> DataFrame:
    """Reader output → the rows a loader applies: NA tokens → NULL, strict
    mapping (``_pos`` kept), required columns added, audit columns dropped."""
    df = null_tokens(df)
    kept = [(c, c) for c in (POS, SOURCE_FILE) if c in df.columns]
    df = map_strict(df, list(spec.mapping) + kept)
    df = fill_missing_required(df, required)
    return drop_audit(df)


def load_replace(spark: SparkSession, batch: DataFrame, spec_keys: Sequence[str], target: VersionedTable,
                 now, progress: tuple[str, int] | None = None, also: Sequence[tuple] = ()) -> DataFrame:
    """fill → each key's rows of its last file only → replace by key → publish
    → report: what one replace per file, in file order, leaves.  ``progress``
    and ``also`` as in :func:`load_upsert`."""
    batch = persisted(last_file_of_key(fill_sentinel(batch), spec_keys))
    try:
        if batch.isEmpty():
            commit_together(also)
            return skipped_report(spark, target.label, target.read() if target.exists() else None)
        if isinstance(target, JdbcTable):
            target.apply(batch.drop(SOURCE_FILE), spec_keys, "replace")
            commit_together(also)
            return load_report(target.label, target.read())
        current, rest = touched_rows(target, target_schema_for(batch), batch)
        staged = target.stage(replace_by_key(current, batch, spec_keys, now, bucketed=bool(target.buckets)), progress=progress, at=now, **rest)
        commit_together([(target, staged), *also])
    finally:
        batch.unpersist()
    return load_report(target.label, target.read())


def last_file_of_key(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that stand in the last file (by ``_pos.file``) that has their
    key: a partial aggregate and a join on (keys, file)."""
    keys = list(keys)
    if POS not in batch.columns:
        return batch
    rows = batch.withColumn("__qs_file", F.col(POS)["file"])
    last = rows.groupBy(*[qcol(k) for k in keys]).agg(F.max("__qs_file").alias("__qs_file"))
    return rows.join(last, [*keys, "__qs_file"]).select(*[qcol(c) for c in batch.columns])


def load_upsert(spark: SparkSession, batch: DataFrame, spec_keys: Sequence[str], target: VersionedTable | JdbcTable,
                now, keep_stored: Sequence[str] = (), guard_cols: Sequence[str] = (), progress: tuple[str, int] | None = None,
                also: Sequence[tuple] = (), gives_way: Column | None = None) -> DataFrame:
    """fill → last-row-wins → upsert → publish → report.  ``keep_stored``:
    required columns the files lack that a match must leave unchanged (new
    rows still get ``-``).  ``progress``: the (stream, micro-batch) that the batch
    is.  ``also``: staged versions of other tables to commit with this one.
    ``gives_way``: stored rows that ``guard_cols`` do not keep (see upsert)."""
    # one pass reads the files, fills the cache and counts: the count decides
    # "skipped" and proves (or not) that the batch is small enough to broadcast
    batch = persisted(fill_sentinel(batch))
    try:
        n = batch.count()
        if n == 0:
            commit_together(also)
            return skipped_report(spark, target.label, target.read() if target.exists() else None)
        if isinstance(target, JdbcTable):
            target.apply(batch.drop(SOURCE_FILE), spec_keys, "upsert")
            commit_together(also)
            return load_report(target.label, target.read())
        current, rest = touched_rows(target, target_schema_for(fill_missing_required(batch, keep_stored)), batch)
        defaults = {c: SENTINEL for c in keep_stored}
        small = small_enough(batch, target)
        staged = target.stage(upsert(current, batch, spec_keys, now, insert_defaults=defaults or None, guard_cols=guard_cols, gives_way=gives_way,
                                     broadcast_batch=small, bitmap=None if small or target.buckets else bitmap_bits(n)), progress=progress, at=now, **rest)
        commit_together([(target, staged), *also])
    finally:
        batch.unpersist()
    return load_report(target.label, target.read())


def run_journal(spark: SparkSession, spec: TableSpec, landing: str, target: VersionedTable | JdbcTable, as_of, now,
                required: Sequence[str] | None = None, min_age_seconds: float = 60,
                latest_only: bool = False, only_paths: Sequence[str] | None = None,
                overwrite_missing: bool = True, on_bad: str = "error",
                quarantine: VersionedTable | None = None, ledger: VersionedTable | None = None) -> FlowResult:
    """One tick of the journal load: discover → classify → read every valid
    file in name order (or only the latest, as the reference picks) →
    prepare → upsert → publish → report + ledger rows for the files read.

    ``required`` defaults to the target's text columns (if it exists).  A
    required column the files lack is written as ``-``; as in the reference
    it overwrites the stored value on a match, unless ``overwrite_missing``
    is false.  A bad row (more fields than the header, a byte the code page
    leaves undefined) fails the load (``on_bad="error"``, as the reference)
    or, with ``on_bad="quarantine"``, is appended to ``quarantine`` (reason
    and fields) while the good rows load.  The files are appended to ``ledger``,
    if given.  Tables that share a commit log become visible together."""
    if spec.strategy == "split":
        raise ValueError(f"{spec.table_name}: strategy 'split' loads two tables; use run_claims_files")
    manifest = discover_files(spark, landing)
    classified = classify_files(manifest, spec.name_pattern, as_of, min_age_seconds)
    valid = classified.where(F.col("state") == "valid")
    if only_paths is not None:
        valid = valid.join(spark.createDataFrame([(p,) for p in only_paths], "path string"), "path", "left_semi")
    if latest_only:
        valid = latest_by_name(valid, extra=["path", "mtime", "length"])
    # the file list (not data) comes to the driver: it names the scan
    files = valid.select("path", "name", "mtime", "length").orderBy("name").collect()
    if not files:
        return FlowResult(skipped_report(spark, target.label, target.read() if target.exists() else None),
                          None, [])
    paths = [r["path"] for r in files]
    bad = None
    if on_bad == "quarantine":
        raw, bad = read_delimited_split(spark, paths, spec.delimiter, spec.encoding, spec.multiline,
                                        require=_mapped(spec), with_source=True)
        bad = bad.drop(SOURCE_FILE) if quarantine is not None else None
    else:
        raw = read_delimited(spark, paths, spec.delimiter, spec.encoding, spec.multiline,
                             require=_mapped(spec), with_source=True)
    if required is None:
        # of the stored table itself, whatever this session's catalog knows
        required = [c for c in text_columns(target.read().schema) if c != SOURCE_FILE] if target.exists() else []
    if overwrite_missing:
        batch, keep = prepare_batch(raw, spec, required), []
    else:
        batch = prepare_batch(raw, spec, [])
        keep = [c for c in required if c not in batch.columns]
    handled = _handled(spark, spec, files, now)
    also = _with_load(spark, bad, quarantine, handled, ledger, now)
    if spec.strategy == "replace":
        report = load_replace(spark, batch, spec.keys, target, now, also=also)
    else:
        report = load_upsert(spark, batch, spec.keys, target, now, keep_stored=keep, also=also)
    return FlowResult(report, handled, paths)


def _handled(spark: SparkSession, spec: TableSpec, files: Sequence, now) -> DataFrame:
    """Ledger rows of the files that a load has read."""
    run_key = f"{spec.table_name}-{_stamp(now)}"
    return spark.createDataFrame([(r["name"], r["mtime"], r["length"], run_key, "SUCCESS") for r in files], LEDGER_SCHEMA)


def _with_load(spark: SparkSession, bad: DataFrame | None, quarantine: VersionedTable | None, handled: DataFrame,
               ledger: VersionedTable | None, now) -> list[tuple]:
    """The bad rows and the files handled, written but not visible: they are
    committed with the load's own tables."""
    out = []
    if bad is not None:
        out.append((quarantine, _quarantined(bad, quarantine, now)))
    if ledger is not None:
        out.append((ledger, ledger.stage(ledger.read_or_empty(LEDGER_SCHEMA).unionByName(handled))))
    return out


QUARANTINE_SCHEMA = T.StructType([
    T.StructField("bad_reason", T.StringType(), True),
    T.StructField("fields", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("record", T.StringType(), True),
    T.StructField("quarantined_at", T.TimestampType(), True),
])


def _quarantined(bad: DataFrame, table: VersionedTable, now):  # noqa: ANN202
    """Bad rows appended as (reason, mapped fields, the whole record as it
    stood), one schema whatever the layout; written, to be committed with the
    load, so that a load that fails and is tried again quarantines its rows once."""
    data = [c for c in bad.columns if c not in (POS, "bad_reason", RECORD)]
    stamp = F.lit(now.isoformat(sep=" ") if hasattr(now, "isoformat") else str(now)).cast("timestamp")
    rows = bad.select(F.col("bad_reason"),
                      F.create_map(*[x for c in data for x in (F.lit(c), qcol(c))]).alias("fields"),
                      F.col(RECORD).alias("record"), stamp.alias("quarantined_at"))
    return table.stage(table.read_or_empty(QUARANTINE_SCHEMA).unionByName(rows))


def _stamp(now) -> str:
    if isinstance(now, _dt.datetime):
        return now.strftime("%Y%m%d_%H%M%S")
    return str(now).replace(" ", "_").replace(":", "")


def run_claims(spark: SparkSession, batch: DataFrame, keys: Sequence[str], normal: VersionedTable,
               repeated: VersionedTable, now, required: Sequence[str] = (), flag: str = "is_complex",
               stamp_repeated: bool = True, move_between: bool = False, cache_input: bool = False,
               audit: bool = True, by_file: bool = False, also: Sequence[tuple] = ()) -> DataFrame:
    """Claims load: flag repeated keys, upsert the normal rows, replace the
    repeated rows by key.  Both new versions are written before either is
    published; tables that share a commit log (and the staged versions in
    ``also``) become visible together.  Returns the two-row load report.

    Tables are independent by default (as in the reference, a key that was
    normal and is now repeated keeps its old normal row); ``move_between``
    removes a key from the other table when it arrives in this one.

    ``cache_input``: the flag reads its input twice (key counts, then the
    join back); for an expensive input (parsed text) the input is cached
    until the flagged cache is filled, so every file is parsed once.
    ``audit=False``: new tables get no audit columns (the legacy load).
    ``by_file``: the batch is several files, to be applied one after the other
    (``_pos.file`` order): a key is repeated if one file repeats it; of normal
    rows the last wins, of repeated rows those of the last file that repeats
    the key."""
    keys = list(keys)
    batch = drop_audit(fill_missing_required(batch, required, exclude=(flag,)))
    if cache_input:
        batch = persisted(batch)
    if by_file:
        per_file = flag_repeated(batch.withColumn("__qs_file", F.col(POS)["file"]), [*keys, "__qs_file"], flag)
        flagged = persisted(per_file.drop("__qs_file"))
    else:
        flagged = persisted(flag_repeated(batch, keys, flag))
    try:
        # one pass: the split counts, and the cache filled for both writes.  The
        # normal half of one file has unique keys, except rows with a NULL key part,
        # which collide with each other, and with a literal "-", once filled
        counts = flagged.agg(F.count_if(~qcol(flag)).alias("n_normal"), F.count_if(qcol(flag)).alias("n_complex"),
                             F.count_if(any_null(keys)).alias("n_null_keys")).first()
        if cache_input:
            batch.unpersist()
        sizes = {"upsert": counts["n_normal"], "replace": counts["n_complex"]}
        dedupe_normal = by_file or counts["n_null_keys"] > 0
        normal_b, repeated_b = split_repeated(batch, keys, flag, flagged=flagged)
        normal_b, repeated_b = fill_sentinel(normal_b), fill_sentinel(repeated_b)
        if by_file:
            repeated_b = last_file_of_key(repeated_b, keys)
        tschema = target_schema_for(normal_b, audit=audit)
        small = {table.label: small_enough(flagged, table) for table in (normal, repeated)}
        staged, reports = [], {}
        for table, part, op in ((normal, normal_b, "upsert"), (repeated, repeated_b, "replace")):
            if not sizes[op]:
                reports[table.label] = skipped_report(spark, table.label,
                                                      table.read() if table.exists() else None)
                continue
            other = repeated_b if op == "upsert" else normal_b
            current, rest = touched_rows(table, tschema, *([part, other] if move_between else [part]))
            if move_between:
                current = current.join(other.select(*[qcol(k) for k in keys]).distinct(), keys, "left_anti")
            if op == "upsert":
                # the whole flagged batch is cached, which bounds each half of it: a
                # small one is broadcast and the stored table is not shuffled
                new = upsert(current, part, keys, now, broadcast_batch=small[table.label], dedupe=dedupe_normal)
            else:
                new = replace_by_key(current, part, keys, now, stamp=stamp_repeated,
                                     broadcast_batch=small[table.label], bucketed=bool(table.buckets))
            staged.append((table, table.stage(new, at=now, **rest)))
        commit_together([*staged, *also])
        for table, _ in staged:
            reports[table.label] = load_report(table.label, table.read())
    finally:
        flagged.unpersist()
    out = [reports[t.label] for t in (normal, repeated)]
    return out[0].unionByName(out[1])


def persisted(df: DataFrame) -> DataFrame:
    """Keep a frame used by two writes (recomputable from lineage on loss)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def run_routed_claims(spark: SparkSession, specs: Sequence[TableSpec], registered: Sequence[str], landing: str,
                      normal: VersionedTable, repeated: VersionedTable, required: Sequence[str],
                      flag: str = "is_complex") -> tuple[str, DataFrame]:
    """Legacy claims load: route the landed files to the first registered spec
    (config order) that has a file, read its greatest-named file, map it
    strictly, add the fixed list of required columns, then flag/split and
    load without audit stamps.  Returns (spec name, report)."""
    from ..sources.files import route_files

    manifest = discover_files(spark, landing)
    allowed = set(registered)
    routes = [(s.table_name, s.name_pattern, s.table_name in allowed) for s in specs]
    hit = route_files(manifest, routes).collect()  # one row: the winning route
    if not hit:
        raise FileNotFoundError(f"no landed file matches a registered spec in {landing}")
    spec = next(s for s in specs if s.table_name == hit[0]["table_name"])
    raw = read_delimited(spark, [hit[0]["path"]], spec.delimiter, spec.encoding, spec.multiline,
                         require=_mapped(spec))
    batch = prepare_batch(raw, spec, [c for c in required if c != flag])
    report = run_claims(spark, batch, spec.keys, normal, repeated, now=None, flag=flag, stamp_repeated=False,
                        cache_input=True, audit=False)
    return spec.table_name, report


def run_claims_files(spark: SparkSession, spec: TableSpec, landing: str, normal: VersionedTable,
                     repeated: VersionedTable, as_of, now, required: Sequence[str] = (),
                     min_age_seconds: float = 60, latest_only: bool = False, on_bad: str = "error",
                     quarantine: VersionedTable | None = None, ledger: VersionedTable | None = None) -> FlowResult:
    """Claims from landed files: discover → classify → read (name order) →
    prepare → :func:`run_claims`, with the result of applying the files one
    after the other.  Bad rows and the files handled are committed with the
    load (in one record, if the tables share a commit log)."""
    manifest = discover_files(spark, landing)
    valid = classify_files(manifest, spec.name_pattern, as_of, min_age_seconds).where(F.col("state") == "valid")
    if latest_only:
        valid = latest_by_name(valid, extra=["path", "mtime", "length"])
    files = valid.select("path", "name", "mtime", "length").orderBy("name").collect()
    if not files:
        empty = [skipped_report(spark, t.label, t.read() if t.exists() else None) for t in (normal, repeated)]
        return FlowResult(empty[0].unionByName(empty[1]), None, [])
    paths = [r["path"] for r in files]
    bad = None
    if on_bad == "quarantine":
        raw, bad = read_delimited_split(spark, paths, spec.delimiter, spec.encoding, spec.multiline,
                                        require=_mapped(spec))
        bad = bad if quarantine is not None else None
    else:
        raw = read_delimited(spark, paths, spec.delimiter, spec.encoding, spec.multiline,
                             require=_mapped(spec))
    batch = prepare_batch(raw, spec, [c for c in required if c != "is_complex"])
    handled = _handled(spark, spec, files, now)
    report = run_claims(spark, batch, spec.keys, normal, repeated, now, cache_input=True, by_file=len(files) > 1,
                        also=_with_load(spark, bad, quarantine, handled, ledger, now))
    return FlowResult(report, handled, paths)
