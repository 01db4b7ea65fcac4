"""Files arriving continuously → keyed table, exactly once per file.

``stream_upsert`` is Structured Streaming: the file source hands each
micro-batch of new files to ``foreachBatch``, which upserts it into a
versioned table and publishes the version.  The stream checkpoint records
which files were consumed; the version that a micro-batch writes keeps its
number, so one that is run again after a failure is recognised and left out
(the upsert is guarded by an order column besides).  Each micro-batch reads the
target from its last published files, so lineage does not grow across batches.

``stream_journal`` streams the manifest of a folder into the journal load, by
either strategy (upsert, replace).  The file source sees a path once, so it knows
neither a file that still grows nor a second upload under one name;
:mod:`quayside.streaming.arrivals` does.

``run_once`` is the polling alternative: one tick of the journal flow with a
ledger of handled files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tokens import SOURCE_FILE
from ..operators.merge import target_schema_for, upsert
from ..plans.flows import FlowResult, load_replace, load_upsert, prepare_batch, run_journal, small_enough
from ..sinks.snapshot import VersionedTable
from ..sources.delimited import read_delimited
from ..spec import TableSpec


def stream_checkpoint(spark: SparkSession, target: VersionedTable, checkpoint: str | None) -> str:
    """Where a stream keeps its progress: what the caller names, else a folder
    beside the target's versions, the same at each call, so that the stream
    resumes."""
    return (checkpoint or f"{target.root}/_stream").rstrip("/")


def stream_name(checkpoint: str) -> str:
    """A stream is known to its targets by where it keeps its progress."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:24]


def done_before(target, stream: str, epoch: int) -> bool:
    """Whether the target already has the rows of this micro-batch."""
    last = target.progress(stream)
    return last is not None and last >= epoch


def load_files(spark: SparkSession, spec: TableSpec, paths: Sequence[str], target: VersionedTable, now,
               required: Sequence[str] = (), progress: tuple[str, int] | None = None, also: Sequence[tuple] = ()) -> DataFrame:
    """Files, in this order, into the table by the spec's strategy, in one
    version.  An upserted row keeps the name of the file that wrote it, and a row
    of a lesser name never overwrites it, unless that file is uploaded again in
    the same load: then the stored row is of a form that is no more, and the key
    may have moved to another file."""
    raw = read_delimited(spark, paths, spec.delimiter, spec.encoding, spec.multiline,
                         require=[(src, dst) for src, dst in spec.mapping], with_source=True)
    load = prepare_batch(raw, spec, required)
    if spec.strategy == "replace":
        return load_replace(spark, load, spec.keys, target, now, progress=progress, also=also)
    again = F.col(SOURCE_FILE).isin([p.rsplit("/", 1)[-1] for p in paths])
    return load_upsert(spark, load, spec.keys, target, now, guard_cols=[SOURCE_FILE], progress=progress, also=also, gives_way=again)


def stream_upsert(spark: SparkSession, source_dir: str, schema: T.StructType, target: VersionedTable,
                  keys: Sequence[str], order_cols: Sequence[str], now, file_format: str = "parquet",
                  max_files_per_trigger: int = 1, checkpoint: str | None = None,
                  available_now: bool = True, options: dict | None = None):
    """Run (or start, with ``available_now=False``) the ingest stream."""
    keys, order_cols = list(keys), list(order_cols)
    checkpoint = stream_checkpoint(spark, target, checkpoint)
    stream_id = stream_name(checkpoint)
    reader = spark.readStream.schema(schema).format(file_format).option(
        "maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    stream = reader.load(source_dir)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        if done_before(target, stream_id, epoch_id):
            return
        batch = batch.persist()
        try:
            n = batch.count()
            if n == 0:
                return
            current = target.read_or_empty(target_schema_for(batch, audit=True))
            target.publish(upsert(current, batch, keys, now, order_cols=order_cols, guard_cols=order_cols,
                                  broadcast_batch=small_enough(batch, target)), progress=(stream_id, epoch_id))
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.start()


def stream_journal(spark: SparkSession, spec: TableSpec, landing: str, target: VersionedTable, now,
                   required: Sequence[str] = (), max_files_per_trigger: int = 1, checkpoint: str | None = None,
                   available_now: bool = True, archive_dir: str | None = None):
    """The journal flow as a stream: the *manifest* is streamed (``binaryFile``
    without its content, so no bytes are read by the stream itself), and each
    micro-batch reads its new files with the delimited reader (a CSV stream
    would need one fixed schema up front, but every file brings its own
    header).  The order of files is that of their names, as in the batch load,
    however many a trigger takes: each stored row keeps the name of the file
    that wrote it (the table's own column ``_source_file``, which batch loads
    write too, so one table takes both), and a row of a lesser name never
    overwrites it.  With strategy "replace" the rows of a key are those of the last
    file that has it, in the order of arrival.  A micro-batch that is run again is
    recognised by its number.  With ``archive_dir`` the file
    source moves consumed files there (``cleanSource=archive``; Spark does it
    lazily, after the batch is committed)."""
    from ..functions.globs import glob_match

    if spec.strategy == "split":
        raise ValueError(f"{spec.table_name}: strategy 'split' loads two tables; use run_claims_files")
    checkpoint = stream_checkpoint(spark, target, checkpoint)
    stream_id = stream_name(checkpoint)
    schema = T.StructType([T.StructField("path", T.StringType(), False),
                           T.StructField("modificationTime", T.TimestampType(), False),
                           T.StructField("length", T.LongType(), False),
                           T.StructField("content", T.BinaryType(), True)])
    reader = (spark.readStream.format("binaryFile").schema(schema)
              .option("maxFilesPerTrigger", str(max_files_per_trigger)))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    files = (reader.load(landing)
             .select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"),
                     F.col("modificationTime").alias("mtime"), "length"))
    files = files.where(glob_match("name", spec.name_pattern))

    def apply(batch: DataFrame, epoch_id: int) -> None:
        paths = [r["path"] for r in batch.select("path", "name").orderBy("name").collect()]
        if paths and not done_before(target, stream_id, epoch_id):
            load_files(spark, spec, paths, target, now, required, (stream_id, epoch_id))

    writer = files.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.start()


def run_once(spark: SparkSession, spec: TableSpec, landing: str, target: VersionedTable, ledger: VersionedTable,
             as_of, now, required: Sequence[str] | None = None, min_age_seconds: float = 60,
             archive_dir: str | None = None) -> FlowResult:
    """One polling tick: files already in the ledger (same name, mtime and
    length) are skipped, the rest are loaded and appended to the ledger: valid
    files as SUCCESS or FAILURE, files that match no pattern once as QUARANTINED.
    Young files are left alone; an empty folder skips the tick.
    With ``archive_dir``, files whose load succeeded on an earlier tick are
    moved there (files never read are never moved)."""
    from pyspark.sql import functions as F

    from ..sinks.files import archive_files
    from ..sinks.report import skipped_report
    from ..sources.files import LEDGER_SCHEMA, classify_files, discover_files, plan_file_actions

    known = ledger.read_or_empty(LEDGER_SCHEMA)
    run_key = f"{spec.table_name}-{now}"
    skipped = FlowResult(target.count().select(F.lit(target.label).alias("table_name"), F.lit("skipped").alias("status"),
                                               "final_count") if target.exists()
                         else skipped_report(spark, target.label, None), None, [])
    try:
        manifest = discover_files(spark, landing)
    except FileNotFoundError:   # nothing has landed, or all of it is archived
        return skipped
    # the ledger's files drop out in Spark, junk is set aside once, young files
    # wait; only what this tick must act on comes back
    states = classify_files(manifest, spec.name_pattern, as_of, min_age_seconds).where("state <> 'young'")
    wanted = ["launch", "relaunch", *(["retire"] if archive_dir else [])]
    actions = plan_file_actions(states, known).where(F.col("action").isin(wanted)).select(
        "path", "name", "mtime", "length", "state", "action").collect()
    if archive_dir:
        archive_files(spark, [r["path"] for r in actions if r["action"] == "retire"], archive_dir)
    junk = [r for r in actions if r["state"] == "invalid"]
    todo = [r for r in actions if r["state"] == "valid" and r["action"] in ("launch", "relaunch")]

    def record(rows, status: str) -> None:
        if rows:
            new = spark.createDataFrame([(r["name"], r["mtime"], r["length"], run_key, status) for r in rows], LEDGER_SCHEMA)
            ledger.publish(ledger.read_or_empty(LEDGER_SCHEMA).unionByName(new))

    record(junk, "QUARANTINED")
    if not todo:
        return skipped
    try:
        result = run_journal(spark, spec, landing, target, as_of, now, required, min_age_seconds,
                             only_paths=[r["path"] for r in todo], ledger=ledger)
    except Exception:
        record(todo, "FAILURE")   # the next tick relaunches these files
        raise
    return result
