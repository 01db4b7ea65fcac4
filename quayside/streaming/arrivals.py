"""Files that settle before they are loaded, and second uploads, on a stream.

The file source of Structured Streaming sees each path once, when it first shows
up.  Here the stream reads *arrivals*: :func:`record_arrivals` lists the folder
(a manifest table, no bytes read), takes away what the log of arrivals has
(name, mtime, length), and appends the rest to it.  A file that grows and a file
uploaded again are new arrivals of their name; one that did not change is none.

:func:`settled` keeps the arrivals of a name in a session that stays open until
the file is ``min_age`` old: each arrival asks for ``mtime + min_age``, a later one
prolongs the session, and when the watermark has passed its end the last arrival
is handed on.  The state holds the files that have not settled, nothing else.
Each listing writes the time it was made at, so time goes on where no file comes.

:func:`stream_settled` loads what settles, in the order of names, by the spec's
strategy.  A file that changed again in the meantime is left for its next
arrival.  A micro-batch that is run again is recognised by its number.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.globs import glob_match
from ..session import fs_for
from ..sinks.snapshot import VersionedTable
from ..sources.files import FILE_ID, MANIFEST_SCHEMA, discover_files
from ..spec import TableSpec
from .ingest import done_before, load_files, stream_checkpoint, stream_name

#: A row without a path (and with an empty name) is a listing's own time.
ARRIVAL_SCHEMA = T.StructType([T.StructField(f.name, f.dataType, True) for f in MANIFEST_SCHEMA.fields] + [T.StructField("seen_at", T.TimestampType(), True)])


def _time(value) -> _dt.datetime:  # noqa: ANN001
    value = _dt.datetime.fromisoformat(value) if isinstance(value, str) else value
    return value if value.tzinfo else value.replace(tzinfo=_dt.timezone.utc)


def record_arrivals(spark: SparkSession, landing: str, log: str, seen_at) -> None:
    """Append the files that are new in ``landing``, or changed, to the log."""
    at = F.lit(_time(seen_at))
    fs, path = fs_for(spark, landing)
    found = discover_files(spark, landing, require_files=False) if fs.exists(path) else spark.createDataFrame([], MANIFEST_SCHEMA)
    fs, path = fs_for(spark, log)
    if fs.exists(path):
        known = spark.read.schema(ARRIVAL_SCHEMA).parquet(log).where("path is not null").select(*FILE_ID)
        found = found.join(known, list(FILE_ID), "left_anti")
    new = found.select(*[F.col(f.name) for f in MANIFEST_SCHEMA.fields], at.alias("seen_at"))
    # a little later than the arrivals, so that one that is old enough settles with this listing
    tick = spark.range(1).select(*[F.lit("" if f.name == "name" else None).cast(f.dataType).alias(f.name) for f in MANIFEST_SCHEMA.fields], (at + F.expr("interval 2 milliseconds")).alias("seen_at"))
    new.unionByName(tick).write.mode("append").parquet(log)


def settled(arrivals: DataFrame, min_age_seconds: float = 60) -> DataFrame:
    """(name, path, mtime, length) of each file once it has settled, in its last
    form; ``arrivals`` is a stream of :data:`ARRIVAL_SCHEMA` rows."""
    wait = (F.unix_millis("mtime") + F.lit(int(min_age_seconds * 1000)) - F.unix_millis("seen_at"))
    gap = F.concat(F.greatest(F.coalesce(wait, F.lit(1)), F.lit(1)).cast("string"), F.lit(" milliseconds"))
    session = F.session_window("seen_at", gap)
    last = F.max(F.struct("seen_at", "mtime", "length", "path")).alias("last")
    # (a condition on the name would be tested before the watermark and stop the clock)
    return (arrivals.withWatermark("seen_at", "0 seconds").groupBy("name", session).agg(last)
            .where("last.path is not null").select("name", "last.path", "last.mtime", "last.length"))


def stream_settled(spark: SparkSession, spec: TableSpec, landing: str, log: str, target: VersionedTable, now,
                   required: Sequence[str] = (), min_age_seconds: float = 60, checkpoint: str | None = None,
                   available_now: bool = True):
    """Load the files of ``landing`` as they settle; see the module."""
    if spec.strategy == "split":
        raise ValueError(f"{spec.table_name}: strategy 'split' loads two tables; use run_claims_files")
    checkpoint = stream_checkpoint(spark, target, checkpoint)
    stream_id = stream_name(checkpoint)
    arrivals = spark.readStream.schema(ARRIVAL_SCHEMA).parquet(log).where(F.col("path").isNull() | glob_match("name", spec.name_pattern))

    def apply(batch: DataFrame, epoch_id: int) -> None:
        if done_before(target, stream_id, epoch_id):
            return
        ready = batch.select("path", *FILE_ID).distinct()
        if ready.isEmpty():
            return
        now_there = discover_files(spark, landing, require_files=False).select("path", *FILE_ID)
        # the list of files (not their rows) comes to the driver: it names the scan
        paths = [r["path"] for r in ready.join(now_there, ["path", *FILE_ID], "left_semi").orderBy("name").collect()]
        if paths:
            load_files(spark, spec, paths, target, now, required, (stream_id, epoch_id))

    writer = settled(arrivals, min_age_seconds).writeStream.outputMode("append").foreachBatch(apply).option("checkpointLocation", checkpoint)
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.start()
