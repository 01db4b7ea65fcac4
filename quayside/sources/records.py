"""Delimited records that go on over line ends, from files read in splits.

A file's lines come from a splittable text scan.  A line taken by itself does not
say whether it begins a record or stands inside a quoted cell: that depends on
all lines before it.  But a line, and so a block of lines, is a map from the
state before it (outside or inside quotes) to the state after it.  So

1. each split of a file is reduced to its map, in parallel;
2. the maps are composed in file order (one row a split, as many as the scan's
   own plan has on the driver), which gives every split its state at the start;
3. each split then puts its lines together to records.  A record that a split
   border cuts is handed on in pieces, which meet by the split that it began in.

A quote opens a cell only at the cell's start; inside, a doubled quote is a
quote and a single one closes the cell; what follows up to the delimiter is
plain text.  Line ends inside quotes stay as they stand.

The steps work on Arrow batches; a batch without a quote, outside quotes, passes
through as it is.  Files too small for Spark to split skip steps 1 and 2.  The
splits are those of Spark's scan; if they should differ between two scans of one
load (a cluster that grows meanwhile), the load fails and is repeated, it never
reads on with another state.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OUTSIDE, INSIDE = 0, 1
#: Row number of a file's first record, the header.
HEADER = -1
#: A record that is handed on in pieces stands behind all others of its split.
_LAST_ROW = 1 << 62


def text_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(uri, block, row, value): the lines of files, with the start of the split
    that each is read by; rows of a split rise with their place."""
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    return lines.select(F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("row"), "value")


class Quotes:
    """The state after a line, by the state before it."""

    def __init__(self, delimiter: str) -> None:
        sep = re.escape(delimiter.encode())
        cell = rb'(?:"(?:[^"]|"")*+"[^%b]*+|[^"%b][^%b]*+|)' % (sep, sep, sep)
        self.opens = re.compile(rb'(?:%b%b)*+"(?:[^"]|"")*+\Z' % (cell, sep)).match
        self.closes = re.compile(rb'(?:[^"]|"")*+"(?!")[^%b]*+(?:%b|\Z)' % (sep, sep)).match

    def after(self, line: bytes, state: int) -> int:
        if b'"' not in line:
            return state
        at = 0
        if state == INSIDE:
            closed = self.closes(line)
            if closed is None:
                return INSIDE
            at = closed.end()
        return INSIDE if self.opens(line[at:] if at else line) else OUTSIDE


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The runs of rows of one split, keyed by (uri, block)."""
    n = len(batch)
    if not n:
        return
    uri, block = batch.column("uri"), batch.column("block")
    if n == 1 or (uri[0] == uri[n - 1] and block[0] == block[n - 1]):
        # a split is never entered again within a batch
        edges = [0, n]
    else:
        change = pc.or_(pc.not_equal(uri.slice(1), uri.slice(0, n - 1)), pc.not_equal(block.slice(1), block.slice(0, n - 1)))
        edges = [0, *[int(i) + 1 for i in pc.indices_nonzero(change).to_pylist()], n]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        yield (uri[lo].as_py(), block[lo].as_py()), batch.slice(lo, hi - lo)


def _has(values: pa.Array, mark: bytes) -> bool:
    """Whether any of the values holds ``mark``."""
    _, offsets, data = values.buffers()
    if data is None or not len(values):
        return False
    ends = memoryview(offsets).cast("q" if pa.types.is_large_binary(values.type) else "i")
    lo, hi = ends[values.offset], ends[values.offset + len(values)]
    return mark in memoryview(data)[lo:hi].tobytes()


def split_maps(lines: DataFrame, delimiter: str) -> DataFrame:
    """(uri, block, outside, inside, ends): per split of the files the states
    after it that follow from each state before it, and whether a record open
    before it ends in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes = Quotes(delimiter)
        key, now, ends = None, [OUTSIDE, INSIDE], False

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([ends])],
                                              names=["uri", "block", "outside", "inside", "ends"])

        for batch in batches:
            for own, rows in _runs(batch):
                if own != key:
                    if key is not None:
                        yield row()
                    key, now, ends = own, [OUTSIDE, INSIDE], False
                if not _has(rows.column("value"), b'"'):
                    continue
                for line in rows.column("value").to_pylist():
                    if b'"' in line:
                        after = quotes.after(line, now[0])
                        now = [after, after if now[0] == now[1] else quotes.after(line, now[1])]
                        ends = ends or now[1] == OUTSIDE
        if key is not None:
            yield row()

    return lines.select("uri", "block", F.col("value").cast("binary").alias("value")).mapInArrow(run, "uri string, block long, outside int, inside int, ends boolean")


def split_states(lines: DataFrame, delimiter: str) -> dict[str, dict[int, tuple[int, int, bool]]]:
    """Per file and split (by its start): the state at its start, the split that
    the record open there began in, and whether it is the file's last."""
    out: dict[str, dict[int, tuple[int, int, bool]]] = {}
    last, state, began = None, OUTSIDE, 0
    for r in sorted(split_maps(lines, delimiter).collect(), key=lambda r: (r.uri, r.block)):
        if r.uri != last:
            last, state, began = r.uri, OUTSIDE, 0
        known = out.setdefault(r.uri, {})
        for block, (s, o, _) in list(known.items())[-1:]:
            known[block] = (s, o, False)
        known[r.block] = (state, began, True)
        if state == OUTSIDE or r.ends:
            began = r.block  # what is open behind this split began in it
        state = r.inside if state == INSIDE else r.outside
    return out


def least_split(spark: SparkSession) -> int:
    """Bytes up to which a file is one split, whatever else is read with it."""
    conf = spark._jsparkSession.sessionState().conf()
    return int(min(conf.filesMaxPartitionBytes(), conf.filesOpenCostInBytes()))


class _Assembler:
    """Lines of one task's splits to records.  Rows: (uri, block, row, closed,
    piece, record); ``piece`` is null for a whole record, else the split that
    holds this piece of the record begun in split ``block``."""

    NAMES = ["uri", "block", "row", "closed", "piece", "record"]
    TYPES = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]

    def __init__(self, delimiter: str, states: dict | None, pieces: bool) -> None:
        self.quotes, self.states, self.pieces = Quotes(delimiter), states, pieces
        self.key: tuple | None = None
        self.out: list[tuple] = []

    def enter(self, key: tuple) -> None:
        self.leave()
        self.key = key
        uri, block = key
        if self.states is None or uri not in self.states:
            if block:
                raise RuntimeError(f"{uri}: split at {block} though the file was to be one split; repeat the load")
            self.state, self.owner, self.last = OUTSIDE, 0, True
        else:
            if block not in self.states[uri]:
                raise RuntimeError(f"{uri}: its splits changed between two scans; repeat the load")
            self.state, self.owner, self.last = self.states[uri][block]
        self.held: list[bytes] = []
        self.cut = self.state == INSIDE  # the record at hand began in an earlier split
        self.header = block == 0
        self.row = _LAST_ROW

    def record(self, row: int, body: bytes, closed: bool, piece: bool, ended: bool) -> None:
        if body.endswith(b"\r") and ended:
            body = body[:-1]
        if piece:
            if self.pieces:
                self.out.append((self.key[0], self.owner if self.cut else self.key[1], HEADER if self.header else _LAST_ROW, ended and closed, self.key[1], body))
            return
        if not body:
            return
        if self.header:
            self.header = False
        elif not self.pieces:
            self.out.append((*self.key, row, closed, None, body))

    def leave(self) -> None:
        if self.key is None or not self.held and not (self.state == INSIDE and self.cut):
            return
        body = b"\n".join(self.held)
        if self.cut:  # went through this split; behind the last there is no end
            self.record(self.row, body if self.last else body + b"\n", False, True, self.last)
        elif self.last:
            self.record(self.row, body, False, False, True)
        else:
            self.record(self.row, body + b"\n", True, True, False)
        self.held, self.state = [], OUTSIDE

    def add(self, rows: pa.RecordBatch) -> pa.RecordBatch | None:
        """The lines of one split; what passes as it is comes back as a batch."""
        values = rows.column("value")
        if self.state == OUTSIDE and not self.header and not _has(values, b'"') and not _has(values, b"\r"):
            if self.pieces:
                return None
            kept = rows.filter(pc.greater(pc.binary_length(values), 0))
            n = len(kept)
            return pa.RecordBatch.from_arrays([kept.column("uri"), kept.column("block"), kept.column("row"), pa.array([True] * n, pa.bool_()), pa.nulls(n, pa.int64()), kept.column("value")], names=self.NAMES)
        after = self.quotes.after
        for line, row in zip(values.to_pylist(), rows.column("row").to_pylist(), strict=True):
            state = after(line, self.state)
            if self.state == OUTSIDE:
                if state == OUTSIDE:
                    self.record(row, line, True, False, True)
                    continue
                self.row = row
            self.held.append(line)
            if state == OUTSIDE:
                self.record(self.row, b"\n".join(self.held), True, self.cut, True)
                self.held, self.cut = [], False
            self.state = state
        return None

    def batch(self) -> pa.RecordBatch | None:
        if not self.out:
            return None
        columns, self.out = list(zip(*self.out, strict=True)), []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, self.TYPES, strict=True)], names=self.NAMES)


def _records(lines: DataFrame, delimiter: str, states: Broadcast | None, pieces: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = _Assembler(delimiter, states.value if states is not None else None, pieces)
        for batch in batches:
            for key, rows in _runs(batch):
                if key != work.key:
                    work.enter(key)
                passed = work.add(rows)
                # in the order of their places
                for got in (work.batch(), passed):
                    if got is not None:
                        yield got
        work.leave()
        if (got := work.batch()) is not None:
            yield got

    rows = lines.select("uri", "block", "row", F.col("value").cast("binary").alias("value"))
    return rows.mapInArrow(run, "uri string, block long, row long, closed boolean, piece long, record binary")


def assembled(spark: SparkSession, files: Sequence[tuple[str, int]], delimiter: str) -> DataFrame:
    """(uri, block, row, closed, record): every record but the header of each of
    the files (path, length), as bytes; ``closed`` is false where the file ends
    inside quotes.  Empty lines are no records."""
    columns = ["uri", "block", "row", "closed", "record"]
    limit = least_split(spark)
    small, large = [p for p, n in files if n <= limit], [p for p, n in files if n > limit]
    out = None
    if small:
        out = _records(text_lines(spark, small), delimiter, None, False).select(*columns)
    if large:
        lines = text_lines(spark, large)
        states = split_states(lines, delimiter)
        known = spark.sparkContext.broadcast(states)
        whole = _records(lines, delimiter, known, False).select(*columns)
        out = whole if out is None else out.unionByName(whole)
        cut = sorted(u for u, blocks in states.items() if any(s == INSIDE for s, _, _ in blocks.values()))
        if cut:
            parts = _records(text_lines(spark, cut), delimiter, known, True)
            joined = parts.groupBy("uri", "block").agg(
                F.max("row").alias("row"), F.max("closed").alias("closed"), F.min("row").alias("first"),
                F.array_sort(F.collect_list(F.struct("piece", F.col("record").cast("string").alias("record")))).alias("pieces"))
            out = out.unionByName(joined.where(F.col("first") != HEADER).select(
                "uri", "block", "row", F.coalesce("closed", F.lit(False)).alias("closed"),
                F.concat_ws("", F.transform("pieces", lambda p: p["record"])).cast("binary").alias("record")))
    return out
