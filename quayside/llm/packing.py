"""Documents packed into sequences of a fixed number of tokens by bounded-space
online best fit.

A document's ids, followed by an end id, are one piece; only a document longer
than a sequence is cut, into pieces of a whole sequence each, of which the first
may be shorter.  A task places its pieces as they come: each goes to the open
sequence that it fills best, the one of the least free space that holds it.  Open
sequences are kept by their free space, and a bitset over the free spaces in use
gives the best one in a few steps.  Their number is fixed: where none fits and
all are in use, the fullest closes.

What is still open when a task ends would be wasted once a task, so those pieces
(places and lengths, no ids unless asked for) are dealt to a few more tasks, one
for ``AGAIN`` pieces, and packed again, the longest first.  A task's state is
bounded by its open sequences; a lost task is simply run again.

Defined cases: a null text is empty and has the end id only; the added tokens'
strings in a text are their own ids, as the tokenizers library has it by default;
repeated rows and repeated or null ids are documents of their own; an empty table
gives no sequence; columns other than the two named are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C
from .bpe import text_list, vocabulary
from .words import ByteWords, kept

CAPACITY = 1024
END = 2
#: Sequences that a task keeps open.
OPEN = 2048
#: Pieces left in open sequences that one more task packs again.
AGAIN = 250_000


class OpenBins:
    """Open bins by free space.  ``place`` returns (bin, offset); bins that
    close are handed to ``closed``."""

    def __init__(self, capacity: int, limit: int) -> None:
        self.capacity, self.limit = capacity, max(1, limit)
        self.used = 0  # bit f is set if a bin with f free places is open
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.count = self.made = 0
        self.closed: list[int] = []

    def _take(self, space: int) -> int:
        found = self.free[space].pop()
        if not self.free[space]:
            self.used ^= 1 << space
        self.count -= 1
        return found

    def place(self, size: int) -> tuple[int, int]:
        fitting = self.used >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            chosen = self._take(space)
        else:
            if self.count == self.limit:
                self.closed.append(self._take((self.used & -self.used).bit_length() - 1))
            space, chosen = self.capacity, self.made
            self.made += 1
        left = space - size
        if left:
            self.free[left].append(chosen)
            self.used |= 1 << left
            self.count += 1
        else:
            self.closed.append(chosen)
        return chosen, self.capacity - space


def cut(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, length) of the pieces of documents of ``sizes``
    tokens (one at least)."""
    n = -(-sizes // capacity)
    doc = np.repeat(np.arange(len(sizes)), n)
    piece = C.ranges(np.zeros(len(sizes), np.int64), n)
    first = sizes - (n - 1) * capacity
    start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
    return doc, piece, start, np.where(piece == 0, first[doc], capacity)


class _Packer:
    """Places rows and hands them on, a batch at a time, when their bin closes."""

    def __init__(self, capacity: int, limit: int, first_id: int) -> None:
        self.bins, self.first_id = OpenBins(capacity, limit), first_id
        self.rows: dict[int, list[tuple[int, int]]] = {}
        self.held: list[pa.RecordBatch] = []
        self.size = 0

    def add(self, batch: pa.RecordBatch, lengths: list[int]) -> tuple[np.ndarray, ...]:
        """Place the rows of ``batch``; (row, bin, offset) of those settled.
        Rows are numbered over all batches held."""
        bins, rows = self.bins, self.rows
        for i, n in enumerate(lengths, self.size):
            chosen, offset = bins.place(n)
            rows.setdefault(chosen, []).append((i, offset))
        self.held.append(batch)
        self.size += len(lengths)
        done = [(i, chosen, offset) for chosen in bins.closed for i, offset in rows.pop(chosen)]
        bins.closed = []
        return self._columns(done)

    def rest(self) -> tuple[np.ndarray, ...]:
        done = [(i, chosen, offset) for chosen, members in self.rows.items() for i, offset in members]
        self.rows = {}
        return self._columns(done)

    def _columns(self, done: list[tuple[int, int, int]]) -> tuple[np.ndarray, ...]:
        out = np.array(done, np.int64).reshape(-1, 3)
        return out[:, 0], out[:, 1] + self.first_id, out[:, 2]

    def take(self, which: np.ndarray, keep: bool = True) -> pa.RecordBatch:
        """The rows ``which``; what stays is moved together, so that no more
        than the rows of open bins are held."""
        table = pa.Table.from_batches(self.held).combine_chunks()
        got = table.take(pa.array(which)).combine_chunks().to_batches()
        if keep:
            stay = np.array(sorted(i for members in self.rows.values() for i, _ in members), np.int64)
            self.held, self.size = table.take(pa.array(stay)).combine_chunks().to_batches(), len(stay)
            to = dict(zip(stay.tolist(), range(len(stay)), strict=True))
            self.rows = {b: [(to[i], o) for i, o in members] for b, members in self.rows.items()}
        return got[0] if got else pa.RecordBatch.from_pylist([], schema=table.schema)


def _with_places(rows: pa.RecordBatch, bins: np.ndarray, offsets: np.ndarray, settled: bool) -> pa.RecordBatch:
    names = [*rows.schema.names, "sequence_id", "offset", "settled"]
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(bins), pa.array(offsets), pa.array(np.full(len(bins), settled))], names=names)


def _packed(pieces: Iterator[pa.RecordBatch], capacity: int, limit: int, first_id: int, settled: bool) -> Iterator[pa.RecordBatch]:
    """Pieces (with a column ``length``) with their sequence and offset;
    ``settled`` says whether the last open sequences are final."""
    packer = _Packer(capacity, limit, first_id)
    for batch in pieces:
        which, bins, offsets = packer.add(batch, batch.column("length").to_pylist())
        if len(which):
            yield _with_places(packer.take(which), bins, offsets, True)
    if packer.size:
        which, bins, offsets = packer.rest()
        yield _with_places(packer.take(which, keep=False), bins, offsets, settled)


def pack(docs: DataFrame, vocabulary_path: str, text: str = "text", doc_id: str = "doc_id", capacity: int = CAPACITY, end: int = END,
         open_bins: int = OPEN, again: int = AGAIN, with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset and, with ``with_ids``, its ids."""
    spec = vocabulary(docs.sparkSession, vocabulary_path)
    rows = docs.select(C.exactly(docs, doc_id).alias("doc_id"), C.exactly(docs, text).cast("string").alias("text"))
    fields = [T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False)))
    fields += [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("settled", T.BooleanType())]
    schema = T.StructType(fields)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = kept(ByteWords, spec)
        for batch in batches:
            _, off = C.text_buffer(batch.column(1))
            for lo, hi in C.doc_chunks(off):
                part = batch.slice(lo, hi - lo)
                flat, count = enc.encode(text_list(part.column(1)))
                flat = np.insert(flat, np.cumsum(count), end).astype("<u4")
                doc, piece, start, length = cut(count + 1, capacity)
                begin = np.cumsum(length) - length  # pieces stand in the order of their ids
                crc = [zlib.crc32(flat[a : a + n].data) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
                cols = [part.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(flat)), pa.int32()), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields[:-3]])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packed(pieces(batches), capacity, open_bins, TaskContext.get().partitionId() << 32, False)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packed(batches, capacity, open_bins, (1 << 62) + (TaskContext.get().partitionId() << 32), True)

    placed = C.written(rows.mapInArrow(C.tidy(first), schema), "packed")
    left = placed.where("not settled").drop("sequence_id", "offset", "settled")
    tasks = max(1, -(-left.count() // again))
    dealt = left.repartition(tasks).sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32")
    return placed.where("settled").unionByName(dealt.mapInArrow(C.tidy(second), schema)).drop("settled")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): whole sequences from ``pack(..., with_ids=True)``;
    a group holds one sequence's ids at most."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` in sequences of 1,024 tokens."""
    import public_tokenizers

    return pack(C.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
