"""Repeated passages by compaction of a de Bruijn graph of words.

Edges are windows of ``window`` consecutive words, nodes the sequences of one
word less.  A word is removed if a window that covers it also starts in a
document with a smaller id; windows are judged on the input.

As in partitioned compaction of k-mer graphs, edges are dealt by minimizer:
the least ``ANCHOR``-word sequence of a window by hash.  Consecutive windows of
one anchor place make a path that is shuffled as two hashes, not window by
window.  An anchor met in one document only has no repeat.  Where all paths of
an anchor are equal they are one nonbranching path, whose first document is
known at once.  The rest is the branching part of the graph:

1. each distinct path is spelt out from its source, as nodes;
2. a join finds the branching nodes (two different predecessors or successors,
   or a path that begins or ends there while another goes on);
3. paths are cut there into nonbranching pieces, equal pieces are compacted
   into one, and the least document of each is joined back;
4. pieces are read at their source coordinates and must agree in a second hash
   of their words, independent of the first.

Every step is a partial aggregate or an equi-join on hashes, so a hot anchor is
many small rows, never one group.

Words: ``[^\\x20\\x09-\\x0D]+`` as they stand.

Defined cases: a null text has no words; a text under ``window`` words keeps
all; rows that repeat an id never remove each other's words; a row with a null
id neither removes nor loses words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

WINDOW = 50
ANCHOR = 10


def _word_codes(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, first = C.word_spans(buf, off, ~C.SPACES)
    return C.word_hashes(buf, starts, ends), first, starts, ends


def paths(buf: np.ndarray, off: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...] | None:
    """(document, first word, edges, anchor hash, path hash) of every path."""
    codes, first, _, _ = _word_codes(buf, off)
    if len(codes) < window:
        return None
    hashed = C.RangeHash(codes)
    place = np.arange(len(codes) - anchor + 1)
    grams = hashed.of(place, place + anchor)
    chosen = C.minimizer_of_window(grams, window - anchor + 1)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))[: len(chosen)]
    valid = np.arange(len(chosen)) + window <= first[doc + 1]
    a, b = C.window_runs(np.where(valid, chosen, -1), valid)
    return doc[a], a - first[doc[a]], b - a, C.signed(grams[chosen[a]]), C.signed(hashed.of(a, b + window - 1))


def anchored(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """rows (doc_id, uid, text): (doc_id, uid, at, edges, anchor, h)."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = C.text_buffer(batch.column(2))
            for lo, hi in C.doc_chunks(off):
                base = off[lo]
                got = paths(buf[base : off[hi]], off[lo : hi + 1] - base, window, anchor)
                if got is None or not len(got[0]):
                    continue
                doc, at, edges, key, h = got
                own = pa.array(doc + lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), pa.array(at.astype(np.int32)), pa.array(edges.astype(np.int32)), pa.array(key), pa.array(h)], names=["doc_id", "uid", "at", "edges", "anchor", "h"])

    return rows.select("doc_id", "uid", "text").mapInArrow(C.tidy(run), f"doc_id {kind}, uid binary, at int, edges int, anchor long, h long")


def _spelt(rows: DataFrame, window: int) -> DataFrame:
    """rows (text, segs of (anchor, h, at, edges)): per path its nodes, and a
    second hash of each of its edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = C.text_buffer(batch.column(0))
            segs = batch.column(1)
            cuts = segs.offsets.to_numpy() - segs.offsets[0].as_py()
            flat = segs.flatten()
            key, h = flat.field("anchor"), flat.field("h")
            at, edges = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("at", "edges"))
            for lo, hi in C.doc_chunks(off):
                base = off[lo]
                part, starts_at = buf[base : off[hi]], off[lo : hi + 1] - base
                codes, first, starts, ends = _word_codes(part, starts_at)
                a, b = int(cuts[lo]), int(cuts[hi])
                if a == b:
                    continue
                doc = np.repeat(np.arange(hi - lo), np.diff(cuts[lo : hi + 1]))
                begin, n = first[doc] + at[a:b], edges[a:b].astype(np.int64)
                one = C.RangeHash(codes)
                two = C.PrimeHash(C.word_hashes(part, starts, ends, second=True))
                node, edge = C.ranges(begin, n + 1), C.ranges(begin, n)
                yield pa.RecordBatch.from_arrays([
                    key.slice(a, b - a), h.slice(a, b - a),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n + 1)]).astype(np.int32)), pa.array(C.signed(one.of(node, node + window - 1)))),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(C.signed(two.of(edge, edge + window)))),
                ], names=["anchor", "h", "nodes", "checks"])

    return rows.mapInArrow(C.tidy(run), "anchor long, h long, nodes array<long>, checks array<long>")


def compacted(spelt: DataFrame) -> DataFrame:
    """spelt (anchor, h, first, nodes, checks): each path cut at branching
    nodes into pieces (anchor, h, first, lo, hi, least), ``least`` being the
    least document that any equal piece stands in."""
    each = spelt.select("anchor", "h", "nodes", F.posexplode("nodes").alias("i", "node"))
    around = each.select("anchor", "h", "i", "node", (F.col("i") == 0).alias("head"), (F.col("i") == F.size("nodes") - 1).alias("tail"),
                         F.when(F.col("i") > 0, F.expr("nodes[i - 1]")).alias("before"),
                         F.when(F.col("i") < F.size("nodes") - 1, F.expr("nodes[i + 1]")).alias("after"))
    mixed = lambda c, end: (F.min(c) != F.max(c)) | (F.max(end) & F.min(c).isNotNull())
    nodes = around.groupBy("node").agg((F.coalesce(mixed("before", "head"), F.lit(False)) | F.coalesce(mixed("after", "tail"), F.lit(False))).alias("branch")).where("branch")
    breaks = around.select("anchor", "h", "i", "node").join(nodes, "node").groupBy("anchor", "h").agg(F.collect_set("i").alias("at"))
    cut = spelt.join(breaks, ["anchor", "h"], "left").withColumn(
        "at", F.array_sort(F.array_union(F.array(F.lit(0), F.size("nodes") - 1), F.coalesce("at", F.array().cast("array<int>")))))
    pieces = cut.select("anchor", "h", "first", "nodes", "checks", F.posexplode(F.expr("transform(sequence(1, size(at) - 1), k -> struct(at[k - 1] as lo, at[k] as hi))")).alias("k", "p"))
    named = pieces.select("anchor", "h", "first", F.col("p.lo").alias("lo"), F.col("p.hi").alias("hi"),
                          F.xxhash64(F.expr("slice(nodes, p.lo + 1, p.hi - p.lo + 1)")).alias("key"), F.xxhash64(F.expr("slice(checks, p.lo + 1, p.hi - p.lo)")).alias("check"))
    least = named.groupBy("key", "check").agg(F.min("first").alias("least"), F.max("first").alias("most")).where("least < most").drop("most")
    return named.join(least, ["key", "check"]).select("anchor", "h", "first", "lo", "hi", "least")


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(uid, spans): per row identity the runs [lo, hi) of words to remove, in
    no order, which may overlap."""
    if anchor >= window:
        raise ValueError("an anchor is shorter than a window")
    ident, body = C.exactly(docs, doc_id), C.exactly(docs, text)
    rows = docs.select(ident.alias("doc_id"), C.row_uid(ident, body).alias("uid"), body.alias("text"))
    places = C.written(anchored(rows.where("doc_id is not null"), window, anchor), "paths")
    state = places.groupBy("anchor").agg(F.min("doc_id").alias("d1"), F.max("doc_id").alias("d2"), F.min("h").alias("h1"), F.max("h").alias("h2")).where("d1 < d2")
    met = C.written(C.spread_join(places, state.select("anchor", F.col("d1").alias("first"), (F.col("h1") == F.col("h2")).alias("same")), ["anchor"]), "repeated")
    whole = lambda rows: rows.select("uid", F.col("at").alias("lo"), (F.col("at") + F.col("edges") + (window - 1)).alias("hi"))
    sure = whole(met.where("same and doc_id > first"))

    mixed = met.where("not same").drop("first", "same")
    kinds = C.written(mixed.groupBy("anchor", "h").agg(F.min("doc_id").alias("first"), F.min(F.struct("doc_id", "uid", "at", "edges")).alias("r")), "kinds")
    chosen = kinds.groupBy(F.col("r.uid").alias("uid")).agg(F.collect_set(F.struct("anchor", "h", F.col("r.at").alias("at"), F.col("r.edges").alias("edges"))).alias("segs"))
    spelt = _spelt(rows.select("uid", "text").join(chosen, "uid").select("text", "segs"), window).dropDuplicates(["anchor", "h"])
    table = C.written(spelt.join(kinds.select("anchor", "h", "first"), ["anchor", "h"]), "spelt")
    pieces = C.written(compacted(table).where("least < first").select("anchor", "h", "lo", "hi"), "pieces")

    own = mixed.join(kinds.select("anchor", "h", "first"), ["anchor", "h"])
    later = whole(own.where("doc_id > first"))
    partly = own.where("doc_id = first").join(pieces, ["anchor", "h"]).select(
        "uid", (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi") + (window - 1)).alias("hi"))
    return sure.unionByName(later).unionByName(partly).groupBy("uid").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def deduplicated(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id", with_text: bool = True, **options) -> DataFrame:  # noqa: ANN003
    """One row a document: doc_id, n_words, n_removed, kept_sha256 and, with
    ``with_text``, the kept words joined by one space."""
    spans = repeated_spans(docs, window, text=text, doc_id=doc_id, **options)
    ident, body = C.exactly(docs, doc_id), C.exactly(docs, text)
    frame = docs.select(C.row_uid(ident, body).alias("uid"), ident.alias("doc_id"), body.alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * with_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = C.text_buffer(batch.column(1))
            n, gone, digest, kept = [], [], [], []
            for i, spans in enumerate(batch.column(2).to_pylist()):
                words = buf[off[i] : off[i + 1]].tobytes().split()
                n.append(len(words))
                if spans:
                    lo, hi = C.merged_spans(np.array([s["lo"] for s in spans]), np.array([s["hi"] for s in spans]))
                    for a, b in zip(lo[::-1].tolist(), hi[::-1].tolist(), strict=True):
                        del words[a:b]
                gone.append(n[-1] - len(words))
                body = b" ".join(words)
                digest.append(hashlib.sha256(body).hexdigest())
                if with_text:
                    kept.append(body.decode("utf-8", "replace"))
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.string())] * with_text, names=names)

    return frame.join(spans, "uid", "left").select("doc_id", "text", "spans").mapInArrow(
        C.tidy(run), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)


def op6_de_bruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(C.table(spark, sf_dir, "documents"), with_text=False)
