"""Repeated byte strings by threshold-bounded interval expansion on a
Burrows-Wheeler transform.

A byte is removed if it is covered by a ``length``-byte string that starts at
two places or more, in one document or several.  The decision comes from
suffix arrays of bounded shards: the shard's Burrows-Wheeler transform is
extended backwards breadth first, which yields the common prefixes of
neighbouring suffixes by increasing value (Beller et al. 2013), and stops at
``length``: neighbours without a value by then share at least that much.

What comes before it only finds the places that can repeat, and loses none:

* Each ``length``-byte window has an anchor, its least ``ANCHOR``-byte string
  by hash (leftmost among equals).  Equal windows have equal anchors at equal
  offsets.  Consecutive windows of one anchor place make a segment, so there is
  about one segment for 85 bytes, of which only hashes are shuffled.
* An anchor met at one place has no repeated window.  Of all others each distinct
  segment, once and with its count, goes to a shard by its anchor.
* An anchor with more than ``HOT`` distinct segments would make an unbounded
  shard, so it is split: windows that have it in their second half go by the
  anchor and the bytes before it that all of them hold, the others by the anchor
  and the bytes behind it.  That halves the places that the anchor can have in a
  window, and is repeated while a group is too large; at the last, a group is the
  copies of one window.

Texts are taken whole; one longer than a chunk is read in overlapping pieces.

Defined cases: a null text is the empty text; a text under ``length`` bytes
keeps all; repeated rows are copies of each other and lose what they share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

LENGTH = 200
ANCHOR = 32
#: Distinct segments of one anchor that may go to one shard.
HOT = 2048
SHARD_BYTES = 1 << 20
#: Ends a segment within a shard; no byte of UTF-8 text.
END = 0xFF


# -- suffix array, transform, bounded common prefixes ----------------------

def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Rotations of ``text`` sorted by their first ``depth`` bytes or more: by
    8 bytes, then by prefix doubling within the groups that are still equal."""
    n = len(text)
    wrapped = np.concatenate([text, np.resize(text, 8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | wrapped[i : i + n]
    order = np.argsort(key)
    sorted_ = key[order]
    new = np.ones(n, bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    rank = np.empty(n, np.int64)  # where a rotation's group starts
    rank[order] = np.repeat(start, size)
    bits, reach = n.bit_length(), 8
    start, size = start[size > 1], size[size > 1]
    while reach < depth and len(start):
        m = int(size.sum())
        at = C.ranges(start, size)
        suffix = order[at]
        behind = suffix + reach
        behind[behind >= n] -= n
        key = (np.repeat(np.arange(len(start)), size) << bits) | rank[behind]
        low = (m - 1).bit_length()
        if len(start).bit_length() + bits + low <= 63:  # sorting numbers is faster than sorting places by them
            key = np.sort((key << low) | np.arange(m))
            moved, key = key & ((1 << low) - 1), key >> low
        else:
            moved = np.argsort(key)
            key = key[moved]
        suffix = suffix[moved]
        order[at] = suffix
        new = np.ones(m, bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        start, size = at[first], np.diff(np.append(first, m))
        rank[suffix] = np.repeat(start, size)
        start, size = start[size > 1], size[size > 1]
        reach *= 2
    return order


class Transform:
    """A Burrows-Wheeler transform: the last-to-first map, the sorted bytes and,
    per byte, the places that hold it."""

    def __init__(self, last: np.ndarray) -> None:
        n = len(last)
        by_byte = np.argsort(last, kind="stable")
        self.first, self.first_of = last[by_byte], np.empty(n, np.int64)
        self.first_of[by_byte] = np.arange(n)
        count = np.bincount(last, minlength=256)
        begin = np.cumsum(count) - count
        self.bytes = [(int(begin[c]), by_byte[begin[c] : begin[c] + count[c]]) for c in np.flatnonzero(count)]


def shares(transform: Transform, limit: int, wide: int = 4096) -> np.ndarray:
    """For each neighbour pair (i - 1, i) of the suffix array whether their
    common prefix is ``limit`` long or longer; index 0 is false.

    Intervals of a string w are extended by each byte c to those of cw; a right
    end met for the first time at depth d has a common prefix of d there.  An
    interval of one suffix goes on to one interval of one suffix, so those are
    a plain list of places; only the others can split."""
    first, first_of = transform.first, transform.first_of
    n = len(first)
    unset = np.ones(n + 1, bool)
    unset[0] = unset[n] = False
    bits = n.bit_length()
    ones = np.zeros(0, np.int64)
    lo, hi = np.array([0], np.int64), np.array([n], np.int64)
    for _ in range(limit):
        if not len(lo) and not len(ones):
            break
        ones = first_of[ones]
        new_lo, new_hi = [lo[:0]], [lo[:0]]
        few = hi - lo <= wide
        if few.any():  # move each suffix and see which stay together
            size = (hi - lo)[few]
            key = np.repeat(np.arange(len(size)) << bits, size)
            key |= first_of[C.ranges(lo[few], size)]
            key.sort()
            to, key = key & ((1 << bits) - 1), key >> bits
            byte = first[to]
            apart = np.ones(len(key), bool)
            apart[1:] = (key[1:] != key[:-1]) | (byte[1:] != byte[:-1])
            begin = np.flatnonzero(apart)
            new_lo.append(to[begin])
            new_hi.append(to[np.append(begin[1:], len(to)) - 1] + 1)
        if not few.all():
            for begin, places in transform.bytes:
                a, b = begin + np.searchsorted(places, lo[~few]), begin + np.searchsorted(places, hi[~few])
                new_lo.append(a[a < b])
                new_hi.append(b[a < b])
        lo, hi = np.concatenate(new_lo), np.concatenate(new_hi)
        ones, met = ones[unset[ones + 1]], unset[hi]
        lo, hi = lo[met], hi[met]
        unset[hi] = False
        unset[ones + 1] = False
        single = hi - lo == 1
        ones = np.concatenate([ones, lo[single]])
        lo, hi = lo[~single], hi[~single]
    out = unset[:n].copy()
    out[0] = False
    return out


def repeated_windows(segments: list[bytes], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """For each segment, which of its windows start at two places or more of
    the shard (a segment stands for ``counts`` equal ones)."""
    text = np.frombuffer(b"\xff".join(segments) + b"\xff", np.uint8)
    order = suffix_array(text, length + 1)
    together = shares(Transform(text[order - 1]), length)
    group = np.cumsum(~together)
    size = np.array([len(s) for s in segments])
    begin = np.cumsum(size + 1) - size - 1
    weight = np.zeros(len(text), np.int64)
    windows = np.maximum(0, size - length + 1)
    places = C.ranges(begin, windows)
    weight[places] = np.repeat(counts, windows)
    total = np.bincount(group, weights=weight[order])
    many = np.zeros(len(text), bool)
    many[order] = total[group] >= 2
    return [many[b : b + w] for b, w in zip(begin.tolist(), windows.tolist(), strict=True)]


# -- segments --------------------------------------------------------------

def segments(buf: np.ndarray, off: np.ndarray, length: int, anchor: int, chunk: int = C.CHUNK_BYTES) -> Iterator[tuple[np.ndarray, ...]]:
    """Per piece of the buffer: (document, start in it, windows, anchor hash,
    segment hash, place of the anchor in the segment) of every segment."""
    total = len(buf)
    ends = off[1:]
    for lo in range(0, max(0, total - length + 1), chunk):
        hi = min(total, lo + chunk + length - 1)
        part = buf[lo:hi]
        if len(part) < length:
            break
        hashed = C.RangeHash(C.byte_codes(part))
        place = np.arange(len(part) - anchor + 1)
        grams = hashed.of(place, place + anchor)
        chosen = C.minimizer_of_window(grams, length - anchor + 1)
        windows = np.arange(len(chosen))
        d0, d1 = int(np.searchsorted(off, lo, "right")) - 1, int(np.searchsorted(off, hi, "left"))
        doc = np.repeat(np.arange(d0, d1), np.diff(np.clip(off[d0 : d1 + 1], lo, hi)))[: len(windows)]
        valid = lo + windows + length <= ends[doc]
        a, b = C.window_runs(np.where(valid, chosen, -1), valid)
        if len(a):
            # a run of one anchor place lies in one document, as its windows do
            yield doc[a], lo + a - off[doc[a]], b - a, C.signed(grams[chosen[a]]), C.signed(hashed.of(a, b + length - 1)), chosen[a] - a


def anchored(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """(uid, at, windows, anchor, h, off) of the segments of ``texts`` (uid, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, at, windows, key, h, off in segments(*C.text_buffer(batch.column(1)), length, anchor):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), pa.array(at.astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(key), pa.array(h), pa.array(off.astype(np.int32))],
                                                 names=["uid", "at", "windows", "anchor", "h", "off"])

    return texts.select("uid", "text").mapInArrow(C.tidy(run), "uid binary, at int, windows int, anchor long, h long, off int")


def _cut_segments(rows: DataFrame, length: int) -> DataFrame:
    """(anchor, h, n, alone, hot, off, segment bytes) of representatives in (text, segs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, off = C.text_buffer(batch.column(0))
            segs = batch.column(1)
            flat = segs.flatten()
            doc = np.repeat(np.arange(len(batch)), np.diff(segs.offsets.to_numpy()))
            at, windows = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("at", "windows"))
            lo = off[doc] + at
            size = windows + length - 1
            data = text[C.ranges(lo, size)]
            body = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
            names = ["anchor", "h", "n", "alone", "hot", "off"]
            yield pa.RecordBatch.from_arrays([*[flat.field(f) for f in names], body], names=[*names, "segment"])

    return rows.mapInArrow(C.tidy(run), "anchor long, h long, n long, alone boolean, hot boolean, off int, segment binary")


def _expand_shards(rows: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """rows (anchor, h, n, segment): (anchor, h, lo, hi), the runs of repeated
    windows of each segment.  A shard is cut between anchors.  Anchors that have
    one distinct segment come first: shards of them hold few common prefixes
    and are soon done."""

    def shard(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        marks = repeated_windows([r[3] for r in rows], np.array([r[2] for r in rows], np.int64), length)
        keys, lo, hi = [], [], []
        for r, m in zip(rows, marks, strict=True):
            step = np.flatnonzero(np.diff(np.concatenate([[False], m, [False]]).astype(np.int8)))
            for a, b in zip(step[::2].tolist(), step[1::2].tolist(), strict=True):
                keys.append(r)
                lo.append(a)
                hi.append(b)
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], names=["anchor", "h", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if size >= shard_bytes and row[0] != held[-1][0]:
                    yield shard(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3]) + 1
        if held:
            yield shard(held)

    dealt = rows.repartition("anchor").sortWithinPartitions(F.desc("alone"), "anchor", "h").select("anchor", "h", "n", "segment")
    return dealt.mapInArrow(C.tidy(run), "anchor long, h long, lo int, hi int")


def halves(segment: bytes, off: int, olo: int, ohi: int, length: int) -> Iterator[tuple[int, int, int, int, int, bytes]]:
    """A segment whose windows have the anchor at places from ``olo`` to ``ohi``
    (at ``off`` in the first window, one less in each next), split by the half
    that the place lies in: (first window, off, olo, ohi, key, segment).  The key
    is a hash of the bytes around the anchor that all windows of a half hold."""
    windows, mid = len(segment) - length + 1, (olo + ohi) // 2
    cut = min(max(off - mid, 0), windows)  # windows before it have the anchor behind mid
    for first, last, a, b in ((0, cut, mid + 1, ohi), (cut, windows, olo, mid)):
        if first < last:
            core = segment[off - a : off + length - b]
            yield first, off - first, a, b, xxhash.xxh3_64_intdigest(core, seed=(a << 32) | b), segment[first : last + length - 1]


def _split(rows: DataFrame, length: int) -> DataFrame:
    """rows (anchor, h, n, i, off, olo, ohi, segment), ``i`` being the window of
    (anchor, h) that the segment starts with: the same of their halves, by key."""
    names = ["anchor", "h", "n", "i", "off", "olo", "ohi", "key", "segment"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for anchor, h, n, i, off, olo, ohi, segment in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for first, at, a, b, key, part in halves(segment, off, olo, ohi, length):
                    out.append((anchor, h, n, i + first, at, a, b, key - (1 << 64) if key >> 63 else key, part))
            cols = list(zip(*out, strict=True)) or [[]] * len(names)
            kinds = [pa.int64(), pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return rows.select(*[c for c in names if c != "key"]).mapInArrow(C.tidy(run), "anchor long, h long, n long, i int, off int, olo int, ohi int, key long, segment binary")


def _split_while_hot(rows: DataFrame, length: int, hot: int) -> tuple[DataFrame, DataFrame] | None:
    """Segments of hot anchors: (groups that fit a shard, as rows of
    ``_expand_shards``; (key, part, anchor, h, i): whose window ``i`` each
    group's segment starts with)."""
    groups = origins = None
    while not rows.isEmpty():
        parts = C.written(_split(rows, length).withColumn("part", F.xxhash64("segment", "off")), "halves")
        kinds = parts.groupBy("key", "part").agg(F.sum("n").alias("n"), F.first("segment").alias("segment"))
        crowds = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("n").alias("all")).where("all > 1")
        state = C.written(crowds.select("key", (F.col("kinds") > hot).alias("hot"), (F.col("kinds") == 1).alias("alone")), "crowds")
        cold = C.written(kinds.join(state.where("not hot"), "key").select(F.col("key").alias("anchor"), F.col("part").alias("h"), "n", "alone", "segment"), "cold")
        own = parts.join(state.where("not hot"), "key").select("key", "part", "anchor", "h", "i")
        groups = cold if groups is None else groups.unionByName(cold)
        origins = own if origins is None else origins.unionByName(own)
        rows = C.written(parts.join(state.where("hot"), "key").drop("key", "part", "hot", "alone"), "hot")
    return None if groups is None else (groups, origins)


def _texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    ident, body = C.exactly(docs, doc_id), C.exactly(docs, text)
    return docs.select(C.row_uid(ident, body).alias("uid"), body.alias("text"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT, text: str = "text", doc_id: str = "doc_id",
                   shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(uid, spans): per row identity the runs [from, to) of bytes to remove,
    as an array of structs in no order, which may overlap."""
    if anchor >= length:
        raise ValueError("an anchor is shorter than the strings sought")
    texts = _texts(docs, text, doc_id)
    places = C.written(anchored(texts, length, anchor), "segments")
    state = places.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    met = C.written(C.spread_join(places, state, ["anchor"]), "repeated")

    kinds = met.groupBy("anchor", "h").agg(F.count("*").alias("n"), F.min(F.struct("uid", "at", "windows", "off")).alias("r"))
    kinds = C.written(kinds.select("anchor", "h", "n", "r.*"), "kinds")
    crowds = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"))
    kinds = C.spread_join(kinds, crowds, ["anchor"])
    chosen = kinds.groupBy("uid").agg(F.collect_list(F.struct("anchor", "h", "n", (F.col("kinds") == 1).alias("alone"), (F.col("kinds") > hot).alias("hot"), "off", "at", "windows")).alias("segs"))
    # a repeated row has the same text; one of its copies is enough
    source = texts.join(chosen, "uid").select("text", "segs")
    cut = C.written(_cut_segments(source, length), "cut")

    cold = cut.where("not hot").select("anchor", "h", "n", "alone", "segment")
    runs = _expand_shards(cold, length, shard_bytes)
    whole = cut.where("hot").select("anchor", "h", "n", F.lit(0).alias("i"), "off", F.lit(0).alias("olo"), F.lit(length - anchor).alias("ohi"), "segment")
    if (parts := _split_while_hot(whole, length, hot)) is not None:
        groups, origins = parts
        inner = _expand_shards(groups, length, shard_bytes).withColumnsRenamed({"anchor": "key", "h": "part"})
        runs = runs.unionByName(origins.join(inner, ["key", "part"]).select(
            "anchor", "h", (F.col("i") + F.col("lo")).alias("lo"), (F.col("i") + F.col("hi")).alias("hi")))
    runs = C.written(runs.distinct(), "runs")
    found = C.spread_join(met.select("anchor", "h", "uid", "at"), runs, ["anchor", "h"]).select(
        "uid", (F.col("at") + F.col("lo")).alias("lo"), (F.col("at") + F.col("hi") + (length - 1)).alias("hi"))
    return found.groupBy("uid").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def removed_runs(spans: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    lo = np.array([s["lo"] for s in spans or ()], np.int64)
    hi = np.array([s["hi"] for s in spans or ()], np.int64)
    return C.merged_spans(lo, hi)


def kept_bytes(raw: bytes, lo: np.ndarray, hi: np.ndarray) -> bytes:
    cut = [0, *np.stack([lo, hi], axis=1).ravel().tolist(), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(cut[::2], cut[1::2], strict=True))


def whole_characters(raw: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans less the characters that they cover only in part."""
    byte = np.frombuffer(raw, np.uint8)
    start = np.append((byte & 0xC0) != 0x80, True)
    at = np.flatnonzero(start)
    lo = at[np.searchsorted(at, lo, "left")]
    hi = at[np.searchsorted(at, hi, "right") - 1]
    some = lo < hi
    return lo[some], hi[some]


def measured(docs: DataFrame, length: int = LENGTH, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:  # noqa: ANN003
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spans = repeated_spans(docs, length, text=text, doc_id=doc_id, **options)
    ident, body = C.exactly(docs, doc_id), C.exactly(docs, text)
    frame = docs.select(C.row_uid(ident, body).alias("uid"), ident.alias("doc_id"), body.alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = C.text_buffer(batch.column(1))
            rows = []
            for i, spans in enumerate(batch.column(2).to_pylist()):
                raw = buf[off[i] : off[i + 1]].tobytes()
                lo, hi = removed_runs(spans)
                rows.append((len(raw), int((hi - lo).sum()), len(lo), hashlib.sha256(kept_bytes(raw, lo, hi)).hexdigest()))
            cols = list(zip(*rows, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return frame.join(spans, "uid", "left").select("doc_id", "text", "spans").mapInArrow(
        C.tidy(run), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:  # noqa: ANN003
    """The documents, with their own columns and the repeated bytes taken out
    of the text.  A character of which only some bytes repeat stays whole; a
    null text stays null; an ``n_chars`` column, if there is one, follows."""
    spans = repeated_spans(docs, length, text=text, doc_id=doc_id, **options)
    names = list(docs.columns)
    uid, cut = C.fresh("q_uid", names), C.fresh("q_spans", names)
    frame = docs.withColumn(uid, C.row_uid(C.exactly(docs, doc_id), C.exactly(docs, text))).join(
        spans.select(F.col("uid").alias(uid), F.col("spans").alias(cut)), uid, "left").select(*[f"`{c}`" for c in names], cut)
    place = names.index(text)
    long = names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = C.text_buffer(batch.column(place))
            valid = batch.column(place).is_valid().to_pylist()
            out: list[str | None] = []
            for i, spans in enumerate(batch.column(len(names)).to_pylist()):
                raw = buf[off[i] : off[i + 1]].tobytes()
                out.append(kept_bytes(raw, *whole_characters(raw, *removed_runs(spans))).decode("utf-8", "replace") if valid[i] else None)
            cols = [batch.column(i) for i in range(len(names))]
            if long is not None:
                before = cols[long].to_pylist()
                changed = [x is not None and len(x.encode()) != int(off[i + 1] - off[i]) for i, x in enumerate(out)]
                cols[long] = pa.array([len(x) if c else b for x, c, b in zip(out, changed, before, strict=True)], cols[long].type)
            cols[place] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return frame.mapInArrow(C.tidy(run), docs.schema)


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(C.table(spark, sf_dir, "documents"))
