"""MinHash near-duplicates by fast similarity sketching.

Sketch (Dahlgaard, Knudsen, Thorup 2017): in round i each shingle is hashed to
a bin and a value; a bin keeps the least (round, value).  In the first t rounds
the bin is random, in the next t rounds round i fills bin i - t, so after at
most 2t rounds every one of the t coordinates is filled, and a document stops
as soon as its own are.  The share of equal coordinates of two documents
estimates their Jaccard similarity with concentration bounds.

Banding: ``BANDS`` bands of ``ROWS`` coordinates.  A pair at the threshold of
0.8 shares no band with probability (1 - 0.8^4)^32 < 5e-8.

Exact verification on full sets, without all pairs of a bucket:

1. rows with equal sets form a class, of which one stands in the buckets;
2. each member of a bucket is compared with the bucket's leader (``LEADERS`` of
   them in a bucket of over ``BLOCK`` / 2 of the first ``LED_BANDS`` bands), members in blocks of ``BLOCK``, so a
   bucket of any size is many bounded groups;
3. links make components; where a bucket's other members still lie in several,
   those outside its largest component are compared with all, block against
   block, skipping pairs that are already in one component, and only links that
   join components leave the task.

Words: A-Z lower-cased, then runs of ``[^\\x20\\x09-\\x0D]``; a set is the
distinct ``shingle``-word sequences, or the whole sequence when shorter.

Defined cases: null, empty or wordless texts have the empty set, link with
nothing and are kept; repeated rows form a class; a null id takes part but is
never a component's id while another id is there, and is not kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .graph import components

SHINGLE = 4
BINS, BANDS, ROWS = 128, 32, 4
BLOCK = 64
#: Rows outside a bucket's largest component that a group compares with four times as many.
REST = 256
LEADERS, LED_BANDS = 5, 4
_EMPTY = np.uint64((1 << 64) - 1)


def shingle_sets(buf: np.ndarray, off: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each document, end to end, and
    the n+1 offsets."""
    low = C.LOWER[buf]
    starts, ends, first = C.word_spans(low, off, ~C.SPACES)
    words = np.diff(first)
    ranged = C.RangeHash(C.word_hashes(low, starts, ends)) if len(starts) else None
    count = np.where(words >= k, words - k + 1, np.minimum(words, 1))
    lo = C.ranges(first[:-1], count)
    hashes = ranged.of(lo, lo + np.repeat(np.minimum(words, k), count)) if len(lo) else np.zeros(0, np.uint64)
    cut = np.concatenate([[0], np.cumsum(count)])
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[cut[:-1][count > 0]] = True
    total = np.concatenate([[0], np.cumsum(new)])
    return hashes[new], total[cut]


def sketches(sets: np.ndarray, cut: np.ndarray, bins: int = BINS) -> np.ndarray:
    """(n, bins) sketches; documents with an empty set keep unfilled rows."""
    n = len(cut) - 1
    out = np.full(n * bins, _EMPTY)
    size = np.diff(cut)
    doc, items = np.repeat(np.arange(n), size), sets
    for i in range(2 * bins):
        if not len(items):
            break
        x = C.mix64(items + np.uint64(((i + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        value = (x >> np.uint64(9)) | (np.uint64(i) << np.uint64(55))
        where = (x % np.uint64(bins)).astype(np.int64) if i < bins else np.full(len(x), i - bins)
        np.minimum.at(out, doc * bins + where, value)
        filled = (out.reshape(n, bins) != _EMPTY).all(axis=1)
        rest = ~filled[doc]
        doc, items = doc[rest], items[rest]
    return out.reshape(n, bins)


def band_keys(sketch: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    parts = sketch.reshape(len(sketch), bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(sketch), 1))
    for j in range(rows):
        key = C.mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key


def sketched(docs: DataFrame, k: int = SHINGLE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, uid, n, s1, s2, bands): the set's size, two 64-bit sums that
    identify it, and its band keys (empty for the empty set)."""
    ident, body = C.exactly(docs, doc_id), C.exactly(docs, text)
    frame = docs.select(ident.alias("doc_id"), C.row_uid(ident, body).alias("uid"), body.alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = C.text_buffer(batch.column(2))
            for lo, hi in C.doc_chunks(off):
                base = off[lo]
                sets, cut = shingle_sets(buf[base : off[hi]], off[lo : hi + 1] - base, k)
                n = np.diff(cut)
                sums = [np.concatenate([[0], np.cumsum(C.mix64(sets ^ np.uint64(salt)))]).astype(np.uint64) for salt in (0x5bd1e995, 0x27d4eb2f165667c5)]
                s1, s2 = (C.signed(s[cut[1:]] - s[cut[:-1]]) for s in sums)
                keys = band_keys(sketches(sets, cut))[n > 0]
                offsets = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n), pa.array(s1), pa.array(s2), pa.ListArray.from_arrays(pa.array(offsets), pa.array(C.signed(keys.ravel())))],
                    names=["doc_id", "uid", "n", "s1", "s2", "bands"])

    return frame.mapInArrow(C.tidy(run), f"doc_id {kind}, uid binary, n long, s1 long, s2 long, bands array<long>")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a and b| >= percent * |a or b|, for sorted distinct arrays."""
    if not len(a) or not len(b):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verify_leaders(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """rows (leader, block, member, text), grouped by (leader, block) with the
    leader first: the (a, b) that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, None
        for batch in batches:
            leader, block, member = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2))
            buf, off = C.text_buffer(batch.column(3))
            a, b = [], []
            for lo, hi in C.doc_chunks(off):
                base = off[lo]
                sets, cut = shingle_sets(buf[base : off[hi]], off[lo : hi + 1] - base, k)
                for i in range(lo, hi):
                    mine = sets[cut[i - lo] : cut[i - lo + 1]]
                    if member[i] == leader[i]:
                        key, own = (leader[i], block[i]), mine.copy()
                    elif key == (leader[i], block[i]) and linked(own, mine, percent):
                        a.append(member[i])
                        b.append(leader[i])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(C.tidy(run), "a long, b long")


def _verify_rest(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """rows (bucket, i, j, asks, member, component, text), grouped by (bucket,
    i, j) with those that ask last: links between a row that asks and another
    that join two components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, others, top = None, [], {}

        def find(x: int) -> int:
            while top.get(x, x) != x:
                x = top[x]
            return x

        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(6)]
            buf, off = C.text_buffer(batch.column(6))
            a, b = [], []
            for lo, hi in C.doc_chunks(off):
                base = off[lo]
                sets, cut = shingle_sets(buf[base : off[hi]], off[lo : hi + 1] - base, k)
                for x in range(lo, hi):
                    now, asks, member, component = (cols[0][x], cols[1][x], cols[2][x]), cols[3][x], cols[4][x], cols[5][x]
                    if now != key:
                        key, others, top = now, [], {}
                    own = sets[cut[x - lo] : cut[x - lo + 1]]
                    if not asks:
                        others.append((member, component, own.copy()))
                        continue
                    for other, c, theirs in others:
                        p, q = find(component), find(c)
                        if p != q and linked(own, theirs, percent):
                            top[max(p, q)] = min(p, q)
                            a.append(member)
                            b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(C.tidy(run), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row a document: doc_id, uid (row identity), n_shingles,
    component_id, kept."""
    ident, body = C.exactly(docs, doc_id), C.exactly(docs, text)
    texts = docs.select(C.row_uid(ident, body).alias("uid"), body.alias("text"))
    table = C.written(sketched(docs, shingle, text, doc_id), "sketches")
    some = table.where("n > 0")
    by_class = some.groupBy("n", "s1", "s2").agg(F.min(F.struct("doc_id", "uid")).alias("r"), F.min_by("bands", F.struct("doc_id", "uid")).alias("bands"))
    # a class is a number, once it is written
    classes = C.written(by_class.select(F.monotonically_increasing_id().alias("member"), "n", "s1", "s2", F.col("r.uid").alias("uid"), "bands"), "classes")
    placed = classes.select("member", F.posexplode("bands").alias("band", "bucket"))
    # one leader could be an outlier that few link with, so a larger bucket gets several, drawn by
    # hashes; a few bands of them make the components that the others find joined already
    drawn = [F.min_by("member", F.xxhash64("member", F.lit(i))) for i in range(1, LEADERS)]
    shared = placed.groupBy("bucket").agg(F.min("member").alias("one"), F.max("member").alias("last"), F.count("*").alias("n"), F.min("band").alias("first"), F.array(*drawn).alias("more")).where("one < last")
    leaders = F.when((F.col("n") > BLOCK // 2) & (F.col("first") < LED_BANDS), F.array_distinct(F.concat(F.array("one"), "more"))).otherwise(F.array("one"))
    shared = shared.select("bucket", leaders.alias("leaders"))
    buckets = C.written(C.spread_join(placed.drop("band"), shared, ["bucket"]), "buckets")

    # the texts that are compared: one a class, of the classes that share a bucket
    wanted = buckets.select("member").distinct().join(classes.select("member", "uid"), "member")
    texts = C.written(texts.join(wanted, "uid").select("member", "text").dropDuplicates(["member"]), "texts")

    pairs = buckets.select(F.explode("leaders").alias("leader"), "member").where("member <> leader").distinct()
    parts = pairs.groupBy("leader").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("parts"))
    own = parts.select("leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("block"), F.col("leader").alias("member"))
    rest = C.spread_join(pairs, parts, ["leader"]).select("leader", F.pmod(F.xxhash64("member"), "parts").cast("int").alias("block"), "member")
    asked = own.unionByName(rest).join(texts, "member").select("leader", "block", "member", "text")
    dealt = asked.repartition("leader", "block").sortWithinPartitions("leader", "block", F.col("member") != F.col("leader"), "member")
    first = C.written(_verify_leaders(dealt, shingle, percent), "links")

    grouped = components(first)
    placed_in = buckets.join(grouped.withColumnRenamed("node", "member"), "member", "left").select(
        "bucket", "member", "leaders", F.coalesce("component", "member").alias("component"))
    members = placed_in.where(~F.array_contains("leaders", F.col("member"))).drop("leaders")
    kinds = members.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum(F.xxhash64("member").cast("decimal(38,0)")).alias("sign"))
    open_ = kinds.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("size"), F.max("n").alias("most"), F.sum("sign").alias("sign"))
    open_ = open_.where("most < size").groupBy("size", "sign").agg(F.min(F.struct("bucket", "main", "most")).alias("b")).select(
        F.col("b.bucket").alias("bucket"), F.col("b.main").alias("main"), F.ceil((F.col("size") - F.col("b.most")) / F.lit(REST)).cast("int").alias("rows"), F.ceil(F.col("size") / F.lit(4 * REST)).cast("int").alias("cols"))
    inside = C.spread_join(members, open_, ["bucket"])
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt_to = lambda n, salt: F.pmod(F.xxhash64("member", F.lit(salt)), n).cast("int")
    others = inside.select("bucket", every("rows").alias("i"), dealt_to("cols", 1).alias("j"), F.lit(False).alias("asks"), "member", "component")
    asking = inside.where("component <> main").select("bucket", dealt_to("rows", 2).alias("i"), every("cols").alias("j"), F.lit(True).alias("asks"), "member", "component")
    todo = others.unionByName(asking).join(texts, "member").select("bucket", "i", "j", "asks", "member", "component", "text")
    second = _verify_rest(todo.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "asks", "member"), shingle, percent)
    more = C.written(second, "links")
    if more.isEmpty():
        final = grouped
    else:
        stars = grouped.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")
        final = components(stars.unionByName(more))

    grouped_classes = classes.select("n", "s1", "s2", F.col("member").alias("node")).join(final, "node", "left").select(
        "n", "s1", "s2", F.coalesce("component", "node").alias("component"))
    rows = some.select("doc_id", "uid", "n", "s1", "s2").join(grouped_classes, ["n", "s1", "s2"])
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = C.spread_join(rows, least, ["component"]).select("doc_id", "uid", F.col("n").alias("n_shingles"), "component_id")
    out = out.unionByName(table.where("n = 0").select("doc_id", "uid", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:  # noqa: ANN003
    """The documents, with their own columns, without those that are near
    copies of one with a smaller id.  Rows without an id stay if their set is
    empty or no row with an id is in their group."""
    found = near_duplicates(docs, text=text, doc_id=doc_id, **options)
    uid = C.fresh("q_uid", docs.columns)
    stay = found.where(F.col("kept") | F.col("component_id").isNull()).select(F.col("uid").alias(uid)).distinct()
    return docs.withColumn(uid, C.row_uid(C.exactly(docs, doc_id), C.exactly(docs, text))).join(stay, uid, "left_semi").drop(uid)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.table(spark, sf_dir, "documents")).drop("uid")
