"""Benchmark decontamination with training suffix arrays.

The documents are the training text.  Each task builds a word-level suffix
array of its shard (a chunk of documents) and binary-searches every test
suffix in it; the least and greatest match give all places of a window, and
word-by-word extension of each place gives the longest verbatim match.  Spark
then takes the longest match of a test suffix over all shards, and flags or
removes the documents that a test window occurs in.

The suffix array is sparse: a place at which no window can begin (its first
words occur in no window) is left out, which loses no match.  It is sorted to
the depth of a window, deeper comparison being the extension.

The hits of a document are the spans of its longest matches: matches are
extended from where a test suffix and a place begin to agree, all together, word
by word.

The benchmark is a stated query set.  It is read in blocks of a bounded size
(``BLOCK_BYTES`` of text, one item at least); a block is broadcast, its hits are
written, and it is let go before the next one is made, so the driver holds one.
The documents are never collected.

Words: A-Z lower-cased, then runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.  A
window is ``window`` consecutive words of an item; an item of fewer words, but
not none, is one window.

Defined cases: null or wordless texts have no words and no hits; a null or
wordless item has no window; a null item_id counts as an item of its own but
is left out of the list of ids; repeated items with one id count once;
repeated documents get equal rows; an empty benchmark flags nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

WINDOW = 10
#: Words that tell whether a window can begin at a place.
HEAD = 4
BLOCK_BYTES = 1 << 20
#: Pairs of a place and a test suffix that are extended together.
PAIRS = 1 << 21
#: What a byte becomes before words are split off: itself lower-cased, or a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class TestBlock:
    """A block of benchmark items: their words numbered from 1 and laid end to
    end (0 behind each item), and their distinct windows by length, each with
    the places of the suffixes that begin with it."""

    __test__ = False

    def __init__(self, items: list[tuple[str | None, str | None]], window: int) -> None:
        self.window = window
        texts = [words_of((t or "").encode()) for _, t in items]
        self.number = {w: i + 1 for i, w in enumerate(sorted({w for t in texts for w in t}))}
        self.ids = [i for i, _ in items]
        size = np.array([len(t) for t in texts], np.int64)
        self.start = np.cumsum(size + 1) - size - 1
        self.flat = np.zeros(int((size + 1).sum()), np.int32)
        for at, t in zip(self.start.tolist(), texts, strict=True):
            self.flat[at : at + len(t)] = np.fromiter(map(self.number.__getitem__, t), np.int32, len(t))
        length = np.minimum(size, window)
        count = np.where(size > 0, size - length + 1, 0)
        places, lengths = C.ranges(self.start, count), np.repeat(length, count)
        # window length: (distinct windows, where the suffixes of each begin, how many)
        self.groups: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in np.unique(lengths).tolist():
            own = places[lengths == n]
            rows = self.flat[own[:, None] + np.arange(n)]
            windows, which = np.unique(rows, axis=0, return_inverse=True)
            order = np.argsort(which.ravel(), kind="stable")
            self.groups[n] = (windows.astype(np.int64), own[order], np.bincount(which.ravel(), minlength=len(windows)))

    def item_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, place, "right") - 1


def sort_keys(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """The first ``depth`` words at each place as byte strings that compare as
    the words do (a suffix that ends early is followed by zeros)."""
    cols = [words[places + i] for i in range(depth)]
    return np.ascontiguousarray(np.stack(cols, axis=1).astype(">u4")).view(f"S{4 * depth}").ravel()


def head_hash(words: np.ndarray, places: np.ndarray | slice, depth: int) -> np.ndarray:
    h = np.zeros(1, np.uint64)
    for i in range(depth):
        part = words[i : len(words) - depth + 1 + i] if isinstance(places, slice) else words[places + i]
        h = h * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64)
    return (h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(42)


class Shard:
    """A sparse suffix array of the words of a chunk of documents, for windows
    of one length.  ``words`` has ``depth`` zeros after each document, zero
    being a word of no item."""

    def __init__(self, words: np.ndarray, windows: np.ndarray) -> None:
        self.words, self.windows = words, windows
        depth = windows.shape[1]
        head = min(depth, HEAD)
        can = np.zeros(1 << 22, bool)
        can[head_hash(windows.ravel(), np.arange(len(windows)) * depth, head)] = True
        places = np.flatnonzero(can[head_hash(words, slice(None), head)] & (words[: len(words) - head + 1] > 0))
        places = places[places + depth <= len(words)]
        keys = sort_keys(words, places, depth)
        order = np.argsort(keys, kind="stable")
        self.array, self.keys = places[order], keys[order]

    def find(self) -> tuple[np.ndarray, np.ndarray]:
        """Per window the range of the suffix array that begins with it."""
        tests = np.ascontiguousarray(self.windows.astype(">u4")).view(f"S{4 * self.windows.shape[1]}").ravel()
        return np.searchsorted(self.keys, tests, "left"), np.searchsorted(self.keys, tests, "right")


def shard_words(block: TestBlock, texts: list[list[bytes]], gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all documents, ``gap`` zeros after each; where each begins."""
    number = block.number
    count = np.fromiter(map(len, texts), np.int64, len(texts))
    start = np.cumsum(count + gap) - count - gap
    words = np.zeros(int((count + gap).sum()) + gap, np.int64)
    for s, t in zip(start.tolist(), texts, strict=True):
        words[s : s + len(t)] = np.fromiter((number.get(w, 0) for w in t), np.int64, len(t))
    return words, start


def shard_hits(block: TestBlock, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(window length, window numbers, places) of every occurrence."""
    for n, (windows, _, _) in block.groups.items():
        shard = Shard(words, windows)
        lo, hi = shard.find()
        yield n, np.repeat(np.arange(len(windows)), hi - lo), shard.array[C.ranges(lo, hi - lo)]


def _item_sizes(block: TestBlock) -> np.ndarray:
    return np.diff(np.append(block.start, len(block.flat))) - 1


def matches(block: TestBlock, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, test place, words) of every longest match: a place and a test
    suffix that agree on a window or more, and not on the word before."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    flat = block.flat
    for n, which, at in shard_hits(block, words):
        _, suffixes, count = block.groups[n]
        first = np.cumsum(count) - count
        total = np.cumsum(count[which])
        for lo in range(0, int(total[-1]) if len(total) else 0, PAIRS):  # pairs by number, whatever window they are of
            pair = np.arange(lo, min(lo + PAIRS, int(total[-1])))
            hit = np.searchsorted(total, pair, "right")
            place = at[hit]
            test = suffixes[first[which[hit]] + pair - (total[hit] - count[which[hit]])]
            # no word of a document is 0, and 0 stands between items
            before = (place > 0) & (test > 0)
            begins = ~before | (words[np.maximum(place, 1) - 1] != flat[np.maximum(test, 1) - 1]) | (flat[np.maximum(test, 1) - 1] == 0)
            place, test = place[begins], test[begins]
            size = np.full(len(place), n, np.int64)
            live = np.arange(len(place))
            while len(live):
                ours, theirs = words[place[live] + size[live]], flat[test[live] + size[live]]
                live = live[(ours == theirs) & (theirs > 0)]
                size[live] += 1
            out.append((place, test, size))
    parts = list(zip(*out, strict=True)) or [[np.zeros(0, np.int64)]] * 3
    place, test, size = (np.concatenate(p) for p in parts)
    return place, test, size


def test_blocks(benchmark: DataFrame, item: str, text: str, window: int, block_bytes: int) -> Iterator[TestBlock]:
    """The benchmark in blocks of ``block_bytes``, streamed to the driver one
    Spark partition at a time; rows in item order."""
    cols = benchmark.select(C.exactly(benchmark, item).cast("string").alias("i"), C.exactly(benchmark, text).alias("t"))
    rows, size = [], 0
    for r in cols.orderBy("i", "t").toLocalIterator():
        rows.append((r.i, r.t))
        size += len(r.t or "")
        if size >= block_bytes:
            yield TestBlock(rows, window)
            rows, size = [], 0
    if rows:
        yield TestBlock(rows, window)


_LONGEST = pa.struct([("words", pa.int64()), ("word", pa.int64()), ("item", pa.string()), ("item_word", pa.int64())])
_LONGEST_TYPE = T.StructType([T.StructField("words", T.LongType()), T.StructField("word", T.LongType()), T.StructField("item", T.StringType()), T.StructField("item_word", T.LongType())])


def _scan(docs: DataFrame, block: TestBlock, window: int, text: str, keep: list[str]) -> DataFrame:
    """Pass ``keep`` columns through and add the longest match, n_words, hits
    (the places of hit words, as starts and ends of runs) and items (ids of items
    met)."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    source, taken = C.fresh("q_text", keep), list(keep)
    frame = docs.select(*[C.exactly(docs, c) for c in keep], C.exactly(docs, text).alias(source))
    added = [C.fresh(c, taken) for c in ("q_longest", "q_words", "q_from", "q_to", "q_items", "q_nulls")]
    schema = docs.select(*[C.exactly(docs, c) for c in keep]).schema
    for name, kind in zip(added, (_LONGEST_TYPE, T.LongType(), T.ArrayType(T.IntegerType()), T.ArrayType(T.IntegerType()), T.ArrayType(T.StringType()), T.IntegerType()), strict=True):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = shared.value
        for batch in batches:
            buf, off = C.text_buffer(batch.column(len(keep)))
            for lo, hi in C.doc_chunks(off, 4 * C.CHUNK_BYTES):
                raw = buf[off[lo] : off[hi]].tobytes()
                base = int(off[lo])
                texts = [words_of(raw[off[k] - base : off[k + 1] - base]) for k in range(lo, hi)]
                words, start = shard_words(b, texts, window)
                place, test, size = matches(b, words)
                doc, own = np.searchsorted(start, place, "right") - 1, b.item_of(test)
                a, z = C.merged_spans(place, place + size)
                owner = np.searchsorted(start, a, "right") - 1
                cut = np.searchsorted(owner, np.arange(hi - lo + 1)).astype(np.int32)
                pairs = np.unique(doc * len(b.ids) + own)
                item_doc, item = pairs // max(1, len(b.ids)), pairs % max(1, len(b.ids))
                names: list[list[str]] = [[] for _ in texts]
                nulls = np.zeros(len(texts), np.int32)
                for d, i in zip(item_doc.tolist(), item.tolist(), strict=True):
                    if b.ids[i] is None:
                        nulls[d] += 1
                    else:
                        names[d].append(b.ids[i])
                # the longest match of each document: the first place, then the first test place, of equal ones
                best = np.lexsort((test, place, -size, doc))
                lead = best[np.flatnonzero(np.diff(doc[best], prepend=-1))]
                longest: list[tuple | None] = [None] * len(texts)
                for d, w, p, i, q in zip(doc[lead].tolist(), size[lead].tolist(), (place - start[doc])[lead].tolist(), own[lead].tolist(), (test - b.start[own])[lead].tolist(), strict=True):
                    longest[d] = {"words": w, "word": p, "item": b.ids[i], "item_word": q}
                part = batch.slice(lo, hi - lo)
                cols = [part.column(i) for i in range(len(keep))]
                cols += [pa.array(longest, _LONGEST), pa.array(list(map(len, texts)), pa.int64()), *[pa.ListArray.from_arrays(pa.array(cut), pa.array((x - start[owner]).astype(np.int32))) for x in (a, z)], pa.array(names, pa.list_(pa.string())), pa.array(nulls)]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return frame.mapInArrow(C.tidy(run), schema)


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item: str = "item_id", item_text: str = "text",
         keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` columns (all, if not given) of every document, with n_words,
    n_hit, n_items, items (sorted as strings), contaminated, and longest (words,
    word, item, item_word), its longest verbatim match and where it stands."""
    keep = list(docs.columns) if keep is None else list(keep)
    row = C.fresh("q_row", keep)
    blocks = test_blocks(benchmark, item, item_text, window, block_bytes)
    block, following = next(blocks, None) or TestBlock([], window), next(blocks, None)
    added = [C.fresh(c, keep) for c in ("q_longest", "q_words", "q_from", "q_to", "q_items", "q_nulls")]
    if following is None:
        found = _scan(docs, block, window, text, keep)
        longest, n, a, z, items, nulls = (C.exactly(found, c) for c in added)
        hit = F.aggregate(F.zip_with(z, a, lambda x, y: x - y), F.lit(0), lambda acc, x: acc + x)
        out = [C.exactly(found, c) for c in keep]
    else:
        # a block at a time, written; a document's spans and items meet by its row identity
        columns = [C.exactly(docs, c) for c in docs.columns if not _is_map(docs, c)]
        ids = docs.withColumn(row, F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(salt), *columns)), 16, "0") for salt in (1, 2)]))
        whole = None
        while block is not None:
            part = C.written(_scan(ids, block, window, text, [row]).distinct(), "block")
            whole = part if whole is None else whole.unionByName(part)
            block, following = following, next(blocks, None)
        order = F.struct(*[F.col(f"{added[0]}.{f}") * sign for f, sign in (("words", 1), ("word", -1))])
        per = whole.groupBy(row).agg(
            F.max_by(added[0], order).alias(added[0]),
            F.max(added[1]).alias(added[1]), F.flatten(F.collect_list(F.arrays_zip(added[2], added[3]))).alias(added[2]),
            F.flatten(F.collect_set(added[4])).alias(added[4]), F.sum(added[5]).alias(added[5]))
        found = ids.join(per, row)
        longest, n, items, nulls = (C.exactly(found, added[i]) for i in (0, 1, 4, 5))
        places = F.flatten(F.transform(C.exactly(found, added[2]), lambda s: F.sequence(s[added[2]], s[added[3]] - 1)))
        hit = F.size(F.array_distinct(places))
        out = [C.exactly(found, c) for c in keep]
    items = F.array_sort(F.array_distinct(items))
    return found.select(*out, n.alias(C.fresh("n_words", keep)), hit.cast("long").alias(C.fresh("n_hit", keep)),
                        (F.size(items) + nulls).cast("long").alias(C.fresh("n_items", keep)), items.alias(C.fresh("items", keep)),
                        longest.alias(C.fresh("longest", keep)), (hit > 0).alias(C.fresh("contaminated", keep)))


def _is_map(df: DataFrame, name: str) -> bool:
    return "map<" in dict(df.dtypes)[name]


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
                    item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per test suffix (item_id, item_word) that begins with an occurring
    window: the longest verbatim match in any shard (n_words), how many places
    have it, and the least of them (doc_id, doc_word)."""
    out = None
    frame = docs.select(C.exactly(docs, doc_id).alias("doc_id"), C.exactly(docs, text).alias("text"))
    for block in test_blocks(benchmark, item, item_text, window, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            b = shared.value
            for batch in batches:
                buf, off = C.text_buffer(batch.column(1))
                ids = batch.column(0)
                for lo, hi in C.doc_chunks(off, 4 * C.CHUNK_BYTES):
                    texts = [words_of(buf[off[k] : off[k + 1]].tobytes()) for k in range(lo, hi)]
                    words, start = shard_words(b, texts, window)
                    place, test, size = matches(b, words)
                    # a match is also one of each of its own later suffixes, as long as a window is left
                    least = np.minimum(window, _item_sizes(b)[b.item_of(test)])
                    more = size - least + 1
                    shift = C.ranges(np.zeros(len(place), np.int64), more)
                    place, test, size = np.repeat(place, more) + shift, np.repeat(test, more) + shift, np.repeat(size, more) - shift
                    own = np.searchsorted(start, place, "right") - 1
                    key = [batch.column(0).slice(lo, hi - lo).to_pylist()[d] for d in own.tolist()]
                    best: dict[int, list] = {}
                    for q, w, k, p in zip(test.tolist(), size.tolist(), key, (place - start[own]).tolist(), strict=True):
                        at = ((k is None, k if k is not None else 0, p), k)
                        have = best.get(q)
                        if have is None or w > have[0]:
                            best[q] = [w, 1, at]
                        elif w == have[0]:
                            have[1] += 1
                            have[2] = min(have[2], at, key=lambda x: x[0])
                    tests = np.array(list(best), np.int64)
                    items = b.item_of(tests)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([b.ids[i] for i in items.tolist()], pa.string()), pa.array(tests - b.start[items]), pa.array([v[0] for v in best.values()], pa.int64()), pa.array([v[1] for v in best.values()], pa.int64()),
                        pa.array([v[2][1] for v in best.values()], ids.type), pa.array([v[2][0][2] for v in best.values()], pa.int64())], names=["item_id", "item_word", "n_words", "n_places", "doc_id", "doc_word"])

        kind = frame.schema["doc_id"].dataType.simpleString()
        found = frame.mapInArrow(C.tidy(run), f"item_id string, item_word long, n_words long, n_places long, doc_id {kind}, doc_word long")
        out = found if out is None else out.unionByName(found)
    if out is None:
        kind = frame.schema["doc_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id string, item_word long, n_words long, n_places long, doc_id {kind}, doc_word long")
    best = out.groupBy("item_id", "item_word").agg(F.max("n_words").alias("n_words"))
    return out.join(best, ["item_id", "item_word", "n_words"]).groupBy("item_id", "item_word", "n_words").agg(
        F.sum("n_places").alias("n_places"), F.min(F.struct("doc_id", "doc_word")).alias("at")).select("item_id", "item_word", "n_words", "n_places", "at.doc_id", "at.doc_word")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:  # noqa: ANN003
    """The documents, with their own columns, in which no window occurs."""
    flagged = hits(docs, benchmark, **options)
    name = flagged.columns[-1]
    return flagged.where(~C.exactly(flagged, name)).select(*[C.exactly(flagged, c) for c in docs.columns])


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hits(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")

