"""Two tokenizers aligned on exact texts, and what their links share corpus-wide.

Texts are shuffled whole, so that each distinct text is tokenised and aligned
once however often it occurs; its pair counts weigh as many documents as hold it.
Its measures are joined back to the documents by a 256-bit hash of the text.

Both tokenizations of a text cover the same bytes.  The byte offsets at which
tokens of both end cut them into groups; the offsets at which a token of either
ends cut the text into intervals, each of which is one overlap of a token of the
one with a token of the other: a link.

A count of a pair of ids is the number of documents that hold it linked.  A chunk
of texts (about ``CHUNK_BYTES``) lists each of its pairs once, with the documents
that hold it, so the shuffle carries a row a chunk and pair, not a row a link; the
totals come back to the chunk, whose texts add them up.  No pair table is
broadcast.

Defined cases: a null or empty text, and one whose tokens of either kind do not
spell it (a model may normalise), has no tokens: its measures are zero and its
digest is empty; repeated rows and repeated or null ids are documents of their
own; an empty table gives an empty result; columns other than the two named are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .bpe import text_list, vocabulary
from .words import ByteWords, PieceWords, kept, piece_model

#: Bytes of text whose pairs are listed together.
CHUNK_BYTES = 8 << 20
#: Words that a worker keeps encoded, for each tokenizer.
CACHE = 400_000


class Alignment:
    """Token ids and ends of texts that lie end to end, and their links."""

    def __init__(self, a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray, text_ends: np.ndarray) -> None:
        self.a, self.b = a.astype(np.int64), b.astype(np.int64)
        both = np.concatenate([ends_a, ends_b])
        both.sort(kind="stable")
        twice = both[1:] == both[:-1]
        cuts = both[np.concatenate([[True], ~twice])] if len(both) else both
        self.common = both[1:][twice]  # where tokens of both end
        self.link_a, self.link_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        of = lambda ends: np.diff(np.concatenate([[0], np.searchsorted(ends, text_ends, "right")]))
        self.n_a, self.n_b, self.n_groups, self.n_links = of(ends_a), of(ends_b), of(self.common), of(cuts)
        self.ends_a, self.ends_b = ends_a, ends_b

    def written(self) -> tuple[np.ndarray, np.ndarray]:
        """Both id lists in the order of their groups as (id, mark) entries of
        one table: a's ids of a group, then b's.  Marks: 0 a comma follows, 1 a
        bar, 2 a semicolon."""
        group_a, group_b = np.searchsorted(self.common, self.ends_a), np.searchsorted(self.common, self.ends_b)
        n = len(self.common)
        before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=n))])  # b's tokens in earlier groups
        upto_a = np.cumsum(np.bincount(group_a, minlength=n))
        ids = np.empty(len(self.a) + len(self.b), np.int64)
        mark = np.zeros(len(ids), np.int64)
        at_a = np.arange(len(self.a)) + before_b[group_a]
        at_b = np.arange(len(self.b)) + upto_a[group_b]
        ids[at_a], ids[at_b] = self.a, self.b
        mark[at_a[upto_a - 1]] = 1
        mark[at_b[before_b[1:] - 1]] = 2
        return ids, mark


class _Digits:
    """Ids and the mark that follows, as bytes."""

    def __init__(self, most: int) -> None:
        texts = [f"{i}{m}".encode() for i in range(most) for m in ",|;"]
        self.texts = texts
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))

    def digests(self, ids: np.ndarray, mark: np.ndarray, per_text: np.ndarray) -> list[str]:
        """sha256 of each text's entries, without the last mark."""
        key = ids * 3 + mark
        joined = b"".join(map(self.texts.__getitem__, key.tolist()))
        total = np.concatenate([[0], np.cumsum(self.size[key])])
        ends = np.cumsum(per_text)
        view = memoryview(joined)
        return [hashlib.sha256(view[x : y - 1]).hexdigest() if x < y else "" for x, y in zip(total[ends - per_text].tolist(), total[ends].tolist(), strict=True)]


class _Bytes:
    """The bytes of ids, end to end."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))

    def spell(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


class _Aligner:
    """Texts to alignments; a worker's two encoders and their tables."""

    def __init__(self, a: ByteWords, b: PieceWords) -> None:
        self.a, self.b = a, b
        a.limit = b.limit = CACHE
        self.bytes_a, self.bytes_b = _Bytes(a.bytes_of()), _Bytes(b.bytes_of())
        self.digits = _Digits(max(a.base, b.base))

    def _kept(self, flat: np.ndarray, count: np.ndarray, spelt: _Bytes, raw: list[bytes]) -> list[bool]:
        whole, size = spelt.spell(flat), spelt.size[flat]
        total = np.concatenate([[0], np.cumsum(size)])
        ends = np.cumsum(count)
        return [whole[x:y] == r for x, y, r in zip(total[ends - count].tolist(), total[ends].tolist(), raw, strict=True)]

    def align(self, texts: list[str]) -> tuple[Alignment, np.ndarray]:
        """The alignment of the texts that both spell, and which these are."""
        spaced = [" " + t for t in texts]
        raw = [t.encode() for t in spaced]
        flat_a, n_a = self.a.encode(spaced)
        flat_b, n_b = self.b.encode(texts)
        good = np.array(self._kept(flat_a, n_a, self.bytes_a, raw), bool) & np.array(self._kept(flat_b, n_b, self.bytes_b, raw), bool)
        good &= np.fromiter(map(len, texts), np.int64, len(texts)) > 0
        flat_a, flat_b = flat_a[np.repeat(good, n_a)], flat_b[np.repeat(good, n_b)]
        size = np.fromiter(map(len, raw), np.int64, len(raw))[good]
        return Alignment(flat_a, np.cumsum(self.bytes_a.size[flat_a]), flat_b, np.cumsum(self.bytes_b.size[flat_b]), np.cumsum(size)), good


_ALIGNERS: dict[tuple[int, int], _Aligner] = {}


def _aligner(a: ByteWords, b: PieceWords) -> _Aligner:
    key = id(a), id(b)
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = _Aligner(a, b)
    return _ALIGNERS[key]


class _Chunk:
    """The aligned texts of a chunk: their measures, and their distinct pairs
    (a << 32 | b), rising within each text."""

    def __init__(self) -> None:
        self.size = 0
        self.measures: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []

    def add(self, aligner: _Aligner, texts: list[str], copies: np.ndarray) -> None:
        al, good = aligner.align(texts)
        self.size += sum(map(len, texts))
        pair = (al.a[al.link_a] << 32) | al.b[al.link_b]
        owner = np.repeat(np.arange(len(al.n_links)), al.n_links)
        order = np.lexsort((pair, owner))
        pair, owner = pair[order], owner[order]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        self.pairs.append(pair[first])
        self.times.append(np.diff(np.append(first, len(pair))))
        self.weights.append(copies[good][owner[first]])
        n_pairs = np.bincount(owner[first], minlength=len(al.n_links))
        keys = [hashlib.sha256(t.encode()).digest() for t, g in zip(texts, good.tolist(), strict=True) if g]
        digests = aligner.digits.digests(*al.written(), al.n_a + al.n_b)
        self.measures += zip(keys, al.n_a.tolist(), al.n_b.tolist(), al.n_groups.tolist(), al.n_links.tolist(), digests, n_pairs.tolist(), strict=True)

    def rows(self, chunk: int) -> Iterator[pa.RecordBatch]:
        if not self.measures:
            return
        pairs, weights = np.concatenate(self.pairs), np.concatenate(self.weights)
        order = np.argsort(pairs, kind="stable")
        new = np.ones(len(pairs), bool)
        new[1:] = pairs[order][1:] != pairs[order][:-1]
        first = np.flatnonzero(new)
        number = np.empty(len(pairs), np.int64)
        number[order] = np.cumsum(new) - 1
        yield _batch([chunk], [0], pairs=[pairs[order][first]], weights=[np.add.reduceat(weights[order], first)])
        n_pairs = np.array([m[6] for m in self.measures])
        ends = np.cumsum(n_pairs)
        step = np.diff(number, prepend=0)
        step[ends - n_pairs] = number[ends - n_pairs]
        links, times = _narrow(step), _narrow(np.concatenate(self.times))
        cut = lambda x: [x[i:j].tobytes() for i, j in zip((ends - n_pairs).tolist(), ends.tolist(), strict=True)]
        names = ("key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_pairs")
        n = len(self.measures)
        yield _batch([chunk] * n, [1] * n, **dict(zip(names, map(list, zip(*self.measures, strict=True)), strict=True)), links=cut(links), times=cut(times))


def _narrow(x: np.ndarray) -> np.ndarray:
    """Numbers in as few bytes each as hold them all."""
    most = int(x.max()) if len(x) else 0
    return x.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4")


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64)


#: A row of kind 0 lists a chunk's pairs and how many documents of the chunk hold
#: each; a row of kind 1 is a text: its links as numbers of the chunk's pairs
#: (steps between them) and how often each occurs.
_CHUNKS = {"chunk": pa.int64(), "kind": pa.int32(), "pairs": pa.list_(pa.int64()), "weights": pa.list_(pa.int64()), "key": pa.binary(), "n_a": pa.int64(), "n_b": pa.int64(),
           "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "n_pairs": pa.int64(), "links": pa.binary(), "times": pa.binary()}
CHUNKS = ("chunk long, kind int, pairs array<long>, weights array<long>, key binary, n_a long, n_b long, n_groups long, n_links long, "
          "groups_sha256 string, n_pairs long, links binary, times binary")
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _batch(chunk: list[int], kind: list[int], **columns: list) -> pa.RecordBatch:
    given = {"chunk": chunk, "kind": kind, **columns}
    return pa.RecordBatch.from_arrays([pa.array(given[c], t) if c in given else pa.nulls(len(chunk), t) for c, t in _CHUNKS.items()], names=list(_CHUNKS))


# -- Spark -----------------------------------------------------------------------

def _aligned(distinct: DataFrame, a_path: str, b_path: str, chunk_bytes: int) -> DataFrame:
    """The chunks of distinct texts (text, copies)."""
    spark = distinct.sparkSession
    a_spec, b_spec = vocabulary(spark, a_path), piece_model(spark, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(kept(ByteWords, a_spec, special=False), kept(PieceWords, b_spec))
        part, number, held = TaskContext.get().partitionId(), 0, _Chunk()
        for batch in batches:
            copies = batch.column(1).to_numpy()
            _, off = C.text_buffer(batch.column(0))
            for lo, hi in C.doc_chunks(off):
                held.add(aligner, text_list(batch.column(0).slice(lo, hi - lo)), copies[lo:hi])
                if held.size >= chunk_bytes:
                    yield from held.rows((part << 32) | number)
                    number, held = number + 1, _Chunk()
        yield from held.rows((part << 32) | number)

    return distinct.select("text", "copies").mapInArrow(C.tidy(run), CHUNKS)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, n, best): the documents that hold a pair linked, and whether no
    pair of its first id is held by more."""
    listed = chunks.where("kind = 0").select(F.explode(F.arrays_zip("pairs", "weights")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.weights").alias("w"))
    total = C.written(listed.groupBy("pair").agg(F.sum("w").alias("n")), "pairs").withColumn("a", F.shiftright("pair", 32))
    most = total.groupBy("a").agg(F.max("n").alias("most"))
    return C.spread_join(total, most, ["a"]).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _summed(chunks: DataFrame, counts: DataFrame) -> DataFrame:
    """The texts with n_best and count_sum.  A chunk's counts travel as one row,
    ahead of its texts."""
    listed = chunks.where("kind = 0").select("chunk", F.posexplode("pairs").alias("pos", "pair"))
    scored = C.spread_join(listed, counts, ["pair"]).select("chunk", F.struct("pos", (F.col("n") * 2 + F.col("best").cast("long")).alias("score")).alias("s"))
    scores = scored.groupBy("chunk").agg(F.collect_list("s").alias("s")).select("chunk", F.col("s.pos").alias("pos"), F.col("s.score").alias("score"))
    texts = chunks.where("kind = 1").select("chunk", "kind", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_pairs", "links", "times")
    rows = texts.unionByName(scores.select("chunk", F.lit(0).alias("kind"), "pos", "score"), allowMissingColumns=True)
    dealt = rows.repartition("chunk").sortWithinPartitions("chunk", "kind")
    names = ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = best = np.zeros(0, np.int64)
        for batch in batches:
            kind = batch.column("kind").to_pylist()
            pos, score = batch.column("pos"), batch.column("score")
            n_pairs, links, times = (batch.column(c).to_pylist() for c in ("n_pairs", "links", "times"))
            keep, sums, bests = [], [], []
            for i, k in enumerate(kind):
                if k == 0:
                    at, value = pos[i].values.to_numpy(), score[i].values.to_numpy()
                    count, best = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
                    count[at], best[at] = value >> 1, value & 1
                    continue
                which, often = np.cumsum(_wide(links[i], n_pairs[i])), _wide(times[i], n_pairs[i])
                keep.append(i)
                sums.append(int((count[which] * often).sum()))
                bests.append(int((best[which] * often).sum()))
            if keep:
                own = batch.select([n for n in names if n not in ("n_best", "count_sum")]).take(pa.array(keep))
                got = {n: own.column(n) for n in own.schema.names} | {"n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
                yield pa.RecordBatch.from_arrays([got[n] for n in names], names=names)

    return dealt.mapInArrow(C.tidy(run), "key binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", doc_id: str = "doc_id", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    body = C.exactly(docs, text).cast("string")
    distinct = docs.select(body.alias("text")).where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    chunks = C.written(_aligned(distinct, a_path, b_path, chunk_bytes), "aligned")
    measured = C.written(_summed(chunks, pair_counts(chunks)), "measured")
    ident = C.exactly(docs, doc_id)
    # a null text gets a key of 8 bytes that no text has, spread by its document
    key = F.coalesce(F.unhex(F.sha2(body, 256)), F.unhex(F.lpad(F.hex(F.xxhash64(ident)), 16, "0")))
    rows = docs.select(ident.alias("doc_id"), key.alias("key"))
    zero = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in MEASURES]
    return C.spread_join(rows, measured, ["key"], "left").select("doc_id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` by byte-level BPE and by a piece model."""
    import public_tokenizers

    return align(C.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
