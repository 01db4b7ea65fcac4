"""Token-id files compressed by Re-Pair grammars, with random access.

Documents are dealt by ranges of their ids, sorted, encoded with the tokenizers
library and followed by an end id.  About ``SHARD_TOKENS`` ids (whole documents)
make a shard, a row of the file: the frequent adjacent pairs of its ids are
replaced by nonterminals, again and again, until no pair occurs ``LEAST`` times
(symbols are two bytes wide, or four in a shard that has more of them).
A shard holds the rules (two symbols each), the expansion length of each rule,
the remaining symbols, and its documents' ids and lengths; the file is Parquet
with these as binary columns, so any store that Spark writes will do and a lost
executor's work is done again whole.

Random access needs no full decode: the symbol that covers a place is found in
the running sum of expansion lengths, and only rules that overlap the wanted
range are opened.

A round replaces many pairs at once: pairs in order of frequency, ties by
symbols, each taken unless its left symbol ends or its right symbol begins a
pair already taken, so no two occurrences overlap.  Equal symbols in a row are
paired from the left.

Defined cases: a null text is empty and has the end id only; rows that repeat an
id stand one after the other in the order of their texts' hashes; a null id
comes first; an empty table gives an empty file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import work_path

from . import common as C
from .bpe import text_list, vocabulary
from .words import ByteWords, kept

SHARD_TOKENS = 1 << 20
#: Bytes of text, and documents, whose distinct words are looked up together.
ENCODE_BYTES, ENCODE_DOCS = 4 << 20, 4096
#: A pair is frequent if it occurs so often in a shard.
LEAST = 16
END = 0


# -- grammar ---------------------------------------------------------------

def _equal_pairs(seq: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the places ``at`` of pairs of equal symbols those that are paired, from
    the left of each run, and their symbols."""
    if not len(at):
        return at, at
    new = np.concatenate([[True], np.diff(at) > 1])
    start = at[np.flatnonzero(new)][np.cumsum(new) - 1]
    at = at[(at - start) % 2 == 0]
    return at, seq[at]


def _sorted_pairs(left: np.ndarray, right: np.ndarray, at: np.ndarray, wide: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of symbols of ``wide`` bits as numbers, in order, and beside them their
    places, in order for each pair, as the lowest ``bits`` bits of a number."""
    pairs = left.astype(np.int64)
    pairs <<= wide
    pairs |= right
    if 2 * wide + bits > 63:
        order = np.argsort(pairs, kind="stable")
        return pairs[order], at[order]
    pairs <<= bits
    pairs |= at
    both = np.sort(pairs)  # a pair and its place in one number
    return np.right_shift(both, bits, out=pairs), both


def repair(ids: np.ndarray, base: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """(rules (k, 2), sequence): symbol ``base + i`` stands for ``rules[i]``.

    A round never makes a pair of older symbols more frequent.  So it sorts and
    counts only pairs that hold a symbol of the last round or whose symbols begin
    and end pairs that were frequent in it."""
    seq = ids.astype(np.int32)
    rules: list[tuple[int, int]] = []
    at = np.arange(max(len(seq) - 1, 0))  # where a pair may be frequent
    while len(at):
        size = base + len(rules)
        wide, bits = int(size).bit_length(), len(seq).bit_length()
        low, place = (1 << wide) - 1, (1 << bits) - 1
        left, right = (seq[:-1], seq[1:]) if len(at) == len(seq) - 1 else (seq[at], seq[1:][at])
        pairs, places = _sorted_pairs(left, right, at, wide, bits)
        new = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        count = np.diff(np.concatenate([new, [len(pairs)]]))
        often = np.flatnonzero(count >= least)
        new, count = new[often], count[often]
        keys = pairs[new]
        begin, finish = keys >> wide, keys & low
        pair_at, pair_of = _equal_pairs(seq, at[left == right] if (begin == finish).any() else at[:0])
        doubles = dict(zip(*(x.tolist() for x in np.unique(pair_of, return_counts=True)), strict=True))
        heads, tails, taken, same = set(), set(), [], []
        order = np.argsort(-count, kind="stable")
        for i, a, b in zip(order.tolist(), begin[order].tolist(), finish[order].tolist(), strict=True):
            if a in tails or b in heads:
                continue
            if a == b:
                if a in heads or doubles.get(a, 0) < least:
                    continue
                same.append(a)
            else:
                taken.append(i)
            heads.add(a)
            tails.add(b)
        if not taken and not same:
            break
        live = np.zeros(len(seq), bool)
        live[at[_either(left, right, begin, finish, size)]] = True
        chosen = np.sort(np.array(taken, np.int64))
        at, name = places[C.ranges(new[chosen], count[chosen])] & place, np.repeat(size + np.arange(len(chosen)), count[chosen])
        rules += zip(begin[chosen].tolist(), finish[chosen].tolist(), strict=True)
        if same:
            double = np.sort(np.array(same, np.int64))
            nth = np.minimum(np.searchsorted(double, pair_of), len(double) - 1)
            hit = double[nth] == pair_of
            at, name = np.concatenate([at, pair_at[hit]]), np.concatenate([name, base + len(rules) + nth[hit]])
            rules += [(a, a) for a in double.tolist()]
        seq[at] = name
        live[at] = True
        live[at[at > 0] - 1] = True
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, live = seq[keep], live[keep]
        at = np.flatnonzero(live[:-1])
    return np.array(rules, np.int64).reshape(-1, 2), seq


def _either(left: np.ndarray, right: np.ndarray, begin: np.ndarray, finish: np.ndarray, size: int) -> np.ndarray:
    """The pairs that begin with one of ``begin`` and end with one of ``finish``."""
    begins, ends = np.zeros(size, bool), np.zeros(size, bool)
    begins[begin] = True
    ends[finish] = True
    return begins[left] & ends[right]


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - base] if a >= base else 1) + (out[b - base] if b >= base else 1))
    return np.array(out, np.int64)


def expand(rules: np.ndarray, lengths: np.ndarray, seq: np.ndarray, base: int) -> np.ndarray:
    """All ids of a shard."""
    texts: list[bytes] = []
    one = lambda s: texts[s - base] if s >= base else int(s).to_bytes(4, "little")
    for a, b in rules.tolist():
        texts.append(one(a) + one(b))
    flat = np.concatenate([np.arange(base, dtype=np.uint32), np.frombuffer(b"".join(texts), "<u4")])
    start = np.concatenate([np.arange(base), base + np.cumsum(lengths) - lengths])
    size = np.concatenate([np.ones(base, np.int64), lengths])
    return flat[C.ranges(start[seq], size[seq])]


def expand_range(rules: np.ndarray, lengths: np.ndarray, seq: np.ndarray, base: int, lo: int, hi: int) -> np.ndarray:
    """The ids [lo, hi) of a shard, opening only rules that overlap them."""
    size = np.where(seq >= base, lengths[np.maximum(seq - base, 0)] if len(lengths) else 1, 1)
    ends = np.cumsum(size)
    hi = min(hi, int(ends[-1]) if len(ends) else 0)
    if lo >= hi:
        return np.zeros(0, np.uint32)
    first, last = int(np.searchsorted(ends, lo, "right")), int(np.searchsorted(ends, hi, "left"))
    at = int(ends[first] - size[first])
    out: list[int] = []
    stack = [(int(s)) for s in seq[first : last + 1][::-1]]
    while stack and at < hi:
        s = stack.pop()
        n = int(lengths[s - base]) if s >= base else 1
        if at + n <= lo:
            at += n
        elif s >= base:
            stack += [int(rules[s - base, 1]), int(rules[s - base, 0])]
        else:
            out.append(s)
            at += 1
    return np.array(out, np.uint32)


# -- files -----------------------------------------------------------------

SHARD_SCHEMA = "part int, shard int, doc_ids array<long>, counts array<int>, n_tokens long, base int, width int, rules binary, lengths binary, symbols binary"


def symbol_type(width: int) -> str:
    """Symbols of a shard take two bytes, or four if there are more of them."""
    return f"<u{width}"


def write_ids(docs: DataFrame, vocabulary_path: str, path: str, text: str = "text", doc_id: str = "doc_id", end: int = END,
              shard_tokens: int = SHARD_TOKENS, least: int = LEAST) -> None:
    """Write the ids of all documents, in ascending order of their ids."""
    spec = vocabulary(docs.sparkSession, vocabulary_path)
    rows = docs.select(C.exactly(docs, doc_id).cast("long").alias("doc_id"), C.exactly(docs, text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = kept(ByteWords, spec)
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        size = 0

        def shard() -> pa.RecordBatch:
            ids = np.concatenate([h[1] for h in held])
            counts = np.concatenate([h[2] for h in held])
            rules, seq = repair(ids, enc.base, least)
            width = 2 if enc.base + len(rules) <= 1 << 16 else 4
            kind = symbol_type(width)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([[d for h in held for d in h[0]]], pa.list_(pa.int64())),
                pa.array([counts.tolist()], pa.list_(pa.int32())), pa.array([len(ids)], pa.int64()), pa.array([enc.base], pa.int32()), pa.array([width], pa.int32()),
                pa.array([rules.astype(kind).tobytes()], pa.binary()), pa.array([expansion_lengths(rules, enc.base).astype("<u4").tobytes()], pa.binary()), pa.array([seq.astype(kind).tobytes()], pa.binary()),
            ], names=["part", "shard", "doc_ids", "counts", "n_tokens", "base", "width", "rules", "lengths", "symbols"])

        for batch in batches:
            _, off = C.text_buffer(batch.column(1))
            for lo, hi in C.doc_chunks(off, ENCODE_BYTES, ENCODE_DOCS):
                flat, count = enc.encode(text_list(batch.column(1).slice(lo, hi - lo)))
                flat = np.insert(flat, np.cumsum(count), end)
                count, doc_ids = count + 1, batch.column(0).slice(lo, hi - lo).to_pylist()
                ends, done = np.cumsum(count), 0
                while done < len(count):
                    before = int(ends[done] - count[done])
                    # up to the document with which the shard is full
                    to = min(len(count), int(np.searchsorted(ends, before + shard_tokens - size)) + 1)
                    held.append((doc_ids[done:to], flat[before : ends[to - 1]], count[done:to]))
                    size, done = size + int(ends[to - 1]) - before, to
                    if size >= shard_tokens:
                        yield shard()
                        held, size, number = [], 0, number + 1
        if held:
            yield shard()

    rows.mapInArrow(C.tidy(run), SHARD_SCHEMA).write.parquet(path)


def _offsets(files: DataFrame) -> DataFrame:
    """(part, shard, begin): ids before each shard.  The driver sees one number
    a range partition."""
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before, rows = 0, []
    for r in parts:
        rows.append((r.part, before))
        before += r.n
    table = files.sparkSession.createDataFrame(rows, "part int, before long")
    from pyspark.sql import Window

    order = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = files.select("part", "shard", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("inside"))
    return inside.join(F.broadcast(table), "part").select("part", "shard", (F.col("before") + F.col("inside")).alias("begin"))


def _placed(files: DataFrame) -> DataFrame:
    """The shards with the ids before each.  The offsets (three numbers a shard of
    about a million ids) are broadcast, so that no shard is shuffled or sorted."""
    return files.join(F.broadcast(_offsets(files)), ["part", "shard"])


def _grammar(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    kind = symbol_type(row["width"])
    lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
    rules = np.frombuffer(row["rules"], kind).astype(np.int64).reshape(-1, 2)
    return rules, lengths, np.frombuffer(row["symbols"], kind).astype(np.int64), row["base"]


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32 and,
    with ``with_ids``, its ids."""
    files = spark.read.schema(SHARD_SCHEMA).parquet(path)
    placed = _placed(files)
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                rules, lengths, seq, base = _grammar(row)
                ids = expand(rules, lengths, seq, base).astype("<u4")
                counts = np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                crc = [zlib.crc32(ids[a:b].data) for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                cols = [pa.array(row["doc_ids"], pa.int64()), pa.array(row["begin"] + ends - counts), pa.array(counts), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return placed.mapInArrow(C.tidy(run), "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def read_range(spark: SparkSession, path: str, lo: int, hi: int) -> DataFrame:
    """(start, ids): the ids at places [lo, hi) of the whole corpus, a row for
    each shard that holds some; other shards are not opened."""
    files = spark.read.schema(SHARD_SCHEMA).parquet(path)
    placed = _placed(files).where((F.col("begin") < hi) & (F.col("begin") + F.col("n_tokens") > lo))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rules, lengths, seq, base = _grammar(row)
                a, b = max(0, lo - row["begin"]), min(row["n_tokens"], hi - row["begin"])
                got = expand_range(rules, lengths, seq, base, a, b)
                yield pa.RecordBatch.from_arrays([pa.array([row["begin"] + a], pa.int64()), pa.array([got.tolist()], pa.list_(pa.int32()))], names=["start", "ids"])

    return placed.mapInArrow(C.tidy(run), "start long, ids array<int>")


def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = work_path(spark, "llm", "tokens")
    write_ids(C.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return read_ids(spark, path, with_ids=False)
