"""Helpers shared by the operators of this subpackage: Arrow text buffers,
vectorised word spans and hashes, sliding minima, row identities.

Everything here works on one Arrow batch inside a task; Spark does the
partitioning, shuffling and joining.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import work_path

#: Bytes of text, and documents, that a task works on at a time.
CHUNK_BYTES, CHUNK_DOCS = 1 << 20, 1024
#: White space of the word rules: \x20 and \x09-\x0D.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, byte by byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MASK64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the cluster's shared folder and read back."""
    path = work_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str, taken: list[str]) -> str:
    """A column name that clashes with none of ``taken`` (case ignored)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def exactly(df: DataFrame, name: str) -> Column:
    """The column called ``name``, whatever dots or quotes are in it."""
    return df["`" + name.replace("`", "``") + "`"]


def row_uid(doc_id: Column, text: Column) -> Column:
    """Identity of a row by content, 128 bits: rows that repeat an id with another
    text stay apart; rows equal in both get the same verdict."""
    halves = [F.lpad(F.hex(h), 16, "0") for h in (F.xxhash64(doc_id, text), F.xxhash64(F.lit("second"), text, doc_id))]
    return F.unhex(F.concat(*halves))


def spread_join(rows: DataFrame, found: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` to an aggregate of them.  The keys' own hash is joined on
    too, so that the aggregate, which is dealt by the keys already, gets an
    exchange of its own; between two exchanges Spark can split a hot key."""
    own = F.xxhash64(*keys)
    mark = fresh("q_hash", rows.columns + found.columns)
    return rows.withColumn(mark, own).join(found.withColumn(mark, own), [*keys, mark], how).drop(mark)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, handing Arrow's unused memory back at the end of
    each task: Python workers outlive their tasks."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return wrapped


# -- text buffers ---------------------------------------------------------

def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and its n+1 offsets
    (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64, len(col) + 1, 8 * col.offset)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def doc_chunks(off: np.ndarray, limit: int = CHUNK_BYTES, docs: int = CHUNK_DOCS) -> Iterator[tuple[int, int]]:
    """Runs [lo, hi) of at most ``docs`` whole documents of about ``limit`` bytes."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = min(n, lo + docs, max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1))
        yield lo, hi
        lo = hi


def word_spans(buf: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all documents in ``buf`` and, per
    document, the number of the first word (n+1 values).  A word never spans
    two documents."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = is_word[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    before = np.empty(len(buf), bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(buf), bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


# -- hashes ---------------------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                have = getattr(self, name)
                setattr(self, name, np.concatenate([have, have * np.uint64(pow(base, k, 1 << 64))]))
        return self.up[:n], self.down[:n]


POWERS = Powers()


class RangeHash:
    """64-bit hashes of any ranges of a sequence of 64-bit codes, each in O(1)
    after one cumulative sum; equal ranges hash equal wherever they stand.

    A polynomial modulo 2^64 tells ranges apart up to some hundreds of codes; from
    1,024 on some ranges collide whatever its base is (Thue-Morse sequences).
    Words of any length are hashed by :func:`word_hashes`, and where equality
    is decided :class:`PrimeHash` is asked too."""

    def __init__(self, codes: np.ndarray) -> None:
        up, self.down = POWERS.upto(len(codes) + 1)
        self.total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[:-1], out=self.total[1:])

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        raw = (self.total[hi] - self.total[lo]) * self.down[lo]
        return mix64(raw + (np.asarray(hi) - np.asarray(lo)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def byte_codes(buf: np.ndarray) -> np.ndarray:
    return _BYTE_CODES[buf]


_PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
_SEEDS = (1_103_515_245, 741_103_597)


class PrimeHash:
    """As :class:`RangeHash`, of another family: polynomials modulo two primes,
    62 bits together."""

    def __init__(self, codes: np.ndarray) -> None:
        n = len(codes) + 1
        self.tables = []
        for p, seed in zip(_PRIMES, _SEEDS, strict=True):
            up, down = (_prime_powers(x, p, n) for x in (seed, pow(seed, -1, p)))
            total = np.zeros(n, np.uint64)
            # terms are below 2^31, so the running sum of 2^33 of them is exact
            np.cumsum(codes % np.uint64(p) * up[:-1] % np.uint64(p), out=total[1:])
            self.tables.append((np.uint64(p), total, down))

    def of(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        a, b = ((total[hi] - total[lo]) % p * down[lo] % p for p, total, down in self.tables)
        return (a << np.uint64(31)) ^ b


def _prime_powers(x: int, p: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(x, len(out), p)) % np.uint64(p)])
    return out[:n]


#: Longer words are hashed one by one.
_LONG_WORD = 64


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, second: bool = False) -> np.ndarray:
    """A 64-bit hash of each word; ``second``: another, independent of the first."""
    codes = byte_codes(buf)
    out = RangeHash(mix64(codes) if second else codes).of(starts, ends)
    for i in np.flatnonzero(ends - starts > _LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(buf[starts[i] : ends[i]].tobytes(), seed=int(second))
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# -- minimizers -----------------------------------------------------------

def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of ``w`` values (blockwise prefix and suffix
    minima, so the cost does not depend on ``w``)."""
    n = len(v)
    if n < w:
        return v[:0]
    padded = np.full(-(-n // w) * w, np.iinfo(v.dtype).max, v.dtype)
    padded[:n] = v
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def minimizer_of_window(order: np.ndarray, w: int) -> np.ndarray:
    """For each window of ``w`` consecutive values the place of its least one,
    leftmost among equals; so equal windows choose the same place."""
    bits = np.uint64(max(1, int(len(order)).bit_length()))
    place = np.arange(len(order), dtype=np.uint64)
    keyed = ((order >> bits) << bits) | place
    return (sliding_min(keyed, w) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def window_runs(chosen: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [a, b) of valid windows that chose the same place."""
    if not len(chosen):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.where(valid, chosen, -1)
    change = np.flatnonzero(np.diff(key)) + 1
    a = np.concatenate([[0], change])
    b = np.concatenate([change, [len(key)]])
    keep = key[a] >= 0
    return a[keep], b[keep]


def ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[0], lo[0]+1, ... (n[0] of them), lo[1], ..., end to end."""
    total = int(n.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(n) - n
    out = np.repeat(np.asarray(lo, np.int64) - first, n)
    out += np.arange(total, dtype=np.int64)
    return out


def merged_spans(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of overlapping or touching spans [lo, hi), in order."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    first = np.flatnonzero(new)
    return lo[first], hi[np.concatenate([first[1:] - 1, [len(lo) - 1]])]
