"""Byte-level BPE encoding and decoding with a segment tree over pair ranks.

Each pretoken is a row of symbols.  A segment tree stands over its adjacent
pairs; a leaf holds (rank of the pair, place), so the root is the leftmost
pair of the lowest rank.  A merge changes three leaves (the pair itself and
its two neighbours) and their ancestors, O(log n), and the loop ends when the
root holds no mergeable pair.  Short pretokens go through one numpy tree for
many of them at once, long ones through a tree of their own, so a pretoken of
a million letters costs n log n.

Texts are whole: nothing is cut.  A text is split where a space stands before
a character that is not white space - there a pretoken always starts - and
pieces already met in the task come from a bounded cache.

Defined cases: a null text encodes as the empty text (0 ids); the special
token's string in a text is its own id, as the tokenizers library has it by
default; repeated rows give repeated results; extra columns are ignored by
``encode`` unless named in ``keep``.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

#: Fixed value: the published pre-tokenisation pattern of byte-level BPE
#: (white space by its Unicode property).
PRETOKENS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: A space before white space or the end: there pieces must stay together.
_SPACE_RUN = re.compile(r" (?:\s|\Z)")
#: A vocabulary file over this size is not broadcast.
MAX_VOCAB_BYTES = 64 << 20
#: Pieces that a task keeps encoded; the store is let go at the end of the task.
CACHE_PIECES = 300_000
NEVER = np.iinfo(np.int32).max


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable Latin-1 stands for itself, the rest for U+0100 onwards."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(own))}
    return [chr(rest.get(b, b)) for b in range(256)]


class Vocabulary:
    """Merge table and token bytes of a byte-level BPE file."""

    def __init__(self, spec: str) -> None:
        model = json.loads(spec)
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        letters = byte_letters()
        to_byte = {c: b for b, c in enumerate(letters)}
        self.byte_id = np.array([vocab[c] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.base = 1 + max([*vocab.values(), *(t["id"] for t in model["added_tokens"])])
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.product = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * self.base + right
        _, first = np.unique(keys, return_index=True)
        self.keys, self.rank = keys[first], first.astype(np.int64)
        self.rank_of = dict(zip(self.keys.tolist(), self.rank.tolist(), strict=True))
        self.product = self.product.astype(np.int32)
        self._hash_pairs()
        two = self.byte_id[:, None] * self.base + self.byte_id[None, :]
        self.byte_pair_rank = self.ranks(np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256)).reshape(two.shape)
        self.bytes_of: list[bytes] = [b""] * self.base
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(to_byte[c] for c in token)
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def _hash_pairs(self) -> None:
        """An open-addressed table of the pairs, a quarter full."""
        bits = max(4, int(len(self.keys) * 4 - 1).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), np.full((1 << bits) + 64, -1, np.int64)
        self.slot_rank = np.full(len(self.slots), -1, np.int32)
        place, key, rank, self.probes = self._slot(self.keys), self.keys, self.rank, 0
        while len(key):
            free = np.flatnonzero(self.slots[place] < 0)
            at, first = np.unique(place[free], return_index=True)
            took = free[first]
            self.slots[at], self.slot_rank[at] = key[took], rank[took]
            left = np.ones(len(key), bool)
            left[took] = False
            place, key, rank, self.probes = place[left] + 1, key[left], rank[left], self.probes + 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids (-1: none), int32."""
        key = a.astype(np.int64) * self.base + b
        at = self._slot(key)
        have = self.slots[at]
        out = np.where(have == key, self.slot_rank[at], np.int32(-1))
        open_ = np.flatnonzero((have != key) & (have >= 0))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            at[open_] += 1
            have = self.slots[at[open_]]
            hit = have == key[open_]
            out[open_[hit]] = self.slot_rank[at[open_[hit]]]
            open_ = open_[~hit & (have >= 0)]
        return out


# -- segment trees --------------------------------------------------------

def merge_many(v: Vocabulary, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encode rows of ``words`` (n, L) bytes, L a power of two, of which the
    first ``lengths`` count.  Returns all ids end to end and the count of each
    row.  One tree a row, all rows a merge further in each round; the arrays
    are flat, row after row."""
    n, width = words.shape
    bits = width.bit_length()
    low = np.int32((1 << bits) - 1)
    place = np.arange(width, dtype=np.int32)
    sym = v.byte_id[words].astype(np.int32).ravel()
    nxt = np.tile(place + 1, n)
    prv = np.tile(place - 1, n)
    alive = (place[None, :] < lengths[:, None]).ravel()
    tree = np.full((n, 2 * width), NEVER, np.int32)
    r = v.byte_pair_rank[words[:, :-1], words[:, 1:]]
    tree[:, width:-1] = np.where((place[None, 1:] < lengths[:, None]) & (r >= 0), (r << bits) | place[None, :-1], NEVER)
    level = width
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2
    tree = tree.ravel()
    rows = np.flatnonzero(tree[1 :: 2 * width] != NEVER)
    ends = lengths.astype(np.int32)

    def put(top: np.ndarray, leaf: np.ndarray, value: np.ndarray | np.int32) -> None:
        """Set leaves (of trees that begin at ``top``) and their ancestors."""
        node = leaf + np.int32(width)
        tree[top + node] = value
        for _ in range(bits - 1):
            child = top + (node & np.int32(-2))
            node = node >> 1
            tree[top + node] = np.minimum(tree[child], tree[child + 1])

    while len(rows):
        row, top = rows * width, rows * (2 * width)
        root = tree[top + 1]
        at, rank = root & low, root >> bits
        gone = nxt[row + at]
        after = nxt[row + gone]
        before = prv[row + at]
        new = v.product[rank]
        sym[row + at] = new
        alive[row + gone] = False
        nxt[row + at] = after
        put(top, gone, NEVER)
        has = after < ends[rows]
        r = v.ranks(new, sym[row + np.where(has, after, 0)])
        put(top, at, np.where(has & (r >= 0), (r << bits) | at, NEVER))
        prv[(row + after)[has]] = at[has]
        has = np.flatnonzero(before >= 0)
        if len(has):
            near = before[has]
            r = v.ranks(sym[row[has] + near], new[has])
            put(top[has], near, np.where(r >= 0, (r << bits) | near, NEVER))
        rows = rows[tree[top + 1] != NEVER]
    return sym[alive], alive.reshape(n, width).sum(axis=1)


def merge_one(v: Vocabulary, symbols: list[int]) -> list[int]:
    """The same for one long word, with a tree of plain numbers."""
    n = len(symbols)
    width = 1 << max(1, (n - 1).bit_length())
    sym, nxt, prv = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    base, rank_of = v.base, v.rank_of
    never = 1 << 62
    tree = [never] * (2 * width)
    for i in range(n - 1):
        if (r := rank_of.get(sym[i] * base + sym[i + 1])) is not None:
            tree[width + i] = r * width + i
    for i in range(width - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def put(leaf: int, value: int) -> None:
        i = leaf + width
        tree[i] = value
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
            i >>= 1

    alive = bytearray(b"\1" * n)
    while tree[1] != never:
        rank, at = divmod(tree[1], width)
        gone = nxt[at]
        after, before = nxt[gone], prv[at]
        sym[at] = new = int(v.product[rank])
        alive[gone] = 0
        nxt[at] = after
        put(gone, never)
        value = never
        if after < n:
            prv[after] = at
            if (r := rank_of.get(new * base + sym[after])) is not None:
                value = r * width + at
        put(at, value)
        if before >= 0:
            r = rank_of.get(sym[before] * base + new)
            put(before, never if r is None else r * width + before)
    return [s for s, a in zip(sym, alive, strict=True) if a]


class Pieces(dict):
    """Numbers pieces in the order in which they are first met."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = i = len(self)
        self.new.append(key)
        return i


class Rows:
    """Growing rows of ids: flat values and offsets."""

    def __init__(self) -> None:
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.count, self.n = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32), 0

    def add(self, flat: np.ndarray, count: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.n + len(count) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.start[self.n : self.n + len(count)] = self.used + np.cumsum(count) - count
        self.count[self.n : self.n + len(count)] = count
        self.used += len(flat)
        self.n += len(count)

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = self.count[which].astype(np.int64)
        return self.flat[C.ranges(self.start[which], count)], count


def split_pieces(text: str) -> list[str]:
    """Pieces between which pretokens never reach: the first as it is, the
    others without the space before them."""
    if not _SPACE_RUN.search(text):
        return text.split(" ")
    out: list[str] = []
    for i, p in enumerate(text.split(" ")):
        if i and (not p or p[0].isspace()):
            out[-1] += " " + p
        else:
            out.append(p)
    return out


class Encoder:
    """Encodes texts; keeps a bounded number of pieces it has met."""

    def __init__(self, v: Vocabulary, limit: int = CACHE_PIECES) -> None:
        self.v, self.limit = v, limit
        self.forget()

    def forget(self) -> None:
        self.pieces, self.words = Pieces(), Pieces()
        self.piece_words, self.word_ids = Rows(), Rows()
        self.piece_ids = Rows()

    def _learn(self) -> None:
        """Encode the pieces met since the last call."""
        counts, members = [], []
        word = self.words.__getitem__
        for p in self.pieces.new:
            # a piece that followed a space has lost it; a leading space marks one that had none
            if p.isalpha():
                counts.append(1)
                members.append(word(" " + p))
                continue
            found = PRETOKENS.findall(p[1:] if p[:1] == " " else " " + p)
            counts.append(len(found))
            members.extend(map(word, found))
        self.pieces.new = []
        self._learn_words()
        which, counts = np.array(members, np.int64), np.array(counts, np.int64)
        flat, n = self.word_ids.gather(which)
        total = np.concatenate([[0], np.cumsum(n)])
        ends = np.cumsum(counts)
        self.piece_ids.add(flat, total[ends] - total[ends - counts])

    def _learn_words(self) -> None:
        raw = [w.encode() for w in self.words.new]
        self.words.new = []
        if not raw:
            return
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        buf = np.frombuffer(b"".join(raw), np.uint8)
        start = np.cumsum(lengths) - lengths
        flat_parts, at_parts, n_parts = [], [], []
        low = 0
        for width in (1, 2, 4, 8, 16, 32, 64):
            mine = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            step = max(1, (1 << 20) // (4 * width))
            for i in range(0, len(mine), step):
                rows = mine[i : i + step]
                place = start[rows][:, None] + np.arange(width)
                byte = buf[np.minimum(place, len(buf) - 1)]
                if width == 1:
                    flat, n = self.v.byte_id[byte.ravel()], np.ones(len(rows), np.int64)
                else:
                    flat, n = merge_many(self.v, byte, lengths[rows])
                flat_parts.append(flat)
                at_parts.append(rows)
                n_parts.append(n)
        for i in np.flatnonzero(lengths > low):
            ids = merge_one(self.v, self.v.byte_id[buf[start[i] : start[i] + lengths[i]]].tolist())
            flat_parts.append(np.array(ids, np.int64))
            at_parts.append(np.array([i]))
            n_parts.append(np.array([len(ids)]))
        flat, at, n = np.concatenate(flat_parts), np.concatenate(at_parts), np.concatenate(n_parts)
        begin = np.cumsum(n) - n
        order = np.argsort(at, kind="stable")
        self.word_ids.add(flat[C.ranges(begin[order], n[order])], n[order])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end and the number of each text."""
        if len(self.pieces) > self.limit:
            self.forget()
        piece = self.pieces.__getitem__
        special = self.v.special_pattern
        numbers: list[np.ndarray] = []
        per_text = np.zeros(len(texts), np.int64)
        marks: list[tuple[int, int]] = []  # (piece place, special id)
        done = 0
        for k, text in enumerate(texts):
            parts = [text]
            if special is not None and (hits := special.findall(text)):
                parts = special.split(text)
            for j, part in enumerate(parts):
                if j:
                    marks.append((done + int(per_text[k]), self.v.special[hits[j - 1]]))
                if part:
                    ps = split_pieces(part)
                    ps[0] = " " + ps[0]
                    got = np.fromiter(map(piece, ps), np.int64, len(ps))
                    numbers.append(got)
                    per_text[k] += len(got)
            done += int(per_text[k])
        self._learn()
        which = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        flat, n = self.piece_ids.gather(which)
        total = np.concatenate([[0], np.cumsum(n)])
        ends = np.cumsum(per_text)
        count = total[ends] - total[ends - per_text]
        if marks:
            at = np.array([m[0] for m in marks], np.int64)
            flat = np.insert(flat, total[at], [m[1] for m in marks])
            # a mark at a text's end belongs to that text, not to the next
            owner = self._owners(texts, special)
            count = count + np.bincount(owner, minlength=len(texts))
        return flat, count

    def _owners(self, texts: list[str], special: regex.Pattern) -> np.ndarray:
        return np.array([k for k, t in enumerate(texts) for _ in special.findall(t)], np.int64)


def decode(v: Vocabulary, ids: np.ndarray) -> bytes:
    return b"".join(map(v.bytes_of.__getitem__, ids.tolist()))


# -- Spark ----------------------------------------------------------------

_LOADED: dict[str, Vocabulary] = {}


def loaded(spec: Broadcast) -> Vocabulary:
    """The vocabulary, the one thing that a Python worker keeps over its tasks."""
    key = hashlib.sha256(spec.value.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(spec.value)
    return _LOADED[key]


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """Broadcast a vocabulary file, whose size is checked."""
    with open(path, encoding="utf-8") as f:
        spec = f.read(MAX_VOCAB_BYTES + 1)
    if len(spec) > MAX_VOCAB_BYTES:
        raise ValueError(f"{path}: over {MAX_VOCAB_BYTES} bytes")
    return spark.sparkContext.broadcast(spec)


def text_list(col: pa.Array) -> list[str]:
    return pc.fill_null(col, "").to_pylist()


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = True) -> DataFrame:
    """One row a document: the ``keep`` columns, ``ids`` (array<int>, unless
    ``with_ids`` is false), ``n_tokens``, ``ids_sha256`` (of the ids as
    little-endian unsigned 32-bit numbers) and ``decoded_sha256`` (of the
    bytes that decoding these ids gives)."""
    spec = vocabulary(docs.sparkSession, path)
    source = C.fresh("q_text", list(keep))
    frame = docs.select(*[C.exactly(docs, c).alias(c) for c in keep], C.exactly(docs, text).cast("string").alias(source))
    fields = [f for f in frame.schema.fields if f.name != source]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False)))
    fields += [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(loaded(spec))
        for batch in batches:
            _, off = C.text_buffer(batch.column(len(keep)))
            for lo, hi in C.doc_chunks(off):
                part = batch.slice(lo, hi - lo)
                flat, count = enc.encode(text_list(part.column(len(keep))))
                ends = np.cumsum(count)
                wide = flat.astype("<u4")
                tokens = list(map(enc.v.bytes_of.__getitem__, flat.tolist()))
                id_hash, text_hash = [], []
                for a, b in zip((ends - count).tolist(), ends.tolist(), strict=True):
                    id_hash.append(hashlib.sha256(wide[a:b].data).hexdigest())
                    text_hash.append(hashlib.sha256(b"".join(tokens[a:b])).hexdigest())
                cols = [part.column(i) for i in range(len(keep))]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat, pa.int32())))
                cols += [pa.array(count, pa.int64()), pa.array(id_hash), pa.array(text_hash)]
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return frame.mapInArrow(C.tidy(run), T.StructType(fields))


def decode_ids(encoded: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Replace an array of ids by the text that they decode to (bytes that are
    no UTF-8 become U+FFFD; null ids: null)."""
    spec = vocabulary(encoded.sparkSession, path)

    @F.pandas_udf("string")
    def text(col):  # noqa: ANN001, ANN202
        v = loaded(spec)
        return col.map(lambda x: None if x is None else decode(v, np.asarray(x)).decode("utf-8", "replace"))

    return encoded.withColumn(out, text(C.exactly(encoded, ids)))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, encoded and decoded."""
    import public_tokenizers

    return encode(C.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
