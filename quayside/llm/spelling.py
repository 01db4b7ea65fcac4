"""Spelling variants of the words of a corpus, found by blocked Gram matrices.

A word is a vector of letter counts.  One inserted or deleted letter moves it by
a squared distance of 1, one replaced letter by 2.  So near words are among the
pairs of squared distance 1 or 2, and a product of two blocks of such vectors
gives all distances between them at once; the pairs kept are then verified letter
by letter.

Blocks are adjacent in length (equal, or one apart), and more finely in coarse
counts: the alphabet is dealt into a few classes of like frequency, and a block
is the words of one count per class.  An edit adds one letter of a class, takes
one, or trades one for another, so a block meets only itself and the blocks that
one such step leads to.  A block is known by a linear hash of its counts, so a
step is a plain sum; blocks whose hashes collide only meet more often.

Spark deals the blocks: a block and its neighbours make a group, cut into tiles
of at most ``TILE`` by ``OTHERS`` words (fewer if they are long), so that a block
of any size is spread and no task holds more than a tile.  A tile gives one row a
word (near words, the best of them), never a row a pair.

Counting is pre-aggregated in the tasks; ``n`` of a word is its occurrences over
all documents.  Of each document's runs those picked by a check sum lose a letter
first, as the contract of the query says; ``noise=0`` turns that off.

Defined cases: a null text has no word; a null id counts as an empty id in the
check sum; repeated rows count each; an empty table gives no row; words are
compared by code points, and of equal counts the smallest word is the form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Letters of a word: A-Z, a-z and U+00C0 to U+00FF; only A-Z are lower-cased.
LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, LEAST = 5, 3
#: A run whose check sum this divides loses a letter.
NOISE = 97
#: A form occurs so many times as often as its variant.
RATIO = 2
#: Words of a block, and of its neighbours, in a tile; letters of a tile's side.
TILE, OTHERS, TILE_LETTERS = 2048, 16384, 1 << 21
#: Doublings of the number of words that are worth one more letter class.
PER_CLASS = 3.5
#: Different words that a task counts before it hands them on.
HELD = 400_000


# -- counting ------------------------------------------------------------------

def occurrences(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shortest: int = SHORTEST, least: int = LEAST, noise: int = NOISE) -> DataFrame:
    """(word, n) of the words of ``shortest`` letters and ``least`` occurrences
    or more."""
    rows = docs.select(C.exactly(docs, doc_id).cast("string").alias("doc_id"), C.exactly(docs, text).cast("string").alias("text"))
    runs = re.compile(f"[{LETTERS}]{{{max(1, shortest)},}}").findall  # a shorter run gives no word

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def rows_held() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            buf, off = C.text_buffer(batch.column(1))
            for i, ident in enumerate(ids):
                before = zlib.crc32(f"{ident or ''}:".encode())
                for word, n in Counter(runs(C.LOWER[buf[off[i] : off[i + 1]]].tobytes().decode())).items():
                    if noise and not (h := zlib.crc32(word.encode(), before)) % noise:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < shortest:
                            continue
                    held[word] = held.get(word, 0) + n
                if len(held) > HELD:
                    yield rows_held()
                    held = {}
        if held:
            yield rows_held()

    return rows.mapInArrow(C.tidy(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# -- blocks ----------------------------------------------------------------------

def letter_classes(words: DataFrame, classes: int) -> dict[int, int]:
    """Code point to class: the most frequent letter left goes to the class of
    least letters.  The driver sees a row a letter, of an alphabet of 90."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").groupBy("letter").count().collect()
    total, out = [0] * classes, {}
    for r in sorted(letters, key=lambda r: (-r["count"], r.letter)):
        k = min(range(classes), key=total.__getitem__)
        out[ord(r.letter)] = k
        total[k] += r["count"]
    return out


def _codes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points (all below 256) of words end to end, and their lengths."""
    listed = words.to_pylist()
    return np.frombuffer("".join(listed).encode("latin-1"), np.uint8), np.fromiter(map(len, listed), np.int64, len(listed))


def _in_blocks(words: DataFrame, value: np.ndarray) -> DataFrame:
    """(word, n, block, size): the block is the sum of its letters' values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, size = _codes(batch.column(0))
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value[codes])])
            ends = np.cumsum(size)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(C.signed(total[ends] - total[ends - size])), pa.array(size)], names=["word", "n", "block", "size"])

    return words.select("word", "n").mapInArrow(C.tidy(run), "word string, n long, block long, size long")


def _tiles(count: F.Column, size: F.Column, most: int) -> F.Column:
    room = F.greatest(F.lit(1), F.least(F.lit(most), F.floor(F.lit(TILE_LETTERS * most // TILE) / size)))
    return F.ceil(count / room).cast("int")


def _grouped(placed: DataFrame, step: np.ndarray, tile: int, others: int) -> DataFrame:
    """(home, i, j, side, word, n): the rows of each tile; side 0 is the home
    block's words, 1 those of the same block again, 2 those of its neighbours."""
    steps = [0, *(int(v) for v in step)]
    steps += [a - b for k, a in enumerate(steps[1:]) for b in steps[1 : k + 1]]
    steps = [int(np.uint64(s % (1 << 64)).view(np.int64)) for s in steps]
    blocks = placed.groupBy("block").agg(F.count("*").alias("count"), F.max("size").alias("size"))
    blocks = C.written(blocks, "blocks")
    near = blocks.select(F.col("block").alias("home"), F.explode(F.array(*[F.lit(s) for s in steps])).alias("step"))
    # sums wrap around, as the hashes do
    near = near.select("home", F.when(F.col("step") == 0, 1).otherwise(2).alias("side"), _wrapped_sum("home", "step").alias("block"))
    near = near.join(blocks, "block")
    shape = near.groupBy("home").agg(F.sum("count").alias("all"), F.max("size").alias("longest")).join(blocks.withColumnRenamed("block", "home"), "home").select(
        "home", _tiles(F.col("count"), F.col("size"), tile).alias("rows"), _tiles(F.col("all"), F.col("longest"), others).alias("cols"))
    shape = C.written(shape, "tiles")
    own = F.xxhash64("word")
    homes = C.spread_join(placed.select("word", "n", F.col("block").alias("home")), shape, ["home"]).select(
        "home", F.pmod(own, F.col("rows")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("j"), F.lit(0).alias("side"), "word", "n")
    links = near.select("block", "home", "side").join(shape, "home")
    rest = C.spread_join(placed.select("word", "n", "block"), links, ["block"]).select(
        "home", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), F.pmod(own, F.col("cols")).cast("int").alias("j"), "side", "word", "n")
    return homes.unionByName(rest)


def _wrapped_sum(a: str, b: str) -> F.Column:
    """a + b modulo 2^64, whatever the session says about overflow: the low and
    the high halves apart."""
    low = F.col(a).bitwiseAND(0xFFFFFFFF) + F.col(b).bitwiseAND(0xFFFFFFFF)
    high = F.shiftrightunsigned(a, 32) + F.shiftrightunsigned(b, 32) + F.shiftrightunsigned(low, 32)
    return F.shiftleft(high.bitwiseAND(0xFFFFFFFF), 32).bitwiseOR(low.bitwiseAND(0xFFFFFFFF))


# -- tiles -------------------------------------------------------------------------

def _matrix(codes: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """Words as rows of code points, filled up with 0."""
    out = np.zeros((len(size), width), np.uint8)
    row = np.repeat(np.arange(len(size)), size)
    out[row, C.ranges(np.zeros(len(size), np.int64), size)] = codes
    return out


def _counts(letters: np.ndarray, dimension: np.ndarray, kind: type) -> np.ndarray:
    d = int(dimension.max()) + 1
    place = np.arange(len(letters))[:, None] * d + dimension[letters]
    flat = np.bincount(place[letters > 0], minlength=len(letters) * d)
    return flat.reshape(len(letters), d).astype(kind)


def one_edit(a: np.ndarray, size_a: np.ndarray, b: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether the words in the rows of ``a`` and ``b`` (code points, 0 behind
    the end, at least one 0 column) are one edit apart."""
    longer = size_a > size_b
    if longer.any():
        a, b = np.where(longer[:, None], b, a), np.where(longer[:, None], a, b)
        size_a, size_b = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    same = a == b
    replaced = (size_a == size_b) & ((~same).sum(axis=1) == 1)
    ahead = np.argmin(np.concatenate([same, np.zeros((len(a), 1), bool)], axis=1), axis=1)
    # behind the first difference the shorter word goes on one letter later
    moved = (a[:, :-1] == b[:, 1:]) | (np.arange(a.shape[1] - 1) < np.minimum(ahead, size_a)[:, None])
    return replaced | ((size_a + 1 == size_b) & moved.all(axis=1))


def near_in_tile(words: list[bytes], n: np.ndarray, side: np.ndarray, dimension: np.ndarray, block: int = TILE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, near words, best near word) as row numbers, of the words that have
    near words here.  Rows of side 0 come first; they are compared with those of
    side 1 (their own block: the result is theirs alone) and side 2."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    width = int(size.max()) + 1
    letters = _matrix(np.frombuffer(b"".join(words), np.uint8), size, width)
    counts = _counts(letters, dimension, np.float32 if width < 4096 else np.float64)
    norm = (counts * counts).sum(axis=1, keepdims=True)
    one = np.ones_like(norm)
    left, right = np.concatenate([-2 * counts, norm, one], axis=1), np.concatenate([counts, one, norm], axis=1)
    home, total = int((side == 0).sum()), len(words)
    found_a, found_b = [], []
    for lo in range(home, total, block):
        distance = left[:home] @ right[lo : lo + block].T  # squared
        a, b = np.divmod(np.flatnonzero(distance.ravel() < 2.5), distance.shape[1])
        b += lo
        step = max(1, (1 << 22) // width)
        for k in range(0, len(a), step):
            x, y = a[k : k + step], b[k : k + step]
            near = one_edit(letters[x], size[x], letters[y], size[y])
            found_a.append(x[near])
            found_b.append(y[near])
    a = np.concatenate(found_a) if found_a else np.zeros(0, np.int64)
    b = np.concatenate(found_b) if found_b else np.zeros(0, np.int64)
    back = side[b] == 2
    a, b = np.concatenate([a, b[back]]), np.concatenate([b, a[back]])
    if not len(a):
        return a, a, a
    order_of = np.empty(total, np.int64)
    order_of[np.array(sorted(range(total), key=words.__getitem__))] = np.arange(total)
    order = np.lexsort((order_of[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    return a[first], np.diff(np.append(first, len(a))), b[first]


def _near(groups: DataFrame, dimension: np.ndarray) -> DataFrame:
    """(word, n_near, minus, best) per word and tile; ``minus`` is the best near
    word's count, negative."""
    dealt = groups.repartition("home", "i", "j").sortWithinPartitions("home", "i", "j", "side")

    def tile(rows: pa.Table) -> pa.RecordBatch | None:
        side = rows.column("side").to_numpy()
        if not len(side) or side[0] != 0 or side[-1] == 0:
            return None
        listed, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        a, count, b = near_in_tile([w.encode("latin-1") for w in listed], n, side, dimension)
        return pa.RecordBatch.from_arrays([pa.array([listed[i] for i in a.tolist()], pa.string()), pa.array(count, pa.int64()), pa.array(-n[b], pa.int64()), pa.array([listed[i] for i in b.tolist()], pa.string())],
                                          names=["word", "n_near", "minus", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key: tuple | None = None
        for batch in batches:
            keys = [batch.column(k).to_numpy() for k in range(3)]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1 if len(batch) > 1 else np.zeros(0, np.int64)
            edges = [0, *change.tolist(), len(batch)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                now = tuple(int(k[lo]) for k in keys)
                if now != key and held:
                    if (out := tile(pa.Table.from_batches(held))) is not None:
                        yield out
                    held = []
                key = now
                held.append(batch.slice(lo, hi - lo))
        if held and (out := tile(pa.Table.from_batches(held))) is not None:
            yield out

    return dealt.mapInArrow(C.tidy(run), "word string, n_near long, minus long, best string")


# -- forms -------------------------------------------------------------------------

def followed(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form): the form's form and so on, to the
    last.  Each round doubles the steps taken; the driver sees a count a round."""
    now = C.written(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then = C.written(C.spread_join(now, onward, ["root"], "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = then.select("word", "root")
        if not then.where("moved").count():
            return now


def variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shortest: int = SHORTEST, least: int = LEAST, noise: int = NOISE,
             ratio: int = RATIO, classes: int | None = None, tile: int = TILE, others: int = OTHERS) -> DataFrame:
    """One row a word: word, form, root, n, n_near, form_n."""
    words = C.written(occurrences(docs, text, doc_id, shortest, least, noise), "words")
    count = words.count()
    if classes is None:  # the more words, the finer their blocks
        classes = max(2, min(12, int(np.log2(max(count, 1)) / PER_CLASS)))
    class_of = letter_classes(words, classes)
    step = np.random.default_rng(12).integers(1, 1 << 63, classes, dtype=np.uint64)
    value, dimension = np.zeros(256, np.uint64), np.zeros(256, np.int64)
    for k, (letter, c) in enumerate(sorted(class_of.items())):
        value[letter], dimension[letter] = step[c], k
    placed = C.written(_in_blocks(words, value), "placed")
    found = _near(_grouped(placed, step, tile, others), dimension)
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("minus", "best")).alias("b")).select(
        "word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best"))
    good = F.col("best_n") >= ratio * F.col("n")
    judged = C.written(words.join(best, "word", "left").select(
        "word", F.when(good, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best_n")).alias("form_n")), "forms")
    roots = followed(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spelling variants of all words of ``documents``."""
    return variants(C.table(spark, sf_dir, "documents"))
