"""Quality classifier: histogram gradient-boosted trees over document
statistics.

Spark reads every whole text once and writes ``FEATURES`` (a few numbers a
document).  The trees are fitted on a bounded sample of labelled rows
(``SAMPLE``, a documented parameter) drawn by a hash of the row: features are
binned, each node's gradient sums are histograms, a child's histogram is its
parent's less its sibling's.  The fitted trees are flattened into arrays (feature,
threshold, left, right, value), and scoring moves all rows of a batch down one
level at a time with numpy.

Defined cases: a null or empty text has all features 0 and gets a score like
any other; rows with a null label or id are not learned from; with one class or
no row to learn from every score is the class's share (0.5 without rows).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .langid import remainder

#: Labelled rows that the trees are fitted on, at most about so many.
SAMPLE = 20_000
BINS, TREES, DEPTH, RATE, L2, LEAST = 64, 60, 4, 0.2, 1.0, 20

FEATURES = (
    "log_bytes", "log_words", "log_lines", "word_length", "long_words", "line_length", "upper", "lower", "digit", "space", "other_ascii", "high_bytes",
    "exclamations", "pipes", "symbols", "sentence_marks", "quotes_brackets", "distinct_words", "commonest_word", "repeated_next", "distinct_lines", "repeated_lines",
    "capital_words", "all_upper_words", "entropy", "end_marks",
)

_CLASS = np.full(256, 5, np.int8)  # 0 upper, 1 lower, 2 digit, 3 space, 4 other ASCII, 5 high
_CLASS[:128] = 4
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[[9, 10, 11, 12, 13, 32]] = 0, 1, 2, 3


def _some(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SETS = {"exclamations": _some("!"), "pipes": _some("|"), "symbols": _some("#$%&*+=<>@^~\\/{}_`"), "sentence_marks": _some(".,;:?"), "quotes_brackets": _some("\"'()[]")}


def _runs_of_equal(key: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document the distinct keys and the count of the commonest."""
    if not len(key):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((key, doc))
    k, d = key[order], doc[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])])
    at = np.flatnonzero(new)
    size = np.diff(np.concatenate([at, [len(k)]]))
    most = np.zeros(n)
    np.maximum.at(most, d[at], size)
    return np.bincount(d[at], minlength=n).astype(float), most


def statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(documents, features) of whole texts."""
    n = len(off) - 1
    out = dict.fromkeys(FEATURES, np.zeros(n))
    size = np.diff(off)
    share = lambda x, by: np.divide(x, by, out=np.zeros(n), where=by > 0)
    doc = np.repeat(np.arange(n), size)
    total = lambda flags: np.bincount(doc[flags], minlength=n).astype(float)
    classes = np.bincount(doc * 6 + _CLASS[buf], minlength=6 * n).reshape(n, 6).astype(float)
    for j, name in enumerate(("upper", "lower", "digit", "space", "other_ascii", "high_bytes")):
        out[name] = share(classes[:, j], size)
    for name, chars in _SETS.items():
        out[name] = share(total(chars[buf]), size)

    starts, ends, first = C.word_spans(buf, off, ~C.SPACES)
    words = np.diff(first).astype(float)
    word_doc = np.repeat(np.arange(n), np.diff(first))
    length = (ends - starts).astype(float)
    codes = C.word_hashes(buf, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    out["log_bytes"], out["log_words"] = np.log1p(size), np.log1p(words)
    out["word_length"] = share(np.bincount(word_doc, length, n), words)
    out["long_words"] = share(np.bincount(word_doc, length > 20, n), words)
    distinct, most = _runs_of_equal(codes, word_doc, n)
    out["distinct_words"], out["commonest_word"] = share(distinct, words), share(most, words)
    same = (codes[1:] == codes[:-1]) & (word_doc[1:] == word_doc[:-1])
    out["repeated_next"] = share(np.bincount(word_doc[1:], same, n), words)
    if len(starts):
        upper = np.concatenate([[0], np.cumsum(_CLASS[buf] == 0)])
        lower = np.concatenate([[0], np.cumsum(_CLASS[buf] == 1)])
        ups, lows = upper[ends] - upper[starts], lower[ends] - lower[starts]
        out["capital_words"] = share(np.bincount(word_doc, _CLASS[buf[starts]] == 0, n), words)
        out["all_upper_words"] = share(np.bincount(word_doc, (ups > 0) & (lows == 0), n), words)
        out["end_marks"] = share(np.bincount(word_doc, _some(".?!;:,")[buf[ends - 1]], n), words)

    is_line = np.ones(256, bool)
    is_line[[10, 13]] = False
    starts, ends, first = C.word_spans(buf, off, is_line)
    lines = np.diff(first).astype(float)
    line_doc = np.repeat(np.arange(n), np.diff(first))
    out["log_lines"] = np.log1p(lines)
    out["line_length"] = np.log1p(share(np.bincount(line_doc, (ends - starts).astype(float), n), lines))
    distinct, most = _runs_of_equal(C.word_hashes(buf, starts, ends) if len(starts) else np.zeros(0, np.uint64), line_doc, n)
    out["distinct_lines"], out["repeated_lines"] = share(distinct, lines), share(most, lines)

    seen = np.bincount(doc * 256 + buf, minlength=256 * n).reshape(n, 256) if n else np.zeros((0, 256))
    p = seen / np.maximum(size, 1)[:, None]
    out["entropy"] = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    return np.stack([out[name] for name in FEATURES], axis=1).astype(np.float32).reshape(n, len(FEATURES))


class Trees:
    """Flattened trees: node i of tree t goes left if feature <= threshold; a
    leaf points to itself."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, left: np.ndarray, right: np.ndarray, value: np.ndarray, depth: int) -> None:
        self.base, self.feature, self.threshold, self.left, self.right, self.value, self.depth = base, feature, threshold, left, right, value, depth

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                go = x[rows, self.feature[t, node]] <= self.threshold[t, node]
                node = np.where(go, self.left[t, node], self.right[t, node])
            total += self.value[t, node]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def fit_trees(x: np.ndarray, y: np.ndarray, bins: int = BINS, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, l2: float = L2, least: int = LEAST) -> Trees:
    """Logistic boosting; each split is the best of all binned thresholds."""
    n, features = x.shape
    mean = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if n else 0.5
    base = float(np.log(mean / (1 - mean)))
    if not n or y.min() == y.max():
        trees = 0
    nodes = 2 ** (depth + 1) - 1
    feature, left = np.zeros((trees, nodes), np.int64), np.tile(np.arange(nodes), (trees, 1))
    right, threshold, value = left.copy(), np.zeros((trees, nodes), np.float32), np.zeros((trees, nodes))
    if not trees:
        return Trees(base, feature, threshold, left, right, value, depth)
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, bins) / bins, method="lower")) for f in range(features)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    cell = binned + np.arange(features) * bins
    usable = np.array([[b < len(e) for b in range(bins)] for e in edges])
    total = np.full(n, base)

    def histogram(rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        at = cell[rows].ravel()
        each = [np.bincount(at, None if v is None else np.repeat(v[rows], features), features * bins) for v in (g, h, None)]
        return np.stack(each).reshape(3, features, bins)

    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        rows_of = {0: np.arange(n)}
        hist_of = {0: histogram(rows_of[0], g, h)}
        for node in range(2**depth - 1):
            if node not in rows_of:
                continue
            rows, hist = rows_of[node], hist_of.pop(node)
            below = hist.cumsum(axis=2)
            whole = below[:, :1, -1:]
            above = whole - below
            gain = below[0] ** 2 / (below[1] + l2) + above[0] ** 2 / (above[1] + l2) - whole[0] ** 2 / (whole[1] + l2)
            gain = np.where(usable & (below[2] >= least) & (above[2] >= least), gain, -1)
            best = int(gain.argmax())
            if gain.flat[best] <= 1e-6:
                continue
            f, b = divmod(best, bins)
            feature[t, node], threshold[t, node] = f, edges[f][b]
            left[t, node], right[t, node] = 2 * node + 1, 2 * node + 2
            go = binned[rows, f] <= b
            parts = rows[go], rows[~go]
            small = int(len(parts[0]) > len(parts[1]))
            own = histogram(parts[small], g, h)
            for side in (0, 1):
                child = 2 * node + 1 + side
                rows_of[child] = parts[side]
                hist_of[child] = own if side == small else hist - own
            del rows_of[node]
        for node, rows in rows_of.items():
            value[t, node] = -rate * g[rows].sum() / (h[rows].sum() + l2)
            total[rows] += value[t, node]
    return Trees(base, feature, threshold, left, right, value, depth)


def described(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, uid, features: array<float>) of every whole text."""
    ident, body = C.exactly(docs, doc_id), C.exactly(docs, text)
    frame = docs.select(ident.alias("doc_id"), C.row_uid(ident, body).alias("uid"), body.alias("text"))
    kind = frame.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = C.text_buffer(batch.column(2))
            for lo, hi in C.doc_chunks(off):
                start = off[lo]
                x = statistics(buf[start : off[hi]], off[lo : hi + 1] - start)
                part = batch.slice(lo, hi - lo)
                offsets = pa.array(np.arange(hi - lo + 1, dtype=np.int32) * x.shape[1])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], names=["doc_id", "uid", "features"])

    return frame.mapInArrow(C.tidy(run), f"doc_id {kind}, uid binary, features array<float>")


def fitted(table: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, folds: int = 3, held: int = 1, **options) -> Trees:  # noqa: ANN003
    """Trees from the labelled rows outside the held-out fold.  A document with
    several labels counts once with the greatest, as an id of several rows does
    with the least by row identity; a sample is drawn by hash."""
    known = labels.select(F.col("doc_id"), C.exactly(labels, label).cast("int").alias("y")).where("y is not null and doc_id is not null")
    known = known.where(remainder(F.col("doc_id"), folds) != held).groupBy("doc_id").agg(F.max("y").alias("y"))
    n = known.count()
    if n > sample:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(sample / n * (1 << 30)))
    # one row an id, whatever number of rows repeat it, so the driver gets the sample's size at most
    rows = C.spread_join(table.select("doc_id", "uid", "features"), known, ["doc_id"]).groupBy("doc_id").agg(F.min(F.struct("uid", "features", "y")).alias("r"))
    rows = rows.select("doc_id", "r.features", "r.y").orderBy("doc_id").toPandas()
    x = np.array(rows["features"].tolist(), np.float32).reshape(len(rows), len(FEATURES))
    return fit_trees(x, rows["y"].to_numpy(np.float64), **options)


def scored(table: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, uid, score) of described rows."""
    shared = table.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared.value.score(x))], names=["doc_id", "uid", "score"])

    kind = table.schema["doc_id"].dataType.simpleString()
    return table.select("doc_id", "uid", "features").mapInArrow(C.tidy(run), f"doc_id {kind}, uid binary, score double")


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:  # noqa: ANN003
    """One row a document: doc_id, held_out, score, predicted."""
    table = C.written(described(docs, text, doc_id), "described")
    found = scored(table, fitted(table, labels, label, **options))
    return found.select("doc_id", F.coalesce(remainder(F.col("doc_id"), options.get("folds", 3)) == options.get("held", 1), F.lit(False)).alias("held_out"),
                        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels"))
