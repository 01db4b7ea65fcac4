"""Language identification by nearest centroid.

A text is a vector of byte 1- to 3-gram counts hashed to ``DIMS`` places,
weighted by TF-IDF and normalised.  Each language has several centroids, found
by spherical k-means; the nearest centroid by cosine gives the language, and a
text whose cosine falls below its centroid's own bound is rejected.

The document frequencies are counted over all learning rows by Spark.  The
centroids of every language are fitted in a Spark group of its own, on about
``PER_LANG`` learning rows drawn by a hash of the row (a documented bound), so that
only the centroids reach the driver; prediction reads every whole text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0
and is rejected; ties go to the centroid that comes first by language; without
learning rows every text is ``und``; rows with a null language or id are never
learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

DIMS = 4096
#: Documents that a task counts at a time (a row of counts each).
DOCS = 256
ORDERS = (1, 2, 3)
CLUSTERS = 4
#: A centroid holds at least so much of its language's rows.
LEAST_SHARE = 0.05
#: Learning rows a language that the centroids are fitted on.
PER_LANG = 400
#: A text is rejected below this share of a low quantile of the cosines of its
#: centroid's learning rows; a text of few distinct n-grams cannot come near any centroid,
#: so below ``FULL`` of them the bound falls with the square root of their number.
SLACK, QUANTILE = 0.6, 0.01
FULL = 400
UNKNOWN = "und"
#: Languages whose sizes (some bytes each) are broadcast.
BROADCAST_LANGS = 100_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: Upper case to lower case; digits and ASCII punctuation to a space.
_PLAIN = C.LOWER.copy()
_PLAIN[[b for b in range(128) if not chr(b).isalpha()]] = 32


def counts(buf: np.ndarray, off: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """(documents, dims) n-gram counts."""
    n = len(off) - 1
    x = _PLAIN[buf].astype(np.uint32)
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(off))
    out = np.zeros(n * dims, np.float32)
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    h = np.zeros(len(x), np.uint32)
    for k in ORDERS:
        size = len(x) - k + 1
        if size <= 0:
            break
        h = h[:size] * np.uint32(0x01000193) + x[k - 1 :] + np.uint32(k)
        whole = doc[:size] == doc[k - 1 :]
        if k > 1:  # blanks only between words, never as words of their own
            whole &= ~((x[:size] == 32) & (x[k - 1 :] == 32))
        else:
            whole &= x[:size] != 32
        place = (h * np.uint32(0x9E3779B1)) >> shift
        out += np.bincount((doc[:size] * dims + place)[whole], minlength=n * dims).astype(np.float32)
    return out.reshape(n, dims)


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)


def weigh(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(count) * idf)


def has_letter(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether a text has a character of a Unicode letter category."""
    total = np.concatenate([[0], np.cumsum(_LETTER[buf])])
    out = total[off[1:]] > total[off[:-1]]
    for i in np.flatnonzero(~out & (np.diff(off) > 0)):
        out[i] = any(ch.isalpha() for ch in buf[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


class Centroids:
    def __init__(self, idf: np.ndarray, centres: np.ndarray, langs: list[str], bounds: np.ndarray) -> None:
        self.idf, self.centres, self.langs, self.bounds = idf, centres, langs, bounds

    def predict(self, buf: np.ndarray, off: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, cosine, rejected) of each text."""
        n = len(off) - 1
        known = has_letter(buf, off)
        if not len(self.centres):
            return [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
        count = counts(buf, off, len(self.idf))
        cosine = weigh(count, self.idf) @ self.centres.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(n), best].astype(np.float64), 0, 1)
        score[~known] = 0
        distinct = (count > 0).sum(axis=1)
        rejected = ~known | (score < self.bounds[best] * np.sqrt(np.minimum(1, distinct / FULL)))
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)], score, rejected


def spherical_means(rows: np.ndarray, k: int, rounds: int = 12, least: float = LEAST_SHARE) -> np.ndarray:
    """At most k unit centroids of unit rows.  The first are drawn (a row by its
    distance to those drawn before, from a fixed seed), then Lloyd's rounds; a
    centroid that holds less than ``least`` of the rows is no cluster of its
    own: it goes, and its rows join the others."""
    rng = np.random.default_rng(len(rows))
    centres = rows[[int(rng.integers(len(rows)))]]
    while len(centres) < k:
        far = np.clip(1 - (rows @ centres.T).max(axis=1), 0, None).astype(np.float64)
        far[far < 1e-6] = 0
        if not far.sum():
            break
        centres = np.vstack([centres, rows[[int(rng.choice(len(rows), p=far / far.sum()))]]])
    while True:
        for _ in range(rounds):
            own = (rows @ centres.T).argmax(axis=1)
            centres = unit(np.stack([rows[own == j].sum(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))]))
        size = np.bincount((rows @ centres.T).argmax(axis=1), minlength=len(centres))
        if len(centres) == 1 or size.min() >= least * len(rows):
            return centres.astype(np.float32)
        centres = np.delete(centres, int(size.argmin()), axis=0)


def _document_frequencies(rows: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    """Rows and, per place, rows that have it; each task adds up its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dims, np.int64), 0
        for batch in batches:
            buf, off = C.text_buffer(batch.column(0))
            for lo, hi in C.doc_chunks(off, docs=DOCS):
                base = off[lo]
                total += (counts(buf[base : off[hi]], off[lo : hi + 1] - base, dims) > 0).sum(axis=0)
                n += hi - lo
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, dims), pa.int32()), pa.array(np.concatenate([[n], total]))], names=["place", "n"])

    found = rows.mapInArrow(C.tidy(run), "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(dims + 1, np.int64)
    for r in found:
        df[r.place + 1] = r.n
    return int(df[0]), df[1:]


def fit(rows: DataFrame, dims: int = DIMS, clusters: int = CLUSTERS, per_lang: int = PER_LANG, slack: float = SLACK) -> Centroids:
    """rows (text, lang, draw): ``draw`` is a number that a row's place in the
    sample hangs on.  Rows with a null language are left out."""
    rows = rows.where("lang is not null")
    n, df = _document_frequencies(rows.select("text"), dims)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    sizes = rows.groupBy("lang").agg(F.count("*").alias("size"))
    share = sizes.select("lang", (F.lit(1.25 * per_lang) / F.col("size")).alias("share"))
    # a row a language: broadcast while they are few, else the planner's choice
    share = F.broadcast(share) if sizes.count() <= BROADCAST_LANGS else share
    drawn = rows.join(share, "lang").where(F.pmod("draw", F.lit(1 << 30)) < F.col("share") * F.lit(1 << 30))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = C.text_buffer(batch.column(1))
            for lo, hi in C.doc_chunks(off, docs=DOCS):
                base = off[lo]
                got = counts(buf[base : off[hi]], off[lo : hi + 1] - base, dims)
                some = [np.flatnonzero(r).astype(np.int16 if dims <= 32768 else np.int32) for r in got]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([s.astype(np.int32).tobytes() for s in some], pa.binary()), pa.array([g[s].tobytes() for g, s in zip(got, some, strict=True)], pa.binary())],
                    names=["lang", "draw", "place", "count"])

    def centroids(table: pa.Table) -> pa.Table:
        own = sorted(zip(*(table.column(c).to_pylist() for c in ("draw", "place", "count")), strict=True))[:per_lang]
        dense = np.zeros((len(own), dims), np.float32)
        for i, (_, place, count) in enumerate(own):
            dense[i, np.frombuffer(place, np.int32)] = np.frombuffer(count, np.float32)
        dense = weigh(dense, idf)
        dense = dense[(dense > 0).any(axis=1)]
        found = spherical_means(dense, clusters) if len(dense) else np.zeros((0, dims), np.float32)
        cosine = dense @ found.T
        own_centre = cosine.argmax(axis=1) if len(dense) else np.zeros(0, np.int64)
        low = [np.quantile(cosine[own_centre == j, j], QUANTILE) if (own_centre == j).any() else np.inf for j in range(len(found))]
        # centroids never outnumber the rows that they are drawn from
        return pa.table({"lang": table.column("lang").slice(0, len(found)), "at": pa.array(range(len(found)), pa.int32()), "centre": pa.array([c.tobytes() for c in found], pa.binary()),
                         "bound": pa.array([slack * float(x) if np.isfinite(x) else 0.0 for x in low], pa.float64())})

    sample = drawn.select("lang", "text", "draw").mapInArrow(C.tidy(run), "lang string, draw long, place binary, count binary")
    fitted = sample.groupBy("lang").applyInArrow(centroids, "lang string, at int, centre binary, bound double").collect()
    fitted.sort(key=lambda r: (r.lang, r["at"]))
    centres = np.array([np.frombuffer(r.centre, np.float32) for r in fitted], np.float32).reshape(-1, dims)
    return Centroids(idf, centres, [r.lang for r in fitted], np.array([r.bound for r in fitted]))


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of an id's text, modulo ``of``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(of))


def predicted(docs: DataFrame, model: Centroids, text: str = "text", keep: list[str] | None = None, stay: bool = False) -> DataFrame:
    """``keep`` columns (all, if not given) and lang_pred, score, rejected; with
    ``stay`` the rejected rows are left out, and the three columns too."""
    keep = list(docs.columns) if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = C.fresh("q_text", keep)
    frame = docs.select(*[C.exactly(docs, c) for c in keep], C.exactly(docs, text).alias(source))
    schema = docs.select(*[C.exactly(docs, c) for c in keep]).schema
    if not stay:
        for name, kind in (("lang_pred", "string"), ("score", "double"), ("rejected", "boolean")):
            schema = schema.add(C.fresh(name, keep), kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = C.text_buffer(batch.column(len(keep)))
            for lo, hi in C.doc_chunks(off, docs=DOCS):
                base = off[lo]
                lang, score, rejected = shared.value.predict(buf[base : off[hi]], off[lo : hi + 1] - base)
                part = batch.slice(lo, hi - lo)
                if stay:
                    part = part.filter(pa.array(~rejected))
                cols = [part.column(i) for i in range(len(keep))]
                if not stay:
                    cols += [pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return frame.mapInArrow(C.tidy(run), schema)


def learned(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", folds: int = 4, held: int = 2, **options) -> Centroids:  # noqa: ANN003
    """Centroids of the documents outside the held-out fold."""
    ident, body = C.exactly(docs, doc_id), C.exactly(docs, text)
    rows = docs.where(remainder(ident, folds) != held).select(body.alias("text"), C.exactly(docs, lang).alias("lang"), F.xxhash64(ident, body).alias("draw"))
    return fit(rows, **options)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    found = predicted(docs.select("doc_id", "text"), learned(docs), keep=["doc_id"])
    held = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
