"""Approximate nearest neighbours by collision counting over single projections.

Nearness is the inner product.  A shard is cut into ranges of falling norm; with
M the greatest norm of a range, x -> (x, sqrt(M^2 - |x|^2)) / M and q -> (q / |q|,
0) turn it into nearness on a sphere.  A range keeps, for each of ``PROJECTIONS``
random directions, its vectors sorted by their projection.  A query opens a window
around its own projection in every sorted array; widening the windows is virtual
rehashing to the next radius, no table is built again.  A vector that lies in at
least ``COLLIDE`` of the windows is a candidate, and candidates are verified with
the exact inner product in double precision.

A query passes over a range if |q| M is below the k-th score it has found.  Else it
widens until a vector of the range that reaches that score would have been a
candidate with probability ``SURE`` (its greatest distance d on the sphere follows
from the score, and its projections lie N(0, d^2) from the query's), or the window
holds everything; so each true neighbour is found with that probability at least,
whatever the norms are and however many candidates there are.

Every vector is indexed.  Vectors are dealt to shards of about ``SHARD`` by a hash of
the id, and the query set, too, to blocks of about ``BLOCK``; a task holds one
shard and one block.  A shard keeps its k best of a query, and Spark merges the
shards' lists.

Defined cases: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part; equal rows count once; ties go to
the smaller id; a query's own id is never its neighbour; fewer than k other
vectors give fewer rows.
"""

from __future__ import annotations

from math import comb
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

K = 20
PROJECTIONS, COLLIDE = 128, 0.8
#: Half widths of the windows: at least START, and growing by GROW at most.
START, GROW = 0.4, 1.12
SURE = 0.95
#: A range ends where the norm falls below 1 / RATIO of its greatest, but holds at least RANGE vectors.
RATIO, RANGE = 1.5, 512
SHARD, BLOCK = 16_384, 2_048
SEED = 7


def norms(rows: np.ndarray) -> np.ndarray:
    """Euclidean norms, of very small and very large rows too."""
    scale = np.abs(rows).max(axis=1, keepdims=True)
    return scale[:, 0] * np.sqrt(((rows / scale) ** 2).sum(axis=1))


def reach(m: int, need: int, sure: float) -> float:
    """The half width of m windows, in units of a vector's distance, at which the
    vector lies in at least ``need`` of them with probability ``sure``."""
    lo, hi = 0.0, 1.0
    for _ in range(50):
        p = (lo + hi) / 2
        tail = sum(comb(m, i) * p**i * (1 - p) ** (m - i) for i in range(need, m + 1))
        lo, hi = (lo, p) if tail >= sure else (p, hi)
    return NormalDist().inv_cdf((1 + min(hi, 1 - 1e-12)) / 2)


class Range:
    """Sorted projections of the vectors of a range of norms."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, norm: np.ndarray, directions: np.ndarray) -> None:
        self.ids, self.rows, self.greatest = ids, rows, float(norm.max())
        self.single = len(np.unique(ids)) == len(ids)
        share = norm / self.greatest
        lifted = np.hstack([rows / self.greatest, np.sqrt(np.maximum(1 - share * share, 0))[:, None]])
        at = lifted @ directions.T
        order = np.argsort(at, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(np.ascontiguousarray(at.T), order, axis=1)
        # place of each vector in each sorted array, to see whether a window holds it
        self.place = np.empty(order.shape, np.uint16 if len(ids) < 1 << 16 else np.uint32)
        np.put_along_axis(self.place, order, np.arange(len(ids), dtype=self.place.dtype)[None, :], axis=1)

    def collisions(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """For each vector the windows [lo, hi) of the sorted arrays that hold it."""
        kind = self.place.dtype
        inside = self.place - lo.astype(kind)[:, None] < (hi - lo).astype(kind)[:, None]
        return inside.view(np.uint8).sum(axis=0, dtype=np.uint8 if len(lo) < 256 else np.uint16)

    def candidates(self, centre: np.ndarray, half: float, need: int) -> np.ndarray:
        if half == np.inf:
            return np.arange(len(self.ids))
        ends = np.stack([centre - half, centre + half], axis=1)
        lo, hi = np.array([row.searchsorted(e) for row, e in zip(self.sorted, ends, strict=True)]).T
        return np.flatnonzero(self.collisions(lo, hi) >= need)


class Index:
    """A shard of vectors in ranges of falling norm."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, projections: int = PROJECTIONS, seed: int = SEED, ratio: float = RATIO, least: int = RANGE) -> None:
        self.directions = np.random.default_rng(seed).standard_normal((projections, rows.shape[1] + 1))
        norm = norms(rows)
        order = np.argsort(-norm, kind="stable")
        fall = -norm[order]
        self.ranges: list[Range] = []
        lo = 0
        while lo < len(order):
            hi = max(int(np.searchsorted(fall, fall[lo] / ratio, "right")), lo + least)
            own = order[lo:hi]
            self.ranges.append(Range(ids[own], rows[own], norm[own], self.directions))
            lo = hi

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, collide: float = COLLIDE, start: float = START, grow: float = GROW,
               sure: float = SURE) -> tuple[list[tuple[int, int, float]], int]:
        """(query id, id, score) of the k best found, and candidates verified."""
        m = len(self.directions)
        need = int(np.ceil(collide * m))
        wide = reach(m, need, sure)
        long = norms(queries)
        centres = (queries / long[:, None]) @ self.directions[:, :-1].T
        best: list[dict[int, float]] = [{} for _ in queries]
        verified = 0
        for part in self.ranges:
            usual = start
            for i, query in enumerate(queries):
                top = long[i] * part.greatest
                worst = self._worst(best[i], k)
                if worst > top * (1 + 1e-9):
                    continue
                # the windows open at the last query's radius; each candidate is verified once
                half = max(start, min(usual, self._enough(worst / top, wide)))
                seen = np.zeros(len(part.ids), bool)
                while True:
                    found = part.candidates(centres[i], half, need)
                    found = found[~seen[found]]
                    seen[found] = True
                    best[i] = self._better(best[i], part, int(query_ids[i]), query, found, k, 1e-9 * top)
                    wanted = self._enough(self._worst(best[i], k) / top, wide)
                    if half >= wanted:
                        break
                    # no distance on the sphere exceeds 2
                    half = min(half * grow, wanted) if half < 2 * wide else np.inf
                usual = min(wanted, 2 * wide)
                verified += int(seen.sum())
        return [(int(q), i, s) for q, own in zip(query_ids, best, strict=True) for i, s in own.items()], verified

    def _enough(self, cosine: float, wide: float) -> float:
        """The half width for all vectors of this lifted cosine or a greater one."""
        return wide * np.sqrt(max(0.0, 2 - 2 * cosine))

    def _worst(self, best: dict[int, float], k: int) -> float:
        return min(best.values()) if len(best) >= k else -np.inf

    def _better(self, best: dict[int, float], part: Range, own: int, query: np.ndarray, found: np.ndarray, k: int, room: float) -> dict[int, float]:
        """The k best ids of those known and those found, each at its best score."""
        found = found[part.ids[found] != own]
        # a fast product first, with room for its rounding; then each row by the same sum
        rough = part.rows[found] @ query
        worst = self._worst(best, k)
        if len(found) > k and part.single:
            worst = max(worst, float(np.partition(rough, len(rough) - k)[len(rough) - k]))
        found = found[rough >= worst - room]
        if not len(found):
            return best
        score = (part.rows[found] * query).sum(axis=1)
        out = dict(best)
        for i, s in zip(part.ids[found].tolist(), score.tolist(), strict=True):
            out[i] = max(s, out.get(i, s))
        return dict(sorted(out.items(), key=lambda x: (-x[1], x[0]))[:k])


def clean(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v: array<double>) of the vectors that take part."""
    v = F.transform(C.exactly(vectors, embedding), lambda x: x.cast("double"))
    rows = vectors.select(C.exactly(vectors, vec_id).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    return rows.dropDuplicates(["vec_id", "v"])


def nearest(vectors: DataFrame, queries: DataFrame | None = None, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding",
            shard_rows: int = SHARD, block_rows: int = BLOCK, **options) -> DataFrame:  # noqa: ANN003
    """(query_id, rank, vec_id, score) for every query (default: the rows whose
    id is divisible by 20)."""
    data = C.written(clean(vectors, vec_id, embedding), "vectors")
    size = data.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    schema = "query_id long, vec_id long, score double"
    if size is None:
        return data.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    data = data.where(F.size("v") == size.d)
    asked = data.where("vec_id % 20 = 0") if queries is None else clean(queries, vec_id, embedding).where(F.size("v") == size.d)
    shards = max(1, -(-size.n // shard_rows))
    blocks = max(1, -(-asked.count() // block_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = data.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), every(blocks).alias("block"), F.lit(False).alias("asks"), "vec_id", "v")
    right = asked.select(every(shards).alias("shard"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), F.lit(True).alias("asks"), "vec_id", "v")
    dims = int(size.d)

    def search(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids = table.column("vec_id").to_numpy()
        v = table.column("v").combine_chunks()
        v = v.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dims)
        found: list[tuple[int, int, float]] = []
        if asks.any() and not asks.all():
            found, _ = Index(ids[~asks], v[~asks]).search(ids[asks], v[asks], k, **options)
        return pa.table({"query_id": pa.array([f[0] for f in found], pa.int64()), "vec_id": pa.array([f[1] for f in found], pa.int64()), "score": pa.array([f[2] for f in found], pa.float64())})

    found = left.unionByName(right).groupBy("shard", "block").applyInArrow(search, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # an id that stands for several vectors is one neighbour, at its best score
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(C.table(spark, sf_dir, "embeddings"))
