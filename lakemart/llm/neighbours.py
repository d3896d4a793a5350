"""Approximate nearest neighbours by collision counting over sorted projections.

The measure is the inner product. Inside a block of candidates with greatest
norm M it becomes a distance: a candidate x gets the further component
``sqrt(M^2 - |x|^2)`` and a query q is scaled to norm M, so that a squared
distance is ``2 M^2 - 2 M (q x) / |q|`` and the order is the same. Each of
``projections`` random directions gives a sorted array of the block. A query's
windows, of one half-width on all arrays, are centred on its own projections;
an expansion (virtual rehashing) only adds the entries between the old and the
new bounds. A vector that lies in ``threshold`` windows is verified with its
inner product on the original vectors.

A vector at distance r lies in a window of half-width ``z r`` with the same
chance on each direction, so the number of its collisions is binomial. ``z`` is
set so that the threshold is reached with chance ``sure``. The entries next to
the centres give a first k-th distance; windows start a little inside its width
and widen until they are ``z`` times the distance of the k-th verified vector:
that finds all that are nearer with at least that chance, and the search ends.

Queries meet all rows in blocks, in rounds of growing size: a query's k-th
inner product of the rounds before sets its first and only width in the next
round, and only vectors that reach it are handed on, at most k a query and
block. A cell of a round holds ``block`` rows and ``query_block`` queries.

Defined results: vectors that are null, zero or hold null or non-finite
components take no part, nor do rows without an id; vectors of different length
are never compared; a query's own row is left out with all rows of its id;
repeated queries are answered each; equal scores go to the smaller id; with
fewer than k candidates all are returned. An empty table gives no rows.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch


def reach(projections: int, threshold: int, sure: float) -> float:
    """The half-width, in distances, at which a vector collides on ``threshold``
    of the directions with chance ``sure``."""
    def enough(p: float) -> float:
        return sum(math.comb(projections, i) * p ** i * (1 - p) ** (projections - i) for i in range(threshold, projections + 1))

    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if enough(middle) >= sure else (middle, high)
    return NormalDist().inv_cdf(min((1 + high) / 2, 1 - 1e-15))


class SortedArrays:
    """A block of vectors (rows of ``x``) under single-projection sorted arrays."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, projections: int, threshold: int, sure: float, seed: int):
        self.x, self.ids, self.threshold, self.z = x, ids, threshold, reach(projections, threshold, sure)
        n, square = len(x), (x * x).sum(axis=1)
        self.top = float(np.sqrt(square.max()))
        self.directions = np.random.default_rng([seed, x.shape[1]]).normal(size=(x.shape[1] + 1, projections))
        placed = (x @ self.directions[:-1] + np.sqrt(np.maximum(self.top ** 2 - square, 0))[:, None] * self.directions[-1]).T
        order = np.argsort(placed, axis=1, kind="stable")
        #: the arrays one after another, ``apart`` from each other, so that one search finds a window's bounds on all
        self.least, self.most = placed.min() - self.top, placed.max() + self.top
        self.apart = np.arange(projections) * (2 * (self.most - self.least))
        self.sorted = (np.take_along_axis(placed, order, axis=1) + self.apart[:, None]).ravel()
        self.begins = np.arange(projections) * n
        self.order = order.astype(np.int32)
        small = np.uint8 if projections < 256 else np.int64
        kind = np.uint16 if n < 2 ** 16 else np.uint32
        self.rank = np.empty((projections, n), kind)
        np.put_along_axis(self.rank, order, np.arange(n, dtype=kind)[None, :], axis=1)
        self._shifted, self._inside, self._sum = np.empty_like(self.rank), np.empty(self.rank.shape, bool), small

    def width(self, score: float, norm: float) -> float:
        """Half-width for all vectors with at least this inner product."""
        return self.z * math.sqrt(max(0.0, 2 * self.top ** 2 - 2 * self.top * score / norm)) + 1e-7 * self.top

    def windows(self, centres: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
        """Places in each array of the first entry inside and of the first behind."""
        ends = [np.clip(c, self.least, self.most) + self.apart for c in (centres - width, centres + width)]
        return tuple(np.searchsorted(self.sorted, e, side) - self.begins for e, side in zip(ends, ("left", "right")))

    def widen(self, counts: np.ndarray, old: tuple[np.ndarray, np.ndarray], new: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Collisions after windows grew from old to new: of the added entries one
        by one, or of all by their ranks where the windows are wide."""
        added = (new[1] - new[0]).sum() - (old[1] - old[0]).sum()
        if added * 8 < self.rank.size:
            parts = [row[a:b] for row, a, b in zip(self.order, new[0].tolist(), old[0].tolist())]
            parts += [row[a:b] for row, a, b in zip(self.order, old[1].tolist(), new[1].tolist())]
            return counts + np.bincount(np.concatenate(parts), minlength=len(counts))
        kind = self.rank.dtype
        np.subtract(self.rank, new[0].astype(kind)[:, None], out=self._shifted)  # wraps below the window
        np.less(self._shifted, (new[1] - new[0]).astype(kind)[:, None], out=self._inside)
        return np.add.reduce(self._inside.view(np.uint8), axis=0, dtype=self._sum).astype(np.int64)

    def search(self, query_id: int, q: np.ndarray, k: int, bound: float | None) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores, how many were verified): the k best found, or those
        among them that reach ``bound``."""
        n, norm = len(self.ids), float(np.sqrt(q @ q))
        centres = (q * (self.top / norm)) @ self.directions[:-1]
        fresh = self.ids != query_id
        places, scores = [np.empty(0, np.int64)], [np.empty(0)]

        def verify(new: np.ndarray) -> None:
            fresh[new] = False
            places.append(new)
            scores.append(self.x[new] @ q)

        def kth() -> float | None:
            known = np.concatenate(scores)
            return np.partition(known, len(known) - k)[len(known) - k] if len(known) >= k else None

        at = np.searchsorted(self.sorted, np.clip(centres, self.least, self.most) + self.apart) - self.begins
        if bound is not None:
            widths = [self.width(bound, norm)]
        else:  # the entries next to the centres give a first distance, and windows start a little inside its width
            beside = np.concatenate([self.order[np.arange(len(at)), np.clip(at + step, 0, n - 1)] for step in (-1, 0)])
            beside = np.unique(beside)
            verify(beside[fresh[beside]])
            widths = [self.z * self.top / 4 if (first := kth()) is None else 0.8 * self.width(first, norm)]
        counts, old = np.zeros(n, np.int64), (at, at)
        while widths:
            width = widths.pop()
            new = self.windows(centres, width)
            counts, old = self.widen(counts, old, new), new
            verify(np.flatnonzero((counts >= self.threshold) & fresh))
            if bound is None and (new[0].any() or (new[1] < n).any()):
                needed = 2 * width if (found := kth()) is None else self.width(found, norm)
                if needed > width:
                    widths.append(needed)
        places, scores = np.concatenate(places), np.concatenate(scores)
        verified = len(places)
        if verified > k:  # ties and rounding are settled below, on the same sums for equal vectors
            places = places[scores >= np.partition(scores, verified - k)[verified - k] - 1e-9 * self.top * norm]
        exact = (self.x[places] * q).sum(axis=1)
        best = np.lexsort((self.ids[places], -exact))[:k]
        if bound is not None:
            best = best[exact[best] >= bound]
        return self.ids[places[best]], exact[best], verified


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


FOUND = {"query": pa.int64(), "query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}


def _cell(k: int, projections: int, threshold: int, sure: float, seed: int):
    """The queries of a cell against its block of rows."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        parts = []
        if len(rows) and len(queries):
            arrays = SortedArrays(_matrix(rows.column("v")), rows.column("vec_id").to_numpy(), projections, threshold, sure, seed)
            names = [queries.column(c).to_pylist() for c in ("query", "query_id", "bound")]
            for query, query_id, bound, q in zip(*names, _matrix(queries.column("qv"))):
                ids, scores, _ = arrays.search(query_id, q, k, bound)
                parts.append((np.full(len(ids), query), np.full(len(ids), query_id), ids, scores))
        columns = zip(*parts) if parts else [[np.empty(0)]] * 4
        return pa.table({name: pa.array(np.concatenate(c), kind) for (name, kind), c in zip(FOUND.items(), columns)})

    return run


def nearest(vectors: DataFrame, queries: Column, k: int = 20, projections: int = 128, threshold: int = 64, sure: float = 0.97,
            block: int = 8192, query_block: int = 1024, growth: int = 16, seed: int = 11, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner product
    found for each row of ``vectors`` that ``queries`` selects, among all rows.
    ``queries`` is a condition on the id column."""
    scratch = Scratch(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    usable = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("v", lambda e: e != 0), F.lit(False))
    held = scratch.table(rows.filter(usable).withColumn("row", F.monotonically_increasing_id()).withColumn("size", F.size("v")), "vectors-rows")
    parts = held.groupBy("size").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"), F.ceil(F.count_if("asks") / query_block).alias("groups")).filter("groups > 0")
    parts = scratch.table(parts, "vectors-parts")
    last = parts.agg(F.max("blocks")).first()[0] or 0  # one number
    hashed = F.xxhash64("row", F.lit(seed))
    dealt = held.join(parts, "size").withColumn("block", F.pmod(hashed, "blocks"))
    asks = dealt.filter("asks").select("size", "blocks", F.col("row").alias("query"), F.col("vec_id").alias("query_id"), F.col("v").alias("qv"), F.pmod(F.xxhash64("row"), "groups").alias("group"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found, low, high = None, 0, 1
    while low < last:
        bounds = asks.withColumn("bound", F.lit(None).cast("double")) if found is None else asks.join(
            found.filter(F.col("rank") == k).select("query", F.col("score").alias("bound")), "query", "left")
        here = bounds.filter(F.col("blocks") > low).withColumn("block", F.explode(F.sequence(F.lit(low).cast("long"), F.least(F.col("blocks"), F.lit(high)) - 1)))
        there = dealt.filter((F.col("block") >= low) & (F.col("block") < high)).select("size", "block", "vec_id", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("group"))
        asked = here.select(F.col("size").alias("qsize"), F.col("block").alias("qblock"), F.col("group").alias("qgroup"), "query", "query_id", "qv", "bound")
        met = there.groupBy("size", "block", "group").cogroup(asked.groupBy("qsize", "qblock", "qgroup")).applyInArrow(
            _cell(k, projections, threshold, sure, seed), "query bigint, query_id bigint, vec_id bigint, score double")
        if found is not None:
            met = met.unionByName(found.drop("rank"))
        found = scratch.table(met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), f"vectors-found{low}")
        low, high = high, high * growth
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return found.select("query_id", "rank", "vec_id", "score")
