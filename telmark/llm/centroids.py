"""Operator 12: clustering around integer centroids, by an equal-average equal-variance nearest-neighbour search.

Vectors become integers, ``floor(scale * x)`` with ``x`` in double precision, and are written once with nothing else. Centroids
begin as the vectors of smallest salted hash. Each round assigns every vector to its nearest centroid and replaces a centroid
by the exact floor of its vectors' mean; a round is one pass, with sums formed in the task and a row for each task and
cluster shuffled. Only the centroids, whose number is a parameter, reach the driver.

Search: centroids lie sorted by component sum. For vectors of d components with sums S and deviations V (the root of the
squared distance to the vector of means), ``distance >= (S - S')^2 / d + (V - V')^2``. From a vector's place
among the sums the search goes outward, nearest sum first. As soon as the first term alone exceeds the best distance so far, nothing
farther out can be nearer; a centroid for which both together exceed it is skipped. All others are measured exactly, in integers. The bounds are
floating-point numbers, so that they reject only beyond a margin, and equality is never rejected, since ties go to the smaller number.

Defined results: vectors that are null, of another length, or hold null or non-finite components are left out, and so are those with
a component beyond ``LARGEST``, whose squares fit no exact number here. Repeated rows are vectors each; of one id, the smaller vector
begins first. Null ids begin last. Equal centroids are allowed: the smaller number takes the vectors, the other stays empty and as it is.
With fewer vectors than centroids each vector is one. A distance or sum that no long holds is null. An empty table gives an
empty result. Further columns are ignored, except for the id.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telmark.llm.shared import checkpoint_folder

#: Components up to SAFE are worked in 64-bit integers, those up to LARGEST in integers of any size.
SAFE = 1 << 26
LARGEST = 1 << 52


def _rows(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1) if n else np.zeros((0, 0), np.int64)


class Centroids:
    """Integer centroids, sorted by component sum, with their deviations."""

    def __init__(self, centroids: np.ndarray):
        self.wide = bool(centroids.size) and int(np.abs(centroids).max()) > SAFE
        self.d = centroids.shape[1]
        sums = centroids.sum(axis=1).astype(np.float64)
        self.order = np.lexsort((np.arange(len(sums)), sums))
        self.rows, self.sums = centroids[self.order], sums[self.order]
        self.deviations = self._deviation(self.rows)

    @staticmethod
    def _deviation(v: np.ndarray) -> np.ndarray:
        f = v.astype(np.float64)
        return np.sqrt(((f - f.mean(axis=1, keepdims=True)) ** 2).sum(axis=1))

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of the nearest centroid of each row, and how many distances were worked out."""
        n, k = len(v), len(self.sums)
        wide = self.wide or (n and int(np.abs(v).max()) > SAFE)
        exact, rows = (v.astype(object), self.rows.astype(object)) if wide else (v, self.rows)
        s, dev = v.sum(axis=1).astype(np.float64), self._deviation(v)
        best = np.full(n, None, object) if wide else np.full(n, np.iinfo(np.int64).max)
        bound, number = np.full(n, np.inf), np.full(n, k, np.int64)
        right = np.searchsorted(self.sums, s)
        left, live, measured = right - 1, np.arange(n), 0
        # Rounding of the bounds: relative to the squares that they are made of.
        margin = 1e-9
        for _ in range(k):
            if not len(live):
                break
            lo, hi = left[live], right[live]
            to_left = np.where(lo >= 0, s[live] - self.sums[np.maximum(lo, 0)], np.inf)
            to_right = np.where(hi < k, self.sums[np.minimum(hi, k - 1)] - s[live], np.inf)
            go_left = to_left <= to_right
            at, gap = np.where(go_left, lo, hi), np.minimum(to_left, to_right)
            by_mean = gap * gap / self.d
            size = np.abs(s[live]) + np.abs(self.sums[at])
            open_ = by_mean <= bound[live] + margin * (size * size / self.d + 1)
            live, at, by_mean, go_left = live[open_], at[open_], by_mean[open_], go_left[open_]
            left[live] -= go_left
            right[live] += ~go_left
            both = dev[live] + self.deviations[at]
            near = by_mean + (dev[live] - self.deviations[at]) ** 2 <= bound[live] + margin * (size[open_] ** 2 / self.d + both * both + 1)
            rows_at, which = live[near], at[near]
            measured += len(rows_at)
            diff = exact[rows_at] - rows[which]
            distance, found = (diff * diff).sum(axis=1), self.order[which]
            known = number[rows_at] < k
            better = ~known
            better[known] = (distance[known] < best[rows_at[known]]) | ((distance[known] == best[rows_at[known]]) & (found[known] < number[rows_at[known]]))
            to = rows_at[better]
            best[to], number[to] = distance[better], found[better]
            bound[to] = distance[better].astype(np.float64)
        return number, best, measured


def integers(df: DataFrame, key: str, vector: str, dimensions: int, scale: int) -> DataFrame:
    """``(id, v)`` of the vectors that take part."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double") * scale) > LARGEST))
    kept = df.filter(x.isNotNull() & (F.size(x) == dimensions) & ~bad)
    return kept.select(F.col(key).alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(scale)).cast("long")).alias("v"))


def seeds(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, in that order; no more than ``k`` rows come to the driver."""
    rank = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    first = vectors.select(rank.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in first], np.int64)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> list[tuple[int, int, list[int]]]:
    """Count and component sums of each non-empty cluster, exactly."""
    d = centroids.shape[1]
    # Each half of a sum fits a long in a task; the tasks' sums are added as decimals.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, n = Centroids(centroids), np.zeros(len(centroids), np.int64)
        high, low = np.zeros((len(centroids), d), np.int64), np.zeros((len(centroids), d), np.int64)
        for batch in batches:
            v = _rows(batch.column("v"))
            if not len(v):
                continue
            number = search.nearest(v)[0]
            order = np.argsort(number, kind="stable")
            found, at = np.unique(number[order], return_index=True)
            n += np.bincount(number, minlength=len(n))
            high[found] += np.add.reduceat((v >> 32)[order], at)
            low[found] += np.add.reduceat((v & 0xFFFFFFFF)[order], at)
        some = np.flatnonzero(n)
        cols = [np.repeat(some, d), np.tile(np.arange(d), len(some)), np.repeat(n[some], d), high[some].ravel(), low[some].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["cluster", "i", "n", "high", "low"])

    parts = vectors.select("v").mapInArrow(run, "cluster long, i long, n long, high long, low long")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    found: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), whole("high"), whole("low")).collect():
        found.setdefault(r["cluster"], (r["n"], [0] * d))[1][r["i"]] = int(r["high"]) * (1 << 32) + int(r["low"])
    return [(number, n, sums) for number, (n, sums) in found.items()]


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode("ascii")).hexdigest()


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64, salt: str = "1:") -> tuple[DataFrame, np.ndarray]:
    """``(id, cluster, distance)`` of every vector that takes part, and the final centroids."""
    spark, folder = df.sparkSession, checkpoint_folder(df.sparkSession)
    path = f"{folder}/vectors-{uuid.uuid4().hex}"
    made = integers(df, key, vector, dimensions, scale)
    made.write.parquet(path)
    vectors = spark.read.schema(made.schema).parquet(path)
    centroids = seeds(vectors, k, salt)
    if not len(centroids):
        centroids = np.zeros((0, dimensions), np.int64)
    for _ in range(rounds if len(centroids) else 0):
        for number, n, sums in _sums(vectors, centroids):
            centroids[number] = [s // n for s in sums]
    kind = vectors.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Centroids(centroids)
        for batch in batches:
            v = _rows(batch.column("v"))
            if len(v):
                number, distance, _ = search.nearest(v)
                if distance.dtype == object:
                    distance = [int(x) if x < 1 << 63 else None for x in distance]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    return vectors.mapInArrow(run, f"id {kind}, cluster int, distance long"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` and ``centroid_sha256``. Rows are written once; a row a cluster is broadcast."""
    path = f"{checkpoint_folder(assigned.sparkSession)}/clusters-{uuid.uuid4().hex}"
    assigned.write.parquet(path)
    rows = assigned.sparkSession.read.schema(assigned.schema).parquet(path)
    whole = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(whole.alias("s")).collect()}
    fits = lambda x: int(x) if x is not None and x < 1 << 63 else None
    total = fits(None if None in sums.values() else sum(sums.values()))
    table = [(i, fits(sums.get(i, 0)), total, centroid_digest(c)) for i, c in enumerate(centroids)]
    dim = assigned.sparkSession.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(dim), "cluster")
