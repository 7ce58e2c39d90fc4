"""Operator 2: nearest neighbours by vantage-point trees per shard.

Every row is indexed once: rows are dealt into shards by a hash of their id, and each shard builds
one vantage-point tree over its distinct vectors. Largest inner product becomes least Euclidean
distance by one more coordinate, sqrt(M^2 - |x|^2) with the shard's largest norm M, so the triangle
inequality holds. The queries stream past each shard's tree in blocks, sorted behind its rows. A subtree is left
out when ``factor`` times its lower bound exceeds the distance of the k-th neighbour so far;
``factor`` 1 is exact, larger ones prune more. Shards return k rows a query at most, merged by
one window per query. A shard's and a block's size bound a task's memory. The index is shuffled once; of the
queries there is one copy for each shard of up to ``SHARD_VALUES`` numbers, so that what is shuffled grows with
queries times vectors over that. Scores are recomputed from the original vectors in double precision.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
take no part, as query or candidate, nor do rows without an id. Vectors of different lengths are never
compared. Equal scores rank by smaller vec_id; equal vectors score alike. A query's own id is no
candidate. Fewer candidates than k give fewer rows; none gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telmark.llm.vectors import matrix, usable

LEAF = 128
#: Numbers in a shard's vectors, 32 MiB of doubles.
SHARD_VALUES = 4 << 20
SMALL_SHARD = 4096
BLOCK = 1024


class VantageTree:
    """A vantage-point tree over lifted vectors; nodes are tuples, leaves index arrays."""

    def __init__(self, x: np.ndarray, seed: int = 0):
        self.x = x
        self.norm2 = (x * x).sum(1)
        self.m2 = float(self.norm2.max(initial=0.0))
        self.lifted = np.sqrt(np.maximum(self.m2 - self.norm2, 0.0))
        self.rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(x)))

    def _between(self, v: int, idx: np.ndarray) -> np.ndarray:
        d2 = self.norm2[idx] + self.norm2[v] - 2 * (self.x[idx] @ self.x[v]) + (self.lifted[idx] - self.lifted[v]) ** 2
        return np.sqrt(np.maximum(d2, 0.0))

    def _build(self, idx: np.ndarray):
        if len(idx) <= LEAF:
            return idx
        # Of a few candidates, the vantage point whose distances spread most.
        tries = self.rng.choice(idx, 4, replace=False)
        some = self.rng.choice(idx, min(len(idx), 64), replace=False)
        v = max(tries, key=lambda t: float(self._between(int(t), some).std()))
        d = self._between(int(v), idx)
        mid = float(np.median(d))
        near = d <= mid
        if near.all():
            near = d < mid
        if not near.any() or near.all():
            return idx
        a, b = d[near], d[~near]
        return int(v), (float(a.min()), float(a.max()), self._build(idx[near])), (float(b.min()), float(b.max()), self._build(idx[~near]))

    def search(self, q: np.ndarray, k: int, factor: float, first_id: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and rows (-1: none) of each query's k best distinct vectors, ties to the smaller first id."""
        best = np.full((len(q), k), -np.inf)
        rows = np.full((len(q), k), -1, np.int64)
        ids = np.full((len(q), k), np.iinfo(np.int64).max)
        q2 = (q * q).sum(1)
        slack = 1e-7 * (1 + np.sqrt(self.m2) + np.sqrt(q2))

        def leaf(idx: np.ndarray, who: np.ndarray) -> None:
            s = q[who] @ self.x[idx].T
            hits = (s >= best[who, -1:]).sum(1)
            some = hits > 0
            who, s = who[some], s[some]
            if not len(who):
                return
            # No row has more hits than the most, so the best of each row are among as many columns.
            most = int(hits.max())
            at = np.argpartition(-s, most - 1, 1)[:, :most] if most < s.shape[1] else np.broadcast_to(np.arange(s.shape[1]), s.shape)
            alls = np.concatenate([best[who], np.take_along_axis(s, at, 1)], 1)
            alli = np.concatenate([ids[who], first_id[idx][at]], 1)
            allr = np.concatenate([rows[who], idx[at]], 1)
            order = np.lexsort((alli, -alls), axis=-1)[:, :k]
            best[who] = np.take_along_axis(alls, order, 1)
            ids[who] = np.take_along_axis(alli, order, 1)
            rows[who] = np.take_along_axis(allr, order, 1)

        def visit(node, who: np.ndarray) -> None:
            if not isinstance(node, tuple):
                leaf(node, who)
                return
            v, near, far = node
            d = np.sqrt(np.maximum(q2[who] + self.m2 - 2 * (q[who] @ self.x[v]), 0.0))
            gap = [np.maximum(np.maximum(d - hi, lo - d), 0.0) for lo, hi, _ in (near, far)]
            closer = gap[0] <= gap[1]
            for turn in (True, False):
                for side, (_, _, child) in enumerate((near, far)):
                    mine = (closer == (side == 0)) if turn else (closer != (side == 0))
                    reach = np.sqrt(np.maximum(q2[who] + self.m2 - 2 * best[who, -1], 0.0))
                    go = mine & (factor * gap[side] <= reach + slack[who])
                    if go.any():
                        visit(child, who[go])

        if len(self.x) and len(q):
            visit(self.root, np.arange(len(q)))
        return best, rows


class _Shard:
    """The tree over a shard's distinct vectors and the ids that hold each."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, x = ids[order], x[order]
        _, first, which = np.unique(x, axis=0, return_index=True, return_inverse=True)
        which = which.ravel()
        self.by = np.argsort(which, kind="stable")
        self.begin = np.searchsorted(which[self.by], np.arange(len(first) + 1))
        self.first_id = self.ids[first]
        self.tree = VantageTree(x[first], seed=len(ids))

    def answer(self, qid: np.ndarray, q: np.ndarray, k: int, factor: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for at in range(0, len(q), BLOCK):
            part = q[at : at + BLOCK]
            _, rows = self.tree.search(part, k + 1, factor, self.first_id)
            for r in range(len(part)):
                hit = rows[r][rows[r] >= 0]
                score = (self.tree.x[hit] * part[r]).sum(1)
                # Of equal vectors only the k + 1 smallest ids can be among k neighbours.
                lists = [self.ids[self.by[self.begin[h] : min(self.begin[h + 1], self.begin[h] + k + 1)]] for h in hit]
                vec = np.concatenate(lists)
                sc = np.repeat(score, [len(v) for v in lists])
                ok = vec != qid[at + r]
                vec, sc = vec[ok], sc[ok]
                top = np.lexsort((vec, -sc))[:k]
                yield np.full(len(top), qid[at + r]), vec[top], sc[top]


def _search(k: int, factor: float):
    """Rows sorted by dimension and shard, the index before the queries, to each query's best in the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: tuple[int, int] | None = None
        shard: _Shard | None = None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in ("dim", "shard", "asks")], 1)
            cut = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
            for s, e in zip(cut, np.r_[cut[1:], len(key)], strict=True):
                if own != (key[s, 0], key[s, 1]):
                    own, shard, held = (key[s, 0], key[s, 1]), None, []
                ids, x = batch.column("vec_id").slice(s, e - s).to_numpy(), matrix(batch.column("embedding").slice(s, e - s))
                if not key[s, 2]:
                    held.append((ids, x))
                    continue
                if held:
                    shard, held = _Shard(*(np.concatenate(c) for c in zip(*held, strict=True))), []
                if shard is not None and (found := list(shard.answer(ids, x, k, factor))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, factor: float = 1.0, shard_rows: int | None = None) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest of each row that ``is_query`` picks, by inner product."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding")).filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).withColumn("dim", F.size("embedding"))
    n = v.agg(F.count("*").alias("rows"), F.coalesce(F.max("dim"), F.lit(1)).alias("dim")).first()
    # As few shards as memory allows, but some for each core where the table is small.
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = -(-n["rows"] // shard_rows) if shard_rows else max(-(-n["rows"] * n["dim"] // SHARD_VALUES), min(-(-n["rows"] // SMALL_SHARD), parts))
    shards = max(1, shards)
    index = v.select("dim", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("asks"), "vec_id", "embedding")
    asked = v.filter(is_query).select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("asks"), "vec_id", "embedding")
    order = ["dim", "shard", "asks", "vec_id"]
    # By range, so that each shard has a task of its own.
    both = index.unionByName(asked).repartitionByRange(shards, "shard").sortWithinPartitions(*order)
    found = both.mapInArrow(_search(k, factor), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
