"""Operator 7: exact n-gram Jaccard join with a count-vector R-tree.

A document is the set of hashes of its word shingles. Documents with equal sets form one class.
Tokens are hashed into ``GROUPS`` groups; a class's counts by group are its point. For two
points the sum of coordinate minima bounds the overlap from above, and so does the same sum over
the upper corners of two R-tree nodes; node pairs whose bound, sizes or components rule a link
out are cut. What is left is verified on the full sets.

To spread the index over tasks, classes meet in blocks: each goes to the blocks of its
``n - ceil(t n) + 1`` first tokens, one of which any two linked classes share. Tokens are ordered by
hash, but up to ``FREQUENT_TOKENS`` that occur most come last; the order is a hint that only
saves work, any fixed one is exact. Postings are range-partitioned, so that a very common token is not gathered in a
task. Sizes too far apart part a block, and members whose positions of the token rule out a link with each other
member are left out. Blocks with the same members are worked once. An R-tree is packed per block;
a block of more than ``TILE`` members is cut into tiles, and each pair of tiles is a group of its own. A
component with more than that in a block has tiles of its own, which do not meet each other.

A link inside a component already found changes no component, so the search runs three times:
neighbours in a block's order; each class's best partner of another component; then all pairs
of different components. No pair is lost between components, and groups of near copies do not make a square of pairs. Only pairs whose bound
passes are emitted.

Defined results: words are split at ASCII white space, A-Z lower-cased. Null, empty and
wordless texts have no shingles, link with nothing and are their own component. Rows that
repeat a doc_id are one document for components; a null doc_id links with nothing. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telmark.llm.shared import connected_components, free_name, written
from telmark.llm.text_hash import mix, shingle_sets, string_buffers

GROUPS = 128
LEAF = 32
LIST_ROWS = 4096
TILE = 8192
PAIR_BATCH = 200_000
BROADCAST_ROWS = 100_000
FREQUENT_IN_BATCH = 4
FREQUENT_TOKENS = 200_000


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + 1 if n else 0


def _signature(s: np.ndarray) -> tuple[int, int]:
    a = mix(s + np.uint64(0x51ED270B1)).sum(dtype=np.uint64)
    b = mix(s ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _point(s: np.ndarray) -> bytes:
    """Counts by group in a byte each, over the scale in the last four; rounded up, so that bounds stay bounds."""
    counts = np.bincount((s & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
    scale = max(1, -(-int(counts.max(initial=0)) // 255))
    return (-(-counts // scale)).astype(np.uint8).tobytes() + np.array([scale, len(s)], "<u4").tobytes()


def _unpack(points: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts by group, not below the true ones, and set sizes."""
    raw = np.frombuffer(b"".join(points), np.uint8).reshape(-1, GROUPS + 8)
    tail = np.ascontiguousarray(raw[:, GROUPS:]).view("<u4").astype(np.int32)
    return raw[:, :GROUPS].astype(np.int32) * tail[:, :1], tail[:, 1].astype(np.int64)


def _sizes(k: int):
    """Rows to sizes and signatures (kind 0), and tokens that several rows of a batch have, with how many (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "doc", "tag", "n", "s1", "s2"]
        for batch in batches:
            sets = list(shingle_sets(*string_buffers(batch.column("text")), k))
            sig = [_signature(s) for s in sets]
            zeros = np.zeros(len(sets), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(zeros), batch.column("doc"), batch.column("tag"), pa.array([len(s) for s in sets], pa.int64()), pa.array([x for x, _ in sig], pa.int64()), pa.array([x for _, x in sig], pa.int64())], names=names)
            # Equal sets are one class and count once.
            whole = np.sort(np.concatenate([*{g: s for g, s in zip(sig, sets, strict=True)}.values(), np.zeros(0, np.uint64)]))
            start = np.flatnonzero(np.r_[True, whole[1:] != whole[:-1]]) if len(whole) else np.zeros(0, np.int64)
            count = np.diff(np.r_[start, len(whole)])
            some = np.flatnonzero(count >= FREQUENT_IN_BATCH)
            token = whole[start[some]].view(np.int64)
            zeros = np.zeros(len(some), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(zeros + 1), pa.array(zeros), pa.array(token), pa.array(count[some].astype(np.int64)), pa.array(zeros), pa.array(zeros)], names=names)

    return run


def _sets(k: int, percent: int, frequent: Broadcast):
    """Rows to sizes, signatures, points and prefixes: the rarest tokens first, as far as that is known, then by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = frequent.value
        for batch in batches:
            ns, sig, points, prefixes = [], [], [], []
            for s in shingle_sets(*string_buffers(batch.column("text")), k):
                ns.append(len(s))
                sig.append(_signature(s))
                points.append(_point(s))
                at = np.searchsorted(common, s)
                late = common[np.minimum(at, len(common) - 1)] == s if len(common) else np.zeros(len(s), bool)
                prefixes.append(np.concatenate([s[~late], s[late]])[: prefix_length(len(s), percent)].tobytes())
            cols = [batch.column("doc"), batch.column("tag"), pa.array(ns, pa.int64()), pa.array([x for x, _ in sig], pa.int64()), pa.array([x for _, x in sig], pa.int64()), pa.array(points, pa.binary()), pa.array(prefixes, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc", "tag", "n", "s1", "s2", "point", "prefix"])

    return run


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes to one row per prefix token; ``place`` is the set size over 2**32 plus the token's position."""
    for batch in batches:
        keys = [np.frombuffer(x, np.int64) for x in batch.column("prefix").to_pylist()]
        lengths = np.array([len(x) for x in keys], np.int64)
        position = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        place = (np.repeat(batch.column("n").to_numpy(), lengths) << 32) | position
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*keys, np.zeros(0, np.int64)])), pa.array(place), pa.array(np.repeat(batch.column("rep").to_numpy(), lengths))], names=["key", "place", "rep"])


def _useful(run: np.ndarray, n: np.ndarray, position: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of runs in order of size have a partner in their run that size and positions allow.

    Two linked sets share a token whose positions leave room for the least overlap in both.
    Runs of more than ``LEAF`` rows are kept whole; their R-tree sorts them out.
    """
    keep, i = np.zeros(len(run), bool), np.arange(len(run))
    for d in range(1, LEAF + 1):
        i = i[i + d < len(run)]
        i = i[run[i + d] == run[i]]
        if not len(i):
            return keep
        j = i + d
        least = -(-percent * (n[i] + n[j]) // (100 + percent))
        ok = (100 * n[i] >= percent * n[j]) & (position[i] <= n[i] - least) & (position[j] <= n[j] - least)
        keep[i[ok]] = keep[j[ok]] = True
    return keep | np.isin(run, run[i])


def _blocks(percent: int):
    """Rows sorted by key, size and class to blocks: a fingerprint and the members, in pieces.

    A key's members fall into runs; sizes too far apart to link lie in different ones. Keys at a
    partition's border, which other partitions may hold too, and very long ones are passed on as they come, under
    the key itself, so that no key is gathered in a task.
    """
    schema = pa.schema([("f1", pa.int64()), ("f2", pa.int64()), ("f3", pa.int64()), ("members", pa.int64()), ("reps", pa.binary())])

    def rows_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, schema, strict=True)], schema=schema)

    def close(key: np.ndarray, place: np.ndarray, rep: np.ndarray) -> pa.RecordBatch:
        n, position = place >> 32, place & 0xFFFFFFFF
        apart = (key[1:] != key[:-1]) | (100 * n[:-1] < percent * n[1:])
        run = np.r_[0, np.cumsum(apart)] if len(key) else np.zeros(0, np.int64)
        keep = _useful(run, n, position, percent)
        run, rep = run[keep], rep[keep]
        start = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(run) else np.zeros(0, np.int64)
        stop = np.r_[start[1:], len(run)]
        rows: list[tuple] = []
        if len(run):
            u = rep.astype(np.uint64)
            f1 = np.add.reduceat(mix(u), start).view(np.int64)
            f2 = np.add.reduceat(mix(u ^ np.uint64(0x2545F4914F6CDD1D)), start).view(np.int64)
            for b in range(len(start)):
                for piece, at in enumerate(range(start[b], stop[b], LIST_ROWS)):
                    rows.append((f1[b], f2[b], piece, stop[b] - start[b], rep[at : min(at + LIST_ROWS, stop[b])].tobytes()))
        return rows_of(rows)

    def passed(key: np.ndarray, rep: np.ndarray) -> pa.RecordBatch:
        rows, cut = [], np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        for s, e in zip(cut, np.r_[cut[1:], len(key)], strict=True):
            u = key[s : s + 1].view(np.uint64)
            f1, f2 = (int(mix(u ^ np.uint64(x)).view(np.int64)[0]) for x in (0x6A09E667F3BCC908, 0xBB67AE8584CAA73B))
            for at in range(s, e, LIST_ROWS):
                own = rep[at : min(at + LIST_ROWS, e)]
                rows.append((f1, f2, int(mix(own.astype(np.uint64)).sum(dtype=np.uint64).view(np.int64)), -1, own.tobytes()))
        return rows_of(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, place, rep = (np.zeros(0, np.int64) for _ in range(3))
        through: int | None = None
        seen = False
        for batch in batches:
            if not batch.num_rows:
                continue
            key, place, rep = (np.concatenate([x, batch.column(c).to_numpy()]) for x, c in ((key, "key"), (place, "place"), (rep, "rep")))
            if not seen:
                seen, through = True, int(key[0])
            first = int(np.searchsorted(key, through, side="right")) if through is not None and key[0] == through else 0
            if first:
                yield passed(key[:first], rep[:first])
                key, place, rep = key[first:], place[first:], rep[first:]
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            if last:
                yield close(key[:last], place[:last], rep[:last])
                key, place, rep = key[last:], place[last:], rep[last:]
            if len(key) > TILE:
                through = int(key[0])
                yield passed(key, rep)
                key, place, rep = key[:0], place[:0], rep[:0]
        if len(key):
            yield passed(key, rep)

    return run


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        reps = [np.frombuffer(x, np.int64) for x in batch.column("reps").to_pylist()]
        lengths = [len(x) for x in reps]
        each = lambda c: pa.array(np.repeat(batch.column(c).to_numpy(), lengths))  # noqa: B023, E731
        yield pa.RecordBatch.from_arrays([each("f1"), each("f2"), each("members"), pa.array(np.concatenate([*reps, np.zeros(0, np.int64)]))], names=["f1", "f2", "members", "rep"])


class RTree:
    """A packed R-tree over count points: a binary hierarchy whose leaves are slices of ``order``.

    A node keeps its points' upper corner, least and greatest set size, and its component if
    all its points share one.
    """

    def __init__(self, points: np.ndarray, size: np.ndarray, comp: np.ndarray):
        self.points, self.size, self.comp = points, size, comp
        m = len(points)
        self.order = np.arange(m)
        slices = [(0, m)]
        self.children: list[tuple[int, int]] = []
        at = 0
        while at < len(slices):
            s, e = slices[at]
            if e - s <= LEAF:
                self.children.append((-1, -1))
            else:
                own = self.order[s:e]
                wide = np.c_[self.size[own], points[own]]
                spread = wide.max(0) - wide.min(0)
                by = wide[:, int(spread.argmax())]
                mid = (e - s) // 2
                self.order[s:e] = own[np.argpartition(by, mid)]
                self.children.append((len(slices), len(slices) + 1))
                slices += [(s, s + mid), (s + mid, e)]
            at += 1
        self.slices = np.array(slices)
        p, z, c = points[self.order], self.size[self.order], comp[self.order]
        self.high = np.array([p[s:e].max(0) for s, e in slices])
        self.least = np.array([z[s:e].min() for s, e in slices])
        self.most = np.array([z[s:e].max() for s, e in slices])
        self.one = np.array([c[s] if (c[s:e] == c[s]).all() else -1 for s, e in slices])
        self.one_has = np.array([(c[s:e] == c[s]).all() for s, e in slices])
        self.kids = np.array(self.children)

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of points of different components whose bound allows a link."""
        stack = [(np.array([0]), np.array([0]))]
        while stack:
            i, j = stack.pop()
            if len(i) > PAIR_BATCH // LEAF:
                half = len(i) // 2
                stack += [(i[:half], j[:half]), (i[half:], j[half:])]
                continue
            bound = np.minimum(self.high[i], self.high[j]).sum(1)
            ok = bound * (100 + percent) >= percent * (self.least[i] + self.least[j])
            ok &= (self.most[i] * 100 >= percent * self.least[j]) & (self.most[j] * 100 >= percent * self.least[i])
            ok &= ~(self.one_has[i] & self.one_has[j] & (self.one[i] == self.one[j]))
            i, j = i[ok], j[ok]
            leaf_i, leaf_j = self.kids[i, 0] < 0, self.kids[j, 0] < 0
            both = leaf_i & leaf_j
            for a, b in zip(i[both], j[both], strict=True):
                (s, e), (t, f) = self.slices[a], self.slices[b]
                x, y = self.order[s:e], self.order[t:f]
                over = np.minimum(self.points[x][:, None, :], self.points[y][None, :, :]).sum(2)
                fine = over * (100 + percent) >= percent * (self.size[x][:, None] + self.size[y][None, :])
                fine &= self.comp[x][:, None] != self.comp[y][None, :]
                if a == b:
                    fine &= np.triu(np.ones(fine.shape, bool), 1)
                p, q = np.nonzero(fine)
                if len(p):
                    yield x[p], y[q]
            i, j, leaf_i, leaf_j = i[~both], j[~both], leaf_i[~both], leaf_j[~both]
            if not len(i):
                continue
            # Both inner: four pairs of children, three for a node with itself. One a leaf: it meets the other's children.
            inner = ~leaf_i & ~leaf_j
            p, q = self.kids[i[inner]], self.kids[j[inner]]
            apart = i[inner] != j[inner]
            for x, y in ((p[:, 0], q[:, 0]), (p[:, 1], q[:, 1]), (p[:, 0], q[:, 1]), (p[apart, 1], q[apart, 0])):
                if len(x):
                    stack.append((x, y))
            if leaf_i.any():
                stack.append((np.repeat(i[leaf_i], 2), self.kids[j[leaf_i]].ravel()))
            if leaf_j.any():
                stack.append((self.kids[i[leaf_j]].ravel(), np.repeat(j[leaf_j], 2)))


def _neighbours(percent: int):
    """Members in a block's order to pairs of neighbours whose bound allows a link; nothing but the last row is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy() for c in ("f1", "f2", "rep")] + [*_unpack(batch.column("point").to_pylist())]
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)] if held else cols
            f1, f2, rep, points, size = cols
            over = np.minimum(points[:-1], points[1:]).sum(1)
            ok = (f1[1:] == f1[:-1]) & (f2[1:] == f2[:-1]) & (over * (100 + percent) >= percent * (size[1:] + size[:-1]))
            a, b = rep[:-1][ok], rep[1:][ok]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
            held = [c[-1:] for c in cols]

    return run


def _candidates(percent: int, mode: str):
    """Members sorted by group to pairs ``(a, b)`` whose bound allows a link.

    ``best``: of the pairs of different components the one with the largest bound for each
    member. ``every``: all of them. Where a group is a pair of tiles, both sides of a pair differ.
    """

    def work(rep: np.ndarray, comp: np.ndarray, side: np.ndarray, points: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if (comp == comp[0]).all():
            return
        best, with_ = np.full(len(rep), -1.0), np.zeros(len(rep), np.int64)
        for a, b in RTree(points, size, comp).pairs(percent):
            apart = (side[a] != side[b]) | (side[a] == 0)
            a, b = a[apart], b[apart]
            if mode == "every":
                yield rep[a], rep[b]
                continue
            share = np.minimum(points[a], points[b]).sum(1) / (size[a] + size[b])
            for x, y in ((a, b), (b, a)):
                order = np.argsort(share, kind="stable")
                better = share > best[x]
                # Of several pairs of one member the last written has the largest share.
                w = order[better[order]]
                best[x[w]], with_[x[w]] = share[w], y[w]
        if mode == "best":
            got = np.flatnonzero(best >= 0)
            yield rep[got], rep[with_[got]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def starts(*keys: np.ndarray) -> np.ndarray:
            return np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]

        def close(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            f1, f2, group, rep, comp, side, points, size = cols
            cut = np.flatnonzero(starts(f1, f2, group))
            found, n = [], 0
            for s, e in zip(cut, np.r_[cut[1:], len(f1)], strict=True):
                for a, b in work(rep[s:e], comp[s:e], side[s:e], points[s:e], size[s:e]):
                    found.append((a, b))
                    n += len(a)
                    if n > PAIR_BATCH:
                        yield emit(found)
                        found, n = [], 0
            if found:
                yield emit(found)

        def emit(found: list) -> pa.RecordBatch:
            a, b = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
            both = np.unique(np.c_[np.minimum(a, b), np.maximum(a, b)], axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy() for c in ("f1", "f2", "group", "rep", "comp", "side")]
            cols += _unpack(batch.column("point").to_pylist())
            held = [np.concatenate(x) for x in zip(held, cols, strict=True)] if held else cols
            last = int(np.flatnonzero(starts(*held[:3]))[-1])
            if last:
                yield from close([c[:last] for c in held])
                held = [c[last:] for c in held]
        if held:
            yield from close(held)

    return run


def _verify(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for u, v in zip(*(shingle_sets(*string_buffers(batch.column(c)), k) for c in ("x", "y")), strict=True):
                both = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(100 * both >= percent * (len(u) + len(v) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _near(members: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    order = ["f1", "f2", "n", "point", "rep"]
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    m = members.select("f1", "f2", "rep").join(points, "rep").select(*order)
    return m.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_neighbours(percent), "a long, b long").distinct()


def _tiled(large: DataFrame) -> DataFrame:
    """Members of large blocks, once for each pair of tiles they belong to; what two tiles of one component share is left out."""
    large = written(large)
    per = large.groupBy("f1", "f2", "comp").agg(F.count("*").alias("c")).withColumn("owner", F.when(F.col("c") > TILE, F.col("comp")))
    tiles = per.groupBy("f1", "f2", "owner").agg(F.ceil(F.sum("c") / TILE).cast("int").alias("tiles"))
    owned = per.filter("owner IS NOT NULL").select("f1", "f2", "comp", "owner")
    others = tiles.select("f1", "f2", F.col("owner").alias("owner2"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile2"))
    key = lambda owner, tile: F.struct(owner.isNull().alias("x"), F.coalesce(owner, F.lit(0)).alias("y"), tile.alias("z"))
    m = large.join(owned, ["f1", "f2", "comp"], "left")
    same = m["f1"].eqNullSafe(tiles["f1"]) & m["f2"].eqNullSafe(tiles["f2"]) & m["owner"].eqNullSafe(tiles["owner"])
    m = m.join(tiles, same).select(m["f1"], m["f2"], "rep", "comp", m["owner"], F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int").alias("tile"))
    m = m.join(others, ["f1", "f2"]).filter(F.col("owner").isNull() | ~F.col("owner").eqNullSafe(F.col("owner2")))
    m = m.withColumns({"k": key(F.col("owner"), F.col("tile")), "k2": key(F.col("owner2"), F.col("tile2"))})
    side = F.when(F.col("k") == F.col("k2"), 0).when(F.col("k") < F.col("k2"), 1).otherwise(2)
    return m.select("f1", "f2", F.xxhash64(F.least("k", "k2"), F.greatest("k", "k2")).alias("group"), "rep", "comp", side.alias("side"))


def _pairs(members: DataFrame, points: DataFrame, comp: DataFrame, percent: int, mode: str) -> DataFrame:
    m = members.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("f1", "f2", "members", "rep", F.coalesce("component", "rep").alias("comp"))
    small = m.filter(F.col("members") <= TILE).select("f1", "f2", F.lit(0).cast("long").alias("group"), "rep", "comp", F.lit(0).alias("side"))
    large = m.filter(F.col("members") > TILE).select("f1", "f2", "rep", "comp")
    m = small if members.filter(F.col("members") > TILE).isEmpty() else small.unionByName(_tiled(large))
    m = m.join(points.select("rep", "point"), "rep").select("f1", "f2", "group", "rep", "comp", "side", "point")
    m = m.repartition("f1", "f2", "group").sortWithinPartitions("f1", "f2", "group", "rep")
    # A pair comes once from each block it shares.
    return m.mapInArrow(_candidates(percent, mode), "a long, b long").distinct()


def _linked(pairs: DataFrame, classes: DataFrame, live: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs of classes whose texts' sets reach the threshold."""
    pairs = written(pairs)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    needed = written(classes.join(wanted, "rep"))
    # Broadcast behind a count, so that the texts need no shuffle; beyond it the join shuffles.
    side = F.broadcast(needed) if needed.count() <= BROADCAST_ROWS else needed
    texts = live.join(side, ["doc", "tag"]).select("rep", "text")
    x = texts.select(F.col("rep").alias("a"), F.col("text").alias("x"))
    y = texts.select(F.col("rep").alias("b"), F.col("text").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify(k, percent), "a long, b long")


def near_duplicate_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row; a link is Jaccard of at least ``percent`` in a hundred."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("tag"), text.alias("text"))
    counted = written(own.mapInArrow(_sizes(k), "kind long, doc long, tag long, n long, s1 long, s2 long"))
    sized = counted.filter("kind = 0").drop("kind")
    # Any fixed order of tokens is exact; putting frequent ones last keeps passages that many documents share out of the prefixes.
    top = counted.filter("kind = 1").groupBy("tag").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "tag").limit(FREQUENT_TOKENS).select("tag").toArrow()
    frequent = docs.sparkSession.sparkContext.broadcast(np.sort(top.column("tag").to_numpy().astype(np.int64).view(np.uint64)))
    has = sized.filter("n > 0 AND doc IS NOT NULL")
    # A class of equal sets is named by its signature and stands for its smallest document.
    classes = has.groupBy(F.col("s1").alias("rep")).agg(F.min(F.struct("doc", "tag")).alias("r")).select("rep", F.col("r.doc").alias("doc"), F.col("r.tag").alias("tag"))
    live = own.filter(F.col("doc").isNotNull())
    full = live.mapInArrow(_sets(k, percent, frequent), "doc long, tag long, n long, s1 long, s2 long, point binary, prefix binary").filter("n > 0")
    first = lambda c: F.min_by(c, F.struct("doc", "tag")).alias(c)
    heads = written(full.groupBy(F.col("s1").alias("rep")).agg(first("point"), first("prefix"), first("n")))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "place", "rep"]
    posted = heads.select("rep", "n", "prefix").mapInArrow(_postings, "key long, place long, rep long").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = posted.mapInArrow(_blocks(percent), "f1 long, f2 long, f3 long, members long, reps binary").dropDuplicates(["f1", "f2", "f3"])
    listed = written(blocks.mapInArrow(_members, "f1 long, f2 long, members long, rep long"))
    border = listed.filter("members < 0").drop("members")
    total = border.groupBy("f1", "f2").agg(F.count("*").alias("members")).filter("members > 1")
    members = listed.filter("members > 0").unionByName(border.join(total, ["f1", "f2"]).select(listed.columns))
    points = heads.select("rep", "point", "n")
    again = has.select("doc", F.col("s1").alias("b")).distinct()
    again = again.join(again.groupBy("doc").agg(F.min("b").alias("a"), F.count("*").alias("c")).filter("c > 1"), "doc").select("a", "b")
    # First one neighbour of each class, then the best partner in another component: enough to join groups of near copies.
    near = _near(members, points, percent).groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    edges = written(_linked(near, classes, live, k, percent).unionByName(again))
    comp = written(connected_components(edges))
    for mode in ("best", "every"):
        more = written(_linked(_pairs(members, points, comp, percent, mode), classes, live, k, percent))
        if not more.isEmpty():
            # The stars found so far connect the same classes as all links before.
            stars = comp.select(F.col("node").alias("a"), F.col("component").alias("b"))
            comp = written(connected_components(stars.unionByName(more)))
    rooted = classes.select("rep", "doc").join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("rep", "doc", F.coalesce("component", "rep").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc").alias("least"))
    labels = rooted.join(least, "root").select("rep", "least")
    out = sized.join(labels, (sized["s1"] == labels["rep"]) & (sized["n"] > 0) & sized["doc"].isNotNull(), "left")
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("least", "doc").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, with one of each component: that of the smallest doc_id.

    Rows without a doc_id stay. Rows that repeat the kept doc_id stay.
    """
    comp = near_duplicate_components(docs, k, percent)
    lost = free_name(docs.columns, "lost_doc_id")
    lose = comp.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(lost)).distinct()
    return docs.join(lose, F.col("doc_id") == F.col(lost), "left_anti")
