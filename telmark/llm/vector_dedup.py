"""Operator 4: near-duplicate vectors by sorted projection passes.

Equal vectors with equal labels are first joined into one class with a count. In each pass the
classes of a label are ordered lexicographically by concatenated random hyperplane bits, and
each is compared with its neighbours in a bounded window; only pairs whose exact cosine reaches
the threshold are united, across all passes. Windows miss some pairs, so an exact search follows
for links between components: the classes of a label are packed into blocks in the order of a
projection, and blocks meet in a join by label and pair of cells, without those of one component and those whose
balls lie too far apart. Then all pairs inside each component are compared, in blocks, so components
and numbers of links are exact. Pairs are counted, never listed. The exact search grows with
the square of a label's classes where balls rule nothing out.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and
rows with a null label or id, link with nothing: n_links 0 and a component of their own.
Vectors of different lengths never link. Repeated rows count as further vectors. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telmark.llm.shared import connected_components, written
from telmark.llm.vectors import matrix, usable

BITS = 62
WINDOW = 256
BLOCK = 1024
PACKED = 1024
PACKS_IN_TASK = 32


def _project(passes: int, seed: int):
    """Rows to one row per pass with the code that orders them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = matrix(part.column("embedding"))
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).normal(size=(int(dim), passes * BITS))
                bits = (x @ planes[dim] > 0).reshape(len(x), passes, BITS)
                codes = bits @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                for p in range(passes):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), p, np.int32)), part.column("label"), part.column("dim"), pa.array(codes[:, p]), part.column("rep"), part.column("embedding")], names=["pass", "label", "dim", "code", "rep", "embedding"])

    return run


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _roots(linked: np.ndarray) -> np.ndarray:
    """For each row the first row of its component in a boolean link matrix."""
    n = len(linked)
    root = np.arange(n)
    while True:
        low = np.minimum(root, np.where(linked, root[None, :], n).min(1))
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _windows(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            group = np.stack([t.column(c).to_numpy() for c in ("pass", "label", "dim")], 1)
            rep = t.column("rep").to_numpy()
            cut = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(1)])
            a_all, b_all = [], []
            for s, e in zip(cut, np.r_[cut[1:], len(rep)], strict=True):
                if e - s < 2:
                    continue
                x = _unit(matrix(t.column("embedding").slice(s, e - s)))
                for i in range(0, max(1, e - s - WINDOW), WINDOW):
                    block = x[i : i + 2 * WINDOW]
                    root = _roots(block @ block.T >= threshold)
                    moved = np.flatnonzero(root != np.arange(len(root)))
                    a_all.append(rep[s + i + moved])
                    b_all.append(rep[s + i + root[moved]])
            if a_all:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_all)), pa.array(np.concatenate(b_all))], names=["a", "b"])
            held = t.slice(max(cut[-1], len(rep) - WINDOW))

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by label, dimension and code to blocks of up to ``PACKED``, each with the ball around its unit vectors."""

    def close(t: pa.Table, s: int, e: int) -> tuple:
        x = matrix(t.column("embedding").slice(s, e - s))
        rep, comp = (t.column(c).slice(s, e - s).to_numpy() for c in ("rep", "comp"))
        unit = _unit(x)
        center = unit.mean(0)
        radius = float(np.sqrt(((unit - center) ** 2).sum(1).max()))
        one = int(comp[0]) if (comp == comp[0]).all() else None
        return int(rep[0]), t.column("label")[s].as_py(), t.column("dim")[s].as_py(), one, center.tolist(), radius, rep.astype(np.int64).tobytes(), comp.astype(np.int64).tobytes(), x.tobytes()

    schema = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("one", pa.int64()), ("center", pa.list_(pa.float64())), ("radius", pa.float64()), ("reps", pa.binary()), ("comps", pa.binary()), ("vectors", pa.binary())])
    held: pa.Table | None = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t]).combine_chunks()
        if held is None or not len(held):
            continue
        group = np.stack([held.column(c).to_numpy() for c in ("label", "dim")], 1)
        cut = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(1)])
        done = 0
        for s, e in zip(cut, np.r_[cut[1:], len(held)], strict=True):
            for i in range(s, e, PACKED):
                # A block at the end may go on in the next batch.
                if batch is None or i + PACKED <= e or e < len(held):
                    done = min(i + PACKED, e)
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, close(held, i, done), strict=True))], schema=schema)
        held = held.slice(done)


def _between(threshold: float):
    """Pairs of blocks to links that join all components the pair's links join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_all, b_all = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for r in batch.to_pylist():
                x, y = (_unit(np.frombuffer(r[c]).reshape(-1, r["dim"])) for c in ("vectors", "vectors2"))
                rep, comp = (np.concatenate([np.frombuffer(r[c], np.int64), np.frombuffer(r[c + "2"], np.int64)]) for c in ("reps", "comps"))
                # Single precision finds what double precision decides.
                near = x.astype(np.float32) @ y.astype(np.float32).T >= threshold - 1e-4 - 2.4e-7 * r["dim"]
                i, j = np.nonzero(near & (comp[: len(x)][:, None] != comp[len(x) :][None, :]))
                for at in range(0, len(i), 1 << 16):
                    p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                    ok = (x[p] * y[q]).sum(1) >= threshold
                    a, b = rep[p[ok]], rep[len(x) + q[ok]]
                    pair = np.c_[comp[p[ok]], comp[len(x) + q[ok]]]
                    # One link for each pair of components is enough.
                    some = np.unique(pair, axis=0, return_index=True)[1] if len(pair) else np.zeros(0, np.int64)
                    a_all.append(a[some])
                    b_all.append(b[some])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_all)), pa.array(np.concatenate(b_all))], names=["a", "b"])

    return run


def _missed_links(members: DataFrame, codes: DataFrame, threshold: float, parts: int) -> DataFrame:
    """Links between classes of different components, at least one for each two components that have any in a block pair."""
    comp = members.withColumnRenamed("node", "rep")
    rows = codes.join(comp, "rep", "left").withColumn("comp", F.coalesce("component", "rep"))
    order = ["label", "dim", "code", "rep"]
    packs = rows.select(*order, "comp", "embedding").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    packs = written(packs.mapInArrow(_pack, "id long, label long, dim int, one long, center array<double>, radius double, reps binary, comps binary, vectors binary"))
    # A label's blocks are dealt to cells of about PACKS_IN_TASK; two cells are a key of the join, so a hot label has many keys.
    hot = packs.groupBy("label", "dim").agg(F.count("*").alias("c")).filter(F.col("c") > PACKS_IN_TASK).select("label", "dim", F.ceil(F.col("c") / PACKS_IN_TASK).cast("int").alias("cells"))
    packs = packs.join(hot, ["label", "dim"], "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
    packs = packs.withColumn("cell", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int"))
    own = ["id", "one", "center", "radius", "reps", "comps", "vectors"]
    left = packs.select("label", "dim", F.col("cell").alias("i"), F.explode(F.sequence("cell", F.col("cells") - 1)).alias("j"), *own)
    right = packs.select("label", "dim", F.explode(F.sequence(F.lit(0), "cell")).alias("i"), F.col("cell").alias("j"), *[F.col(c).alias(c + "2") for c in own])
    gap = F.sqrt(F.aggregate(F.zip_with("center", "center2", lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda s, v: s + v))
    far = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    # A block meets those of other cells, and of its own cell each once.
    once = (F.col("i") < F.col("j")) | (F.col("id") <= F.col("id2"))
    open_ = F.coalesce(F.col("one") != F.col("one2"), F.lit(True))
    pairs = left.join(right, ["label", "dim", "i", "j"]).filter(once & open_ & (gap <= F.col("radius") + F.col("radius2") + F.lit(far)))
    return pairs.select("dim", "reps", "comps", "vectors", "reps2", "comps2", "vectors2").mapInArrow(_between(threshold), "a long, b long")


def _count_links(threshold: float):
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        comp, rep, n, part = (t.column(c).to_numpy() for c in ("component", "rep", "n", "part"))
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        order = np.argsort(comp, kind="stable")
        cut = np.flatnonzero(np.r_[True, comp[order][1:] != comp[order][:-1]])
        reps, links = [], []
        for s, e in zip(cut, np.r_[cut[1:], len(order)], strict=True):
            own = order[s:e]
            x = _unit(matrix(t.column("embedding").take(pa.array(own))))
            if i == j:
                linked = x @ x.T >= threshold
                np.fill_diagonal(linked, False)
                reps.append(rep[own])
                links.append(linked @ n[own])
            else:
                a, b = part[own] == i, part[own] == j
                linked = x[a] @ x[b].T >= threshold
                reps += [rep[own[a]], rep[own[b]]]
                links += [linked @ n[own[b]], linked.T @ n[own[a]]]
        return pa.Table.from_arrays([pa.array(np.concatenate(reps)), pa.array(np.concatenate(links).astype(np.int64))], schema=schema)

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, passes: int = 8, seed: int = 11) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    ok = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    keyed = rows.withColumn("ok", ok).withColumns({"k1": F.xxhash64("label", "embedding"), "k2": F.xxhash64("embedding", F.lit(1), "label")})
    classes = keyed.filter("ok").groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    classes = written(classes.withColumn("dim", F.size("embedding")))
    items = "float" if dict(vectors.dtypes)["embedding"] == "array<float>" else "double"
    project = lambda n: classes.select("rep", "label", "dim", "embedding").mapInArrow(_project(n, seed), f"pass int, label long, dim int, code long, rep long, embedding array<{items}>")
    order = ["pass", "label", "dim", "code", "rep"]
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = project(passes).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_windows(threshold), "a long, b long")
    members = written(connected_components(edges))
    missed = written(_missed_links(members, project(1), threshold, parts))
    if not missed.isEmpty():
        members = written(connected_components(members.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(missed)))
    sizes = members.groupBy("component").agg(F.count("*").alias("size")).filter("size > 1").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    inside = members.withColumnRenamed("node", "rep").join(sizes, "component").join(classes.select("rep", "n", "embedding"), "rep")
    inside = inside.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # Components of one block share tasks; larger ones get a task for each pair of blocks.
    bucket = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(4 * parts))).otherwise(-1)
    inside = inside.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other"), "bucket": bucket, "own": F.when(F.col("blocks") == 1, 0).otherwise(F.col("component")), "dim": F.size("embedding")})
    linked = inside.groupBy("bucket", "own", "i", "j").applyInArrow(_count_links(threshold), "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))
    by_class = classes.select("k1", "k2", "rep", "n").join(members.withColumnRenamed("node", "rep"), "rep", "left").join(linked, "rep", "left").select("k1", "k2", F.col("n").alias("copies"), F.coalesce("component", "rep").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    out = keyed.select("vec_id", "ok", "k1", "k2").join(by_class, ["k1", "k2"], "left")
    comp = F.when(F.col("ok"), F.col("component")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.when(F.col("ok"), F.col("links") + F.col("copies") - 1).otherwise(0).cast("long").alias("n_links"), comp.alias("component_id"), F.coalesce(F.col("vec_id") == comp, F.lit(True)).alias("kept"))
