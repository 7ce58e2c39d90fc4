"""Operator 11: a Merkle manifest of a dataset, with membership proofs by an Octopus multiproof for each leaf partition.

A leaf is a digest of a row. Leaves of a group ascend by an order column; every ``ARITY`` consecutive nodes (the last run
may be shorter) become the digest of their concatenated hex digests, until one is left, the group's subroot. Subroots, by group,
likewise give the root.

Digests are written once as narrow rows, range-partitioned by group and order, and written again with their place. Leaf
partitions are short runs of that table. Each finds the largest complete subtrees in its range; only those go on, about
``2 * ARITY`` a level for each partition, and are joined to the nodes that straddle partitions, a level at a time. Each
partition also computes the minimal union of node coordinates that its proofs lack: at each level the members of the runs it touches
that neither it nor the level below can give. Those are fetched once, in one join; interiors that its leaves share are derived
once, and each leaf's proof is expanded in place. Subroots are the leaves of a second tree by the same steps, so any number of
groups will do. A hot group is many leaf partitions; no task holds more than ``LEAVES`` leaves, and the rows of a range
partition that are equal in all else are parted by their place in the first table.

Defined results: nulls are hashed as ``-``; a null group comes first, a null order value comes first in its group. Repeated
rows and rows of one order value are leaves each, ordered by digest, then in any order, since they are equal. A group of one
leaf is its own subroot, and a single subroot is the root; such a proof has no levels. Texts of any length are hashed whole. An
empty table gives an empty result. Columns to keep are passed on under names that never clash.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telmark.llm.shared import checkpoint_folder

ARITY = 16
#: Leaves of a leaf partition, and of a range partition that is cut into those.
LEAVES = 4096
RANGE_LEAVES = 1 << 20
#: So many nodes of the levels above are joined in one task.
TASK_NODES = 100_000
PROOF = "array<struct<before:string,after:string>>"
_PROOF = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def leaf_digest(*columns: Column) -> Column:
    """Hex sha256 of the values, each as ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[part(c.cast("string")) for c in columns]), 256)


def proof_digest(proof: Column) -> Column:
    """Hex sha256 of a proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda x: F.concat(x["before"], x["after"])), ""), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda acc, x: F.sha2(F.concat(x["before"], acc, x["after"]), 256))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{checkpoint_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _above(lo: int, hi: int, size: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Level by level up to the top: the nodes that a range of leaves gives, and the runs it touches.

    Yields ``(level, size, lo, hi, a, b)``: nodes ``lo`` to ``hi`` are known, ``a`` to ``b`` are members of their runs.
    """
    level = 0
    while size > 1:
        yield level, size, lo, hi, lo // ARITY * ARITY, min(size, -(-hi // ARITY) * ARITY)
        lo, hi, size, level = lo // ARITY, -(-hi // ARITY), -(-size // ARITY), level + 1


def _height(size: int) -> int:
    n = 0
    while size > 1:
        size, n = -(-size // ARITY), n + 1
    return n


def _runs(nodes: list[str]) -> list[str]:
    """Digests of consecutive runs that begin at a border."""
    return [_digest("".join(nodes[i : i + ARITY])) for i in range(0, len(nodes), ARITY)]


def _subtrees(digests: list[str], lo: int, size: int) -> Iterator[tuple[int, int, str]]:
    """The largest complete subtrees over leaves from ``lo`` on, as ``(level, index, digest)``."""
    level = 0
    while digests:
        hi = lo + len(digests)
        a, b = -(-lo // ARITY), (-(-hi // ARITY) if hi == size else hi // ARITY)
        if size == 1 or a >= b:
            yield from ((level, lo + i, d) for i, d in enumerate(digests))
            return
        yield from ((level, lo + i, d) for i, d in enumerate(digests[: a * ARITY - lo]))
        yield from ((level, b * ARITY + i, d) for i, d in enumerate(digests[b * ARITY - lo :]))
        digests = _runs(digests[a * ARITY - lo : b * ARITY - lo])
        lo, size, level = a, -(-size // ARITY), level + 1


def _proofs(digests: list[str], lo: int, size: int, fetched: dict[tuple[int, int], str]) -> list[list[tuple[str, str]]]:
    """Each leaf's siblings before and after it at each level; pairs of shared nodes are shared objects."""
    levels = []
    for level, _, first, last, a, b in _above(lo, lo + len(digests), size):
        nodes = [fetched[level, i] for i in range(a, first)] + digests + [fetched[level, i] for i in range(last, b)]
        pairs = []
        for i in range(first, last):
            at, start = i - a, (i - a) // ARITY * ARITY
            pairs.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + ARITY])))
        levels.append((first, pairs))
        digests = _runs(nodes)
    out = []
    for i in range(lo, lo + (len(levels[0][1]) if levels else len(digests))):
        own, at = [], i
        for first, pairs in levels:
            own.append(pairs[at - first])
            at //= ARITY
        out.append(own)
    return out


def _list(rows: list[list[tuple[str, str]]]) -> pa.Array:
    flat = [x for own in rows for x in own]
    ends = [0]
    for own in rows:
        ends.append(ends[-1] + len(own))
    pairs = pa.StructArray.from_arrays([pa.array([x[0] for x in flat], pa.string()), pa.array([x[1] for x in flat], pa.string())], ["before", "after"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)


def _placed(leaves: DataFrame) -> DataFrame:
    """The leaves in order with ``part`` and ``place``, frozen in a table. Expects ``grp, ord, digest`` and more columns."""
    frozen = _written(leaves, "leaves")
    n = max(1, -(-frozen.count() // RANGE_LEAVES))
    # The table's files are read alike by every attempt of a task, so that the row's place parts equal rows for good.
    sorted_ = frozen.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, "grp", "ord", "digest", "_tie").sortWithinPartitions("grp", "ord", "digest", "_tie")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = sorted_.withColumns({"range": F.spark_partition_id(), "place": place}).drop("_tie")
    return _written(rows.withColumn("part", F.shiftleft(F.col("range").cast("long"), 32) + F.floor(F.col("place") / LEAVES)), "ordered")


def _tree(leaves: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The leaves in order, the spans of each part and group, all nodes above the parts, and the coordinates each part wants."""
    ordered = _placed(leaves)
    # Two steps of counting: a group's ranges are few, a range's parts are bounded.
    ranges = ordered.groupBy("range", "grp").agg(F.count("*").alias("n"), F.min("place").alias("least"))
    w = Window.partitionBy("grp").orderBy("range")
    ranges = ranges.withColumns({"offset": F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "size": F.sum("n").over(Window.partitionBy("grp"))})
    spans = ordered.groupBy("part", "range", "grp").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    r = ranges.select(F.col("range").alias("r"), F.col("grp").alias("g"), "least", "offset", "size")
    spans = spans.join(r, (F.col("range") == F.col("r")) & F.col("grp").eqNullSafe(F.col("g")))
    spans = _written(spans.select("part", "grp", "first", "n", (F.col("offset") + F.col("first") - F.col("least")).alias("lo"), "size"), "spans")

    schema = pa.schema([("part", pa.int64()), ("grp", pa.string()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.string()), ("height", pa.int32())])

    def work(own: pa.Table, mine: pa.Table) -> pa.Table:
        digests = [d.hex() for d in own.sort_by("place").column("digest").to_pylist()]
        rows, at = [], 0
        for s in mine.sort_by("first").to_pylist():
            part = digests[at : at + s["n"]]
            at += s["n"]
            lo, size, height = s["lo"], s["size"], _height(s["size"])
            rows += [(None, s["grp"], level, i, d, height) for level, i, d in _subtrees(part, lo, size)]
            for level, _, first, last, a, b in _above(lo, lo + s["n"], size):
                rows += [(s["part"], s["grp"], level, i, None, height) for i in (*range(a, first), *range(last, b))]
        cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    found = ordered.select("part", "place", "digest").groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(work, "part long, grp string, level int, idx long, digest string, height int")
    found = _written(found, "subtrees")
    known = found.filter("part IS NULL").drop("part")
    top = known.agg(F.count("*").alias("n"), F.max("height").alias("h")).first()
    known = known.coalesce(-(-max(1, top["n"]) // TASK_NODES))
    levels, joined = [known], None
    for level in range(top["h"] or 0):
        at = known.filter(F.col("level") == level)
        if joined is not None:
            at = at.unionByName(joined)
        # A run's members that no part could join are all here; a group's top has no run.
        at = at.filter(F.col("height") > level)
        if top["n"] <= TASK_NODES:
            at = at.coalesce(1)
        run = F.array_sort(F.collect_list(F.struct("idx", "digest")))
        joined = at.groupBy("grp", F.floor(F.col("idx") / ARITY).alias("up")).agg(F.sha2(F.array_join(F.transform(run, lambda x: x["digest"]), ""), 256).alias("digest"), F.max("height").alias("height"))
        joined = joined.select("grp", F.lit(level + 1).alias("level"), F.col("up").alias("idx"), "digest", "height")
        levels.append(joined)
    nodes = levels[0]
    for x in levels[1:]:
        nodes = nodes.unionByName(x)
    nodes = _written(nodes, "nodes")
    wanted = found.filter("part IS NOT NULL").select("part", "grp", "level", "idx")
    return ordered, spans, nodes, wanted


def _fetched(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    n = nodes.select(F.col("grp").alias("g"), F.col("level").alias("l"), F.col("idx").alias("i"), "digest")
    return wanted.join(n, (F.col("level") == F.col("l")) & (F.col("idx") == F.col("i")) & F.col("grp").eqNullSafe(F.col("g"))).select("part", "grp", "level", "idx", "digest")


def _expanded(ordered: DataFrame, spans: DataFrame, fetched: DataFrame, upper: DataFrame | None, keep: list[str]) -> DataFrame:
    """Each row with ``grp``, ``leaf``, the columns to keep and ``proof``; with ``upper``, proofs to the root and ``subroot``."""
    none = lambda kind: F.lit(None).cast(kind)
    given = spans.select("part", F.lit(0).alias("kind"), "grp", "first", "n", "lo", "size", none("int").alias("level"), none("string").alias("digest"), none(PROOF).alias("path"))
    given = given.unionByName(fetched.select("part", F.lit(1).alias("kind"), "grp", none("long").alias("first"), none("long").alias("n"), F.col("idx").alias("lo"), none("long").alias("size"), "level", "digest", none(PROOF).alias("path")))
    if upper is not None:
        u = upper.select(F.col("grp").alias("g"), F.col("leaf").alias("digest"), F.col("proof").alias("path"))
        tops = spans.select("part", "grp").join(u, F.col("grp").eqNullSafe(F.col("g")))
        given = given.unionByName(tops.select("part", F.lit(2).alias("kind"), "grp", none("long").alias("first"), none("long").alias("n"), none("long").alias("lo"), none("long").alias("size"), none("int").alias("level"), "digest", "path"))
    rows = ordered.select("part", "place", "grp", "digest", *keep)
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = ", ".join([f"`{c}` {fields[c]}" for c in keep] + ["grp string", "leaf string", "subroot string", f"proof {PROOF}"])

    def work(own: pa.Table, mine: pa.Table) -> pa.Table:
        own = own.sort_by("place")
        digests = [d.hex() for d in own.column("digest").to_pylist()]
        lists: dict = {0: [], 1: {}, 2: {}}
        for s in mine.to_pylist():
            if s["kind"] == 0:
                lists[0].append(s)
            elif s["kind"] == 1:
                lists[1].setdefault(s["grp"], {})[s["level"], s["lo"]] = s["digest"]
            else:
                lists[2][s["grp"]] = (s["digest"], [(x["before"], x["after"]) for x in s["path"]])
        proofs, tops, at = [], [], 0
        for s in sorted(lists[0], key=lambda s: s["first"]):
            top, path = lists[2].get(s["grp"], (None, []))
            proofs += [p + path for p in _proofs(digests[at : at + s["n"]], s["lo"], s["size"], lists[1].get(s["grp"], {}))]
            tops += [top] * s["n"]
            at += s["n"]
        cols = [own.column(c) for c in keep] + [own.column("grp"), pa.array(digests, pa.string()), pa.array(tops, pa.string()), _list(proofs)]
        return pa.table(cols, names=[*keep, "grp", "leaf", "subroot", "proof"])

    return rows.groupBy("part").cogroup(given.groupBy("part")).applyInArrow(work, out)


def manifest(df: DataFrame, group: Column, order: Column, digest: Column, keep: list[str]) -> DataFrame:
    """A row for each leaf: the columns to keep, ``leaf``, ``subroot``, ``root`` and ``proof``.

    ``digest`` is a leaf's hex digest; ``proof`` lists, level by level up to the root, the siblings before and after the node
    on the leaf's path, as concatenated hex digests. The group is compared as text.
    """
    names = {c: f"keep_{i}" for i, c in enumerate(keep)}
    leaves = df.select(group.cast("string").alias("grp"), order.alias("ord"), F.unhex(digest).alias("digest"), *[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    ordered, spans, nodes, wanted = _tree(leaves)
    subroots = nodes.filter("level = height").select(F.lit(None).cast("string").alias("grp"), F.col("grp").alias("ord"), F.unhex("digest").alias("digest"))
    o, s, n, w = _tree(subroots)
    upper = _expanded(o, s, _fetched(n, w), None, ["ord"]).select(F.col("ord").alias("grp"), "leaf", "proof")
    # One row at most.
    root = n.filter("level = height").select("digest").first()
    out = _expanded(ordered, spans, _fetched(nodes, wanted), _written(upper, "upper"), list(names.values()))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()], "leaf", "subroot", F.lit(root["digest"] if root else None).cast("string").alias("root"), "proof")
