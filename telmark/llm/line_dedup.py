"""Operator 9: line deduplication by range-partitioned hashes with a secondary sort.

Lines of every text become ``(hash, doc_id, position)`` rows. They are range-partitioned by
hash, then document, then position, so that a very frequent line spreads over several
partitions, and sorted inside each. A stream over a partition sees the lines of one key
together, largest document first: it keeps the first document's and drops the others' once a
third document shows. Keys that touch a partition's border, or whose run is long, are settled
by a pre-aggregated count of documents instead, so nothing depends on where borders fall. The
result is a compressed keep bitmap per document that loses lines; texts stay where they are
until the bitmaps are applied.

Defined results: null and empty texts are one empty line, kept. A null ``doc_id`` counts as
one document smaller than all others. Rows that repeat a doc_id count as one document, and
each gets its own bitmap; rows that repeat a text too share one. Lines shorter than ``min_chars`` stay. Very long texts
are hashed whole. An empty table gives an empty result. Further columns, of any name, are carried through by
``drop_lines``, which says which names it adds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telmark.llm.shared import durable, free_name
from telmark.llm.text_hash import chunks, line_keys, string_buffers

LINE_SCHEMA = "h1 long, h2 long, doc long, tag long, pos int, n_lines int"
RUN_ROWS = 100_000


def _hash_lines(min_chars: int):
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("pos", pa.int32()), ("n_lines", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, raw = string_buffers(batch.column("text"))
            doc = batch.column("doc").to_numpy(zero_copy_only=False)
            tag = batch.column("tag").to_numpy(zero_copy_only=False)
            for i, j in chunks(offsets):
                lo, hi = int(offsets[i]), int(offsets[j])
                row, pos, length, h1, h2 = line_keys(raw[lo:hi], offsets[i : j + 1] - lo)
                n = np.bincount(row, minlength=j - i)
                keep = np.flatnonzero(length >= min_chars)
                r = row[keep] + i
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (h1[keep].view(np.int64), h2[keep].view(np.int64), doc[r], tag[r], pos[keep].astype(np.int32), n[row[keep]].astype(np.int32))],
                    schema=schema,
                )

    return run


def _stream_runs(min_docs: int):
    """Rows sorted by key, document descending, position: dropped lines (edge 0) and undecided ones (edge 1)."""
    names = ["h1", "h2", "doc", "tag", "pos", "n_lines"]
    kinds = [np.int64] * 4 + [np.int32] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        edge_key: tuple[int, int] | None = None  # a key whose rows are all left to the second step
        seen = False

        def out(cols: list[np.ndarray], pick: np.ndarray, edge: int) -> pa.RecordBatch:
            arrays = [pa.array(c[pick]) for c in cols]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(np.full(int(pick.sum()), edge, np.int32))], names=[*names, "edge"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy(zero_copy_only=False).astype(t, copy=False) for k, t in zip(names, kinds, strict=True)]
            if held is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(held, cols, strict=True)]
            h1, h2, doc = cols[:3]
            if not seen:
                seen, edge_key = True, (int(h1[0]), int(h2[0]))
            new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            start = np.flatnonzero(new)
            of = np.cumsum(new) - 1
            other = np.r_[True, doc[1:] != doc[:-1]] | new
            docs = np.add.reduceat(other.astype(np.int64), start)
            last = of == len(start) - 1
            edge = np.zeros(len(h1), bool)
            if edge_key == (int(h1[0]), int(h2[0])):
                edge |= of == 0
            if last.sum() > RUN_ROWS:
                edge |= last
            if edge[-1]:
                edge_key, held = (int(h1[-1]), int(h2[-1])), None
                last = np.zeros(len(h1), bool)
            else:
                held = [c[last] for c in cols]
            drop = ~last & ~edge & (docs[of] >= min_docs) & (doc != doc[start][of])
            yield out(cols, drop, 0)
            yield out(cols, edge, 1)
        if held is not None:
            yield out(held, np.ones(len(held[0]), bool), 1)

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines = batch.column("n_lines").to_pylist()
        pos = batch.column("positions")
        maps, dropped = [], []
        for r, n in enumerate(n_lines):
            keep = np.ones(n, bool)
            keep[pos[r].values.to_numpy(zero_copy_only=False)] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 6))
            dropped.append(int(n - keep.sum()))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("tag"), batch.column("n_lines"), pa.array(dropped, pa.int64()), pa.array(maps, pa.binary())], names=["doc", "tag", "n_lines", "n_dropped", "keep_bitmap"])


def _own(docs: DataFrame) -> DataFrame:
    """The three columns used, under names of their own."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"), F.xxhash64(text).alias("tag"), text.alias("text"))


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``(doc, tag, n_lines, n_dropped, keep_bitmap)`` of each document that loses lines.

    ``tag`` is ``xxhash64(text)``; with ``doc`` it names the row. The bitmap is
    zlib-compressed, one bit per line, most significant first.
    """
    lines = durable(_own(docs).mapInArrow(_hash_lines(min_chars), LINE_SCHEMA))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["h1", "h2", F.col("doc").desc(), "tag", "pos"]
    runs = durable(lines.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(_stream_runs(min_docs), LINE_SCHEMA + ", edge int"))
    edge = runs.filter("edge = 1").drop("edge")
    counted = (
        edge.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(F.count("one").alias("docs"), F.max("doc").alias("top")).filter(F.col("docs") >= min_docs)
    )
    settled = edge.join(counted, ["h1", "h2"]).filter(F.col("doc") != F.col("top"))
    cols = ["doc", "tag", "n_lines", "pos"]
    drops = runs.filter("edge = 0").select(*cols).unionByName(settled.select(*cols))
    per_doc = drops.groupBy("doc", "tag", "n_lines").agg(F.collect_set("pos").alias("positions"))
    return per_doc.mapInArrow(_bitmaps, "doc long, tag long, n_lines int, n_dropped long, keep_bitmap binary")


def _kept_text(text: str, bitmap: bytes | None) -> str:
    if bitmap is None:
        return text
    lines = text.split("\n")
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines)).astype(bool)
    return "\n".join([x for x, k in zip(lines, keep.tolist(), strict=True) if k])


def drop_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, counts: tuple[str, str] | None = ("n_lines_before", "n_lines_dropped")) -> DataFrame:
    """The documents, with all their columns, and ``text`` without the dropped lines.

    A null text stays null. Two columns of the names in ``counts`` (long) are added; columns of the
    documents that have such a name give way. Null adds none, and all columns stay.
    """
    from pyspark.sql.types import LongType, StructField, StructType

    doc, tag, lost, bitmap, d, t = (free_name(docs.columns, f"__{c}") for c in ("doc", "tag", "dropped", "bitmap", "d", "t"))
    maps = keep_bitmaps(docs, min_chars, min_docs).select(F.col("doc").alias(doc), F.col("tag").alias(tag), F.col("n_dropped").alias(lost), F.col("keep_bitmap").alias(bitmap))
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumns({d: F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), t: F.xxhash64(text)})
    joined = keyed.join(maps, (F.col(d) == F.col(doc)) & (F.col(t) == F.col(tag)), "left").drop(d, t, doc, tag)
    own = [c for c in docs.columns if c not in (counts or ())]
    schema = StructType([f for f in docs.schema.fields if f.name in own] + [StructField(c, LongType()) for c in counts or ()])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, maps_ = batch.column("text").to_pylist(), batch.column(bitmap).to_pylist()
            new = [None if x is None else _kept_text(x, m) for x, m in zip(texts, maps_, strict=True)]
            arrays = [pa.array(new, pa.large_string()).cast(batch.schema.field("text").type) if c == "text" else batch.column(c) for c in own]
            if counts:
                arrays += [pa.array([(x or "").count("\n") + 1 for x in texts], pa.int64()), batch.column(lost).fill_null(0)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return joined.mapInArrow(apply, schema)
