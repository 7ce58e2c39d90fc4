"""Operator 13: packing by non-negative least squares over combinations of lengths that fill a window.

A document is its ids and an end token. Its full pieces of a sequence's length stand alone; what is left, its tail, is shorter than a sequence. A
sequence whose length is a power of two needs no padding, so that every power of two up to the sequence length is a window. All
combinations of one or two tails that fill a window exactly are enumerated, and of three for windows up to ``TRIPLES``. Their repeat
counts are solved by non-negative least squares against the histogram of all tails, then rounded down, and raised
again where tails are left. Histogram and combinations are bounded by the sequence length, whatever the input; nothing else comes to the
driver. A tail's number among those of its length, from counts per part of the input, decides its place: no group of
documents is gathered, and a length that a third of all documents have is no hot key. Small windows line up inside sequences.

Tails that no combination takes are packed greedily in groups: longest first, each where it leaves least room; then the least
filled bins are poured out into the gaps of the others, which cuts at most one document a gap. The rest, less than a
sequence a group, is cut at powers of two. So no sequence is padded, and only residual tails are cut.

Ids are written once with the table of tails, two bytes each where the vocabulary allows, and read again only for tails that are cut: bitmaps of these are sent out, so that the ids of no other tail move.

Defined results: a null text is an empty one: a single end token. Repeated rows are packed each. Very long texts are
cut into as many pieces as they need. Null doc_ids stay null. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telmark.llm.packing import _slices, token_bytes
from telmark.llm.shared import checkpoint_folder

TRIPLES = 1024
ROUNDS = 60
#: Bitmaps of 4 KB each that all tasks may get.
BITMAPS = 16_384
#: Where sequence ids of each kind begin: windows that fill no whole sequence, residual groups, and full pieces.
SPLIT, RESIDUAL, FULL = 1 << 58, 1 << 60, 1 << 61
TAILS = "part int, place long, doc_id long, doc_tokens long, full array<long>, full_first long, tail int, nth long, crc long, ids binary"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{checkpoint_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tails(docs: DataFrame, path: str, sequence_length: int, end_id: int) -> DataFrame:
    """A row for each document: checksums of its full pieces, and its tail with its number among the part's tails of that length."""
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * sequence_length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, full = TaskContext.get().partitionId(), 0, 0
        seen = np.zeros(sequence_length, np.int64).tolist()
        for batch in batches:
            docs_, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for i, j in _slices(texts):
                rows: list[tuple] = []
                for doc, ids in zip(docs_[i:j], token_bytes(texts[i:j], path), strict=True):
                    ids += end
                    n = len(ids) // 4
                    tail, whole = n % sequence_length, n // sequence_length
                    crcs = [zlib.crc32(ids[at * width : (at + 1) * width]) for at in range(whole)]
                    rest = ids[whole * width :]
                    narrow = np.frombuffer(rest, "<u4")
                    if narrow.size and narrow.max() < 1 << 16:
                        narrow = narrow.astype("<u2")
                    rows.append((part, place, doc, n, crcs, full, tail, seen[tail], zlib.crc32(rest), narrow.tobytes()))
                    seen[tail] += 1
                    full += whole
                    place += 1
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in TAILS.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, TAILS)


def combinations(lengths: np.ndarray, sequence_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows and the one to three lengths, ascending and 0 where there are fewer, that fill each exactly."""
    has = np.zeros(sequence_length + 1, bool)
    has[lengths] = True
    windows, members = [], []
    w = 1
    while w <= sequence_length:
        if w < sequence_length and has[w]:
            windows.append([w])
            members.append([[0, 0, w]])
        a = np.arange(1, w // 2 + 1)
        a = a[has[a] & has[w - a]]
        if len(a):
            windows.append(np.full(len(a), w))
            members.append(np.stack([np.zeros_like(a), a, w - a], axis=1))
        if w <= TRIPLES:
            for first in np.flatnonzero(has[1 : w // 3 + 1]) + 1:
                b = np.arange(first, (w - first) // 2 + 1)
                b = b[has[b] & has[w - first - b]]
                if len(b):
                    windows.append(np.full(len(b), w))
                    members.append(np.stack([np.full_like(b, first), b, w - first - b], axis=1))
        w *= 2
    if not windows:
        return np.zeros(0, np.int64), np.zeros((0, 3), np.int64)
    return np.concatenate(windows).astype(np.int64), np.concatenate([np.asarray(m, np.int64) for m in members])


def solve(members: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Repeat counts, not negative, whose use of each length is nearest to the histogram, long tails weighing more.

    Multiplicative steps for least squares: each keeps the counts non-negative and never raises the error.
    """
    weight = (np.arange(len(count)) / len(count)) ** 2
    use = lambda x: sum(np.bincount(members[:, i], x, len(count)) for i in range(3))
    back = lambda r: (weight * r)[members].sum(axis=1)
    goal = back(count.astype(np.float64))
    x = np.ones(len(members))
    for _ in range(ROUNDS):
        used = use(x)
        used[0] = 0
        x = x * goal / np.maximum(back(used), 1e-300)
    return x


@dataclass
class Plan:
    """Which tail of a length goes where: slots of length L from number ``first`` on lie ``step`` tokens apart from ``at`` on."""

    key: np.ndarray
    at: np.ndarray
    step: np.ndarray
    inside: np.ndarray
    used: np.ndarray
    tokens: int


def _rounded(members: np.ndarray, x: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Whole repeat counts within the histogram: rounded down first, then as many more as tails allow, largest fraction first."""
    left, repeats = count.tolist(), [0] * len(x)
    floor = np.floor(x).astype(np.int64)
    rest = x - floor

    def take(order: np.ndarray, most: list[int] | None) -> None:
        for j in order.tolist():
            own = [v for v in rows[j] if v]
            n = min(left[v] // own.count(v) for v in own)
            if most is not None:
                n = min(n, most[j])
            if n > 0:
                repeats[j] += n
                for v in own:
                    left[v] -= n

    rows = members.tolist()
    some = np.flatnonzero(floor)
    take(some[np.argsort(-x[some], kind="stable")], floor.tolist())
    take(np.argsort(-rest, kind="stable"), None)
    return np.array(repeats, np.int64)


def plan(histogram: dict[int, int], sequence_length: int) -> Plan:
    count = np.zeros(sequence_length + 1, np.int64)
    for length, n in histogram.items():
        count[length] = n
    count[0] = 0
    windows, members = combinations(np.flatnonzero(count), sequence_length)
    repeats = _rounded(members, solve(members, count), count) if len(members) else np.zeros(0, np.int64)
    some = np.flatnonzero(repeats)
    # Large windows first, so that each lies within one sequence.
    some = some[np.argsort(-windows[some], kind="stable")]
    key, at, step, inside, used, tokens = [], [], [], [], [0] * (sequence_length + 1), 0
    for j in some.tolist():
        w, n, before = int(windows[j]), int(repeats[j]), 0
        for v in members[j].tolist():
            if v:
                key.append((v << 40) + used[v])
                at.append(tokens)
                step.append(w)
                inside.append(before)
                used[v] += n
                before += v
        tokens += w * n
    order = np.argsort(np.array(key, np.int64), kind="stable")
    pick = lambda a: np.array(a, np.int64)[order]
    return Plan(pick(key), pick(at), pick(step), pick(inside), np.array(used, np.int64), tokens)


def _look_up(p: Plan, tail: np.ndarray, number: np.ndarray, sequence_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether a tail has a slot, its sequence and its offset there."""
    taken = (tail > 0) & (number < p.used[tail])
    sequence, offset = np.zeros(len(tail), np.int64), np.zeros(len(tail), np.int64)
    some = np.flatnonzero(taken)
    if len(some):
        key = (tail[some].astype(np.int64) << 40) + number[some]
        e = np.searchsorted(p.key, key, side="right") - 1
        start = p.at[e] + (key - p.key[e]) * p.step[e]
        whole = start < p.tokens // sequence_length * sequence_length
        sequence[some] = np.where(whole, start // sequence_length, SPLIT + start)
        offset[some] = np.where(whole, start % sequence_length, 0) + p.inside[e]
    return taken, sequence, offset


def pour(lengths: list[int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Greedy packing without padding: ``(row, start, length, sequence, offset)``."""
    spaces: dict[int, list[int]] = {}
    bins: list[list[int]] = []
    open_ = 0
    for row in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[row]
        fits = open_ >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            at = spaces[room].pop()
            if not spaces[room]:
                open_ &= ~(1 << room)
        else:
            room, at = capacity, len(bins)
            bins.append([])
        bins[at].append(row)
        if room > n:
            spaces.setdefault(room - n, []).append(at)
            open_ |= 1 << (room - n)
    bins.sort(key=lambda b: -sum(lengths[i] for i in b))
    n_full = sum(lengths) // capacity
    out = []
    pool = [[row, 0, lengths[row]] for b in reversed(bins[n_full:]) for row in b]

    def fill(sequence: int, at: int, end: int) -> None:
        while at < end:
            top = pool[-1]
            n = min(top[2], end - at)
            out.append((top[0], top[1], n, sequence, at))
            top[1], top[2], at = top[1] + n, top[2] - n, at + n
            if not top[2]:
                pool.pop()

    for sequence, b in enumerate(bins[:n_full]):
        at = 0
        for row in b:
            out.append((row, 0, lengths[row], sequence, at))
            at += lengths[row]
        fill(sequence, at, capacity)
    rest, sequence = sum(x[2] for x in pool), n_full
    while rest:
        size = 1 << (rest.bit_length() - 1)
        fill(sequence, 0, size)
        rest, sequence = rest - size, sequence + 1
    return out


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``number``, a tail's place among all of its length: those of earlier parts come first."""
    per = rows.groupBy("part", "tail").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("tail").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(per.select("part", "tail", before.alias("before")), ["part", "tail"]).withColumn("number", F.col("before") + F.col("nth")).drop("before", "nth")


def _marked(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose ``part`` and ``place`` are among the wanted ones, by bitmaps of a bit for each row that are sent to all tasks; the rows themselves do not move.

    With more bitmaps than ``BITMAPS`` all rows are left.
    """
    place = F.col("place") + 1
    bits = wanted.groupBy("part", F.bitmap_bucket_number(place).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits"))
    bits = _written(bits, "marks")
    if bits.count() > BITMAPS:
        return rows
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.expr("substring(_bits, CAST(_at div 8 + 1 AS INT), 1)")), 16, 10).cast("int")
    near = rows.withColumns({"_bucket": F.bitmap_bucket_number(place), "_at": at}).join(F.broadcast(bits), ["part", "_bucket"])
    return near.filter(byte.bitwiseAND(F.expr("shiftleft(1, CAST(_at % 8 AS INT))")) != 0).select(rows.columns)


def pack_documents(docs: DataFrame, path: str, sequence_length: int = 4096, end_id: int = 2, group_rows: int = 16384) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of all pieces."""
    if sequence_length & (sequence_length - 1):
        raise ValueError("the sequence length must be a power of two")
    written = _written(tails(docs, path, sequence_length, end_id), "tails")
    p = plan({r["tail"]: r["count"] for r in written.groupBy("tail").count().collect()}, sequence_length)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken, sequence, offset = _look_up(p, batch.column("tail").to_numpy().astype(np.int64), batch.column("number").to_numpy(), sequence_length)
            cols = [batch.column(c) for c in ("part", "place", "doc_id", "doc_tokens", "tail", "crc")] + [pa.array(taken), pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(cols, names=["part", "place", "doc_id", "doc_tokens", "tail", "crc", "taken", "sequence_id", "offset"])

    narrow = _numbered(written.filter("tail > 0").select("part", "place", "doc_id", "doc_tokens", "tail", "crc", "nth"))
    placed = _written(narrow.mapInArrow(place, "part int, place long, doc_id long, doc_tokens long, tail int, crc long, taken boolean, sequence_id long, offset long"), "placed")

    residual = placed.filter("NOT taken").select("part", "place", "doc_id", "doc_tokens", "tail", "crc")
    n_groups = max(1, -(-residual.count() // group_rows))

    def greedy(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["part", "place"]).reset_index(drop=True)
        row, start, length, sequence, offset = np.array(pour(df["tail"].tolist(), sequence_length), np.int64).T
        out = df.iloc[row].reset_index(drop=True)
        out["at"], out["length"], out["offset"] = start, length, offset
        out["sequence_id"] = RESIDUAL + (int(key[0]) << 36) + sequence
        return out[["part", "place", "doc_id", "doc_tokens", "tail", "crc", "at", "length", "sequence_id", "offset"]]

    keyed = residual.withColumn("g", F.pmod(F.xxhash64("part", "place"), F.lit(n_groups)))
    poured = keyed.groupBy("g").applyInPandas(lambda key, df: greedy(key, df.drop(columns="g")), "part int, place long, doc_id long, doc_tokens long, tail int, crc long, at long, length long, sequence_id long, offset long")
    poured = _written(poured, "poured")

    def checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for ids, n, at, length in zip(*(batch.column(c).to_pylist() for c in ("ids", "tail", "at", "length")), strict=True):
                crcs.append(zlib.crc32(np.frombuffer(ids, f"<u{len(ids) // n}")[at : at + length].astype("<u4").tobytes()))
            cols = [batch.column(c) for c in ("doc_id", "doc_tokens", "tail", "at", "length", "sequence_id", "offset")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(crcs, pa.int64())], names=["doc_id", "doc_tokens", "tail", "at", "length", "sequence_id", "offset", "crc"])

    cut = poured.filter("length < tail").drop("crc")
    cut = cut.join(_marked(written.select("part", "place", "ids"), cut).hint("merge"), ["part", "place"])
    cut = cut.mapInArrow(checksum, "doc_id long, doc_tokens long, tail int, at long, length long, sequence_id long, offset long, crc long")

    def piece(df: DataFrame, at: Column, length: Column) -> DataFrame:
        return df.select("doc_id", (F.col("doc_tokens") - F.col("tail") + at).cast("long").alias("start"), length.cast("long").alias("length"), F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

    full = written.select("doc_id", "doc_tokens", "part", "full_first", F.posexplode("full").alias("i", "crc"))
    full = full.select("doc_id", (F.col("i").cast("long") * sequence_length).alias("start"), F.lit(sequence_length).cast("long").alias("length"), F.col("crc").alias("ids_crc32"), "doc_tokens", (F.lit(FULL) + F.shiftleft(F.col("part").cast("long"), 38) + F.col("full_first") + F.col("i")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = full.unionByName(piece(placed.filter("taken"), F.lit(0), F.col("tail")))
    out = out.unionByName(piece(poured.filter("length = tail"), F.lit(0), F.col("length")))
    return out.unionByName(piece(cut, F.col("at"), F.col("length")))
