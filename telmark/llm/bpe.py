"""Operator 10: byte-level BPE with a rank queue made of a hierarchical bitmap.

A pre-token's bytes form a linked list. For each adjacent pair that a merge rank covers, its
left position goes into the bucket of that rank, and the rank's bit is set in a bitmap of
two levels of 256-bit words. Find-first-set gives the lowest rank; the bucket's leftmost position
is merged if it still holds that pair (stale entries are skipped), and the two new neighbours
are queued. The work is near linear in a pre-token's length, however long.

Each distinct chunk of a batch is encoded once. Its short pre-tokens share one queue, whose buckets are merged
a bucket at a time; each of more than ``MANY_BYTES`` bytes has a queue to itself. Tasks keep the ids of
chunks they have met in a table that is emptied when it reaches a bound, so memory does not grow
with the input.

Defined results: null and empty texts encode to no ids. Null doc_ids stay null, repeated rows are encoded
each, an empty table gives an empty result, other columns are ignored. Texts are encoded whole, whatever
their length. Unknown single bytes cannot occur: the vocabulary must hold all 256, which is checked.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telmark.llm.text_hash import chunks, string_buffers

CACHE_ENTRIES = 600_000
CACHE_TOKEN_BYTES = 256
#: Longer pre-tokens have a queue of their own.
MANY_BYTES = 64
SLICE_BYTES = 8 << 20


class Merger:
    """Merges pre-tokens with one rank queue, which is empty between them.

    ``low`` has a bit per rank in words of 256, ``top`` a bit per word of ``low``.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.low = [0] * ((max(ranks.values()) >> 8) + 1)
        self.bits = [1 << i for i in range(256)]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: always the lowest-ranked pair, leftmost first."""
        get = self.ranks.get
        if (whole := get(piece)) is not None:
            return [whole]
        low, bits, top = self.low, self.bits, 0
        buckets: dict[int, list[int]] = {}
        n = len(piece)
        # A symbol stands at its first byte: where it ends, 0 once it is merged away, and where the one before begins.
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for i in range(n - 1):
            if (rank := get(piece[i : i + 2])) is not None:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    low[rank >> 8] |= bits[rank & 255]
                    top |= 1 << (rank >> 8)
        while top:
            b = (top & -top).bit_length() - 1
            w = low[b]
            rank = (b << 8) + (w & -w).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                low[b] = w = w & (w - 1)
                if not w:
                    top &= top - 1
            middle = end[i]
            if not middle or middle >= n:
                continue
            last = end[middle]
            if get(piece[i:last]) != rank:
                continue
            end[i], end[middle] = last, 0
            if last < n:
                before[last] = i
                if (rank := get(piece[i : end[last]])) is not None:
                    if rank in buckets:
                        heappush(buckets[rank], i)
                    else:
                        buckets[rank] = [i]
                        low[rank >> 8] |= bits[rank & 255]
                        top |= 1 << (rank >> 8)
            if (h := before[i]) >= 0 and (rank := get(piece[h:last])) is not None:
                if rank in buckets:
                    heappush(buckets[rank], h)
                else:
                    buckets[rank] = [h]
                    low[rank >> 8] |= bits[rank & 255]
                    top |= 1 << (rank >> 8)
        out, i = [], 0
        while i < n:
            out.append(get(piece[i : end[i]]))
            i = end[i]
        return out


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("the vocabulary lacks single bytes")
    if array("I").itemsize != 4 or sys.byteorder != "little":
        raise RuntimeError("ids are written as little-endian 32-bit integers")
    return ranks


class ManyMerger:
    """Merges many pre-tokens with one rank queue, a bucket at a time.

    All pre-tokens stand in one buffer, linked lists do not cross their borders. The lowest rank in
    the queue is the lowest of every pre-token that has it, so its bucket is merged at once: the
    leftmost live position of each pre-token; further ones of the same pre-token go back.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.none = max(ranks.values()) + 1
        pairs = [(ranks[t[:i]], ranks[t[i:]], rank) for t, rank in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        order = np.argsort(left << 32 | right)
        self.keys, self.merged = (left << 32 | right)[order], rank[order]
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        both = np.repeat(self.byte, 256) << 32 | np.tile(self.byte, 256)
        self.byte_pairs = self._rank(both).astype(np.uint16 if self.none < 1 << 16 else np.int64)

    def _rank(self, keys: np.ndarray) -> np.ndarray:
        """Ranks of pairs, ``none`` where they do not merge."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.merged[at], self.none)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token as little-endian bytes."""
        none, lengths = self.none, np.array([len(p) for p in pieces], np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(data)
        stop = np.cumsum(lengths)
        owner = np.repeat(np.arange(len(pieces)), lengths)
        symbol = self.byte[data]
        # Position n stands for no neighbour.
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[stop - 1] = n
        before[stop - lengths] = n
        live = np.ones(n, bool)
        first = self.byte_pairs[(data[:-1].astype(np.int64) << 8) | data[1:]]
        first[stop[:-1] - 1] = none
        pair = np.full(n + 1, none, np.int64)
        pair[: n - 1] = first
        order = np.argsort(first, kind="stable")
        order = order[: np.searchsorted(first[order], none)]
        start = np.flatnonzero(np.r_[True, first[order][1:] != first[order][:-1]]) if len(order) else np.zeros(0, np.int64)
        buckets: dict[int, list[int]] = {}
        filled = dict(zip(first[order[start]].tolist(), np.split(order, start[1:]), strict=True)) if len(order) else {}
        low, top = [0] * ((none >> 8) + 1), 0
        for rank in filled:
            low[rank >> 8] |= 1 << (rank & 255)
            top |= 1 << (rank >> 8)
        while top:
            b = (top & -top).bit_length() - 1
            w = low[b]
            rank = (b << 8) + (w & -w).bit_length() - 1
            low[b] = w = w & (w - 1)
            if not w:
                top &= top - 1
            at, more = filled.pop(rank, None), buckets.pop(rank, None)
            if more is not None:
                at = np.unique(np.concatenate([at, more]) if at is not None else np.array(more))
            at = at[pair[at] == rank]
            if not len(at):
                continue
            own = owner[at]
            lead = own[1:] != own[:-1]
            if not lead.all():
                lead = np.r_[True, lead]
                buckets[rank] = at[~lead].tolist()
                low[b] |= 1 << (rank & 255)
                top |= 1 << b
                at = at[lead]
            middle = after[at]
            last = after[middle]
            live[middle] = False
            pair[middle] = none
            symbol[at] = rank
            after[at] = last
            pair[at] = none
            some = last < n
            i, k = at[some], last[some]
            before[k] = i
            h = before[at]
            some = h < n
            h, j = h[some], at[some]
            where = np.concatenate([i, h])
            new = self._rank(symbol[where] << 32 | symbol[np.concatenate([k, j])])
            pair[where] = new
            some = new < none
            for r, p in zip(new[some].tolist(), where[some].tolist(), strict=True):
                if r in buckets:
                    buckets[r].append(p)
                else:
                    buckets[r] = [p]
                    low[r >> 8] |= 1 << (r & 255)
                    top |= 1 << (r >> 8)
        ids = symbol[live].astype("<u4").tobytes()
        cut = (4 * np.cumsum(np.bincount(owner[live], minlength=len(pieces)))).tolist()
        return [ids[a:b] for a, b in zip([0, *cut], cut, strict=False)]


# White space in UTF-8 beyond ASCII, by its last byte and what stands before; fixed by Unicode.
_WIDE = re.compile(b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
# These are all letters, so that one match of the pattern takes them, with a space before or without.
_LETTERS = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ɏ]+")


def _chunk_starts(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where texts begin, and single spaces between characters that are no white space."""
    at = np.flatnonzero(data == 32)
    at = at[(at > 0) & (at < len(data) - 1)]
    white = _ASCII_SPACE[data]
    for m in _WIDE.finditer(data.data):
        white[m.start() : m.end()] = True
    at = at[~white[at - 1] & ~white[at + 1]]
    mark = np.zeros(len(data) + 1, bool)
    mark[at] = True
    mark[rows] = True
    mark[-1] = True
    return np.flatnonzero(mark)


class Codec:
    """Encoder and decoder for one vocabulary file and pre-token pattern.

    The pattern must take a single space together with what follows it, as its alternatives
    `` ?x+`` do: where one stands between other characters a match ends before it. Texts are cut
    there first, and each distinct chunk of a batch is matched and merged once.
    """

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        # White space as Unicode defines it; the module's own class also takes the separators U+001C to U+001F.
        self.find = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.long, self.many = Merger(self.ranks), ManyMerger(self.ranks)
        self.known: dict[str, bytes] = {}
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())

    def _learn(self, chunks_: list[str]) -> list[bytes]:
        """Ids of chunks not met before."""
        split = [(x,) if _LETTERS.fullmatch(x) else self.find(x) for x in chunks_]
        ids: dict[str, bytes] = dict.fromkeys(p for x in split for p in x)
        short, raws = [], []
        for piece in ids:
            raw = piece.encode()
            if (whole := self.ranks.get(raw)) is not None:
                ids[piece] = whole.to_bytes(4, "little")
            elif len(raw) > MANY_BYTES:
                ids[piece] = array("I", self.long.merge(raw)).tobytes()
            else:
                short.append(piece)
                raws.append(raw)
        if short:
            ids.update(zip(short, self.many.merge(raws), strict=True))
        return [ids[x[0]] if len(x) == 1 else b"".join([ids[p] for p in x]) for x in split]

    def encode(self, texts: pa.Array) -> Iterator[pa.Array]:
        """Ids of each text of a string column as little-endian bytes, some rows at a time."""
        offsets, raw = string_buffers(texts)
        for i, j in chunks(offsets, SLICE_BYTES):
            lo, hi = int(offsets[i]), int(offsets[j])
            data, rows = raw[lo:hi], np.asarray(offsets[i : j + 1]) - lo
            starts = _chunk_starts(data, rows)
            if len(starts) < 2:
                yield pa.array([b""] * (j - i), pa.large_binary())
                continue
            coded = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)).dictionary_encode()
            words = coded.dictionary.to_pylist()
            if len(self.known) > CACHE_ENTRIES:
                self.known.clear()
            new = [x for x in words if x not in self.known]
            fresh = dict(zip(new, self._learn(new), strict=True))
            self.known.update((x, y) for x, y in fresh.items() if len(x) <= CACHE_TOKEN_BYTES)
            ids = pa.array([y if (y := self.known.get(x)) is not None else fresh[x] for x in words], pa.large_binary()).take(coded.indices)
            at = np.frombuffer(ids.buffers()[1], np.int64)[np.searchsorted(starts, rows)]
            yield pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(at), ids.buffers()[2]])

    def decode(self, ids: pa.Array) -> pa.Array:
        """Bytes of each text from its ids."""
        offsets, raw = string_buffers(ids.cast(pa.large_binary()))
        parts, n, at = [], 0, [0]
        for i, j in chunks(offsets, SLICE_BYTES):
            own = np.frombuffer(raw[int(offsets[i]) : int(offsets[j])], "<u4")
            text = self.tokens.take(pa.array(own))
            ends = np.frombuffer(text.buffers()[1], np.int64)[(offsets[i + 1 : j + 1] - offsets[i]) // 4] if len(own) else np.zeros(j - i, np.int64)
            at += (ends + n).tolist()
            parts.append(b"" if not len(own) else text.buffers()[2].to_pybytes())
            n = at[-1]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(np.array(at, np.int64)), pa.py_buffer(b"".join(parts))])


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids binary)``: each text's ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            at = 0
            for ids in c.encode(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(ids)), ids.cast(pa.binary())], names=["doc_id", "ids"])
                at += len(ids)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, decoded binary)`` of ``encode``'s rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), c.decode(batch.column("ids")).cast(pa.binary())], names=["doc_id", "decoded"])

    return encoded.mapInArrow(run, "doc_id long, decoded binary")


def _digests(column: pa.Array) -> list[str]:
    offsets, raw = string_buffers(column)
    cut = offsets.tolist()
    return [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(cut, cut[1:], strict=False)]


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: encodes each text, decodes the ids, digests both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            at = 0
            for ids in c.encode(batch.column("text")):
                n = np.diff(string_buffers(ids)[0]) // 4
                cols = [batch.column("doc_id").slice(at, len(ids)), pa.array(n.astype(np.int64)), pa.array(_digests(ids), pa.string()), pa.array(_digests(c.decode(ids)), pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                at += len(ids)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
