"""Vectorised hashing of words, word shingles and lines over the bytes of an Arrow string column.

A word or line is hashed as a polynomial over random 64-bit values of its bytes, modulo
2**64, read off one running sum per chunk of text; A-Z fold to a-z. Equal strings have equal
hashes wherever they stand. Different strings collide with probability about 2**-64 each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 512 << 10
_rng = np.random.default_rng(20240607)
_P = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_TABLES = []
for _ in range(2):
    _t = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    _t[65:91] = _t[97:123]
    _TABLES.append(_t)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_MULT = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pow(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if which not in _powers or len(_powers[which][0]) < n:
        n = max(n, CHUNK_BYTES + 1)
        p = int(_P[which])
        out = []
        for base in (p, pow(p, -1, 2**64)):
            a = np.full(n, base, np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        if n > 4 * CHUNK_BYTES:
            return out[0], out[1]
        _powers[which] = (out[0], out[1])
    return _powers[which]


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    up, down = _pow(which, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLES[which][data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _MULT[63])


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and bytes of a string or binary column; a null has no bytes."""
    wide = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    if column.null_count:
        column = column.fill_null(b"" if wide == pa.large_binary() else "")
    column = column.cast(wide)
    _, off, data = column.buffers()
    if off is None or len(column) == 0:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets, raw


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; one longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        j = min(j, n)
        yield i, j
        i = j


def word_spans(data: np.ndarray, rows: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words and the row of each; rows: the offsets of rows in data."""
    solid = ~space[data]
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = solid[:-1]
    inner = rows[(rows > 0) & (rows < len(data))]
    begin = solid & ~before
    begin[inner] = solid[inner]
    starts = np.flatnonzero(begin)
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    stop = solid & ~after
    stop[inner - 1] = solid[inner - 1]
    ends = np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(rows, starts, side="right") - 1


def _words_of(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, r = word_spans(data, rows)
    return span_hash(data, starts, ends), r


def words(offsets: np.ndarray, raw: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of rows: first row, end row, word hashes, and for each row the first word (one more at the end).

    A row longer than a chunk is cut at white space, so memory stays near its own size.
    """
    for i, j in chunks(offsets, CHUNK_BYTES):
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo <= 2 * CHUNK_BYTES:
            h, r = _words_of(raw[lo:hi], offsets[i : j + 1] - lo)
            yield i, j, h, np.searchsorted(r, np.arange(j - i + 1))
            continue
        parts, at = [], lo
        while at < hi:
            to = min(at + CHUNK_BYTES, hi)
            while to < hi and not SPACE[raw[to]]:
                gap = np.flatnonzero(SPACE[raw[to : to + CHUNK_BYTES]])
                to = to + int(gap[0]) if len(gap) else min(to + CHUNK_BYTES, hi)
            parts.append(_words_of(raw[at:to], np.array([0, to - at]))[0])
            at = to
        h = np.concatenate(parts)
        yield i, j, h, np.array([0, len(h)])


def shingle_sets(offsets: np.ndarray, raw: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its k-word shingles (all words as one, if fewer; none without words)."""
    for i, j, h, first in words(offsets, raw):
        n = len(h)
        full = max(0, n - k + 1)
        sh = np.zeros(full, np.uint64)
        for t in range(k):
            sh += h[t : t + full] * _MULT[t]
        sh = mix(sh + np.uint64(k))
        for r in range(j - i):
            a, b = int(first[r]), int(first[r + 1])
            if b - a >= k:
                s = np.sort(sh[a : b - k + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield s[keep]
            elif b > a:
                yield mix((h[a:b] * _MULT[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def line_keys(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """For every line (rows end lines too): row, position in the row, code points of the stripped line, two hashes of it."""
    cuts = np.flatnonzero(data == 10)
    row = np.concatenate([np.arange(len(rows) - 1), np.searchsorted(rows[1:], cuts, side="right")])
    order = np.argsort(row, kind="stable")
    row, starts = row[order], np.concatenate([rows[:-1], cuts + 1])[order]
    pos = np.arange(len(row)) - np.searchsorted(row, np.arange(len(rows) - 1))[row]
    last = np.r_[row[1:] != row[:-1], True] if len(row) else np.zeros(0, bool)
    ends = np.where(last, rows[row + 1], np.r_[starts[1:], 0] - 1)
    solid = np.flatnonzero(~SPACE[data])
    if len(solid):
        a = np.searchsorted(solid, starts)
        b = np.searchsorted(solid, ends) - 1
        some = a <= b
        s = np.where(some, solid[np.minimum(a, len(solid) - 1)], starts)
        e = np.where(some, solid[np.maximum(b, 0)] + 1, starts)
    else:
        s = e = starts
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    return row, pos, heads[e] - heads[s], span_hash(data, s, e, 0), span_hash(data, s, e, 1)
