"""Operator 6: secret scans with a recursive decoding worklist.

A text is layer 0. Each layer is scanned, then its encoded stretches are unwrapped into new
layers: percent escapes, ``\\uXXXX``, ``\\UXXXXXXXX``, ``\\xXX`` and ``&#NN;`` escapes, base64 (both alphabets),
and gzip, zlib, bzip2 or raw deflate inside base64. A layer met before over the same stretch of the text is not
entered again, so the worklist ends at a fixpoint. A finding in an inner layer is mapped to the stretch of the
original text it came from: character by character through escapes, the whole encoded run
through base64. Each layer has one map into the text, composed from that of the layer around it, so that depth costs no stack.
After ``STEPS`` levels of escapes in a row, what is left of them that gives ASCII is reduced in a single pass, however deep it is.

A base64 run may go on over line breaks (real ones, or written as ``\\n``), and may stand after other characters of its alphabet, as in a
path: all four alignments are unwrapped, and compressed data is looked for at every place in them (raw deflate only where a run
begins). Decoded bytes are read as UTF-8, and as UTF-16 where a quarter of them are zeros. A run has ``MIN_BASE64`` characters
at least; the shortest finding takes 14 bytes, which are 19 characters, so that none is lost to it.

Defined results: null and empty texts have no findings and the digest of an empty string. An empty table gives an empty result.
Repeated rows are scanned each; other columns are ignored. Texts are scanned whole, whatever their
length. Bytes that are no UTF-8 and control characters are scanned with what stands around them. All
members of compressed data are read, and what follows them; damaged data as far as it goes and as text.

An inner layer of more than ``MAX_INFLATED`` bytes is scanned in pieces, and its run is reported as kind
``bomb`` besides, since an encoded run in it that is itself longer than that, or compressed data nested in it
deeper than ``STREAMED_LEVELS``, may not be unwrapped whole. So is gzip or bzip2 data that turns out to be damaged.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_INFLATED = 32 << 20
PIECE = 1 << 20
OVERLAP = 256
STREAMED_LEVELS = 64
MIN_BASE64 = 16
#: Levels of escapes one by one, before all that are left are reduced at once.
STEPS = 4
KINDS = ("assign", "access", "hex", "bomb")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_WORD = re.compile(r"password|passwd|secret|token|api_?key")
# Runs are maximal, so the length can stand in the pattern: a run that is too short holds no longer one.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_ESCAPES = re.compile(r"(?:%[0-9A-Fa-f]{2})+|(?:\\U[0-9A-Fa-f]{8})+|\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\u[0-9A-Fa-f]{4})+|(?:\\x[0-9A-Fa-f]{2})+|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_BASE64)
_BREAK = r"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*"
_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{4,}%s)+[A-Za-z0-9+/_-]{2,}={0,2}" % _BREAK)
_BREAKS = re.compile(_BREAK)
# Where compressed data may begin inside other bytes.
_MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\x78[\x01\x5e\x9c\xda]")
# Stretches in which one escape may give a part of another, and the escapes that may end at a character.
_DENSE = re.compile(r"[%\\&][%\\&#;{}xuXU0-9A-Fa-f]{2,}")
_UNIT = re.compile(r"(?:%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)\Z")
_HEX_DIGITS = frozenset("0123456789abcdefABCDEF")
_SPACES = re.compile(r"\x20{17,}")
# What an escape, a base64 run or a finding without spaces consists of.
_RUN_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=%\\&#;{}.:\"'"
SCHEMA = "doc_id long, findings array<struct<kind:string,start:int,end:int,depth:int,via:string>>"


def scan_layer(text: str) -> list[tuple[str, int, int]]:
    """Base findings of one layer: ``(kind, start, end)`` in code points."""
    out = []
    if _WORD.search(text.lower()):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return out


def _unescape(run: str) -> str | None:
    try:
        if run[0] == "%":
            return bytes.fromhex(run.replace("%", "")).decode("utf-8", "replace")
        if run.startswith("\\u{"):
            return chr(int(run[3:-1], 16))
        if run.startswith("\\U"):
            return "".join(chr(int(x, 16)) for x in run.split("\\U")[1:])
        if run.startswith("\\u"):
            units = b"".join(int(x, 16).to_bytes(2, "big") for x in run.split("\\u")[1:])
            return units.decode("utf-16-be", "replace")
        if run.startswith("\\x"):
            return bytes.fromhex(run.replace("\\x", "")).decode("utf-8", "replace")
        code = int(run[3:-1], 16) if run[2] in "xX" else int(run[2:-1])
        return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else None
    except (ValueError, OverflowError):
        return None


class _Map:
    """Positions of a layer to positions of the layer around it, piecewise."""

    def __init__(self) -> None:
        self.at: list[int] = []
        self.pieces: list[tuple[int, int, bool]] = []  # outer start, outer end, one to one

    def add(self, inner: int, start: int, end: int, even: bool) -> None:
        self.at.append(inner)
        self.pieces.append((start, end, even))

    def span(self, start: int, end: int) -> tuple[int, int]:
        i = bisect_right(self.at, start) - 1
        s, e, even = self.pieces[i]
        lo = s + start - self.at[i] if even else s
        i = bisect_right(self.at, end - 1) - 1
        s, e, even = self.pieces[i]
        hi = s + end - self.at[i] if even else e
        return lo, hi

    def over(self, outer: _Map) -> _Map:
        """The map from this layer to what ``outer`` maps the layer around it to."""
        out = _Map()
        ends = [*self.at[1:], None]
        for at, end, (s, e, even) in zip(self.at, ends, self.pieces, strict=True):
            if not even:
                out.add(at, *outer.span(s, e), False)
                continue
            i, e = bisect_right(outer.at, s) - 1, s + end - at if end is not None else e
            while i < len(outer.at) and outer.at[i] < e:
                lo = max(s, outer.at[i])
                os, oe, one = outer.pieces[i]
                out.add(at + lo - s, os + lo - outer.at[i] if one else os, oe, one)
                i += 1
        return out


def _escaped_layer(text: str) -> tuple[str, _Map] | None:
    if "%" not in text and "\\" not in text and "&#" not in text:
        return None
    parts, table, inner, last, some = [], _Map(), 0, 0, False
    for m in _ESCAPES.finditer(text):
        new = _unescape(m[0])
        if new is None:
            continue
        some = True
        if m.start() > last:
            table.add(inner, last, m.start(), True)
            parts.append(text[last : m.start()])
            inner += m.start() - last
        if new:
            # Each decoded character maps to its own escape where every escape gave one; else to the run.
            unit = {"%": 3, "\\u": 6, "\\U": 10, "\\x": 4}.get(m[0][0] if m[0][0] == "%" else m[0][:2], 0)
            each = unit if unit * len(new) == len(m[0]) else 0
            for k, _ in enumerate(new):
                table.add(inner + k, m.start() + k * each, m.start() + (k + 1) * each, False) if each else table.add(inner + k, m.start(), m.end(), False)
        parts.append(new)
        inner += len(new)
        last = m.end()
    if not some:
        return None
    if last < len(text):
        table.add(inner, last, len(text), True)
        parts.append(text[last:])
    return "".join(parts), table


def _may_end(stack: list[tuple[str, int, int]]) -> bool:
    """Whether an escape may end with the last character: one of fixed length begins in its place, or it has a closing mark."""
    n, last = len(stack), stack[-1][0]
    return last in ";}" or (last in _HEX_DIGITS and ((n > 2 and stack[-3][0] == "%") or any(n >= k and stack[-k][0] == "\\" for k in (4, 6, 10))))


def _reduced_layer(text: str) -> tuple[str, _Map] | None:
    """All escapes that give ASCII reduced until none is left, from left to right; a result may be part of the next escape."""
    parts, table, inner, last = [], _Map(), 0, 0
    for m in _DENSE.finditer(text):
        stack: list[tuple[str, int, int]] = []
        some = False
        for i, c in enumerate(m[0], m.start()):
            stack.append((c, i, i + 1))
            while True:
                unit = _UNIT.search("".join(x[0] for x in stack[-10:])) if _may_end(stack) else None
                new = _unescape(unit[0]) if unit else None
                if not new or len(new) > 1 or new > "\x7f":
                    break
                n = len(unit[0])
                stack[-n:] = [(new, stack[-n][1], stack[-1][2])]
                some = True
        if not some:
            continue
        if m.start() > last:
            table.add(inner, last, m.start(), True)
            parts.append(text[last : m.start()])
            inner += m.start() - last
        for k, (_, s, e) in enumerate(stack):
            table.add(inner + k, s, e, False)
        parts.append("".join(x[0] for x in stack))
        inner += len(stack)
        last = m.end()
    if not parts:
        return None
    if last < len(text):
        table.add(inner, last, len(text), True)
        parts.append(text[last:])
    return "".join(parts), table


def _opener(head: bytes):
    """A decompressor for data that begins so; None if it is not compressed."""
    if head[:2] == b"\x1f\x8b" or (len(head) > 2 and head[0] == 0x78 and (head[0] * 256 + head[1]) % 31 == 0):
        return zlib.decompressobj(47)
    return bz2.BZ2Decompressor() if head[:3] == b"BZh" else None


class _Members:
    """Compressed members one after another, unwrapped piece by piece; ``rest`` is what follows them."""

    def __init__(self) -> None:
        self.open = None
        self.some = self.failed = self.ended = False
        self.held, self.rest = b"", []

    def feed(self, data: bytes) -> Iterator[bytes]:
        data, self.held = self.held + data, b""
        while data and not self.failed:
            if self.ended:
                self.rest.append(data)
                return
            if self.open is None:
                # Zeros may fill up a member's last block.
                data = data.lstrip(b"\0") if self.some else data
                if len(data) < 4:
                    self.held = data
                    return
                self.open = _opener(data)
                self.ended, self.some = self.open is None, True
                continue
            try:
                out = self.open.decompress(data, PIECE)
                if isinstance(self.open, bz2.BZ2Decompressor):
                    data = b""
                    while out:
                        yield out
                        out = b"" if self.open.eof or self.open.needs_input else self.open.decompress(b"", PIECE)
                else:
                    data = self.open.unconsumed_tail
                    while len(out) == PIECE:
                        yield out
                        out = self.open.decompress(data, PIECE)
                        data = self.open.unconsumed_tail
                    if out:
                        yield out
                if self.open.eof:
                    data, self.open = self.open.unused_data, None
            except (zlib.error, OSError, ValueError, EOFError):
                self.failed = True


class _Stream:
    """A layer of any length: its bytes as texts that overlap, and those of compressed data in it."""

    def __init__(self, level: int = 0) -> None:
        self.level, self.text = level, ""
        self.decoder = codecs.getincrementaldecoder("utf-8")("replace")
        self.members: _Members | None = None
        self.inner: _Stream | None = None
        self.begun = False

    def feed(self, data: bytes, last: bool = False) -> Iterator[str]:
        if data and not self.begun:
            self.begun = True
            if self.level < STREAMED_LEVELS and _opener(data) is not None:
                self.members, self.inner = _Members(), _Stream(self.level + 1)
        if self.members is not None:
            for out in self.members.feed(data):
                yield from self.inner.feed(out)
            self.members.rest.clear()  # scanned as text here
            if last:
                yield from self.inner.feed(b"", True)
        # All of the layer has one place, so only whether something is found counts, and spaces can be fewer.
        self.text = _SPACES.sub(" " * 16, self.text + self.decoder.decode(data, last))
        if last:
            if self.text:
                yield self.text
            return
        if len(self.text) < PIECE:
            return
        cut = len(self.text.rstrip(_RUN_CHARS))
        if len(self.text) - cut > max(MAX_INFLATED, PIECE):
            cut += (len(self.text) - cut) // 4 * 4
        elif len(self.text) - cut == len(self.text):
            return
        if cut > OVERLAP:
            yield self.text[:cut]
            self.text = self.text[cut - OVERLAP :]


def _unwrapped(raw: bytes) -> Iterator[tuple[str | None, str]]:
    """Decoded bytes to texts and how they came about; None for what may not be unwrapped whole."""
    todo, met = [(raw, "base64")], set()
    while todo:
        blob, via = todo.pop()
        digest = hashlib.sha256(blob).digest()
        if not blob or digest in met:
            continue
        met.add(digest)
        if _opener(blob) is None:
            yield blob.decode("utf-8", "replace"), via
            continue
        members, parts, n, large = _Members(), [], 0, None
        for out in members.feed(blob):
            if large is None:
                parts.append(out)
                n += len(out)
                if n <= MAX_INFLATED:
                    continue
                yield None, "compressed"
                large, out = _Stream(), b"".join(parts)
            for new in large.feed(out):
                yield new, "compressed"
        if large is not None:
            for new in large.feed(b"", True):
                yield new, "compressed"
        else:
            todo.append((b"".join(parts), "compressed"))
        todo.append((b"".join([*members.rest, members.held]), "compressed"))
        if members.failed:
            if blob[:3] == b"\x1f\x8b\x08" or (blob[:3] == b"BZh" and blob[4:10] == b"1AY&SY"):
                yield None, "compressed"
            yield blob.decode("utf-8", "replace"), via


def _texts(raw: bytes) -> Iterator[str]:
    yield raw.decode("utf-8", "replace")
    if 4 * raw.count(0) >= len(raw) > 3:
        yield raw.decode("utf-16-le", "replace")
        yield raw.decode("utf-16-be", "replace")


def _deflated(raw: bytes) -> str | None:
    """The text of raw deflate data that is whole and has nothing after it."""
    try:
        d = zlib.decompressobj(-15)
        out = d.decompress(raw, MAX_INFLATED)
        return out.decode("utf-8") if d.eof and not d.unused_data and out else None
    except (zlib.error, ValueError):
        return None


def _decoded(run: str) -> Iterator[tuple[str | None, str]]:
    """What a base64 run holds, at each of its four alignments."""
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    for at in range(min(4, len(run))):
        part = run[at:]
        part = part[:-1] if len(part) % 4 == 1 else part
        try:
            raw = base64.b64decode(part + "=" * (-len(part) % 4), validate=True)
        except ValueError:
            continue
        if at == 0:
            yield from _unwrapped(raw)
            if _opener(raw) is None and (new := _deflated(raw)) is not None:
                yield new, "compressed"
            texts = list(_texts(raw))[1:]
        else:
            texts = list(_texts(raw))
        for new in texts:
            yield new, "base64"
        # Data that stands behind other bytes of the run.
        for m in _MAGIC.finditer(raw, 1 if at == 0 and _opener(raw) is not None else 0):
            if m.start() or at:
                members = _Members()
                first = next(members.feed(raw[m.start() : m.start() + 4096]), b"")
                if first and not members.failed:
                    yield from _unwrapped(raw[m.start() :])


def _base64_layers(text: str) -> Iterator[tuple[str | None, int, int, str]]:
    for m in _BASE64.finditer(text):
        for new, via in _decoded(m[0]):
            yield new, m.start(), m.end(), via
    for m in _LINES.finditer(text):
        run = _BREAKS.sub("", m[0])
        if len(run) >= MIN_BASE64:
            for new, via in _decoded(run):
                yield new, m.start(), m.end(), via


def scan_text(text: str) -> list[tuple[str, int, int, int, str]]:
    """``(kind, start, end, depth, via)`` of a text and all its layers, in the text's code points.

    Base findings come first. A span that an inner layer repeats is listed once.
    """
    found = [(k, s, e, 0, "") for k, s, e in scan_layer(text)]
    known = {(k, s, e) for k, s, e, _, _ in found}
    met = {(hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest(), 0, len(text))}

    def inner(layer: str, where: _Map | tuple[int, int], depth: int, steps: int) -> Iterator[tuple[str, _Map | tuple[int, int], int, str, int]]:
        fixed = isinstance(where, tuple)
        esc = _escaped_layer(layer) if steps < STEPS else _reduced_layer(layer) or _escaped_layer(layer)
        if esc is not None:
            yield esc[0], where if fixed else esc[1].over(where), depth, "escape", steps + 1
        for new, s, e, how in _base64_layers(layer):
            span = where if fixed else where.span(s, e)
            if new is not None:
                yield new, span, depth, how, 0
            elif ("bomb", *span) not in known:
                known.add(("bomb", *span))
                found.append(("bomb", *span, depth, how))

    # One iterator for each layer on the way inward, so that pieces of a long layer are not held together.
    whole = _Map()
    whole.add(0, 0, len(text), True)
    work = [inner(text, whole, 1, 0)]
    while work:
        if (step := next(work[-1], None)) is None:
            work.pop()
            continue
        new, where, depth, how, steps = step
        if not new:
            continue
        fixed = isinstance(where, tuple)
        # The same payload at another place is another finding. Escapes only shorten and a run has one span
        # for all it holds, so the same over the same stretch is a cycle, or repeats what was found.
        mark = (hashlib.sha256(new.encode("utf-8", "surrogatepass")).digest(), *(where if fixed else where.span(0, len(new))))
        if mark in met:
            continue
        met.add(mark)
        for k, s, e in scan_layer(new):
            span = where if fixed else where.span(s, e)
            if (k, *span) not in known:
                known.add((k, *span))
                found.append((k, *span, depth, how))
        work.append(inner(new, where, depth + 1, steps))
    return found


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, findings)``: each finding's kind, span in the text, depth of its layer and last unwrapping."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("depth", pa.int32()), ("via", pa.string())]))
        for batch in batches:
            rows = [[dict(zip(("kind", "start", "end", "depth", "via"), f, strict=True)) for f in scan_text(v.as_py() or "")] for v in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "findings"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)


def redact(text: str) -> str:
    """The text with every finding, merged where they overlap, replaced by ``[SECRET]``; repeated until none is left.

    No finding can hold a bracket, so each round takes away characters of the given text and the rounds end.
    """
    while spans := sorted((s, e) for _, s, e, _, _ in scan_text(text)):
        out, at = [], 0
        for s, e in spans:
            if s >= at:
                out += [text[at:s], "[SECRET]"]
            at = max(at, e)
        text = "".join([*out, text[at:]])
    return text


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with secrets replaced in ``text``; null stays null."""
    own = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = pa.array([None if t is None else redact(t) for t in batch.column("text").to_pylist()], batch.schema.field("text").type)
            yield pa.RecordBatch.from_arrays([new if c == "text" else batch.column(c) for c in own], names=own)

    return docs.mapInArrow(run, docs.schema)
