"""Operator 3: packing token pieces into sequences by minimum bin slack.

Texts become ids in map tasks; only ``(doc_id, piece, start, length, crc)`` moves. Pieces as
long as a sequence stand alone. The others are dealt into groups of about ``group_rows``
documents. In a group each bin takes the longest piece left, then a subset-sum dynamic
program over the lengths still available (one big integer as a bitset of reachable sums, long
lengths first, stopping as soon as the bin's exact rest is reachable) finds the fullest
feasible combination, which is removed. A group wastes at most a few partly filled bins, which
against its thousands of bins is little; the number of groups follows the input.

Defined results: a null text is an empty one: a single end token. Repeated rows are packed each, and dealt
to different groups. Pieces of one length are interchangeable, the one with the smaller doc_id and piece goes first. Very long
texts are cut into as many pieces as they need. Null doc_ids stay null. An empty table gives an empty
result. Further columns are ignored.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"
CACHE_ENTRIES = 400_000


# A comma or full stop between a letter and white space is a token of its own.
_TAIL = re.compile(r"(?<=[a-zà-öø-ÿ])([,.])(?=[ \n])")


class WordIds:
    """Ids of texts, word by word.

    The tokenizer lower-cases, drops white space and never merges across it, so a text's ids are
    those of its words one after another. Words met before come from a table; new ones are
    encoded together in one call. The table is emptied at a bound, so memory does not grow
    with the input.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {"": b""}

    def _encode(self, words: list[str]) -> list[bytes]:
        starts = np.cumsum([0, *map(len, words)]) + np.arange(len(words) + 1)
        e = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        offsets = e.offsets
        at = np.fromiter((s for s, _ in offsets), np.int64, len(offsets))
        ids = np.array(e.ids, "<u4").tobytes()
        cut = (4 * np.searchsorted(at, starts)).tolist()
        return [ids[a:b] for a, b in zip(cut, cut[1:], strict=False)]

    @staticmethod
    def _split(text: str) -> list[str]:
        # Letters whose lower case depends on what follows, and names of special tokens, are left as they are. So are
        # texts that the tokenizer's NFC step would change, before lower-casing or after: it comes before its own.
        if "<|" not in text and "İ" not in text and "Σ" not in text:
            low = text.lower()
            if text.isascii() or (unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low)):
                text = low
        return _TAIL.sub(r" \1", text).replace("\n", " ").replace("\t", " ").split(" ")

    def texts(self, texts: list[str]) -> list[bytes]:
        lists = [self._split(t) for t in texts]
        if len(self.words) > CACHE_ENTRIES:
            self.words = {"": b""}
        new = list(set().union(*lists).difference(self.words))
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            self.words.update(zip(part, self._encode(part), strict=True))
        return [b"".join(map(self.words.__getitem__, x)) for x in lists]


_tables: dict[str, WordIds] = {}


def token_bytes(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers, without special tokens."""
    if path not in _tables:
        _tables[path] = WordIds(path)
    return _tables[path].texts(texts)


def _slices(texts: list[str], chars: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def pieces(docs: DataFrame, path: str, sequence_length: int = 4096, end_id: int = 1) -> DataFrame:
    """Each document's ids and its end token, cut into pieces of at most ``sequence_length``."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 4 * sequence_length
        for batch in batches:
            rows: list[tuple] = []
            docs_, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for i, j in _slices(texts):
                for doc, ids in zip(docs_[i:j], token_bytes(texts[i:j], path), strict=True):
                    ids += end
                    rows += [(doc, p, at // 4, min(width, len(ids) - at) // 4, zlib.crc32(ids[at : at + width])) for p, at in enumerate(range(0, len(ids), width))]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECE_SCHEMA)


def minimum_slack(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each length (1 to capacity), numbered from 0."""
    count = np.bincount(lengths, minlength=capacity + 1)
    left = {int(v): int(count[v]) for v in np.flatnonzero(count)[::-1]}
    order = np.argsort(lengths, kind="stable")
    first = np.concatenate([[0], np.cumsum(count)])
    taken = dict.fromkeys(left, 0)
    bins, at = np.zeros(len(lengths), np.int64), 0
    while left:
        big = next(iter(left))
        chosen, rest = [big], capacity - big
        left[big] -= 1
        if rest:
            mask, goal = (1 << (rest + 1)) - 1, 1 << rest
            sums, steps = 1, []
            for v, n in left.items():
                if v > rest:
                    continue
                for _ in range(min(n, rest // v)):
                    wider = (sums | (sums << v)) & mask
                    if wider == sums:
                        break
                    steps.append((v, sums))
                    sums = wider
                    if sums & goal:
                        break
                if sums & goal:
                    break
            want = sums.bit_length() - 1
            for v, had in reversed(steps):
                if not had >> want & 1:
                    chosen.append(v)
                    want -= v
            for v in chosen[1:]:
                left[v] -= 1
        for v in set(chosen):
            if not left[v]:
                del left[v]
        for v in chosen:
            bins[order[first[v] + taken[v]]] = at
            taken[v] += 1
        at += 1
    return bins


def pack(parts: DataFrame, n_groups: int, capacity: int = 4096) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; each sequence is gapless from 0."""

    def run(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable", na_position="first").reset_index(drop=True)
        length = df["length"].to_numpy(np.int64)
        seq = np.zeros(len(df), np.int64)
        full = length >= capacity
        some = np.flatnonzero(~full)
        n = 0
        if len(some):
            seq[some] = minimum_slack(length[some], capacity)
            n = int(seq[some].max()) + 1
        seq[full] = n + np.arange(int(full.sum()))
        df["sequence_id"] = seq
        df["offset"] = df.groupby("sequence_id")["length"].cumsum() - df["length"]
        df["sequence_id"] += int(key[0]) << 32
        return df[[c.split()[0] for c in PACKED_SCHEMA.split(", ")]]

    # The row's place deals out rows that are equal in all else.
    keyed = parts.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(n_groups)))
    return keyed.groupBy("g").applyInPandas(lambda key, df: run(key, df.drop(columns="g")), PACKED_SCHEMA)


def pack_documents(docs: DataFrame, path: str, sequence_length: int = 4096, end_id: int = 1, group_rows: int = 16384) -> DataFrame:
    """All documents' pieces, packed."""
    n_groups = max(1, -(-docs.count() // group_rows))
    return pack(pieces(docs, path, sequence_length, end_id), n_groups, sequence_length)
