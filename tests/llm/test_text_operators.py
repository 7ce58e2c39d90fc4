"""Line dedup, n-gram join, packing, BPE and secret scan against brute force."""

import base64
import bz2
import gzip
import hashlib
import random
import re
import time
import urllib.parse
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from telmark.llm import bpe, line_dedup, ngram_join, packing, queries, secret_scan
from telmark.llm.text_hash import line_keys, shingle_sets, string_buffers

public_tokenizers = pytest.importorskip("public_tokenizers")
SPACES = " \t\n\x0b\x0c\r"
LOWER = {i: i + 32 for i in range(65, 91)}
WORDS = "alpha Beta gamma delta épsilon zeta eta theta iota kappa".split()


def random_texts(n, seed=0):
    rng = random.Random(seed)
    lines = [" ".join(rng.choices(WORDS, k=rng.randint(1, 8))) for _ in range(30)]
    out = ["\n".join(rng.choice([str.upper, str, lambda s: f" {s}\t"])(rng.choice(lines)) for _ in range(rng.randint(0, 12))) for _ in range(n)]
    return out + [None, "", "\n", "\n\n", " \t\r\n ", "x" * 25, "x" * 25 + "\n", "\n" + "X" * 25 + "\n" + "x" * 25]


def keep_lines(rows):
    key = lambda line: line.strip(SPACES).translate(LOWER)
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(i)
    drop = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    return {i: [x for x in (t or "").split("\n") if key(x) not in drop or drop[key(x)] == i] for i, t in rows}


def test_line_dedup_equals_brute_force(make_docs):
    rows = list(enumerate(random_texts(80)))
    got = {r["doc_id"]: r for r in line_dedup.drop_lines(make_docs(rows)).collect()}
    want = keep_lines(rows)
    assert len(got) == len(rows)
    for i, t in rows:
        assert (got[i]["text"] or "") == "\n".join(want[i]), i
        assert got[i]["n_lines_before"] == len((t or "").split("\n")) and got[i]["n_lines_dropped"] == got[i]["n_lines_before"] - len(want[i])
    assert got[rows[80][0]]["text"] is None and got[0]["tag"] == "x"


def test_line_dedup_long_runs_and_repeats(make_docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "RUN_ROWS", 5)
    line = "the same long line in every document"
    rows = [(i, line + "\n" + f"own line number {i:020d}") for i in range(40)] + [(39, "another row of document 39\n" + line), (None, line), (None, line + " x")]
    out = line_dedup.drop_lines(make_docs(rows)).collect()
    assert Counter(line in (r["text"] or "").split("\n") for r in out if r["doc_id"] == 39)[True] == 2
    assert sum(line in (r["text"] or "").split("\n") for r in out) == 2


def test_line_dedup_passes_on_a_long_run_of_one_document(monkeypatch):
    monkeypatch.setattr(line_dedup, "RUN_ROWS", 50)
    names = ["h1", "h2", "doc", "tag", "pos", "n_lines"]

    def batches():
        yield pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), pa.array([1]), pa.array([1]), pa.array([0], pa.int32()), pa.array([1], pa.int32())], names=names)
        for at in range(0, 1000, 10):
            same = pa.array(np.full(10, 7, np.int64))
            yield pa.RecordBatch.from_arrays([same, same, same, same, pa.array(np.arange(at, at + 10, dtype=np.int32)), pa.array(np.full(10, 1000, np.int32))], names=names)

    seen = 0
    for n, out in enumerate(line_dedup._stream_runs(3)(batches())):
        own = out.filter(pa.compute.equal(out.column("h1"), 7))
        assert own.column("edge").to_pylist() == [1] * own.num_rows
        seen += own.num_rows
        # Two results a batch; no more than the limit and one batch is held back.
        assert seen >= min(1000, 10 * (n // 2)) - 70
    assert seen == 1000


def test_line_dedup_empty(make_docs):
    assert line_dedup.drop_lines(make_docs([])).count() == 0


def test_line_keys_positions():
    import pyarrow as pa

    texts = ["a\n\nb", "", "\n", "c\n", " D "]
    off, raw = string_buffers(pa.array(texts))
    row, pos, length, h1, h2 = line_keys(raw, off)
    assert list(zip(row.tolist(), pos.tolist(), length.tolist(), strict=True)) == [(0, 0, 1), (0, 1, 0), (0, 2, 1), (1, 0, 0), (2, 0, 0), (2, 1, 0), (3, 0, 1), (3, 1, 0), (4, 0, 1)]
    off, raw = string_buffers(pa.array(["d"]))
    assert line_keys(raw, off)[3][0] == h1[-1] and len(set(zip(h1.tolist(), h2.tolist(), strict=True))) == 5


def shingles(text, k):
    words = [w for w in (text or "").translate(LOWER).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def components(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_texts(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(1, 5)))
    passage = [word() for _ in range(60)]
    base = [[word() for _ in range(rng.choice([1, 2, 3, 5, 20, 60, 200]))] for _ in range(n // 3)]
    out = []
    for _ in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 5, 15])):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.3:
            w = w + passage
        out.append(rng.choice([" ", "\n", "\t "]).join(x.upper() if rng.random() < 0.1 else x for x in w))
    return out + [None, "", "   ", "a", "A", "a b", "A\tB"]


@pytest.mark.parametrize(("k", "percent", "seed"), [(3, 90, 1), (5, 80, 2)])
def test_ngram_join_equals_brute_force(make_docs, k, percent, seed):
    rows = list(enumerate(near_texts(150, seed)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicate_components(make_docs(rows), k, percent).collect()}
    assert got == components(rows, k, percent)


def test_ngram_join_dense_group_and_repeats(make_docs):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        w = list(base)
        w[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(i + 300, " ".join(base)) for i in range(200)] + [(7, "quite another text than before"), (900, "quite another text than before"), (None, " ".join(base))]
    out = ngram_join.near_duplicate_components(make_docs(rows), 3, 90).collect()
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], set()).add(r["component_id"])
    # Two edits to a base of 118 shingles leave about 112 of 124 in common.
    assert by[300] == {0} and by[None] == {None}
    assert by[7] == by[900] == {0}
    kept = ngram_join.keep_one(make_docs(rows), 3, 90)
    assert kept.filter("doc_id >= 300 AND doc_id < 500").count() == 0 and kept.filter("doc_id IS NULL").count() == 1 and kept.columns[5] == "tag"


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_tiles_equal_brute_force(make_docs, monkeypatch, seed):
    monkeypatch.setattr(ngram_join, "TILE", 4)
    rows = list(enumerate(near_texts(150, seed)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicate_components(make_docs(rows), 3, 90).collect()}
    assert got == components(rows, 3, 90)


def test_ngram_join_large_blocks_are_many_groups(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 10)
    comp = [0] * 60 + [1] * 5 + list(range(2, 57))
    large = spark.createDataFrame([(7, 8, i, c) for i, c in enumerate(comp)], "f1 long, f2 long, rep long, comp long")
    groups = {}
    for r in ngram_join._tiled(large).collect():
        groups.setdefault(r["group"], []).append((r["rep"], r["side"]))
    assert max(map(len, groups.values())) <= 50
    met = {(a, b) for g in groups.values() for a, x in g for b, y in g if a < b and (x != y or x == 0)}
    assert {(a, b) for a in range(120) for b in range(a + 1, 120) if comp[a] != comp[b]} <= met


def test_ngram_join_empty_and_long_text(make_docs, monkeypatch):
    assert ngram_join.near_duplicate_components(make_docs([]), 3, 90).count() == 0
    monkeypatch.setattr("telmark.llm.text_hash.CHUNK_BYTES", 1000)
    import pyarrow as pa

    text = " ".join(f"w{i}" for i in range(3000))
    off, raw = string_buffers(pa.array([text, "a b c", text.upper()]))
    a, b, c = shingle_sets(off, raw, 3)
    assert len(a) == 2998 and len(b) == 1 and (a == c).all()


def test_packing(make_docs, spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(4)
    texts = [" ".join(rng.choices(WORDS + ["İx,", "Σς.", "a,.b", "don't", "中文"], k=rng.choice([0, 1, 5, 40, 90, 300]))) for _ in range(120)] + [None, ""]
    rows = list(enumerate(texts))
    out = packing.pack_documents(make_docs(rows), path, sequence_length=64, group_rows=50).toPandas()
    tk = Tokenizer.from_file(path)
    total = 0
    for i, t in rows:
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        g = out[out.doc_id == i].sort_values("piece")
        want = [(p, 64 * p, len(ids[64 * p : 64 * p + 64]), zlib.crc32(np.array(ids[64 * p : 64 * p + 64], "<u4").tobytes())) for p in range(-(-len(ids) // 64))]
        assert [tuple(map(int, x)) for x in g[["piece", "start", "length", "ids_crc32"]].to_numpy()] == want
    s = out.sort_values(["sequence_id", "offset"])
    assert (s.groupby("sequence_id")["length"].cumsum() - s["length"] == s["offset"]).all()
    assert s.groupby("sequence_id")["length"].sum().max() <= 64
    assert out.sequence_id.nunique() <= -(-total // 64) + 4
    assert packing.pack_documents(make_docs([]), path).count() == 0


def test_packing_combining_marks_and_repeated_rows(make_docs):
    """Letters that compose only when small, and rows that are equal in all columns or have no id."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    texts = [f"A{m} word H̱ {a}{m}{b}, X" for m in "̱̌̈̊́" for a in "HJTWYeE" for b in ("", "s")] + ["été ẞ", "plain Text. And, more"]
    rows = list(enumerate(texts)) + [(7, "twice")] * 3 + [(None, "no id")] * 4
    out = packing.pack_documents(make_docs(rows), path).toPandas()
    assert len(out) == len(rows) and out.doc_id.isna().sum() == 4
    for i, t in enumerate(texts):
        ids = np.array([*tk.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert zlib.crc32(ids) in set(out[out.doc_id == i].ids_crc32), t
    s = out.sort_values(["sequence_id", "offset"])
    assert (s.groupby("sequence_id")["length"].cumsum() - s["length"] == s["offset"]).all()


def test_added_columns_do_not_clash(make_docs):
    line = "the same long line in every document"
    docs = make_docs([line + f"\n{i}" for i in range(4)]).withColumns({c: F.lit("own") for c in ("n_lines_before", "__doc", "__tag", "__d", "lost_doc_id")})
    out = line_dedup.drop_lines(docs, counts=None)
    assert out.columns == docs.columns and {r["n_lines_before"] for r in out.collect()} == {"own"}
    counted = line_dedup.drop_lines(docs).collect()
    assert sum(r["n_lines_dropped"] for r in counted) == 3 and {r["__doc"] for r in counted} == {"own"}
    kept = ngram_join.keep_one(docs, k=2, percent=50)
    assert kept.columns == docs.columns and kept.count() == 1


def test_one_queue_for_many_pretokens_equals_one_for_each():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    c = bpe.Codec(path, public_tokenizers.PATTERN)
    rng = random.Random(8)
    pieces = [bytes(rng.choices(b"aeinrst hu\xc3\xa9", k=rng.randint(1, 60))) for _ in range(3000)] + [b"a" * n for n in range(1, 64)] + [b"-" * 63, b"ababab" * 10]
    want = [np.array(c.long.merge(p), "<u4").tobytes() for p in pieces]
    assert c.many.merge(pieces) == want


def test_bpe_nulls_and_empty_table(make_docs):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    rows = [(None, "some text"), (1, None), (1, "some text"), (2, ""), (3, "  two  spaces    wide\x1c \n\n end ")]
    out = bpe.round_trip(make_docs(rows), path, public_tokenizers.PATTERN).collect()
    assert len(out) == 5 and {r["n_tokens"] for r in out if r["doc_id"] in (None, 2)} == {2, 0}
    assert {r["decoded_sha256"] for r in out} == {hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows}
    assert bpe.round_trip(make_docs([]), path, public_tokenizers.PATTERN).count() == 0


def test_minimum_slack_fills_bins():
    lengths = np.array([6, 5, 4, 3, 2, 1, 9, 7, 3])
    bins = packing.minimum_slack(lengths, 10)
    assert np.bincount(bins, lengths).tolist() == [10, 10, 10, 10]
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 4096, 3000)
    bins = packing.minimum_slack(lengths, 4096)
    load = np.bincount(bins, lengths)
    assert load.max() <= 4096 and len(load) <= -(-lengths.sum() // 4096) * 1.03 + 1


def test_bpe_equals_library(make_docs):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    rng = random.Random(2)
    alphabet = "ab   \n\t\r\x1c\x1f\x85  　é'sS1٣²中😀.,!\x00ªǅ"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(400)] + [None, "", "ab" * 20000 + "".join(rng.choices("abcdefgh", k=20000))]
    out = {r["doc_id"]: r for r in bpe.round_trip(make_docs(texts), path, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert out[i]["n_tokens"] == len(ids)
        assert out[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    docs = make_docs(texts)
    back = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN)
    assert {r["doc_id"]: r["decoded"] for r in back.collect()}[5] == texts[5].encode()


SECRET = 'password = "hunter2hunter2"'


@pytest.mark.parametrize(("wrap", "depth"), [
    (lambda s: s, 0), (urllib.parse.quote, 1), (lambda s: "".join(f"\\u{ord(c):04x}" for c in s), 1), (lambda s: base64.b64encode(s.encode()).decode(), 1), (lambda s: base64.b64encode(gzip.compress(s.encode())).decode(), 1),
    (lambda s: urllib.parse.quote(base64.b64encode(zlib.compress(urllib.parse.quote(s).encode())).decode()), 3), (lambda s: base64.b64encode(base64.b64encode(base64.b64encode(s.encode()))).decode(), 3),
])
def test_secrets_in_layers(wrap, depth):
    text = f"é before {wrap(SECRET)} after"
    found = [f for f in secret_scan.scan_text(text) if f[0] == "assign"]
    assert found, text
    assert min(f[3] for f in found) <= depth
    start, end = min(f[1] for f in found), max(f[2] for f in found)
    assert 9 <= start < end <= len(text) - len(" after")
    assert "hunter2" not in secret_scan.redact(text)


def test_secret_base_rules():
    spans = lambda t: [(k, s, e) for k, s, e, d, _ in secret_scan.scan_text(t) if d == 0]
    assert spans("secret=token:abcdefgh12") == []
    assert spans("PassWord: 'abcdefgh'") == [("assign", 0, 19)]
    assert spans("tſoken=abcdefgh1 " + "f" * 31) == []
    assert spans("AKIAAKIA1234567890 " + "a0" * 16) == [("access", 0, 18), ("hex", 19, 51)]
    assert secret_scan.scan_text("") == []


def test_secret_cycle_and_bomb(monkeypatch):
    monkeypatch.setattr(secret_scan, "MAX_INFLATED", 1000)
    bomb = base64.b64encode(zlib.compress(b"a " * 100000)).decode()
    assert [f[0] for f in secret_scan.scan_text(bomb)] == ["bomb"]
    assert secret_scan.scan_text("%2525252525252525") == []


def test_secret_query_and_redaction(make_docs, spark, tmp_path):
    rows = [(1, f"x {SECRET} {'ab' * 20}"), (2, None), (3, ""), (4, "nothing here")]
    make_docs(rows).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op6_secret_scan(spark, str(tmp_path)).collect()}
    assert (got[1]["n_assign"], got[1]["n_access"], got[1]["n_hex"], got[1]["spans"]) == (1, 0, 1, "assign:2:28,hex:30:70")
    assert got[1]["base_sha256"] == hashlib.sha256(b"assign:2:28,hex:30:70").hexdigest() and got[2]["spans"] == ""
    assert got[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    out = {r["doc_id"]: r["text"] for r in secret_scan.redact_documents(make_docs(rows)).collect()}
    assert out == {1: 'x [SECRET]" [SECRET]', 2: None, 3: "", 4: "nothing here"}


def test_secret_repeated_passages():
    run = base64.b64encode(b"%70assword%3Dhunter2hunter2").decode()
    text = " ".join(f"{i} {run}," for i in range(12))
    spans = {(s, e) for k, s, e, *_ in secret_scan.scan_text(text) if k == "assign"}
    at = [i for i in range(len(text)) if text.startswith(run, i)]
    assert spans == {(i, i + len(run)) for i in at} and len(at) == 12
    assert secret_scan.redact(text) == " ".join(f"{i} [SECRET]," for i in range(12))


def test_secret_redaction_ends_without_findings(monkeypatch):
    # Each round uncovers one more finding.
    scan = lambda t: [("assign", t.index("#"), t.index("#") + 1, 0, "")] if "#" in t else []
    monkeypatch.setattr(secret_scan, "scan_text", scan)
    assert secret_scan.redact("#" * 20) == "[SECRET]" * 20


def _nested(data, times):
    for _ in range(times):
        data = gzip.compress(data)
    return data


@pytest.mark.parametrize("data", [
    gzip.compress(b"nothing here") + gzip.compress(SECRET.encode()), bz2.compress(b"nothing here") + bz2.compress(SECRET.encode()), zlib.compress(b"nothing here") + b"\0" * 20 + gzip.compress(SECRET.encode()), gzip.compress(b"nothing here") + b" then " + SECRET.encode(),
    b"\xff\x00 before " + SECRET.encode(), b"\x1b[1m" + SECRET.encode(), b"x^2 " + SECRET.encode(), gzip.compress(b"\xfe\x07" + SECRET.encode())[:-4], _nested(SECRET.encode(), 80),
], ids=["gzip", "bzip2", "mixed", "rest", "no utf-8", "control", "no zlib", "cut off", "nested"])
def test_secrets_in_awkward_layers(data):
    text = f"before {base64.b64encode(data).decode()} after"
    assert {(s, e) for k, s, e, *_ in secret_scan.scan_text(text) if k == "assign"} == {(7, len(text) - 6)}
    assert secret_scan.redact(text) == "before [SECRET] after"


@pytest.mark.parametrize("at", [0, 990, 4090, 50_000, 99_000])
@pytest.mark.parametrize("wrap", [lambda b: b, base64.b64encode, lambda b: urllib.parse.quote(b).encode(), lambda b: b.replace(b" = ", b" " * 6000 + b"= ")], ids=["plain", "base64", "escape", "spaces"])
def test_secrets_in_large_layers(monkeypatch, at, wrap):
    monkeypatch.setattr(secret_scan, "MAX_INFLATED", 5000)
    monkeypatch.setattr(secret_scan, "PIECE", 4096)
    noise = " ".join(random.Random(1).choices(WORDS, k=20_000)).encode()[:100_000]
    data = noise[:at] + b" " + wrap(SECRET.encode()) + b" " + noise[at:]
    text = base64.b64encode(gzip.compress(gzip.compress(data))).decode()
    assert {f[0] for f in secret_scan.scan_text(text)} == {"assign", "bomb"}


def test_damaged_compressed_data_is_reported():
    data = bytearray(gzip.compress(random.Random(1).randbytes(3000)))
    data[1500:] = b""
    assert secret_scan.scan_text(base64.b64encode(bytes(data)).decode()) == []
    data = bytearray(bz2.compress(random.Random(1).randbytes(3000)))
    data[1500:1600] = bytes(100)
    assert "bomb" in {f[0] for f in secret_scan.scan_text(base64.b64encode(bytes(data)).decode())}


WRAPPED = b"x password = hunter2hunter2hunter2 and so on"


@pytest.mark.parametrize("text", [
    f"https://x.io/a/{base64.b64encode(WRAPPED).decode()}", f"w{base64.b64encode(WRAPPED).decode()}", f"wo{base64.b64encode(WRAPPED).decode()}", f"wor{base64.b64encode(WRAPPED).decode()}", f"path/{base64.b64encode(gzip.compress(WRAPPED)).decode()}",
    base64.b64encode(WRAPPED.decode().encode("utf-16-le")).decode(), base64.b64encode(WRAPPED.decode().encode("utf-16-be")).decode(), "\\U00000070assword=hunter2hunter2hunter2", base64.b64encode(zlib.compress(WRAPPED)[2:-4]).decode(),
    base64.encodebytes(b"lorem ipsum dolor sit amet consectetur a" + WRAPPED + b" tail" * 30).decode(), base64.encodebytes(b"lorem ipsum dolor sit amet consectetur a" + WRAPPED + b" tail" * 30).decode().replace("\n", "\\n"),
    base64.encodebytes(b"lorem ipsum dolor sit amet consectetur a" + WRAPPED + b" tail" * 30).decode().replace("\n", "\r\n  "),
], ids=["slash", "glued 1", "glued 2", "glued 3", "compressed after a slash", "utf-16-le", "utf-16-be", "capital U", "raw deflate", "lines", "written lines", "indented lines"])
def test_secrets_in_places_of_base64(text):
    assert "assign" in {f[0] for f in secret_scan.scan_text(text)}
    left = secret_scan.redact(text)
    assert left.startswith(text[:2]) or left.startswith("[SECRET]")
    assert not secret_scan.scan_text(left) and len(left) < 40


@pytest.mark.parametrize("text", ["%" + "25" * 100_000 + "70assword=hunter2hunter2", "\\u005c" + "u005c" * 20_000 + "u0070assword=hunter2hunter2", "&#38;" + "#38;" * 30_000 + "#112;assword=hunter2hunter2", "%2" + "%3" * 50_000 + "%3570assword=hunter2hunter2"], ids=["percent", "unicode", "numeric", "digits"])
def test_deep_escapes_are_reduced_at_once(text):
    start = time.perf_counter()
    assert ("assign", 0, len(text)) in {f[:3] for f in secret_scan.scan_text(text)}
    assert time.perf_counter() - start < 5


def test_deep_escapes_through_spark(make_docs):
    rows = [(1, "%" + "25" * 1002 + "41"), (2, ("%" + "25" * 400 + "70assword=hunter2hunter2 ") * 20), (2, "x"), (2, "x")]
    out = {r["doc_id"]: r["text"] for r in secret_scan.redact_documents(make_docs(rows)).collect() if r["text"] != "x"}
    assert "hunter2" not in out[2] and secret_scan.scan(make_docs(rows)).count() == 4
    assert secret_scan.scan(make_docs([])).count() == 0


def _percent(t):
    return "".join(f"%{b:02x}" for b in t.encode())


NESTS = [
    _percent, lambda t: t.replace("a", "%61").replace("=", "%3D"), lambda t: "".join(f"\\u{ord(c):04x}" for c in t), lambda t: "".join(f"\\x{b:02x}" for b in t.encode()), lambda t: "".join(f"&#{ord(c)};" for c in t),
    lambda t: base64.b64encode(t.encode()).decode(), lambda t: base64.urlsafe_b64encode(t.encode()).decode().rstrip("="), lambda t: base64.encodebytes(t.encode()).decode(), lambda t: base64.b64encode(gzip.compress(t.encode())).decode(),
    lambda t: base64.b64encode(bz2.compress(t.encode())).decode(), lambda t: f"x/y{base64.b64encode(t.encode()).decode()}", lambda t: base64.b64encode(t.encode("utf-16-le")).decode(), lambda t: f"say {t} now",
]


def unwrapped(text, depth=0):
    """All that plain decoding of a text gives, by brute force over its stretches."""
    out = [text]
    if depth > 12 or len(out) > 10_000:
        return out
    new = [urllib.parse.unquote(text), re.sub(r"\\u([0-9a-f]{4})|\\x([0-9a-f]{2})|&#(\d+);", lambda m: chr(int(m[1] or m[2], 16) if m[1] or m[2] else int(m[3])), text)]
    for run in re.findall(r"[A-Za-z0-9+/_-]{16,}=*", text) + [x.replace("\n", "") for x in re.findall(r"(?:[A-Za-z0-9+/]+\n)+[A-Za-z0-9+/]*=*", text)]:
        for at in range(4):
            part = run.rstrip("=")[at:].replace("-", "+").replace("_", "/")
            try:
                raw = base64.b64decode(part + "=" * (-len(part) % 4), validate=True)
            except ValueError:
                continue
            for f in (bytes, gzip.decompress, bz2.decompress):
                for code in ("utf-8", "utf-16-le"):
                    try:
                        new.append(f(raw).decode(code))
                    except (ValueError, OSError, EOFError):
                        pass
    for t in set(new) - {text}:
        out += unwrapped(t, depth + 1)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_random_nests_against_brute_force(seed):
    rng = random.Random(seed)
    text = "token = abcdefgh12345678"
    for _ in range(rng.randrange(1, 6)):
        text = rng.choice(NESTS)(text)
        if len(text) > 4000:
            break
    text = f"first {text} last"
    assert any("token = abcdefgh12345678" in t for t in unwrapped(text))
    assert any(k == "assign" for k, *_ in secret_scan.scan_text(text))
    left = secret_scan.redact(text)
    assert left.startswith("first ") and not any("abcdefgh1234" in t for t in unwrapped(left))
