"""The Merkle manifest, centroid clustering and window packing against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from telmark.llm import centroids, merkle, queries, window_packing

DOCS = "doc_id long, source string, lang string, n_chars long, text string, part string, place string, grp string, digest string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*map(enc, (*row[:4], text)))


def folded(nodes):
    """The top, and each leaf's siblings level by level, from plain recursion over lists."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, at in zip(paths, where, strict=True):
            run = at // 16 * 16
            path.append((nodes[run:at], nodes[at + 1 : run + 16]))
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        where = [at // 16 for at in where]
    return nodes[0], paths


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops, paths = {}, {}
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
        tops[s], paths[s] = folded([x[2] for x in groups[s]])
    root, upper = folded([tops[s] for s in names])
    out = []
    for s, up in zip(names, upper, strict=True):
        for (_, _, own, r), path in zip(groups[s], paths[s], strict=True):
            proof = path + up
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            acc = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])) if bad else own
            for before, after in proof:
                acc = h(*before, acc, *after)
            out.append((r[0], own, tops[s], root, h(*[x for before, after in proof for x in before + after]), acc, acc == root))
    return out


def manifest_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 6 + ["Z", "a", "é", "", "😀", None, f"own-{i}"])
        text = rng.choice(["", None, "Abc", "ünï Text 😀", "plain", "X" * 5000])
        rows.append((rng.choice([i, i, i, None]) if i % 50 == 0 else i, source, rng.choice(["en", None, ""]), rng.choice([None, 3, -1]), text, "p", None, "g", "d"))
    return rows + [rows[n // 2]] * 40 + [rows[-1]] * 3


@pytest.mark.parametrize(("n", "leaves", "per_range"), [(900, 7, 60), (300, 64, 1 << 20), (1, 4096, 1 << 20)])
def test_manifest_equals_plain_recursion(spark, tmp_path, monkeypatch, n, leaves, per_range):
    monkeypatch.setattr(merkle, "LEAVES", leaves)
    monkeypatch.setattr(merkle, "RANGE_LEAVES", per_range)
    monkeypatch.setattr(merkle, "TASK_NODES", 100)
    rows = manifest_rows(n, n)
    spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_merkle_manifest(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected(rows), key=str)
    assert {r["verified"] for r in got if r["doc_id"] is None} <= {True}


def test_manifest_of_an_empty_table_and_kept_columns(spark):
    df = spark.createDataFrame([], DOCS)
    digest = merkle.leaf_digest(F.col("text"))
    assert merkle.manifest(df, F.col("source"), F.col("doc_id"), digest, ["doc_id"]).count() == 0
    df = spark.createDataFrame([(1, "s", None, None, "t", "p", "q", "g", "d")], DOCS)
    r = merkle.manifest(df, F.col("source"), F.col("doc_id"), digest, ["part", "place", "grp", "digest"]).first()
    assert (r["part"], r["place"], r["grp"], r["digest"]) == ("p", "q", "g", "d")
    assert r["leaf"] == r["subroot"] == r["root"] == h("1:t") and r["proof"] == []


@pytest.mark.parametrize("size", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4097])
def test_multiproof_of_any_range_is_minimal_and_enough(size):
    rng = random.Random(size)
    leaves = [h(str(i)) for i in range(size)]
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(merkle._runs(levels[-1]))
    for _ in range(20):
        lo = rng.randrange(size)
        hi = rng.randrange(lo, size) + 1
        wanted = {(level, i) for level, _, first, last, a, b in merkle._above(lo, hi, size) for i in (*range(a, first), *range(last, b))}
        proofs = merkle._proofs(leaves[lo:hi], lo, size, {(level, i): levels[level][i] for level, i in wanted})
        for i, proof in zip(range(lo, hi), proofs, strict=True):
            acc = leaves[i]
            for before, after in proof:
                acc = h(before, acc, after)
            assert acc == levels[-1][0] and len(proof) == len(levels) - 1
        covered = {(0, i) for i in range(lo, hi)}
        for level in range(1, len(levels)):
            covered |= {(level, i // 16) for lev, i in covered if lev == level - 1}
        assert not wanted & covered
        for level, i, d in merkle._subtrees(leaves[lo:hi], lo, size):
            assert levels[level][i] == d


def kmeans(rows, k=16, rounds=3):
    kept = [(i, [int(np.floor(64 * np.float64(x))) for x in e]) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and np.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, h(f"1:{r[0]}"), r[1]))
    c = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, x, strict=True)), j) for j, x in enumerate(c))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(c)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = [(i, *near(v)) for i, v in kept]
    by = {}
    for _, d, j in found:
        by[j] = by.get(j, 0) + d
    fits = lambda x: x if x < 1 << 63 else None
    return [(i, j, fits(d), fits(by[j]), fits(sum(by.values())), h(",".join(map(str, c[j])))) for i, d, j in found]


def embedding_rows(n, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(6, 64))
    rows = [(i, [float(np.float32(x)) for x in scale * (base[i % 6] * 0.5 + rng.normal(size=64))]) for i in range(n)]
    hot = rows[0][1] if rows else [0.0] * 64
    rows += [(1000 + i, hot) for i in range(n // 2)] + [(7, hot), (7, hot), (None, hot), (2000, [0.0] * 64)]
    return rows + [(3000, None), (3001, [1.0] * 63), (3002, [1.0] * 63 + [None]), (3003, [float("nan")] * 64), (3004, [float("-inf")] * 64), (3005, []), (3006, [-0.001] * 64)]


@pytest.mark.parametrize(("n", "scale"), [(120, 1.0), (60, 3e7), (3, 1.0)])
def test_centroids_equal_brute_force(spark, tmp_path, n, scale):
    rows = embedding_rows(n, n, scale)
    spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<float>, label int, id string, v int").repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op12_centroid_clustering(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(kmeans(rows), key=str)


def test_centroids_of_an_empty_table_and_beyond_the_bounds(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert centroids.with_inertia(*centroids.cluster(df)).count() == 0
    df = spark.createDataFrame([(1, [1e30, 0.0]), (2, [1e10, 0.0]), (3, [-1e10, 0.0]), (4, [1e10, 1.0])], "vec_id long, embedding array<float>")
    got = {r["id"]: (r["cluster"], r["distance"]) for r in centroids.cluster(df, dimensions=2, k=1, rounds=0)[0].collect()}
    assert set(got) == {2, 3, 4} and None in {d for _, d in got.values()}


@pytest.mark.parametrize("seed", range(6))
def test_search_rejects_only_what_cannot_win(seed):
    rng = np.random.default_rng(seed)
    spread = [1, 3, 100, 10**6][seed % 4]
    base = rng.integers(-spread, spread + 1, (40, 16))
    base[20:] = np.maximum(np.minimum(base[:20], base[20:]), base[:20])
    v = np.concatenate([base, rng.integers(-spread, spread + 1, (300, 16)), np.repeat(base[:1], 50, axis=0)])
    number, distance, measured = centroids.Centroids(base).nearest(v)
    all_ = ((v[:, None, :] - base[None]) ** 2).sum(axis=2)
    assert (distance == all_.min(axis=1)).all() and (number == all_.argmin(axis=1)).all()
    assert measured <= len(v) * len(base)


def check_pieces(rows, docs, ids, length=4096):
    by_doc, by_sequence = {}, {}
    for doc, start, n, crc, total, sequence, offset in rows:
        by_doc.setdefault(doc, []).append((start, n, crc, total))
        by_sequence.setdefault(sequence, []).append((offset, n))
    assert set(by_doc) == set(docs)
    for doc, parts in by_doc.items():
        own, at = ids[doc], 0
        for start, n, crc, total in sorted(parts):
            assert start == at and n > 0 and total == len(own) and crc == zlib.crc32(own[at : at + n].tobytes())
            at += n
        assert at == len(own)
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length and at & (at - 1) == 0
    return by_sequence


def test_windows_hold_every_id_once_without_padding(spark, make_docs):
    path = queries.vocabulary("word_bpe_49k.json")
    rng = random.Random(5)
    words = "alpha beta gamma delta, epsilon. zeta ETA theta".split()
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 5, 60, 300, 900, 2500]))) for _ in range(300)]
    texts += [None, "", " ", "a " * 4095, "a " * 4096, "a " * 8191, "a " * 30000] + ["a " * 999] * 150
    tok = Tokenizer.from_file(path)
    ids = {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for i, t in enumerate(texts)}
    rows = [tuple(r) for r in window_packing.pack_documents(make_docs(texts), path, group_rows=40).collect()]
    by_sequence = check_pieces(rows, range(len(texts)), ids)
    total = sum(map(len, ids.values()))
    # Each group ends in twelve short sequences at most, and so do the windows.
    assert len(by_sequence) <= total / 4096 + 12 * (len(texts) // 40 + 2)
    again = window_packing.pack_documents(make_docs([(1, "x y"), (1, "x y"), (None, "z")]), path).collect()
    assert sorted((r["doc_id"] or 0, r["start"], r["doc_tokens"]) for r in again if r["start"] == 0) == [(0, 0, 2), (1, 0, 3), (1, 0, 3)]
    assert window_packing.pack_documents(make_docs([]), path).count() == 0


def test_query_of_window_packing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    tok = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    ids = {r["doc_id"]: np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4") for r in docs}
    out = queries.op13_nnls_packing(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check_pieces([tuple(r) for r in out.collect()], ids.keys(), ids)


@pytest.mark.parametrize("seed", range(8))
def test_plan_uses_no_more_than_there_is_and_fills_windows(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 1024, rng.integers(1, 3000)) if seed % 2 else rng.choice([100, 156, 412, 1000, 512], 500)
    count = {int(a): int(b) for a, b in zip(*np.unique(lengths, return_counts=True), strict=True)}
    p = window_packing.plan(count, 1024)
    spans = {}
    for length, n in count.items():
        taken, sequence, offset = window_packing._look_up(p, np.full(n, length), np.arange(n), 1024)
        assert int(taken.sum()) == int(p.used[length]) <= n
        for s, o in zip(sequence[taken], offset[taken], strict=True):
            spans.setdefault(int(s), []).append((int(o), length))
    for parts in spans.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 1024 and at & (at - 1) == 0
    if seed % 2 == 0:
        # 512 stands alone, 100 goes with 412 or 156, and 1000 with none.
        assert p.used[512] == count[512] and p.used[100] == count[100] and p.used[1000] == 0


def test_least_squares_splits_a_shared_length_by_need():
    members = np.array([[0, 100, 924], [0, 100, 412]])
    count = np.zeros(1025, np.int64)
    count[[100, 924, 412]] = [1000, 700, 300]
    assert np.allclose(window_packing.solve(members, count), [700, 300], rtol=0.05)


@pytest.mark.parametrize("seed", range(8))
def test_pour_keeps_all_and_pads_nothing(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 256, rng.integers(1, 400)).tolist() if seed else [200]
    pieces = window_packing.pour(lengths, 256)
    for row, n in enumerate(lengths):
        at = 0
        for start, length in sorted((s, k) for r, s, k, *_ in pieces if r == row):
            assert start == at
            at += length
        assert at == n
    sizes = {}
    for _, _, length, sequence, _ in pieces:
        sizes[sequence] = sizes.get(sequence, 0) + length
    assert all(n & (n - 1) == 0 for n in sizes.values()) and sum(n == 256 for n in sizes.values()) == sum(lengths) // 256


def test_only_wanted_rows_are_left_by_bitmaps(spark, monkeypatch):
    from telmark.llm import window_packing

    rows = spark.range(70_000).selectExpr("CAST(id % 2 AS INT) AS part", "id DIV 2 AS place", "CAST('x' AS BINARY) AS ids")
    wanted = rows.filter("place IN (0, 1, 7, 8, 32767, 32768) AND part = 1 OR place = 34999 AND part = 0").select("part", "place")
    want = sorted(map(tuple, wanted.collect()))
    got = window_packing._marked(rows, wanted)
    assert got.columns == rows.columns and sorted((r["part"], r["place"]) for r in got.collect()) == want
    monkeypatch.setattr(window_packing, "BITMAPS", 0)
    assert window_packing._marked(rows, wanted).count() == 70_000
