"""Vectors, URLs, shards, toxicity and the pipeline against brute force and held-out labels."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from telmark.llm import ann, queries, sharding, toxicity, url_filter, vector_dedup

VECTOR = "vec_id long, embedding array<float>, label int, shard string, rep string"


def vectors(spark, n=300, dim=12, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, dim))
    rows = []
    for i in range(n):
        x = base[rng.integers(len(base))] + rng.normal(size=dim) * rng.choice([0, 0.03, 0.06, 0.3])
        rows.append((i, [float(np.float32(v)) for v in x], int(rng.integers(3)), "s", "r"))
    hot = [1.0] + [0.5] * (dim - 1)
    rows += [(n + i, hot, 1, "s", None) for i in range(60)]
    rows += [(n + 60, None, 1, None, None), (n + 80, [0.0] * dim, 1, None, None), (n + 81, [float("nan")] * dim, 1, None, None), (n + 82, [1.0, None] + [0.0] * (dim - 2), 1, None, None), (n + 83, [float("inf")] * dim, 1, None, None), (n + 84, hot, None, None, None), (n + 85, [], 1, None, None), (n + 100, [2.0] * (dim - 1), 1, None, None)]
    return rows, spark.createDataFrame(rows, VECTOR)


def usable(e):
    return e and all(v is not None and np.isfinite(v) for v in e) and any(e)


@pytest.mark.parametrize("k", [5, 40])
def test_vantage_trees_exact_with_factor_one(spark, monkeypatch, k):
    monkeypatch.setattr(ann, "BLOCK", 8)
    rows, df = vectors(spark)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=k, factor=1.0, shard_rows=100).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ok = [(i, np.array(e, np.float64)) for i, e, *_ in rows if usable(e)]
    asked = [(i, e) for i, e in ok if i % 20 == 0]
    assert set(got) == {i for i, e in asked if any(len(e) == len(x) and j != i for j, x in ok)}
    for i, e in asked:
        if i not in got:
            continue
        best = sorted(((-float((x * e).sum()), j) for j, x in ok if j != i and len(x) == len(e)))[:k]
        assert [v for _, v, _ in got[i]] == [j for _, j in best]
        assert np.allclose([s for *_, s in got[i]], [-s for s, _ in best], rtol=1e-12)


def test_vantage_trees_recall_of_production_factor(spark):
    rows, df = vectors(spark, n=800, dim=32, seed=3)
    got = {(r["query_id"], r["vec_id"]) for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=20, factor=1.15, shard_rows=400).collect()}
    want = {(r["query_id"], r["vec_id"]) for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k=20, factor=1.0, shard_rows=10**6).collect()}
    assert len(got & want) >= 0.95 * len(want)


def test_vantage_trees_empty(spark):
    assert ann.nearest(spark.createDataFrame([], VECTOR), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("block", [16, 1024])
def test_vector_dedup_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    rows, df = vectors(spark, seed=1)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vector_dedup.near_duplicates(df).collect()}
    ok = [(i, np.array(e, np.float64) / np.linalg.norm(e), lab) for i, e, lab, *_ in rows if usable(e) and lab is not None]
    links = {i: [] for i, *_ in rows}
    for a, x, la in ok:
        for b, y, lb in ok:
            if a != b and la == lb and len(x) == len(y) and float(x @ y) >= 0.98:
                links[a].append(b)
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        assert got[i] == (len(links[i]), min(seen), min(seen) == i), i
    assert vector_dedup.near_duplicates(df.limit(0)).count() == 0


def test_vector_dedup_finds_links_outside_of_windows(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "WINDOW", 1)
    monkeypatch.setattr(vector_dedup, "PACKED", 16)
    monkeypatch.setattr(vector_dedup, "PACKS_IN_TASK", 4)
    rng = np.random.default_rng(5)
    # Near copies before a common background are no neighbours in the order of one pass.
    base = rng.normal(size=(120, 16)) * 0.35 + 1
    near = base + rng.normal(size=base.shape) * 0.1
    rows = [(i, [float(np.float32(v)) for v in x], i % 2, "s", "r") for i, x in enumerate(np.concatenate([base, near]))]
    df = spark.createDataFrame(rows, VECTOR)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.near_duplicates(df, threshold=0.98, passes=1).collect()}
    x = np.array([np.array(e) / np.linalg.norm(e) for _, e, *_ in rows])
    lab = np.array([r[2] for r in rows])
    linked = (x @ x.T >= 0.98) & (lab[:, None] == lab[None, :])
    np.fill_diagonal(linked, False)
    root = vector_dedup._roots(linked)
    assert linked.any() and {i: (int(n), int(c)) for i, (n, c) in enumerate(zip(linked.sum(1), root, strict=True))} == got


def test_url_rules_and_hosts(spark):
    urls = [
        (1, "https://www.example.com/en/x"), (2, "http://A.Example.COM/en/1?q=/fr/"), (3, "http://example.com/fr/"), (4, "x.net/es/"), (5, "http://b.net/es/1"), (6, "http://notnet/es/"), (7, None), (8, ""), (9, "http://c.com"), (10, "http://x.org#/fr/"), (11, "http://x.net/ES/"),
    ]
    df = spark.createDataFrame(urls, "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(df, queries.URL_RULES).collect()}
    assert got[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[2] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[3] == ("example.com", "/fr/", "com/", "allow")
    assert got[4][:3] == ("", "", None) and got[7][:3] == ("", "", None) and got[8][:3] == ("", "", None)
    assert got[5][2:] == ("net/es/", "block") and got[6][2] is None and got[9][:3] == ("c.com", "", None) and got[10][:3] == ("x.org", "", None) and got[11][2] is None
    assert {v[3] for v in got.values()} <= {"allow", "block"} and len(got) == len(urls)


def test_url_model_separates_and_matches_brute_force(spark):
    rng = random.Random(0)
    good, bad = ["garden", "recipes", "library", "museum"], ["casino", "pills", "jackpot", "xxx"]
    rows = [(i, f"http://{rng.choice(good)}{rng.randint(0, 99)}.ok/{rng.choice(good)}") for i in range(60)] + [(100 + i, f"http://{rng.choice(bad)}{rng.randint(0, 99)}.no/{rng.choice(bad)}") for i in range(60)]
    rows += [(200 + i, f"http://{rng.choice(good)}.new/{rng.choice(good)}") for i in range(20)] + [(300 + i, f"http://{rng.choice(bad)}.new/{rng.choice(bad)}") for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.judge(df, [("allow", "ok", "/"), ("block", "no", "/")]).collect()}
    assert all(got[i]["verdict"] == "allow" for i in range(200, 220)) and all(got[i]["verdict"] == "block" for i in range(300, 320))

    def model(texts):
        counts = {}
        for t in texts:
            s = "\u0002" * 3 + t + "\u0003"
            for p in range(3, len(s)):
                for k in range(4):
                    counts.setdefault(s[p - k : p], {}).setdefault(s[p], 0)
                    counts[s[p - k : p]][s[p]] += 1
        def prob(ctx, c):
            below = prob(ctx[1:], c) if ctx else 1 / 256
            seen = counts.get(ctx, {})
            n, t = sum(seen.values()), len(seen)
            return (seen.get(c, 0) + t * below) / (n + t) if n else below
        return prob

    strip = lambda u: u.split("://")[1]
    a, b = model([strip(u) for i, u in rows if i < 100]), model([strip(u) for i, u in rows if 100 <= i < 200])
    for i, u in rows[120:]:
        s = "\u0002" * 3 + strip(u) + "\u0003"
        want = np.mean([np.log(a(s[p - 3 : p], s[p])) - np.log(b(s[p - 3 : p], s[p])) for p in range(3, len(s))])
        assert abs(got[i]["score"] - want) < 1e-6


def test_url_model_reads_query_fragment_and_urls_without_a_host(spark):
    rng = random.Random(4)
    word = lambda good: rng.choice(["garden", "recipes", "library"] if good else ["casino", "pills", "jackpot"])
    shapes = [lambda w: f"http://x.{{}}/p?q={w}-{w}", lambda w: f"http://x.{{}}/p#{w}-{w}"]
    rows = [(i, rng.choice(shapes)(word(i < 60)).format("ok" if i < 60 else "no")) for i in range(120)]
    new = [(200 + i, rng.choice(shapes)(word(i < 20)).format("new")) for i in range(40)] + [(300 + i, f"{word(i < 20)}-{word(i < 20)}") for i in range(40)]
    long = "http://y.new/" + "garden-" * 5000
    df = spark.createDataFrame([(*r, "h", "t") for r in rows + new + [(400, long), (None, new[0][1]), (200, new[0][1]), (500, None)]], "page_id long, url string, host string, text string")
    got = {}
    for r in url_filter.judge(df, [("allow", "ok", "/"), ("block", "no", "/")]).collect():
        got.setdefault(r["page_id"], []).append(r)
    for i, _ in new:
        assert {r["verdict"] for r in got[i]} == {"allow" if i % 100 < 20 else "block"}, i
    assert len(got[200]) == 2 and got[None][0]["score"] == got[200][0]["score"] and got[400][0]["verdict"] == "allow" and len(got[500]) == 1
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty, [("allow", "ok", "/")]).count() == 0


def test_hypergeometric_law():
    rng = random.Random(1)
    x = np.array([sharding.hypergeometric(rng, 30, 70, 20) for _ in range(4000)])
    assert abs(x.mean() - 6) < 0.15 and abs(x.var() - 20 * 0.3 * 0.7 * 80 / 99) < 0.4
    m = np.array(sharding.communication_matrix([5, 0, 17, 300], [81, 81, 80, 80], 3))
    assert m.sum(1).tolist() == [5, 0, 17, 300] and m.sum(0).tolist() == [81, 81, 80, 80] and (m >= 0).all()


@pytest.mark.parametrize("block", [7, 1000])
def test_shards(make_docs, block):
    import zlib

    rows = [(i, "same text" if i % 3 == 0 else f"text é {i}") for i in range(500)] + [(None, None), (1, "x"), (1, "x"), (None, "")]
    out = sharding.shuffle_into_shards(make_docs(rows), 16, block_rows=block).toPandas()
    assert len(out) == len(rows)
    sizes = out.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1 and len(sizes) == 16
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in out.groupby("shard"))
    want = sorted(((-1 if i is None else i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted(zip(out.doc_id.fillna(-1).astype(int), out["size"], out.text_crc32, strict=True)) == want
    again = sharding.shuffle_into_shards(make_docs(rows), 16, block_rows=block).toPandas()
    key = lambda d: sorted(zip(d.doc_id.fillna(-1), d.text_crc32, d.shard, d.slot, strict=True))
    assert key(out) == key(again)
    assert sharding.shuffle_into_shards(make_docs([]), 16).count() == 0


def test_label_model_finds_good_voters():
    rng = np.random.default_rng(0)
    y = rng.random(5000) < 0.2
    cols = [np.where(rng.random(5000) < acc, np.where(y, 1, -1), np.where(y, -1, 1)) for acc in (0.95, 0.9, 0.85, 0.6)]
    cols.append(cols[3])  # a copy of the poor voter
    patterns, counts = np.unique(np.stack(cols, 1).astype(np.int8), axis=0, return_counts=True)
    acc, balance, weight = toxicity.label_model(patterns, counts.astype(float))
    assert abs(balance - 0.2) < 0.05 and weight[4] < 0.8
    got = toxicity.posterior(np.stack(cols, 1), acc, balance, weight) >= 0.5
    assert (got == y).mean() > 0.93


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op5_weak_supervision(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    p = out.filter("held_out").join(labels, "doc_id").toPandas()
    hit = ((p.predicted == 1) & (p.toxic == 1)).sum()
    assert hit >= 0.6 * (p.toxic == 1).sum() and ((p.predicted == 1) & (p.toxic == 0)).sum() <= 0.1 * (p.toxic == 0).sum()
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_toxicity_odd_inputs(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    docs = make_docs([(1, None), (2, ""), (3, "you stupid pathetic idiot, " * 5), (4, "a calm and friendly note about gardens " * 5), (None, "1 2 3")])
    out = {r["doc_id"]: r["toxic_score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert out[3] >= 0.5 and all(out[i] < 0.5 for i in (1, 2, 4, None))
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_toxicity_repeated_ids_and_clashing_names(spark, make_docs):
    rude, kind = "you stupid pathetic idiot with zorgle words, " * 5, "a calm and friendly note about gardens " * 5
    rows = [(i, rude if i % 4 == 0 else kind) for i in range(400)] + [(8, rude)] * 50 + [(8, kind)]
    labels = spark.createDataFrame([(i, 0, int(i % 4 == 0)) for i in range(400)] + [(8, 0, 0), (None, 0, 1), (5, 0, None)], "doc_id long, quality int, toxic int")
    docs = make_docs(rows).withColumn("toxic_score", F.lit("own"))
    model = toxicity.fit(docs, labels)
    out = toxicity.score(docs, model, "__score")
    assert out.columns == [*docs.columns, "__score"]
    got = out.collect()
    assert len(got) == len(rows) and all((r["__score"] >= 0.5) == (r["text"] == rude) and r["toxic_score"] == "own" for r in got)
    assert toxicity.score(docs, model).columns == docs.columns


def test_vantage_trees_odd_ids(spark):
    """Repeated and null ids: a null takes no part, repeats are candidates like others."""
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (1, [0.8, 0.2]), (None, [5.0, 5.0]), (20, [0.0, 1.0])]
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=3).collect()]
    assert sorted(got) == [(0, 1, 1), (0, 2, 1), (0, 3, 20), (20, 1, 1), (20, 2, 1), (20, 3, 0)]


def test_pipeline_odd_tables(spark, make_docs, tmp_path):
    """Every stage on an empty table, on repeated rows, and with columns of the names that stages use."""
    pipeline = pytest.importorskip("corpus_pipeline")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    extra = {c: F.lit("own") for c in ("toxic_score", "n_lines_before", "lost_doc_id", "kept_by")}
    for n, rows in enumerate(([], [(1, "a few plain words here")] * 3 + [(None, "a few plain words here"), (2, None)])):
        docs = make_docs(rows).withColumns(extra)
        for i, (_, stage) in enumerate(pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            out.write.parquet(str(tmp_path / f"{n}-{i}"))
            assert i == len(pipeline.STAGES) - 1 or out.columns == docs.columns
            docs = spark.read.schema(out.schema).parquet(str(tmp_path / f"{n}-{i}"))
        assert docs.count() == len(rows)


def test_pipeline(spark, make_docs, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    shared = "this very line stands in many documents"
    base = [word() for _ in range(200)]
    near = list(base)
    near[10] = "changed"
    rows = [(i, " ".join(word() for _ in range(80)) + "\n" + shared) for i in range(10)] + [(20, " ".join(base)), (21, " ".join(near)), (22, " ".join(base)), (30, "stupid idiot trash pathetic moron " * 10), (40, 'note password = "hunter2hunter2" end'), (41, None), (42, "")]
    make_docs(rows).drop("tag", "n", "rep").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    names = []
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / f"out{len(names)}")
        out.write.parquet(path)
        names.append(name)
        if len(names) < len(pipeline.STAGES):
            assert out.columns == docs.columns
            docs = spark.read.parquet(path)
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert 30 not in kept and 20 in kept and 21 not in kept and 22 not in kept
    assert sum(shared in (t or "") for t in kept.values()) == 1 and shared in kept[9]
    assert "hunter2" not in kept[40] and kept[41] is None
    packed = spark.read.parquet(str(tmp_path / "out4")).toPandas()
    assert set(packed.doc_id) == set(kept) and packed.groupby("sequence_id")["length"].sum().max() <= 4096
    whole = pipeline.run(spark, str(tmp_path)).toPandas()
    cols = ["doc_id", "piece", "length", "ids_crc32"]
    assert sorted(map(tuple, whole[cols].to_numpy())) == sorted(map(tuple, packed[cols].to_numpy()))
