"""The registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telmark.llm import ann, bpe, centroids, line_dedup, merkle, ngram_join, packing, secret_scan, sharding, toxicity, url_filter, vector_dedup, window_packing
from telmark.llm.shared import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_url_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


def op2_vantage_point_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0, k=20, factor=1.15)


def op3_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary("word_bpe_49k.json"))


def op4_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a
)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) c ON c.node = e.vec_id
"""


def op5_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("findings", lambda f: f["depth"] == 0)
    rank = F.create_map(*[x for i, k in enumerate(secret_scan.KINDS) for x in (F.lit(k), F.lit(i))])
    joined = lambda a: F.concat_ws(",", F.transform(F.array_sort(F.transform(a, lambda f: F.struct(f["start"].alias("start"), rank[f["kind"]].alias("rank"), f["end"].alias("end"), f["kind"].alias("kind")))), lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])))
    n = lambda kind: F.size(F.filter(base, lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicate_components(table(spark, sf_dir, "documents", "doc_id", "text"), k=3, percent=90)


OP7_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(words) - 2), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS shingles FROM w
), n AS (SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n FROM s),
t AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM t a JOIN t b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a)
SELECT n.doc_id, n.n AS n_shingles, c.component_id FROM n JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) c ON c.node = n.doc_id
"""


def op8_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shuffle_into_shards(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", F.col("n_lines_before").alias("n_lines"), F.col("n_lines_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP9_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), keyed AS (
  SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), counted AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.top AS dropped FROM keyed k LEFT JOIN counted c USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    leaf = lambda text: merkle.leaf_digest(*map(F.col, ("doc_id", "source", "lang", "n_chars")), text)
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    docs = docs.withColumn("tampered", F.when(fifth, leaf(F.translate("text", string.ascii_uppercase, string.ascii_lowercase))))
    out = merkle.manifest(docs, F.col("source"), F.col("doc_id"), leaf(F.col("text")), ["doc_id", "tampered"])
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    out = out.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _op11_tree(name: str, source: str, levels: int = 6) -> str:
    """CTEs that fold ``(g, i, h)`` to the top, 16 nodes a run, and each leaf's siblings and folded ``bad`` digest. 16 ** levels leaves at most."""
    over = "PARTITION BY g, i // 16 ORDER BY i ROWS BETWEEN"
    parts, n = [f"{name}n0 AS (SELECT g, i, h FROM {source})"], name
    for k in range(levels):
        parts.append(f"""{n}s{k} AS (SELECT g, i, h, count(*) OVER (PARTITION BY g) AS m, coalesce(string_agg(h, '') OVER ({over} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') OVER ({over} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {n}n{k})""")
        parts.append(f"{n}n{k + 1} AS (SELECT g, i // 16 AS i, CASE WHEN any_value(m) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h FROM {n}s{k} GROUP BY g, i // 16)")
    parts.append(f"{n}p0 AS (SELECT g, i AS leaf_i, i, bad, '' AS proof FROM {source})")
    for k in range(levels):
        parts.append(f"{n}p{k + 1} AS (SELECT p.g, leaf_i, p.i // 16 AS i, CASE WHEN m > 1 THEN sha256(l || bad || r) ELSE bad END AS bad, CASE WHEN m > 1 THEN proof || l || r ELSE proof END AS proof FROM {n}p{k} p JOIN {n}s{k} s ON p.g IS NOT DISTINCT FROM s.g AND p.i = s.i)")
    return ",\n".join([*parts, f"{n}top AS (SELECT g, h FROM {n}n{levels})", f"{n}proof AS (SELECT g, leaf_i AS i, bad, proof FROM {n}p{levels})"])


_OP11_LEAF = " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)"))
#: CRC-32 bit by bit: each character is followed by eight shifts, written as -1.
_OP11_CRC = "xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [CAST(ord(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"
OP11_SQL = f"""
WITH d AS (
  SELECT doc_id, source, sha256({_OP11_LEAF} || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256({_OP11_LEAF} || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS lowered, {_OP11_CRC} AS crc FROM documents
), a AS (
  SELECT doc_id, source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h, CASE WHEN crc % 5 = 0 THEN lowered ELSE leaf END AS bad FROM d
), {_op11_tree("a", "a")}, b AS (
  SELECT true AS g, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS i, g AS source, h, h AS bad FROM atop
), {_op11_tree("b", "b")}, u AS (
  SELECT b.source, b.i, b.h AS subroot, p.proof, (SELECT h FROM btop) AS root FROM b JOIN bproof p ON b.i = p.i
), f0 AS (
  SELECT a.doc_id, a.h AS leaf, u.subroot, u.root, p.proof || u.proof AS proof, p.bad AS acc, u.i AS i FROM a JOIN aproof p ON a.g IS NOT DISTINCT FROM p.g AND a.i = p.i JOIN u ON u.source IS NOT DISTINCT FROM a.g
), """ + ", ".join(f"f{k + 1} AS (SELECT f.doc_id, leaf, subroot, root, proof, CASE WHEN m > 1 THEN sha256(l || acc || r) ELSE acc END AS acc, f.i // 16 AS i FROM f{k} f JOIN bs{k} s ON f.i = s.i)" for k in range(6)) + """
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root AS verified FROM f6
"""


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, found = centroids.cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=16, rounds=3, dimensions=64, scale=64, salt="1:")
    return centroids.with_inertia(assigned, found).select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _op12_sql(rounds: int = 3) -> str:
    near = lambda c: f"SELECT e, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT v.e, c.k, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN {c} c ON v.i = c.i GROUP BY v.e, c.k) q GROUP BY e"
    parts = [
        "w AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS e, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS HUGEINT)) AS z FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "v AS (SELECT e, unnest(z) AS x, generate_subscripts(z, 1) AS i FROM w)",
        "c0 AS (SELECT k, unnest(z) AS x, generate_subscripts(z, 1) AS i FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, z) - 1 AS k, z FROM w) q WHERE k < 16)",
    ]
    for r in range(rounds):
        parts.append(f"a{r} AS ({near(f'c{r}')})")
        parts.append(f"m{r} AS (SELECT a.k, v.i, (sum(v.x) - ((sum(v.x) % count(*)) + count(*)) % count(*)) // count(*) AS x FROM a{r} a JOIN v USING (e) GROUP BY a.k, v.i)")
        parts.append(f"c{r + 1} AS (SELECT c.k, c.i, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON c.k = m.k AND c.i = m.i)")
    parts.append(f"f AS ({near(f'c{rounds}')})")
    parts.append(f"s AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS sha FROM c{rounds} GROUP BY k)")
    return "WITH " + ",\n".join(parts) + "\nSELECT w.vec_id, CAST(f.k AS INTEGER) AS cluster, CAST(f.d AS BIGINT) AS distance, CAST(sum(f.d) OVER (PARTITION BY f.k) AS BIGINT) AS cluster_inertia, CAST(sum(f.d) OVER () AS BIGINT) AS inertia, s.sha AS centroid_sha256 FROM f JOIN w USING (e) JOIN s ON s.k = f.k"


OP12_SQL = _op12_sql()


def op13_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), vocabulary("word_bpe_49k.json"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_url_language_model, op2_vantage_point_trees, op3_min_bin_slack, op4_sorted_projections, op5_weak_supervision, op6_secret_scan, op7_ngram_jaccard, op8_hypergeometric_shards, op9_line_dedup, op10_bpe, op11_merkle_manifest, op12_centroid_clustering, op13_nnls_packing)}


def oracle_sql() -> dict[str, str]:
    return {"op4_sorted_projections": OP4_SQL, "op7_ngram_jaccard": OP7_SQL, "op9_line_dedup": OP9_SQL, "op11_merkle_manifest": OP11_SQL, "op12_centroid_clustering": OP12_SQL}
