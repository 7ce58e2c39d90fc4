"""Operator 1: URL filters. Rules first; for the rest a character language-model ratio.

URLs that a rule decides are the training text of two smoothed variable-order Markov models,
one of accepted and one of rejected URLs (Witten-Bell interpolation from order 3 down to a
uniform law; a context that was never seen falls back to the next shorter one). A URL's score
is its log-likelihood difference per character. The cut is calibrated on the decided URLs
themselves, each scored by models trained on the other half (halves by a hash of the host), as
the score with the least balanced error. The final models use all decided URLs.

All of it is DataFrame expressions. The n-gram table is a shuffle aggregation that grows with
the corpus; n-grams that nearly every URL has are pre-aggregated for the counts, and adaptive
execution splits them in the scoring join. The driver sees a histogram of 512 rows.

The models read all of a URL that follows ``://``, query and fragment included, with the host's A-Z lower-cased, and the whole of a URL
without ``://``.

Defined results: null URLs and URLs without ``://`` have empty host and path, and no rule fits
them; a null URL is read as an empty one, which is its end mark alone. With no accepted or no rejected training URL, undecided URLs
get the class that has some, or ``allow`` if neither has. Repeated rows are judged each, null page_ids stay null, very long URLs are
read whole. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telmark.llm.shared import durable

ORDER = 3
ALPHABET = 256
BINS = 256
SPAN = 4.0
VARIANTS = [f"{c}{v}" for c in "ab" for v in ("all", "0", "1")]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty without ``://``."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.when(has, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def model_text(url: Column, host: Column) -> Column:
    """What the models read of a URL."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    after = F.substring(url, F.instr(url, "://") + 3 + F.length(host), F.length(url))
    return F.coalesce(F.when(has, F.concat(host, after)).otherwise(url), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule ``(verdict, host, path)`` as text, and its verdict; nulls where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _grams(df: DataFrame) -> DataFrame:
    """One row per character: the character with its ORDER predecessors."""
    s = F.concat(F.lit("\u0002" * ORDER), F.col("text"), F.lit("\u0003"))
    at = F.explode(F.sequence(F.lit(1), F.length("text") + 1))
    return df.withColumn("s", s).select("*", at.alias("i")).withColumn("gram", F.substring(F.col("s"), F.col("i"), F.lit(ORDER + 1))).drop("s", "i", "text")


def log_ratios(counts: DataFrame) -> DataFrame:
    """``(gram, dall, d0, d1)`` from n-gram counts of both classes and halves; d0 is trained without half 0."""
    n = [f"n{v}" for v in VARIANTS]
    lower: DataFrame | None = None
    for k in range(ORDER + 1):
        suffix = F.substring("gram", ORDER - k + 1, k + 1)
        own = counts.groupBy(suffix.alias("gram_k")).agg(*[F.sum(x).alias(x) for x in n])
        own = own.withColumn("context", F.substring("gram_k", 1, k))
        heads = own.groupBy("context").agg(*[F.sum(x).alias("N" + x) for x in n], *[F.sum((F.col(x) > 0).cast("long")).alias("T" + x) for x in n])
        j = own.join(heads, "context")
        if lower is None:
            below = {x: F.lit(1.0 / ALPHABET) for x in n}
        else:
            j = j.withColumn("shorter", F.substring("gram_k", 2, k)).join(lower, "shorter")
            below = {x: F.col("p" + x) for x in n}
        p = lambda x: F.when(F.col("N" + x) > 0, (F.col(x) + F.col("T" + x) * below[x]) / (F.col("N" + x) + F.col("T" + x))).otherwise(below[x])  # noqa: B023, E731
        lower = j.select(F.col("gram_k").alias("shorter"), *[p(x).alias("p" + x) for x in n])
    # Variant "0" was counted on half 1 and judges half 0.
    return lower.select(F.col("shorter").alias("gram"), *[(F.log("pna" + v) - F.log("pnb" + v)).alias("d" + v) for v in ("all", "0", "1")])


def judge(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` of every row."""
    host, path = host_path(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", rule).withColumn("decided", verdict).withColumn("row", F.xxhash64("page_id", "url"))
    half = F.pmod(F.xxhash64("host"), F.lit(2)).cast("int")
    grams = _grams(rows.select("row", "decided", half.alias("half"), model_text(F.col("url"), F.col("host")).alias("text")))
    is_a, is_b = F.col("decided").eqNullSafe("allow"), F.col("decided").eqNullSafe("block")
    one = lambda c: F.sum(c.cast("long"))
    counts = durable(grams.groupBy("gram").agg(
        *[one(c).alias(f"n{k}all") for k, c in (("a", is_a), ("b", is_b))],
        *[one(c & (F.col("half") == 1 - h)).alias(f"n{k}{h}") for k, c in (("a", is_a), ("b", is_b)) for h in (0, 1)],
    ))
    per_gram = grams.join(log_ratios(counts), "gram")
    # Repeated rows share one key, so their sum counts them all alike and the mean is unchanged.
    scores = per_gram.groupBy("row").agg(F.round(F.avg("dall"), 9).alias("score"), F.round(F.avg(F.when(F.col("half") == 0, F.col("d0")).otherwise(F.col("d1"))), 9).alias("crossed"), F.first("decided").alias("decided"))
    scores = durable(scores)
    cut, default = _calibrate(scores)
    chosen = F.when(F.col("score") >= F.lit(cut), "allow").otherwise("block") if default is None else F.lit(default)
    return rows.join(scores.select("row", "score"), "row", "left").select("page_id", "host", "path", "rule", F.coalesce("decided", chosen).alias("verdict"), "score")


def _calibrate(scores: DataFrame) -> tuple[float, str | None]:
    """The cut with the least balanced error, or the verdict for all where a class is missing."""
    b = F.least(F.greatest(F.floor((F.col("crossed") + SPAN) / (2 * SPAN) * BINS), F.lit(0)), F.lit(BINS - 1)).cast("int")
    seen = scores.filter("decided IS NOT NULL").groupBy("decided", b.alias("bin")).agg(F.count("*").alias("n")).collect()
    table = {k: [0] * BINS for k in ("allow", "block")}
    for r in seen:
        table[r["decided"]][r["bin"]] = r["n"]
    a, z = sum(table["allow"]), sum(table["block"])
    if not a or not z:
        return 0.0, "block" if z else "allow"
    wrong, best = [], None
    under_a = under_b = 0
    for i in range(BINS + 1):
        wrong.append(under_a / a + (z - under_b) / z)
        if i < BINS:
            under_a += table["allow"][i]
            under_b += table["block"][i]
    best = min(wrong)
    at = [i for i, w in enumerate(wrong) if w <= best + 1e-12]
    return (at[0] + at[-1]) / 2 / BINS * 2 * SPAN - SPAN, None
