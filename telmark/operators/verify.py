"""Parity and lineage checks between layers and between warehouses; no fact reaches the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telmark import contracts as C


def content_conflicts(facts: DataFrame) -> DataFrame:
    """Fact ids that occur with two hashes."""
    return facts.groupBy("fact_id").agg(F.min("fact_hash").alias("a"), F.max("fact_hash").alias("b")).filter("a <> b").select("fact_id")


def fact_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """J5, G2. Fact ids that are missing in ``b``, unexpected there, or have another hash."""
    x = a.groupBy("fact_id").agg(F.min("fact_hash").alias("a_hash"))
    y = b.groupBy("fact_id").agg(F.min("fact_hash").alias("b_hash"))
    kind = F.when(F.col("b_hash").isNull(), "missing").when(F.col("a_hash").isNull(), "unexpected").when(F.col("a_hash") != F.col("b_hash"), "hash_mismatch")
    return x.join(y, "fact_id", "full_outer").withColumn("kind", kind).filter("kind IS NOT NULL").select("fact_id", "kind")


def missing_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """G2. Keys of ``a`` that ``b`` lacks, in order."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti").orderBy(key)


def catalog_equality(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """G3. One row: whether both hold the same set of keys."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    d = x.join(y, key, "left_anti").unionByName(y.join(x, key, "left_anti"))
    return d.agg((F.count("*") == 0).alias("equal"))


def relation_identity_parity(a: DataFrame, b: DataFrame, least: int = 0) -> DataFrame:
    """G5. One row: equal sets of relation ids, at least ``least``."""
    x, y = a.select("relation_id").distinct().withColumn("x", F.lit(1)), b.select("relation_id").distinct().withColumn("y", F.lit(1))
    j = x.join(y, "relation_id", "full_outer")
    return j.agg(F.count("*").alias("relations"), (F.coalesce(F.max((F.col("x").isNull() | F.col("y").isNull()).cast("int")), F.lit(0)) == 0).alias("same")).select("relations", (F.col("same") & (F.col("relations") >= least)).alias("passed"))


def relation_coverage(expected: DataFrame, relations: DataFrame) -> DataFrame:
    """J6. One row: expected fact ids, how many the relations give evidence for, and their share (1 if none is expected)."""
    e = expected.select("fact_id").distinct()
    seen = relations.select(F.explode("evidence_fact_ids").alias("fact_id")).distinct().withColumn("hit", F.lit(1))
    return e.join(seen, "fact_id", "left").agg(F.count("*").alias("expected_facts"), F.count("hit").alias("covered_facts")).withColumn("coverage", F.when(F.col("expected_facts") == 0, 1.0).otherwise(F.col("covered_facts") / F.col("expected_facts")))


def layer_lineage(landing: DataFrame, normalized: DataFrame, core: DataFrame) -> DataFrame:
    """J7. Records by what is wrong with them: missing in a later layer, orphaned, or with another hash."""
    name = lambda df, n: df.groupBy("source_record_id").agg(F.min("source_record_hash").alias(n))
    j = name(landing, "l").join(name(normalized, "n"), "source_record_id", "full_outer").join(name(core, "c"), "source_record_id", "full_outer")
    kind = (
        F.when(F.col("l").isNull(), "orphan").when(F.col("n").isNull(), "not_normalized").when(F.col("c").isNull(), "not_projected").when((F.col("l") != F.col("n")) | (F.col("n") != F.col("c")), "hash_differs").otherwise("complete")
    )
    return j.groupBy(kind.alias("lineage")).agg(F.count("*").alias("records"))


def shadow_parity(a: DataFrame, b: DataFrame, relations: DataFrame, expected: DataFrame, max_lag_ms: int, min_coverage: float) -> DataFrame:
    """V1. One row of counts, checks and a status. Raises ValueError for bad bounds.

    ``a`` and ``b`` have fact_id, fact_hash and projected_at. Each side is read once and both meet in one join. A
    fact with two contents fails the row with SMPP_FACT_CONTENT_CONFLICT when it is read.
    """
    if not isinstance(max_lag_ms, int) or max_lag_ms < 0 or not 0 <= min_coverage <= 1:
        raise ValueError("SMPP_PARITY_BOUND_INVALID")
    side = lambda df, n: df.groupBy("fact_id").agg(F.min("fact_hash").alias(f"{n}_hash"), F.max("fact_hash").alias(f"{n}_other"), F.max("projected_at").alias(f"{n}_at"))
    both = side(a, "a").join(side(b, "b"), "fact_id", "full_outer")
    missing, unexpected = F.col("b_hash").isNull(), F.col("a_hash").isNull()
    row = both.agg(
        F.count("a_hash").alias("a_count"), F.count("b_hash").alias("b_count"), F.max("a_at").alias("a_watermark"), F.max("b_at").alias("b_watermark"),
        F.count_if(missing).alias("missing"), F.count_if(unexpected).alias("unexpected"), F.count_if(F.col("a_hash") != F.col("b_hash")).alias("hash_mismatch"),
        F.count_if((F.col("a_hash") != F.col("a_other")) | (F.col("b_hash") != F.col("b_other"))).alias("torn"),
    )
    row = row.withColumn("a_count", F.when(F.col("torn") == 0, F.col("a_count")).otherwise(F.raise_error("SMPP_FACT_CONTENT_CONFLICT").cast("bigint"))).drop("torn")
    # Each part is one row, so the join on a constant is of single rows.
    key = lambda df: df.withColumn("one", F.lit(1))
    row = key(row).join(key(relation_coverage(expected, relations)), "one").drop("one")
    lag = F.greatest(F.lit(0), F.unix_millis("a_watermark") - F.unix_millis("b_watermark"))
    row = row.withColumn("watermark_lag_ms", F.when(F.col("a_watermark").isNotNull() & F.col("b_watermark").isNotNull(), lag))
    row = row.withColumns({
        "count_parity": F.col("a_count") == F.col("b_count"), "fact_hash_parity": (F.col("missing") + F.col("unexpected") + F.col("hash_mismatch")) == 0,
        "watermark_parity": F.coalesce(F.col("watermark_lag_ms") <= max_lag_ms, F.lit(False)), "relation_coverage_ok": F.col("coverage") >= min_coverage,
    })
    passed: Column = F.col("count_parity") & F.col("fact_hash_parity") & F.col("watermark_parity") & F.col("relation_coverage_ok")
    return row.withColumn("status", F.when(passed, "passed").otherwise("failed"))


def e2e_checks(parity: DataFrame, facts: DataFrame, relations_a: DataFrame, relations_b: DataFrame, core: DataFrame, least_relations: int = 48) -> DataFrame:
    """V2. One row of booleans over two warehouses: parity of counts, hashes, watermark and coverage, all record types, source, projection and relations."""
    key = lambda df: df.withColumn("one", F.lit(1))
    types = facts.agg((F.countDistinct(F.when(F.col("fact_type").isin(C.RECORD_TYPES), F.col("fact_type"))) == len(C.RECORD_TYPES)).alias("all_types"), (F.min("source_system").eqNullSafe(C.SOURCE_SYSTEM) & F.max("source_system").eqNullSafe(C.SOURCE_SYSTEM)).alias("source_release"))
    ids = core.agg((F.min("projection_id").eqNullSafe(C.CORE_PROJECTION_ID) & F.max("projection_id").eqNullSafe(C.CORE_PROJECTION_ID)).alias("projection_identity"))
    rel = relation_identity_parity(relations_a, relations_b, least_relations).select(F.col("passed").alias("relation_identity"))
    p = parity.select("count_parity", "fact_hash_parity", "watermark_parity", "relation_coverage_ok")
    return key(p).join(key(types), "one").join(key(ids), "one").join(key(rel), "one").drop("one")


def migration_consistency(landing: DataFrame, canonical: DataFrame, core: DataFrame, conflicts: DataFrame, dead_letters: DataFrame) -> DataFrame:
    """V3. Metrics to compare before and after a migration, one row each."""
    def metric(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.agg(value.cast("string").alias("value")).select(F.lit(name).alias("metric"), "value")

    out = metric(landing, "record_ids", F.countDistinct("source_record_id"))
    digest = F.sum(F.conv(F.substring("source_record_hash", 1, 8), 16, 10).cast("decimal(38,0)"))
    for df, name, value in (
        (landing, "record_hash_sum", digest), (landing, "min_occurred_at", F.min(F.unix_millis("occurred_at"))), (landing, "max_occurred_at", F.max(F.unix_millis("occurred_at"))),
        (conflicts, "conflicts", F.count("*")), (dead_letters, "not_normalizable", F.count("*")), (core, "core_facts", F.countDistinct("fact_id")), (canonical, "normalized_facts", F.countDistinct("fact_id")),
    ):
        out = out.unionByName(metric(df, name, value))
    by_type = landing.groupBy("record_type").agg(F.count("*").cast("string").alias("value")).select(F.concat(F.lit("records_"), "record_type").alias("metric"), "value")
    return out.unionByName(by_type)
