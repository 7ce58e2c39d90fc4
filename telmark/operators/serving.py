"""Serving aggregates and lookups over core, landing and quality tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telmark import contracts as C
from telmark.sources.tables import latest_by_version

# Search parameters and their columns.
EVENT_FILTERS = {
    "tenantId": "tenant_id", "projectId": "project_id", "providerId": "provider_id", "resourceId": "resource_id", "taskId": "task_id", "operationName": "operation_name",
    "runtimeInstanceId": "runtime_instance_id", "deploymentId": "deployment_id", "recordId": "source_record_id", "traceId": "trace_id", "externalExecutionId": "external_execution_id",
    "providerEventId": "provider_event_id", "recordType": "record_type", "eventCategory": "event_category", "deliveryClass": "delivery_class",
}


def final(df: DataFrame, table: str) -> DataFrame:
    """The table's rows as a reader of merged versions sees them."""
    keys, version = C.TABLE_KEYS[table]
    return latest_by_version(df, keys, version)


def provider_activity_summary(core: DataFrame) -> DataFrame:
    """A1."""
    return core.groupBy("tenant_id", "project_id", "provider_entity_urn", "fact_type").agg(F.count("*").alias("event_count"), F.min("occurred_at").alias("first_occurred_at"), F.max("occurred_at").alias("last_occurred_at"))


def _latest(core: DataFrame, urn: str) -> DataFrame:
    """Payload at the greatest (occurred_at, projected_at, fact_id) per URN: a partial maximum of small structs."""
    top = F.max_by("payload_json", F.struct("occurred_at", "projected_at", "fact_id"))
    return core.groupBy("tenant_id", "project_id", urn).agg(top.alias("payload_json"), F.max("occurred_at").alias("occurred_at"), F.max("projected_at").alias("data_watermark"))


def resource_current_state(resource_state: DataFrame) -> DataFrame:
    """A2."""
    return _latest(resource_state.filter("resource_entity_urn IS NOT NULL"), "resource_entity_urn")


def provider_current_health(resource_health: DataFrame) -> DataFrame:
    """A3."""
    return _latest(resource_health, "provider_entity_urn")


def projection_watermark(core: DataFrame) -> DataFrame:
    """A4, T7."""
    return core.groupBy("projection_id", "projection_version").agg(F.max("projected_at").alias("data_watermark"), F.count("*").alias("projected_facts"))


def data_quality(conflicts: DataFrame, dead_letters: DataFrame) -> DataFrame:
    """G1."""
    a = conflicts.select(F.lit("record_hash_conflict").alias("rule_id"), "tenant_id", "project_id", F.col("source_record_id").alias("subject_id"), F.col("received_at").alias("detected_at"), F.lit("critical").alias("severity"))
    b = dead_letters.select(F.lit("normalization_dead_letter").alias("rule_id"), F.lit("").alias("tenant_id"), F.lit("").alias("project_id"), F.col("source_record_id").alias("subject_id"), F.col("created_at").alias("detected_at"), F.lit("error").alias("severity"))
    return a.unionByName(b)


def data_quality_summary(conflicts: DataFrame, dead_letters: DataFrame) -> DataFrame:
    """A5."""
    return data_quality(conflicts, dead_letters).groupBy("rule_id", "severity").agg(F.count("*").alias("count"), F.max("detected_at").alias("last_detected_at")).orderBy("severity", "rule_id")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """A6."""
    return outcomes.groupBy("outcome", F.coalesce("error_code", F.lit("")).alias("reason")).agg(F.count("*").alias("records"))


def projection_outcome_counts(progress: DataFrame) -> DataFrame:
    """A7. Batches, failures and records by target from progress rows (target_id, failed, num_rows)."""
    return progress.groupBy("target_id").agg(F.sum((~F.col("failed")).cast("long")).alias("batches"), F.sum(F.col("failed").cast("long")).alias("failures"), F.sum("num_rows").alias("records"))


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """A8. Rows by layer, and whether all are equal."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        out = one if out is None else out.unionByName(one)
    # As many rows as layers, so one window over them is bounded.
    w = Window.partitionBy(F.lit(1))
    return out.withColumn("parity", F.min("row_count").over(w) == F.max("row_count").over(w))


def landing_profile(landing: DataFrame, approximate: bool = False) -> DataFrame:
    """A9. One row: rows, distinct records, duplicates, time bounds, lag in seconds."""
    distinct = F.approx_count_distinct("source_record_id") if approximate else F.countDistinct("source_record_id")
    one = landing.agg(F.count("*").alias("rows"), distinct.alias("unique_records"), F.min("occurred_at").alias("min_occurred_at"), F.max("occurred_at").alias("max_occurred_at"), F.max("ingested_at").alias("max_ingested_at"))
    return one.withColumn("duplicates", F.col("rows") - F.col("unique_records")).withColumn("lag_seconds", (F.unix_millis("max_ingested_at") - F.unix_millis("max_occurred_at")) / 1000.0)


def relation_confidence(relations: DataFrame) -> DataFrame:
    """A10."""
    return relations.select("confidence_class").distinct()


def batch_verdict(outcomes: DataFrame, request: str) -> DataFrame:
    """A11. Per request the gravest of its records' outcomes; no record stops another."""
    grade = F.when(F.col("outcome") == "retryable", 3).when(F.col("outcome").isin("conflict", "semantic_conflict"), 2).when(F.col("outcome") == "rejected", 1).otherwise(0)
    names = F.create_map(F.lit(3), F.lit("retryable"), F.lit(2), F.lit("conflict"), F.lit(1), F.lit("permanent"), F.lit(0), F.lit("ok"))
    return outcomes.groupBy(request).agg(F.max(grade).alias("g"), F.count("*").alias("records")).select(request, names[F.col("g")].alias("verdict"), "records")


def throughput_window(records: DataFrame, ts_col: str, seconds: int = 15, late: str | None = None) -> DataFrame:
    """A12. Records per second in windows; with ``late`` also fit for streams."""
    df = records.withWatermark(ts_col, late) if late else records
    g = df.groupBy(F.window(ts_col, f"{seconds} seconds").alias("w")).agg(F.count("*").alias("records"))
    return g.select(F.col("w.start").alias("window_start"), "records", (F.col("records") / F.lit(float(seconds))).alias("records_per_second"))


def entity_relation_degree(relations: DataFrame) -> DataFrame:
    """A13. Distinct relations and neighbours of each source and target."""
    a = relations.select(F.col("source_entity_urn").alias("entity_urn"), F.col("target_entity_urn").alias("other"), "relation_id", F.lit("out").alias("direction"))
    b = relations.select(F.col("target_entity_urn").alias("entity_urn"), F.col("source_entity_urn").alias("other"), "relation_id", F.lit("in").alias("direction"))
    return a.unionByName(b).groupBy("entity_urn", "direction").agg(F.countDistinct("relation_id").alias("relations"), F.countDistinct("other").alias("neighbours"))


def event_search(activity: DataFrame, filters: dict[str, str], start: datetime.datetime | None = None, end: datetime.datetime | None = None, limit: int = 100) -> DataFrame:
    """P14, L1. Latest events that fit all filters; a bad parameter raises ValueError('INVALID_<name>')."""
    for name, value in filters.items():
        if name not in EVENT_FILTERS or not isinstance(value, str) or not 1 <= len(value) <= 512:
            raise ValueError(f"INVALID_{name}")
    if not isinstance(limit, int) or not 1 <= limit <= 1000:
        raise ValueError("INVALID_limit")
    df = activity
    for name, value in filters.items():
        df = df.filter(F.col(EVENT_FILTERS[name]) == value)
    for bound, op in ((start, ">="), (end, "<=")):
        if bound is not None:
            df = df.filter((F.col("occurred_at") >= F.lit(bound)) if op == ">=" else (F.col("occurred_at") <= F.lit(bound)))
            if "month" in activity.columns:  # prunes partitions
                m = F.lit(bound.strftime("%Y%m"))
                df = df.filter((F.col("month") >= m) if op == ">=" else (F.col("month") <= m))
    return df.orderBy(F.col("occurred_at").desc(), F.col("source_record_id").desc()).limit(limit)


def topology(relations: DataFrame, tenant: str | None = None, limit: int | None = 5000) -> DataFrame:
    """P15, L3. Edges between the two systems, latest first."""
    a, b = F.col("source_system"), F.col("target_system")
    df = relations.filter(((a == C.ORIGIN_SYSTEM) & (b == C.SOURCE_SYSTEM)) | ((a == C.SOURCE_SYSTEM) & (b == C.ORIGIN_SYSTEM)))
    if tenant is not None:
        df = df.filter(F.col("tenant_id") == tenant)
    df = df.select("tenant_id", "project_id", "relation_id", "relation_type", "source_entity_urn", "target_entity_urn", "source_system", "target_system", "valid_from", "valid_to", "route_id", "attempt_no", "confidence_class", "evidence_fact_ids")
    return df if limit is None else df.orderBy(F.col("valid_from").desc(), "relation_id").limit(limit)


def task_timeline(task_lifecycle: DataFrame, urn: str, limit: int = 1000) -> DataFrame:
    """L2."""
    cols = ["tenant_id", "project_id", "task_entity_urn", "occurred_at", "fact_type", "operation_name", "payload_json", "source_system", "source_record_id", "fact_id", "projected_at"]
    return task_lifecycle.filter(F.col("task_entity_urn") == urn).select(*cols).orderBy("occurred_at", "fact_id").limit(limit)


def task_relations(relations: DataFrame, urn: str, limit: int = 1000) -> DataFrame:
    """J8."""
    return relations.filter((F.col("source_entity_urn") == urn) | (F.col("target_entity_urn") == urn)).orderBy("valid_from", "relation_id").limit(limit)


def record_lookup(canonical: DataFrame, system: str, record_id: str, limit: int = 10) -> DataFrame:
    """L4."""
    cols = ["fact_id", "fact_hash", "fact_type", "source_system", "source_record_id", "source_record_hash", "tenant_id", "project_id", "occurred_at", "payload_json", "correlation_json", "normalizer_id", "normalizer_version"]
    return canonical.filter((F.col("source_system") == system) & (F.col("source_record_id") == record_id)).select(*cols).orderBy("fact_id").limit(limit)


def provider_health(resource_health: DataFrame, urn: str) -> DataFrame:
    """L5."""
    return provider_current_health(resource_health).filter(F.col("provider_entity_urn") == urn).orderBy("tenant_id", "project_id").limit(1)


def resource_state(resource_state_: DataFrame, urn: str) -> DataFrame:
    """L5."""
    return resource_current_state(resource_state_).filter(F.col("resource_entity_urn") == urn).orderBy("tenant_id", "project_id").limit(1)


def projection_watermarks(core: DataFrame) -> DataFrame:
    """L6."""
    return projection_watermark(core).orderBy("projection_id", "projection_version")


def dashboard_activity(core: DataFrame, limit: int = 100) -> DataFrame:
    """L7."""
    return provider_activity_summary(core).orderBy(F.col("last_occurred_at").desc(), "tenant_id", "provider_entity_urn", "fact_type").limit(limit)


def dashboard_topology(relations: DataFrame, limit: int = 100) -> DataFrame:
    """L8."""
    return topology(relations, limit=limit)


def data_watermark(df: DataFrame, column: str) -> DataFrame:
    """T7. How fresh a result is: one row."""
    return df.agg(F.max(column).alias("data_watermark"))
