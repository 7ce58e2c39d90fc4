"""Tables on Parquet: versioned reads, month partitions, idempotent writes, retention, schema evolution, views."""

from __future__ import annotations

import datetime
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telmark.operators.project import Target
from telmark.sources.store import no_leftovers


def latest_by_version(df: DataFrame, keys: list[str], *versions: str) -> DataFrame:
    """W1. One row per key: the highest version, later columns breaking ties."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(v).desc() for v in versions])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def with_month(df: DataFrame, ts_col: str) -> DataFrame:
    """S9. Adds ``month`` (yyyyMM) to partition by."""
    return df.withColumn("month", F.date_format(ts_col, "yyyyMM"))


def month_bounds(ts_col: str, start: Column | None, end: Column | None) -> Column:
    """Predicate on ``ts_col`` with the months that it implies, so that partitions are pruned."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts_col) >= start) & (F.col("month") >= F.date_format(start, "yyyyMM"))
    if end is not None:
        cond = cond & (F.col(ts_col) <= end) & (F.col("month") <= F.date_format(end, "yyyyMM"))
    return cond


def write_layer(df: DataFrame, root: str, table: str, ts_col: str, batch_id: int | None = None, sort: list[str] | None = None) -> str:
    """S6. Writes rows by month. With ``batch_id`` a repeated batch replaces itself, so retries add nothing."""
    path = f"{root}/{table}" + ("" if batch_id is None else f"/batch_id={batch_id}")
    out = with_month(df, ts_col)
    # One task per month and hash of the row: files stay few, and a long month is not one task.
    if sort:
        out = out.sortWithinPartitions("month", *sort)
    with no_leftovers(df.sparkSession):
        out.write.mode("append" if batch_id is None else "overwrite").partitionBy("month").parquet(path)
    return path


def apply_retention(df: DataFrame, ts_col: str, days: int, now: Column) -> DataFrame:
    """S8. Rows not older than ``days``."""
    return df.filter(F.col(ts_col) + F.make_interval(days=F.lit(days)) > now)


def evolve_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """S10. The target's columns in its order; missing ones are null."""
    return df.select([(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target])


def raw_compat_view(landing: DataFrame) -> DataFrame:
    """S11. Landing rows under the earlier column names."""
    return landing.select(
        "tenant_id", "project_id", "environment", "mapping_version", F.col("source_record_id").alias("record_id"), F.col("source_record_hash").alias("record_hash"), "record_type", F.col("source_schema_name").alias("schema_name"),
        F.col("source_schema_version").alias("schema_version"), "provider_id", F.col("runtime_instance_id").alias("instance_id"), "task_id", "resource_id", "operation_name", "correlation_id", "occurred_at", "emitted_at", "received_at",
        "ingested_at", "attributes_json", "payload_json", "envelope_json", "arrival_seq", "ingest_version",
    )


ACTIVITY_COLUMNS = [
    "tenant_id", "project_id", "environment", "source_record_id", "source_record_hash", "record_type", "event_category", "delivery_class", "provider_id", "runtime_version", "runtime_instance_id",
    "deployment_id", "task_id", "resource_id", "resource_type", "external_execution_id", "operation_name", "provider_event_id", "provider_event_sequence", "event_type", "execution_mode", "simulation_id",
    "adapter_revision", "observation_revision", "command_sequence", "correlation_id", "trace_id", "span_id", "occurred_at", "emitted_at", "received_at", "ingested_at",
]


def provider_ops_activity(landing: DataFrame) -> DataFrame:
    """S12."""
    return landing.select(*ACTIVITY_COLUMNS)


# Meta tables, their columns and keys.
META_TABLES = {
    "source_mapping": ("mapping_version int, policy_version int, collector_id string, trust_domain string, deployment_id string, provider_id string, instance_id string, tenant_id string, project_id string, environment string, source_product string, projection_route_ids array<string>, status string, valid_from timestamp, valid_to timestamp, created_at timestamp", "collector_id deployment_id provider_id instance_id mapping_version", "created_at"),
    "schema_definition": ("schema_name string, schema_version string, compatibility_mode string, status string, schema_hash string, json_schema string, valid_from timestamp, valid_to timestamp, created_at timestamp", "schema_name schema_version", "created_at"),
    "normalizer_definition": ("normalizer_id string, normalizer_version int, source_system string, source_schema_name string, source_schema_range string, target_envelope_version string, status string, created_at timestamp", "normalizer_id normalizer_version", "created_at"),
    "projection_definition": ("projection_id string, projection_version int, accepted_fact_types array<string>, target_models array<string>, status string, created_at timestamp", "projection_id projection_version", "created_at"),
    "projection_target": ("target_id string, target_type string, endpoint_ref string, database_mapping_json string, write_mode string, status string, valid_from timestamp, valid_to timestamp, created_at timestamp", "target_id", "created_at"),
    "projection_route": ("route_id string, source_system string, fact_type string, tenant_scope string, project_scope string, relation_selector string, target_id string, fanout_mode string, projection_set array<string>, valid_from timestamp, valid_to timestamp, created_at timestamp", "route_id target_id", "created_at"),
    "projection_checkpoint": ("target_id string, checkpoint_name string, arrival_seq bigint, updated_at timestamp", "target_id checkpoint_name", "updated_at"),
    "projection_dead_letter": ("dlq_id string, target_id string, fact_id string, source_record_id string, error_code string, error_summary string, payload_summary string, created_at timestamp, resolved_at timestamp", "dlq_id", "created_at"),
    "replay_job": ("job_id string, scope_json string, normalizer_version int, projection_id string, projection_version int, target_ids array<string>, status string, created_at timestamp, started_at timestamp, completed_at timestamp, result_json string", "job_id", "created_at"),
}


def meta_table(spark: SparkSession, name: str, rows: list | DataFrame | None = None) -> DataFrame:
    """S13. The current rows of a meta table, the latest of each key."""
    schema, keys, version = META_TABLES[name]
    df = rows if isinstance(rows, DataFrame) else spark.createDataFrame(rows or [], schema)
    return latest_by_version(df, keys.split(), version)


def load_targets(path: str) -> list[Target]:
    """S5. Enabled targets of a configuration file (small, read on the driver)."""
    with open(path) as f:
        data = json.load(f)
    if not isinstance(data.get("targets"), list):
        raise ValueError("PROJECTION_TARGETS_INVALID")
    made = [Target(t["targetId"], t.get("targetType", "standalone"), bool(t.get("enabled")), bool(t.get("required")), bool(t.get("acceptAllMappings")), list(t.get("routeIds") or []), list(t.get("writeLayers") or []), dict(t.get("tableMap") or {})) for t in data["targets"]]
    return [t for t in made if t.enabled]


def pending(records: DataFrame, checkpoint: int, limit: int = 200) -> DataFrame:
    """L9. The next records after a checkpoint in arrival order."""
    return records.filter(F.col("arrival_seq") > checkpoint).orderBy("arrival_seq").limit(limit)


def cutoff(now: datetime.datetime, days: int) -> datetime.datetime:
    """The oldest time that retention keeps; months before its month can be dropped whole."""
    return now - datetime.timedelta(days=days)
