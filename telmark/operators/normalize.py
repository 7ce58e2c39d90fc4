"""Accepted records to canonical facts with entity references and relations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telmark import contracts as C
from telmark.functions import scalars as S


def source_payload(df: DataFrame) -> Column:
    """N2. JSON of attributes, payload and the lineage fields that are present, by their source keys."""
    by_key = {k: c for c, k in C.ENVELOPE_FIELDS}
    fields = [F.try_parse_json(F.coalesce(F.col("attributes_json"), F.lit("{}"))).alias("attributes"), F.try_parse_json(F.coalesce(F.col("payload_json"), F.lit("null"))).alias("payload")]
    fields += [F.col(by_key[k]).alias(k) for k in C.LINEAGE_KEYS if by_key[k] in df.columns]
    return F.to_json(F.struct(*fields))


def entity_refs(tenant: Column, deployment: Column) -> Column:
    """N3. References to runtime, provider, task, resource and execution, in that order, without empty ids."""
    pairs = [("runtime", "instance_id"), ("provider", "provider_id"), ("task", "task_id"), ("resource", "resource_id"), ("execution", "external_execution_id")]
    refs = F.array(*[F.struct(F.lit(k).alias("entity_type"), F.coalesce(F.col(c), F.lit("")).alias("local_id"), S.entity_urn(tenant, F.lit(C.SOURCE_SYSTEM), deployment, F.lit(k), F.col(c)).alias("urn")) for k, c in pairs])
    return F.filter(refs, lambda r: r["local_id"] != "")


def derive_relations() -> Column:
    """N4, N5. Edges from declared origin ids to the fact's task, provider or both; an array of structs.

    Origin tasks invoke and origin invocations delegate to the task (else the provider); origin
    runtimes are served by the provider (else the task).
    """
    corr = F.col("correlation")
    task, provider = S.first_ref(F.col("entity_refs"), "task", "urn"), S.first_ref(F.col("entity_refs"), "provider", "urn")

    def source(kind: str, relation: str, to: str) -> Callable[[Column], Column]:
        return lambda i: F.struct(S.entity_urn(F.col("tenant_id"), F.lit(C.ORIGIN_SYSTEM), corr["origin_deployment_id"], F.lit(kind), i).alias("source"), F.lit(relation).alias("relation"), F.lit(to).alias("to"))

    def edge(x: Column, ends: Column) -> Column:
        target = F.when(x["to"] == "local", F.coalesce(ends["task"], ends["provider"])).otherwise(F.coalesce(ends["provider"], ends["task"]))
        return F.struct(
            S.relation_id(F.col("fact_id"), x["source"], target, x["relation"]).alias("relation_id"), x["relation"].alias("relation_type"), F.lit(1).alias("relation_version"),
            F.col("tenant_id").alias("tenant_id"), F.col("project_id").alias("project_id"), x["source"].alias("source_entity_urn"), target.alias("target_entity_urn"),
            F.lit(C.ORIGIN_SYSTEM).alias("source_system"), F.lit(C.SOURCE_SYSTEM).alias("target_system"), F.col("occurred_at").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"),
            corr["correlation_id"].alias("correlation_id"), corr["trace_id"].alias("trace_id"), F.col("fact_id").alias("causation_fact_id"), corr["route_id"].alias("route_id"),
            corr["attempt_no"].try_cast("int").alias("attempt_no"), F.array(F.col("fact_id")).alias("evidence_fact_ids"), F.lit("provider_correlation_metadata").alias("binding_source"),
            F.lit("traced").alias("confidence_class"), F.col("source_record_id").alias("source_record_id"), F.col("source_record_hash").alias("source_record_hash"),
            F.col("received_at").alias("created_at"), F.lit(C.RELATION_PROJECTION_ID).alias("projection_id"), F.lit(C.RELATION_PROJECTION_VERSION).alias("projection_version"),
        )

    sources = F.concat(
        F.transform(corr["origin_task_ids"], source("task", "invokes", "local")), F.transform(corr["origin_invocation_ids"], source("invocation", "delegates_to", "local")), F.transform(corr["origin_runtime_ids"], source("runtime", "served_by", "provider"))
    )
    # Records of other origins have no edges, and their ids are not looked at.
    wanted = F.when(corr["origin_system"].eqNullSafe(C.ORIGIN_SYSTEM) & F.coalesce(task, provider).isNotNull(), sources).otherwise(F.filter(sources, lambda _: F.lit(False)))
    return S.let(F.struct(task.alias("task"), provider.alias("provider")), lambda ends: F.transform(wanted, lambda x: edge(x, ends)))


def normalize(accepted: DataFrame, now: Column) -> DataFrame:
    """N1. Canonical facts of accepted records (envelope columns, ``mapping``, ``context`` or ``deployment_id``, ``correlation``).

    ``now`` is the time of normalization. A fact's hash covers all but that time.
    """
    deployment = F.col("context.deployment_id") if "context" in accepted.columns else F.col("deployment_id")
    m = F.col("mapping")
    text = lambda name, fallback: F.col(name) if name in accepted.columns else fallback
    quality = F.struct(text("quality_status", F.lit("unknown")).alias("status"), text("reason_codes", F.array().cast("array<string>")).alias("reason_codes"))
    facts = accepted.select(
        S.fact_id(F.col("record_id"), F.col("record_type")).alias("fact_id"), F.col("record_type").alias("fact_type"), F.lit("1.0.0").alias("fact_version"), F.lit(C.SOURCE_SYSTEM).alias("source_system"),
        m["source_product"].alias("source_product"), F.col("record_id").alias("source_record_id"), F.col("record_hash").alias("source_record_hash"), F.col("schema_name").alias("source_schema_name"), F.col("schema_version").alias("source_schema_version"),
        m["tenant_id"].alias("tenant_id"), m["project_id"].alias("project_id"), m["environment"].alias("environment"),
        F.struct(m["smpp_source_id"].alias("smpp_source_id"), deployment.alias("deployment_id"), F.col("instance_id").alias("runtime_instance_id"), F.col("provider_id").alias("provider_id"), text("runtime_version", F.lit(None).cast("string")).alias("runtime_version")).alias("source_instance"),
        S.entity_urn(m["tenant_id"], F.lit(C.SOURCE_SYSTEM), deployment, F.lit("runtime"), F.col("instance_id")).alias("source_instance_urn"),
        entity_refs(m["tenant_id"], deployment).alias("entity_refs"), "correlation", "occurred_at", F.col("emitted_at").alias("observed_at"), "received_at",
        source_payload(accepted).alias("payload_json"), F.col("payload_json").alias("raw_payload_json"), text("external_execution_id", F.lit(None).cast("string")).alias("external_execution_id"),
        text("provider_event_id", F.lit(None).cast("string")).alias("provider_event_id"), text("operation_name", F.lit(None).cast("string")).alias("operation_name"), text("observation_revision", F.lit(None).cast("bigint")).alias("observation_revision"),
        F.struct(F.lit(C.NORMALIZER_ID).alias("normalizer_id"), F.lit(C.NORMALIZER_VERSION).alias("normalizer_version"), m["mapping_version"].alias("mapping_version"), m["policy_version"].alias("policy_version"), quality.alias("provider_quality")).alias("provenance"),
        *[c for c in ("arrival_seq",) if c in accepted.columns],
    )
    facts = facts.withColumn("relations", derive_relations())
    hashed = [c for c in facts.columns if c not in ("raw_payload_json", "arrival_seq")]
    return facts.withColumn("fact_hash", S.fact_hash(F.struct(*hashed), facts.select(hashed).schema)).withColumn("normalized_at", now)


def entity_ref_rows(facts: DataFrame) -> DataFrame:
    """N3 as a table: one row per fact and reference."""
    return facts.select("fact_id", "tenant_id", "project_id", F.explode("entity_refs").alias("r"), "normalized_at").select("fact_id", "tenant_id", "project_id", F.col("r.entity_type").alias("entity_type"), F.col("r.urn").alias("entity_urn"), F.col("r.local_id").alias("local_id"), F.col("normalized_at").alias("created_at"))


def dead_letters(df: DataFrame, error: Column, now: Column) -> tuple[DataFrame, DataFrame]:
    """N11. Rows without an error, and dead-letter rows of the others."""
    marked = df.withColumn("_error", error)
    bad = marked.filter("_error IS NOT NULL").select(
        S.uuid_v5(F.concat_ws("|", F.lit("dlq"), F.col("source_record_id"), F.col("_error"))).alias("dlq_id"), F.lit(C.SOURCE_SYSTEM).alias("source_system"), "source_record_id", F.lit(C.NORMALIZER_ID).alias("normalizer_id"),
        F.col("_error").alias("error_code"), F.substring("_error", 1, 256).alias("error_summary"), now.alias("created_at"), F.lit(None).cast("timestamp").alias("resolved_at"),
    )
    return marked.filter("_error IS NULL").drop("_error"), bad


def unknown_schema(records: DataFrame, now: Column) -> DataFrame:
    """Dead letters of records that no normalizer takes."""
    code = F.lit("SCHEMA_VERSION_UNSUPPORTED")
    return records.select(
        S.uuid_v5(F.concat_ws("|", F.lit("dlq"), F.col("record_id"), code)).alias("dlq_id"), F.lit(C.SOURCE_SYSTEM).alias("source_system"), F.col("record_id").alias("source_record_id"), F.lit(C.NORMALIZER_ID).alias("normalizer_id"),
        code.alias("error_code"), F.concat_ws(" ", "schema_name", "schema_version").substr(1, 256).alias("error_summary"), now.alias("created_at"), F.lit(None).cast("timestamp").alias("resolved_at"),
    )
