"""Projections of canonical facts to landing, normalized, core and shared-warehouse rows, and routing to targets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telmark import contracts as C
from telmark.functions import scalars as S


def _maybe(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def landing_rows(accepted: DataFrame, now: Column) -> DataFrame:
    """P16. Landing rows; their trace and correlation fall back in another order than the facts' do."""
    m = F.col("mapping")
    attr = lambda path: F.get_json_object("attributes_json", path)
    deployment = F.col("context.deployment_id") if "context" in accepted.columns else F.col("deployment_id")
    collector = F.col("context.collector_id") if "context" in accepted.columns else _maybe(accepted, "collector_id")
    g = lambda name, kind="string": _maybe(accepted, name, kind).alias(name)
    return accepted.select(
        m["tenant_id"].alias("tenant_id"), m["project_id"].alias("project_id"), m["environment"].alias("environment"), m["mapping_version"].alias("mapping_version"), m["policy_version"].alias("policy_version"),
        F.lit(C.SOURCE_SYSTEM).alias("source_system"), m["source_product"].alias("source_product"), F.col("record_id").alias("source_record_id"), F.col("record_hash").alias("source_record_hash"),
        F.col("schema_name").alias("source_schema_name"), F.col("schema_version").alias("source_schema_version"), "record_type", "event_category", "delivery_class",
        F.coalesce(_maybe(accepted, "priority"), F.lit("P2")).alias("priority"), g("runtime_version"), F.col("instance_id").alias("runtime_instance_id"), deployment.alias("deployment_id"), collector.alias("collector_id"),
        "provider_id", F.col("instance_id").alias("provider_instance_id"), "task_id", "resource_id", g("resource_type"), "external_execution_id", g("operation_name"), "provider_event_id", "provider_event_sequence",
        g("event_type"), g("execution_mode"), g("simulation_id"), g("adapter_revision"), g("observation_revision", "bigint"), g("command_sequence", "bigint"),
        F.coalesce(_maybe(accepted, "correlation_id"), attr("$.correlationId")).alias("correlation_id"), F.coalesce(_maybe(accepted, "causation_record_id"), attr("$.causationRecordId")).alias("causation_record_id"),
        F.coalesce("trace_id", attr("$.traceId"), attr("$.correlation.traceId")).alias("trace_id"), F.coalesce(_maybe(accepted, "span_id"), attr("$.spanId"), attr("$.correlation.spanId")).alias("span_id"),
        "occurred_at", "emitted_at", "received_at", now.alias("ingested_at"), F.coalesce("attributes_json", F.lit("{}")).alias("attributes_json"), F.coalesce("payload_json", F.lit("null")).alias("payload_json"),
        g("envelope_json"), g("arrival_seq", "bigint"), F.unix_millis(now).alias("ingest_version"),
        # What replay needs besides the envelope, so that facts get the hashes they had.
        m["smpp_source_id"].alias("smpp_source_id"), F.coalesce(_maybe(accepted, "quality_status"), F.lit("unknown")).alias("quality_status"),
        F.coalesce(_maybe(accepted, "reason_codes", "array<string>"), F.array().cast("array<string>")).alias("reason_codes"),
    )


def canonical_rows(facts: DataFrame) -> DataFrame:
    """P17. Canonical facts with their nested parts as JSON."""
    js = lambda c: F.to_json(F.col(c), {"ignoreNullFields": "false"}).alias(f"{c}_json")
    flat = ["fact_id", "fact_hash", "fact_type", "fact_version", "source_system", "source_product", "source_record_id", "source_record_hash", "source_schema_name", "source_schema_version", "tenant_id", "project_id", "environment", "source_instance_urn", "occurred_at", "received_at", "normalized_at"]
    p = F.col("provenance")
    return facts.select(*flat, js("entity_refs"), js("relations"), js("correlation"), "payload_json", *[p[x].alias(x) for x in ("normalizer_id", "normalizer_version", "mapping_version", "policy_version")])


def conflict_rows(conflicts: DataFrame) -> DataFrame:
    """P18."""
    m = F.col("mapping")
    summary = F.coalesce(_maybe(conflicts, "blocking_code"), F.lit("record hash differs"))
    return conflicts.select(
        m["tenant_id"].alias("tenant_id"), m["project_id"].alias("project_id"), m["environment"].alias("environment"), m["mapping_version"].alias("mapping_version"), F.col("record_id").alias("source_record_id"),
        F.col("accepted_hash").alias("accepted_record_hash"), F.col("record_hash").alias("conflicting_record_hash"), "provider_id", "record_type", "occurred_at", "received_at", summary.alias("conflict_summary"), "arrival_seq",
    )


def rejected_rows(rejected: DataFrame, hint: Column) -> DataFrame:
    """P18. Summary rows of rejected records: no content beyond the safe hint."""
    collector = F.col("context.collector_id") if "context" in rejected.columns else _maybe(rejected, "collector_id")
    return rejected.select(S.uuid_v5(F.concat_ws("|", F.lit("rejected"), F.col("arrival_seq").cast("string"), F.col("error_code"))).alias("rejection_id"), collector.alias("collector_id"), hint.alias("source_hint"), "error_code", F.substring(F.coalesce("error_message", "error_code"), 1, 256).alias("error_summary"), "received_at")


def core_rows(facts: DataFrame, now: Column) -> DataFrame:
    """N6. One wide core row per fact with ``core_table``, its specialised table (null if none)."""
    refs, corr, p = F.col("entity_refs"), F.col("correlation"), F.col("provenance")
    return facts.select(
        "fact_id", "fact_hash", "fact_type", "source_system", "source_product", "source_record_id", "source_record_hash", "tenant_id", "project_id", "environment",
        S.primary_entity_urn(refs, F.col("source_instance_urn")).alias("primary_entity_urn"), F.coalesce(S.first_ref(refs, "provider", "urn"), F.lit("")).alias("provider_entity_urn"),
        S.first_ref(refs, "task", "urn").alias("task_entity_urn"), S.first_ref(refs, "resource", "urn").alias("resource_entity_urn"), F.col("source_instance.runtime_instance_id").alias("runtime_instance_id"),
        F.col("source_instance.deployment_id").alias("deployment_id"), "external_execution_id", "provider_event_id", corr["trace_id"].alias("trace_id"), corr["span_id"].alias("span_id"), "operation_name", "occurred_at", "payload_json",
        F.to_json(corr, {"ignoreNullFields": "false"}).alias("correlation_json"), "source_schema_name", "source_schema_version", p["normalizer_id"].alias("normalizer_id"), p["normalizer_version"].alias("normalizer_version"),
        F.lit(C.CORE_PROJECTION_ID).alias("projection_id"), F.lit(C.CORE_PROJECTION_VERSION).alias("projection_version"), now.alias("projected_at"), S.core_table_of(F.col("fact_type")).alias("core_table"),
    )


def project_core(facts: DataFrame, now: Column) -> dict[str, DataFrame]:
    """N6. ``provider_operation_fact`` with all facts, and each specialised table."""
    rows = core_rows(facts, now)
    out = {"provider_operation_fact": rows.drop("core_table")}
    for t in sorted(set(C.CORE_TABLE_OF.values())):
        out[t] = rows.filter(F.col("core_table") == t).drop("core_table")
    return out


RELATION_COLUMNS = [
    "relation_id", "relation_type", "relation_version", "tenant_id", "project_id", "source_entity_urn", "target_entity_urn", "source_system", "target_system", "valid_from", "valid_to",
    "correlation_id", "trace_id", "causation_fact_id", "route_id", "attempt_no", "evidence_fact_ids", "binding_source", "confidence_class", "created_at", "projection_id", "projection_version",
]


def project_core_relations(facts: DataFrame) -> DataFrame:
    """N7. One row per relation."""
    return facts.select(F.explode("relations").alias("r")).select(*[F.col(f"r.{c}").alias(c) for c in RELATION_COLUMNS])


def shared_error(facts: DataFrame) -> Column:
    """Why a fact cannot go to the shared warehouse; null if it can."""
    source = F.col("source_instance.smpp_source_id")
    return F.when((F.coalesce(F.length(source), F.lit(0)) == 0) | ~F.col("provenance.mapping_version").eqNullSafe(4), "SMPP_SOURCE_MAPPING_ID_MISSING").otherwise(S.payload_semantics(F.col("fact_type"), F.col("raw_payload_json"))["error_code"])


def relation_error(facts: DataFrame) -> Column:
    """The code if a relation of the fact has a URN that is not canonical; null if none has."""
    bad = F.exists("relations", lambda r: S.parse_urn(r["source_entity_urn"]).isNull() | S.parse_urn(r["target_entity_urn"]).isNull())
    return F.when(F.coalesce(bad, F.lit(False)), F.lit("SMPP_RELATION_URN_INVALID"))


def project_shared_provider(facts: DataFrame, now: Column) -> DataFrame:
    """N8. Typed rows of the shared warehouse; facts with a ``shared_error`` must be diverted before."""
    f = facts.withColumn("s", S.payload_semantics(F.col("fact_type"), F.col("raw_payload_json")))
    s, corr, p, refs = F.col("s"), F.col("correlation"), F.col("provenance"), F.col("entity_refs")
    text = lambda c: F.coalesce(c, F.lit(""))
    sdar = corr["origin_system"].eqNullSafe(C.ORIGIN_SYSTEM)
    ids = lambda n: F.when(sdar, corr[n]).otherwise(F.array().cast("array<string>"))
    revision = F.when(F.length(text(s["provider_revision"])) > 0, s["provider_revision"]).otherwise(text(F.col("observation_revision").cast("string")))
    runtime = F.when(F.length(text(s["runtime_revision"])) > 0, s["runtime_revision"]).otherwise(text(F.col("source_instance.runtime_version")))
    provenance = F.to_json(F.struct(F.lit(4).alias("mappingVersion"), p["normalizer_id"].alias("normalizerId"), p["normalizer_version"].alias("normalizerVersion"), F.lit("smpp.providerops-payload-catalog/v1.1").alias("payloadCatalog"), p["policy_version"].alias("policyVersion"), F.lit(False).alias("providerTerminalIsGoalSuccess"), F.lit("SdarSharedWarehouseProjectionV1").alias("targetAdapter"), s["terminal_status"].alias("terminalStatus")), {"ignoreNullFields": "false"})
    return f.select(
        "tenant_id", "project_id", "environment", F.col("source_instance.smpp_source_id").alias("smpp_source_id"), F.col("source_instance.deployment_id").alias("source_deployment_id"), F.col("source_instance.runtime_instance_id").alias("source_runtime_instance_id"),
        "fact_id", "fact_hash", "fact_type", "fact_version", "source_system", "source_product", "source_record_id", "source_record_hash", "source_schema_name", "source_schema_version",
        S.local_id(refs, "provider").alias("provider_id"), F.col("source_instance.runtime_instance_id").alias("provider_instance_id"), S.local_id(refs, "resource").alias("resource_id"), S.local_id(refs, "task").alias("external_task_id"), S.local_id(refs, "execution").alias("external_execution_id"),
        text(s["external_command_id"]).alias("external_command_id"), text(F.col("operation_name")).alias("operation_name"), text(s["lifecycle_status"]).alias("lifecycle_status"), text(s["provider_substate"]).alias("provider_substate"), text(s["reason_code"]).alias("reason_code"),
        runtime.alias("runtime_revision"), revision.alias("provider_revision"), s["progress_percent"].alias("progress_percent"), text(corr["correlation_id"]).alias("correlation_id"), text(corr["causation_record_id"]).alias("causation_record_id"), text(corr["trace_id"]).alias("trace_id"), text(corr["span_id"]).alias("span_id"),
        ids("origin_runtime_ids").alias("origin_sdar_runtime_ids"), ids("origin_task_ids").alias("origin_sdar_task_ids"), ids("origin_invocation_ids").alias("origin_sdar_invocation_ids"),
        S.canonical_json_native(F.to_json("entity_refs")).alias("entity_refs_json"), S.canonical_json_native(F.col("payload_json")).alias("payload_json"), S.canonical_json_native(provenance).alias("provenance_json"),
        "occurred_at", F.coalesce(F.try_to_timestamp(s["observed_at"]), F.col("observed_at"), F.col("occurred_at")).alias("observed_at"), "received_at", "normalized_at", now.alias("projected_at"),
        p["normalizer_id"].alias("normalizer_id"), p["normalizer_version"].alias("normalizer_version"), F.lit(4).alias("mapping_version"), p["policy_version"].alias("policy_version"), F.lit(C.SHARED_PROJECTION_ID).alias("projection_id"), F.lit(C.SHARED_PROJECTION_VERSION).alias("projection_version"),
    )


def project_shared_relations(facts: DataFrame, now: Column) -> DataFrame:
    """N9. Relations with their URNs parsed; facts with a ``relation_error`` must be diverted before; their rows are left out."""
    r = facts.select("environment", F.col("source_instance.smpp_source_id").alias("smpp_source_id"), F.explode("relations").alias("r")).select("environment", "smpp_source_id", "r.*")
    r = r.withColumns({"su": S.parse_urn(F.col("source_entity_urn")), "tu": S.parse_urn(F.col("target_entity_urn"))}).filter("su IS NOT NULL AND tu IS NOT NULL")
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return r.select(
        "tenant_id", "project_id", "environment", "smpp_source_id", "relation_id", "relation_type", "relation_version", "source_entity_urn", F.col("su.entity_type").alias("source_entity_type"), F.col("su.entity_id").alias("source_entity_id"),
        "target_entity_urn", F.col("tu.entity_type").alias("target_entity_type"), F.col("tu.entity_id").alias("target_entity_id"), "source_system", "target_system", "valid_from", "valid_to", text("correlation_id"), text("trace_id"),
        "causation_fact_id", text("route_id"), "attempt_no", "evidence_fact_ids", "binding_source", "confidence_class", "source_record_id", "source_record_hash", "created_at", now.alias("projected_at"),
        F.lit(C.SHARED_RELATION_PROJECTION_ID).alias("projection_id"), F.lit(C.SHARED_PROJECTION_VERSION).alias("projection_version"),
    )


def check_target_schema(df: DataFrame, expected: T.StructType) -> None:
    """N10. Raises ValueError unless names and types equal the expected ones, in order."""
    actual = [(f.name, f.dataType.simpleString()) for f in df.schema]
    wanted = [(f.name, f.dataType.simpleString()) for f in expected]
    if actual != wanted:
        raise ValueError("SMPP_SCHEMA_DRIFT")


def check_target_catalog(spark: SparkSession, core: str, meta: str, expected: dict[str, T.StructType]) -> None:
    """N10 in full: raises ValueError unless the shared warehouse has the release, the tables and the views that the projection is written for.

    ``core`` and ``meta`` are its databases as the session's catalog names them. Of each expected table the names and types of all columns
    must agree, in order. Nothing is read but one row of the release view.
    """
    release = f"{meta}.{C.SHARED_RELEASE_VIEW}"
    if not spark.catalog.tableExists(release):
        raise ValueError("SMPP_SCHEMA_DRIFT: no release")
    missing = [c for c in C.SHARED_RELEASE if c not in spark.table(release).columns]
    # The first of one row; a second one makes the release ambiguous.
    rows = [] if missing else spark.table(release).select(*C.SHARED_RELEASE).limit(2).collect()
    if len(rows) != 1 or rows[0].asDict() != C.SHARED_RELEASE:
        raise ValueError("SMPP_SCHEMA_DRIFT: release")
    for name, schema in expected.items():
        if not spark.catalog.tableExists(f"{core}.{name}"):
            raise ValueError(f"SMPP_SCHEMA_DRIFT: {name}")
        check_target_schema(spark.table(f"{core}.{name}"), schema)
    for view in C.SHARED_VIEWS:
        if not spark.catalog.tableExists(f"{core}.{view}"):
            raise ValueError(f"SMPP_SCHEMA_DRIFT: {view}")


@dataclass
class Target:
    """S5. A projection target; ``route_ids`` defaults to the target's own id."""

    target_id: str
    target_type: str = "standalone"
    enabled: bool = True
    required: bool = False
    accept_all_mappings: bool = False
    route_ids: list[str] = field(default_factory=list)
    write_layers: list[str] = field(default_factory=lambda: ["landing", "normalized", "core", "relation"])
    table_map: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.route_ids = self.route_ids or [self.target_id]
        if self.target_type == "sdar_shared_warehouse" and self.table_map:
            raise ValueError("SMPP_TARGET_TABLE_MAP_FORBIDDEN")

    def table(self, name: str) -> str:
        """S7."""
        return self.table_map.get(name, name)


def route_filter(df: DataFrame, target: Target) -> DataFrame:
    """P12. Records whose mapping shares a route with the target; unmapped ones only if it accepts all."""
    if target.accept_all_mappings:
        return df
    return df.filter(F.coalesce(F.arrays_overlap(F.col("mapping.route_ids"), F.array(*map(F.lit, target.route_ids))), F.lit(False)))


def layer_tables(tables: dict[str, DataFrame], target: Target) -> dict[str, DataFrame]:
    """P13. The tables, named ``layer.table``, of the layers that the target writes, under its own names."""
    out = {}
    for name, df in tables.items():
        layer = "relation" if name.endswith("entity_relation_fact") else name.split(".")[0]
        if layer in target.write_layers:
            out[target.table(name)] = df
    return out


Normalizer = Callable[[DataFrame, Column], DataFrame]
Projection = Callable[[DataFrame, Column], dict[str, DataFrame]]


@dataclass(frozen=True)
class NormalizerEntry:
    """Takes records of a schema whose version is ``low`` or later and before ``high``, as ``major.minor.patch``."""

    source_system: str
    schema_name: str
    low: str
    high: str
    normalize: Normalizer


#: Plug-ins: normalizers by schema and range of versions, the first that fits; projections by id.
NORMALIZERS: list[NormalizerEntry] = []
PROJECTIONS: dict[str, Projection] = {}


def _version(text: Column) -> Column:
    """A version as an array that compares like one; null for any other text. Versions before a release rank as no release."""
    return F.when(text.rlike(r"^[0-9]{1,9}\.[0-9]{1,9}\.[0-9]{1,9}$"), F.transform(F.split(text, r"\."), lambda x: x.cast("int")))


def normalizer_of(entries: list[NormalizerEntry]) -> Column:
    """The number of a record's normalizer; null if none takes it."""
    own, out = _version(F.col("schema_version")), F.lit(None).cast("int")
    for i, e in reversed(list(enumerate(entries))):
        fits = (F.col("source_system") == e.source_system) & (F.col("schema_name") == e.schema_name) & (own >= _version(F.lit(e.low))) & (own < _version(F.lit(e.high)))
        out = F.when(F.coalesce(fits, F.lit(False)), F.lit(i)).otherwise(out)
    return out


def normalize_by_schema(accepted: DataFrame, now: Column, entries: list[NormalizerEntry] | None = None) -> tuple[DataFrame, DataFrame]:
    """2.13. Facts of records of several schemas and versions in one plan, each row by its own normalizer, and dead letters of those without one."""
    from telmark.operators.normalize import unknown_schema

    entries = NORMALIZERS if entries is None else entries
    rows = accepted if "source_system" in accepted.columns else accepted.withColumn("source_system", F.lit(C.SOURCE_SYSTEM))
    marked = rows.withColumn("_normalizer", normalizer_of(entries))
    facts = None
    for i, e in enumerate(entries):
        own = e.normalize(marked.filter(F.col("_normalizer") == i).drop("_normalizer"), now)
        facts = own if facts is None else facts.unionByName(own)
    return facts, unknown_schema(marked.filter("_normalizer IS NULL"), now)


def _register_defaults() -> None:
    from telmark.operators.normalize import normalize

    NORMALIZERS.append(NormalizerEntry(C.SOURCE_SYSTEM, C.SCHEMA_NAME, C.SCHEMA_VERSION, "1.2.0", normalize))
    PROJECTIONS[C.CORE_PROJECTION_ID] = lambda facts, now: {**{f"core.{k}": v for k, v in project_core(facts, now).items()}, "core.entity_relation_fact": project_core_relations(facts)}
    PROJECTIONS[C.SHARED_PROJECTION_ID] = lambda facts, now: {"core.external_provider_fact": project_shared_provider(facts, now), "core.external_entity_relation_fact": project_shared_relations(facts, now)}


_register_defaults()
