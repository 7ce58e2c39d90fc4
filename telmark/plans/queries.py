"""Registered queries of the telemetry operators over records derived from ``events``, with their SQL.

Times come out as epoch milliseconds and lists as joined text, so that both engines print
them alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telmark import contracts as C
from telmark.functions import scalars as S
from telmark.operators import classify, mapping, normalize, project, serving, validate, verify
from telmark.plans import fixtures, pipeline
from telmark.plans.oracles import oracle, uuid5
from telmark.sources import otlp, tables
from telmark.sources.store import checkpoint_folder, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Times as epoch milliseconds, lists as text, small integers as long."""
    out: list[Column] = []
    for f in df.schema:
        kind, c = f.dataType.simpleString(), F.col(f"`{f.name}`")
        if kind.startswith("timestamp"):
            c = F.unix_millis(c)
        elif kind == "array<string>":
            c = F.array_join(c, ",")
        elif kind == "int":
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(out)


def query(name: str, sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: plain(f(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return f

    return add


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.telemetry(spark, sf_dir)


def classified(spark: SparkSession, sf_dir: str) -> pipeline.Classified:
    return pipeline.classify_all(records(spark, sf_dir), fixtures.mappings(spark))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.facts_of(classified(spark, sf_dir).accepted)


def written_facts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Facts for queries that use them several times; with columns only those, and only what they need is worked out."""
    f = facts(spark, sf_dir)
    return stored(f.select(*columns) if columns else f, "facts")


def core_of(f: DataFrame) -> DataFrame:
    return project.core_rows(f, pipeline.projected_at("2 seconds"))


def core(spark: SparkSession, sf_dir: str, table: str | None = None) -> DataFrame:
    rows = core_of(facts(spark, sf_dir))
    return rows if table is None else rows.filter(F.col("core_table") == table)


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.landing_rows(classified(spark, sf_dir).accepted, pipeline.projected_at())


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.project_core_relations(facts(spark, sf_dir))


def conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.conflict_rows(classified(spark, sf_dir).conflicts)


def diverted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    f = facts(spark, sf_dir)
    return normalize.dead_letters(f, project.shared_error(f), pipeline.projected_at())


# Sources, sinks and tables
def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export requests of up to 8 records each, in both spellings of keys."""
    text = lambda k, v: F.struct(F.lit(k).alias("key"), F.struct(v.alias("stringValue")).alias("value"))
    r = records(spark, sf_dir)
    log = F.struct(F.array(text("sdar.schema.name", F.col("schema_name")), text("sdar.schema.version", F.col("schema_version")), text("sdar.record.id", F.col("record_id")), text("sdar.record.hash", F.col("record_hash"))).alias("attributes"), F.col("trace_id").alias("traceId"), F.col("arrival_seq").cast("string").alias("timeUnixNano"), F.struct(F.struct(F.array(F.struct(F.lit("schemaName").alias("key"), F.struct(F.lit(C.SCHEMA_NAME).alias("stringValue"), F.lit(None).cast("string").alias("intValue")).alias("value")), F.struct(F.lit("n").alias("key"), F.struct(F.lit(None).cast("string").alias("stringValue"), F.col("arrival_seq").cast("string").alias("intValue")).alias("value"))).alias("values")).alias("kvlistValue")).alias("body"))
    g = r.groupBy(F.expr("arrival_seq div 8").alias("request")).agg(F.sort_array(F.collect_list(F.struct("arrival_seq", log.alias("log")))).alias("logs"))
    body = F.to_json(F.struct(F.array(F.struct(F.struct(F.array(text("service.name", F.lit("provider"))).alias("attributes")).alias("resource"), F.array(F.struct(F.struct(F.lit("scope").alias("name")).alias("scope"), F.transform("logs", lambda x: x["log"]).alias("logRecords"))).alias("scopeLogs"))).alias("resourceLogs")))
    snake = F.replace(F.replace(F.replace(F.replace(F.replace(body, F.lit("resourceLogs"), F.lit("resource_logs")), F.lit("scopeLogs"), F.lit("scope_logs")), F.lit("logRecords"), F.lit("log_records")), F.lit("traceId"), F.lit("trace_id")), F.lit("timeUnixNano"), F.lit("time_unix_nano"))
    return g.select(F.when(F.col("request") % 2 == 0, body).otherwise(snake).alias("request_json"))


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return otlp.flatten_otlp_logs(_requests(spark, sf_dir))


@query("s1_flatten_otlp_logs", "SELECT arrival_seq AS seq, record_id, trace_id, 'scope' AS scope_name, 'provider' AS service FROM tin")
def _(spark, sf):
    return _logs(spark, sf).select(F.col("time_unix_nano").cast("long").alias("seq"), F.col("attributes")["sdar.record.id"].alias("record_id"), "trace_id", F.col("scope.name").alias("scope_name"), F.col("resource")["service.name"].alias("service"))


@query("s2_anyvalue_to_json", f"SELECT arrival_seq AS seq, '{{\"schemaName\":\"{C.SCHEMA_NAME}\",\"n\":' || arrival_seq || '}}' AS body_json FROM tin")
def _(spark, sf):
    return _logs(spark, sf).select(F.col("time_unix_nano").cast("long").alias("seq"), "body_json")


@query("p1_select_provider_ops", "SELECT schema_version, count(*) AS n FROM tin WHERE schema_version = '1.1.0' GROUP BY 1")
def _(spark, sf):
    return otlp.select_provider_ops(_logs(spark, sf)).groupBy(F.col("attributes")["sdar.schema.version"].alias("schema_version")).agg(F.count("*").alias("n"))


TRUSTED = {"collector_id": "gateway-1", "trust_domain": "local", "deployment_id": "dep-1", "runtime_instance_id": "runtime-0", "provider_id": "provider-0"}


@query("p2_stamp_trusted_ingress", "SELECT 'gateway-1' AS collector, 'dep-1' AS deployment, 'smpp' AS system, 'provider' AS service, count(*) AS n FROM tin")
def _(spark, sf):
    r = F.col("resource")
    return otlp.stamp_trusted_ingress(_logs(spark, sf), TRUSTED).groupBy(r["telemetry.source.collector_id"].alias("collector"), r["telemetry.source.deployment_id"].alias("deployment"), r["telemetry.source.system"].alias("system"), r["service.name"].alias("service")).agg(F.count("*").alias("n"))


@query("p3_stamp_contract", "SELECT 'smpp.provider_ops' AS channel, schema_version AS version, count(*) AS n FROM tin GROUP BY 2")
def _(spark, sf):
    a = F.col("attributes")
    return otlp.stamp_contract(_logs(spark, sf)).groupBy(a["telemetry.channel"].alias("channel"), a["telemetry.contract.version"].alias("version")).agg(F.count("*").alias("n"))


@query("p4_stamp_runtime_metrics", "SELECT 'smpp.runtime_metrics' AS channel, 'provider-0' AS provider, count(*) AS n FROM tin")
def _(spark, sf):
    r = F.col("resource")
    return otlp.stamp_runtime_metrics(_logs(spark, sf).select("resource"), TRUSTED).groupBy(r["telemetry.channel"].alias("channel"), r["telemetry.source.provider_id"].alias("provider")).agg(F.count("*").alias("n"))


@query("p5_validate_ingress", "SELECT CASE WHEN arrival_seq % 5 = 0 THEN 'CHANNEL_INVALID' WHEN arrival_seq % 7 = 0 THEN 'COLLECTOR_ID_NOT_ALLOWED' ELSE '' END AS code, count(*) AS n FROM tin GROUP BY 1")
def _(spark, sf):
    r = records(spark, sf)
    resource = F.create_map(F.lit("telemetry.source.system"), F.lit("smpp"), F.lit("telemetry.source.collector_id"), F.when(F.col("arrival_seq") % 7 == 0, "other").otherwise("gateway-1"), F.lit("telemetry.source.trust_domain"), F.lit("local"), F.lit("telemetry.source.deployment_id"), F.lit("dep-1"))
    attributes = F.create_map(F.lit("telemetry.channel"), F.when(F.col("arrival_seq") % 5 == 0, "x").otherwise(C.CHANNEL))
    out = validate.validate_ingress(r.select("arrival_seq", resource.alias("resource"), attributes.alias("attributes")), allowed_ids=["gateway-1"])
    return out.groupBy(F.coalesce("ingress_code", F.lit("")).alias("code")).agg(F.count("*").alias("n"))


@query("p6_validate_envelope", "SELECT arrival_seq, code AS error_code FROM val")
def _(spark, sf):
    return validate.validate_envelopes(records(spark, sf)).select("arrival_seq", "error_code")


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope texts; each 11th has a forbidden key, each 13th a forbidden value, every second of these spelled with an escape."""
    r = records(spark, sf_dir)
    n = F.col("arrival_seq")
    extra = F.when(n % 22 == 0, F.lit("secr\\u0065tValue")).when(n % 11 == 0, F.lit("secretValue")).otherwise(F.lit("note"))
    value = F.when(n % 26 == 0, F.lit("Be\\u0061rer abc.def")).when(n % 13 == 0, F.lit("Bearer abc.def")).otherwise(F.lit("plain"))
    body = F.concat(F.lit('{"recordId":"'), "record_id", F.lit('","payload":'), "payload_json", F.lit(',"'), extra, F.lit('":"'), value, F.lit('"}'))
    return r.select("arrival_seq", "record_id", "payload_json", body.alias("envelope_json"))


@query("s3_read_envelopes", "SELECT arrival_seq, record_id, payload_json FROM tin")
def _(spark, sf):
    path = f"{checkpoint_folder(spark)}/envelopes-{uuid.uuid4().hex}"
    body = F.concat(F.lit('{"arrivalSeq":'), F.col("arrival_seq").cast("string"), F.lit(","), F.substring("envelope_json", 2, 2**31 - 1))
    _envelopes(spark, sf).select(body.alias("value")).write.text(path)
    e = validate.parse_envelopes(otlp.read_envelopes(spark, path))
    return e.select(F.get_json_object("envelope_json", "$.arrivalSeq").cast("long").alias("arrival_seq"), "record_id", "payload_json")


@query("p7_scan_sensitive", "SELECT arrival_seq, CASE WHEN arrival_seq % 11 = 0 THEN 'SENSITIVE_KEY_DETECTED' WHEN arrival_seq % 13 = 0 THEN 'SENSITIVE_VALUE_DETECTED' END AS code FROM tin")
def _(spark, sf):
    return _envelopes(spark, sf).select("arrival_seq", validate.scan_sensitive(F.col("envelope_json")).alias("code"))


@query("p8_forbid_evaluation_identity", "SELECT arrival_seq, CASE WHEN arrival_seq % 17 = 0 THEN 'SMPP_EVALUATION_DOMAIN_IDENTITY_FORBIDDEN' END AS code FROM tin")
def _(spark, sf):
    key = F.when(F.col("arrival_seq") % 34 == 0, F.lit("M\\u00312")).when(F.col("arrival_seq") % 17 == 0, F.lit("M12")).otherwise(F.lit("m12x"))
    body = F.concat(F.lit('{"a":{"'), key, F.lit('":"grade"},"p":'), "payload_json", F.lit("}"))
    return records(spark, sf).select("arrival_seq", validate.forbid_evaluation_identity(body).alias("code"))


@query("p9_normalize_correlation", "SELECT arrival_seq, CASE WHEN src % 4 = 0 THEN 'sdar' END AS origin_system, CASE WHEN src % 4 = 0 THEN array_to_string(list_sort(list_distinct(['st-' || (src % 7), 'st-' || (src % 3)])), ',') ELSE '' END AS origin_task_ids, trace_id FROM tin")
def _(spark, sf):
    return validate.normalize_correlation(records(spark, sf)).select("arrival_seq", "correlation.origin_system", "correlation.origin_task_ids", "correlation.trace_id")


@query("p10_safe_source_hint", "SELECT arrival_seq, '{\"schemaName\":\"' || schema_name || '\",\"schemaVersion\":\"' || schema_version || '\",\"recordId\":\"' || record_id || '\",\"recordHash\":\"' || record_hash || '\",\"recordType\":\"' || record_type || '\",\"providerId\":\"' || provider_id || '\",\"instanceId\":\"' || instance_id || '\"}' AS hint FROM tin")
def _(spark, sf):
    r = records(spark, sf)
    return r.select("arrival_seq", validate.safe_source_hint(r).alias("hint"))


@query("p11_error_summary", "SELECT arrival_seq, substr(repeat(payload_json, 20), 1, 256) AS summary FROM tin")
def _(spark, sf):
    return records(spark, sf).select("arrival_seq", validate.error_summary(F.repeat("payload_json", F.lit(20))).alias("summary"))


@query("p12_route_filter", "SELECT tenant_id, count(*) AS n FROM accepted GROUP BY 1")
def _(spark, sf):
    return project.route_filter(classified(spark, sf).accepted, project.Target("standalone-smpp")).groupBy(F.col("mapping.tenant_id").alias("tenant_id")).agg(F.count("*").alias("n"))


@query("p13_layer_filter", "SELECT 'landing.provider_ops' AS table_name, count(*) AS n FROM accepted UNION ALL SELECT 'edges', count(*) FROM rel")
def _(spark, sf):
    t = project.Target("a", write_layers=["landing", "relation"], table_map={"core.entity_relation_fact": "edges"})
    accepted = classified(spark, sf).accepted
    f = pipeline.facts_of(accepted)
    made = project.layer_tables({"landing.provider_ops": project.landing_rows(accepted, pipeline.projected_at()), "core.entity_relation_fact": project.project_core_relations(f), "core.provider_operation_fact": core_of(f)}, t)
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("table_name"), "n") for k, df in made.items()]
    return parts[0].unionByName(parts[1])


@query("p14_event_search", "SELECT epoch_ms(occurred_at) AS occurred_at, record_id AS source_record_id, record_type FROM accepted WHERE tenant_id = 't2' AND provider_id = 'provider-0' ORDER BY accepted.occurred_at DESC, record_id DESC LIMIT 100")
def _(spark, sf):
    return serving.event_search(tables.provider_ops_activity(landing(spark, sf)), {"tenantId": "t2", "providerId": "provider-0"}).select("occurred_at", "source_record_id", "record_type")


@query("p15_topology_filter", "SELECT relation_id, source_urn AS source_entity_urn, target_urn AS target_entity_urn FROM rel")
def _(spark, sf):
    return serving.topology(relations(spark, sf), limit=None).select("relation_id", "source_entity_urn", "target_entity_urn")


@query("p16_landing_row", "SELECT tenant_id, record_id AS source_record_id, record_hash AS source_record_hash, record_type, 'P2' AS priority, task_id, resource_id, provider_event_sequence, trace_id, epoch_ms(received_at + INTERVAL '1' SECOND) AS ingested_at, attributes_json, payload_json, epoch_ms(received_at + INTERVAL '1' SECOND) AS ingest_version FROM accepted")
def _(spark, sf):
    return landing(spark, sf).select("tenant_id", "source_record_id", "source_record_hash", "record_type", "priority", "task_id", "resource_id", "provider_event_sequence", "trace_id", "ingested_at", "attributes_json", "payload_json", "ingest_version")


@query("p17_canonical_row", "SELECT fact_id, record_id AS source_record_id, tenant_id, runtime_urn AS source_instance_urn, epoch_ms(normalized_at) AS normalized_at, CAST(4 AS BIGINT) AS mapping_version, CAST(3 AS BIGINT) AS normalizer_version, CASE WHEN src % 4 = 0 THEN 'sdar' END AS origin FROM facts")
def _(spark, sf):
    return project.canonical_rows(facts(spark, sf)).select("fact_id", "source_record_id", "tenant_id", "source_instance_urn", "normalized_at", "mapping_version", "normalizer_version", F.get_json_object("correlation_json", "$.origin_system").alias("origin"))


_CONFLICT_SQL = "SELECT arrival_seq, record_id AS source_record_id, h1 AS accepted_record_hash, record_hash AS conflicting_record_hash, 'record hash differs' AS conflict_summary FROM cls WHERE status = 'conflict' UNION ALL SELECT arrival_seq, record_id, NULL, record_hash, blocking_code FROM judged WHERE blocking_code IS NOT NULL"


@query("p18_conflict_row", _CONFLICT_SQL)
def _(spark, sf):
    return conflicts(spark, sf).select("arrival_seq", "source_record_id", "accepted_record_hash", "conflicting_record_hash", "conflict_summary")


@query("p18_rejected_row", f"SELECT {uuid5(chr(39) + 'rejected|' + chr(39) + ' || arrival_seq || ' + chr(39) + '|' + chr(39) + ' || error_code')} AS rejection_id, 'gateway-1' AS collector_id, error_code, error_code AS error_summary, epoch_ms(received_at) AS received_at FROM mapped WHERE error_code IS NOT NULL")
def _(spark, sf):
    r = classified(spark, sf).rejected
    return project.rejected_rows(r, validate.safe_source_hint(r)).drop("source_hint")


# Joins and lookups
@query("j1_resolve_source_mapping", "SELECT arrival_seq, tenant_id, smpp_source_id FROM mapped")
def _(spark, sf):
    return mapping.resolve_source_mapping(records(spark, sf), fixtures.mappings(spark)).select("arrival_seq", "mapping.tenant_id", "mapping.smpp_source_id")


@query("j2_classify_against_accepted", "SELECT n.arrival_seq, CASE WHEN o.record_id IS NULL AND n.rn = 1 THEN 'new' WHEN coalesce(o.record_hash, n.h1) = n.record_hash THEN 'duplicate' ELSE 'conflict' END AS status FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY arrival_seq) AS rn, first_value(record_hash) OVER (PARTITION BY record_id ORDER BY arrival_seq) AS h1 FROM tin WHERE arrival_seq % 2 = 1) n LEFT JOIN (SELECT record_id, record_hash FROM tin WHERE arrival_seq % 2 = 0) o ON o.record_id = n.record_id")
def _(spark, sf):
    r = records(spark, sf)
    return classify.classify_records(r.filter("arrival_seq % 2 = 1"), r.filter("arrival_seq % 2 = 0").select("source_system", "record_id", "record_hash")).select("arrival_seq", "status")


@query("j3_core_table_of", "SELECT record_type AS fact_type, core_table, count(*) AS n FROM core GROUP BY 1, 2")
def _(spark, sf):
    return facts(spark, sf).groupBy("fact_type", S.core_table_of(F.col("fact_type")).alias("core_table")).agg(F.count("*").alias("n"))


@query("j4_payload_catalog_join", "SELECT fact_id, CASE WHEN record_type = 'provider.resource.state' THEN json_extract_string(payload_json, '$.state') END AS lifecycle_status, CAST(NULL AS VARCHAR) AS error_code FROM facts")
def _(spark, sf):
    return facts(spark, sf).select("fact_id", S.payload_semantics(F.col("fact_type"), F.col("raw_payload_json")).alias("s")).select("fact_id", "s.lifecycle_status", "s.error_code")


def _two(spark: SparkSession, sf_dir: str, f: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The facts of two warehouses: the second lacks some, changes some and is earlier."""
    # The columns of the core rows that are compared.
    c = (facts(spark, sf_dir) if f is None else f).select("fact_id", "source_record_id", F.col("source_record_hash").alias("fact_hash"), pipeline.projected_at("2 seconds").alias("projected_at"), "fact_type")
    n = F.conv(F.substring("source_record_id", 1, 4), 16, 10).cast("long")
    b = c.filter(n % 50 != 0).withColumn("fact_hash", F.when(n % 50 == 1, F.lit("changed")).otherwise(F.col("fact_hash"))).withColumn("projected_at", F.col("projected_at") - F.expr("INTERVAL 1 second"))
    return c, b


_N = "CAST('0x' || substr(record_id, 1, 4) AS BIGINT)"


@query("j5_shadow_parity_join", f"SELECT fact_id, CASE WHEN {_N} % 50 = 0 THEN 'missing' ELSE 'hash_mismatch' END AS kind FROM facts WHERE {_N} % 50 IN (0, 1)")
def _(spark, sf):
    return verify.fact_differences(*_two(spark, sf))


@query("g2_missing_fact_ids", f"SELECT fact_id FROM facts WHERE {_N} % 50 = 0")
def _(spark, sf):
    return verify.missing_ids(*_two(spark, sf), "fact_id")


@query("j6_relation_coverage", "SELECT count(*) AS expected_facts, count(*) FILTER (WHERE src % 4 = 0) AS covered_facts, count(*) FILTER (WHERE src % 4 = 0) / count(*) AS coverage FROM facts WHERE src % 2 = 0")
def _(spark, sf):
    f = written_facts(spark, sf, "fact_id", "relations", "arrival_seq")
    return verify.relation_coverage(f.join(records(spark, sf).filter("src % 2 = 0").select("arrival_seq"), "arrival_seq", "left_semi"), project.project_core_relations(f))


@query("j7_layer_lineage", "SELECT CASE WHEN core_table IS NULL THEN 'not_projected' ELSE 'complete' END AS lineage, count(*) AS records FROM core GROUP BY 1")
def _(spark, sf):
    accepted = classified(spark, sf).accepted
    f = stored(pipeline.facts_of(accepted), "facts")
    return verify.layer_lineage(project.landing_rows(accepted, pipeline.projected_at()), f, core_of(f).filter("core_table IS NOT NULL"))


_URN = "urn:telemetry:t1:smpp:dep-1:task:task-16"


@query("j8_task_relations", f"SELECT relation_id, source_urn AS source_entity_urn, epoch_ms(occurred_at) AS valid_from FROM rel WHERE target_urn = '{_URN}' OR source_urn = '{_URN}' ORDER BY rel.occurred_at, relation_id LIMIT 1000")
def _(spark, sf):
    return serving.task_relations(relations(spark, sf), _URN).select("relation_id", "source_entity_urn", "valid_from")


# Aggregations
_A1 = "SELECT tenant_id, project_id, provider_urn AS provider_entity_urn, record_type AS fact_type, count(*) AS event_count, epoch_ms(min(occurred_at)) AS first_occurred_at, epoch_ms(max(occurred_at)) AS last_occurred_at FROM core GROUP BY 1, 2, 3, 4"


@query("a1_provider_activity_summary", _A1)
def _(spark, sf):
    return serving.provider_activity_summary(core(spark, sf))


def _source_payload_sql() -> str:
    return "json_extract_string(payload_json, '$.state') || json_extract_string(payload_json, '$.k')"


def _latest(df: DataFrame) -> DataFrame:
    inner = lambda k: F.get_json_object("payload_json", f"$.payload.{k}")
    return df.withColumn("payload_json", F.concat(inner("state"), inner("k"))).withColumnRenamed("payload_json", "payload")


def _latest_sql(urn: str, table: str) -> str:
    return f"SELECT tenant_id, project_id, {urn}_urn AS {urn}_entity_urn, arg_max({_source_payload_sql()}, (occurred_at, projected_at, fact_id)) AS payload, epoch_ms(max(occurred_at)) AS occurred_at, epoch_ms(max(projected_at)) AS data_watermark FROM core WHERE core_table = '{table}' GROUP BY 1, 2, 3"


@query("a2_resource_current_state", _latest_sql("resource", "resource_state_fact"))
def _(spark, sf):
    return _latest(serving.resource_current_state(core(spark, sf, "resource_state_fact")))


@query("a3_provider_current_health", _latest_sql("provider", "resource_health_fact"))
def _(spark, sf):
    return _latest(serving.provider_current_health(core(spark, sf, "resource_health_fact")))


_A4 = "SELECT 'core-smpp-v1' AS projection_id, CAST(1 AS BIGINT) AS projection_version, epoch_ms(max(projected_at)) AS data_watermark, count(*) AS projected_facts FROM core"


@query("a4_projection_watermark", _A4)
def _(spark, sf):
    return serving.projection_watermark(core(spark, sf))


@query("l6_projection_watermarks", _A4)
def _(spark, sf):
    return serving.projection_watermarks(core(spark, sf))


@query("t7_data_watermark", "SELECT epoch_ms(max(projected_at)) AS data_watermark FROM core")
def _(spark, sf):
    return serving.data_watermark(core(spark, sf), "projected_at")


@query("a5_data_quality_summary", "SELECT 'record_hash_conflict' AS rule_id, 'critical' AS severity, count(*) AS \"count\", epoch_ms(max(received_at)) AS last_detected_at FROM (SELECT received_at FROM cls WHERE status = 'conflict' UNION ALL SELECT received_at FROM judged WHERE blocking_code IS NOT NULL) c")
def _(spark, sf):
    return serving.data_quality_summary(conflicts(spark, sf), diverted(spark, sf)[1])


@query("g1_telemetry_data_quality", "SELECT 'record_hash_conflict' AS rule_id, tenant_id, 'p1' AS project_id, record_id AS subject_id, epoch_ms(received_at) AS detected_at, 'critical' AS severity FROM (SELECT tenant_id, record_id, received_at FROM cls WHERE status = 'conflict' UNION ALL SELECT tenant_id, record_id, received_at FROM judged WHERE blocking_code IS NOT NULL) c")
def _(spark, sf):
    return serving.data_quality(conflicts(spark, sf), diverted(spark, sf)[1])


_OUTCOMES = "SELECT arrival_seq, 'rejected' AS outcome, error_code FROM mapped WHERE error_code IS NOT NULL UNION ALL SELECT arrival_seq, status, NULL FROM cls WHERE status <> 'new' UNION ALL SELECT arrival_seq, CASE WHEN blocking_code IS NOT NULL THEN 'semantic_conflict' WHEN NOT has_identity THEN 'not_applicable' WHEN reason IS NOT NULL THEN 'accepted_with_quality_issue' ELSE 'accepted' END, blocking_code FROM judged"


@query("a6_outcome_counts", f"SELECT outcome, coalesce(error_code, '') AS reason, count(*) AS records FROM ({_OUTCOMES}) o GROUP BY 1, 2")
def _(spark, sf):
    return serving.outcome_counts(classified(spark, sf).outcomes())


@query("a7_projection_outcome_counts", "SELECT 'target-' || (arrival_seq % 3) AS target_id, CAST(count(*) FILTER (WHERE arrival_seq % 11 <> 0) AS BIGINT) AS batches, CAST(count(*) FILTER (WHERE arrival_seq % 11 = 0) AS BIGINT) AS failures, CAST(sum(arrival_seq % 200) AS BIGINT) AS records FROM tin GROUP BY 1")
def _(spark, sf):
    r = records(spark, sf)
    return serving.projection_outcome_counts(r.select(F.concat(F.lit("target-"), (F.col("arrival_seq") % 3).cast("string")).alias("target_id"), (F.col("arrival_seq") % 11 == 0).alias("failed"), (F.col("arrival_seq") % 200).alias("num_rows")))


@query("a8_layer_counts", "SELECT layer, n AS row_count, true AS parity FROM (SELECT count(*) AS n FROM accepted) a, (VALUES ('landing'), ('normalized'), ('core')) l(layer)")
def _(spark, sf):
    accepted = classified(spark, sf).accepted
    f = stored(pipeline.facts_of(accepted), "facts")
    return serving.layer_counts({"landing": project.landing_rows(accepted, pipeline.projected_at()), "normalized": f, "core": core_of(f)})


@query("a9_landing_profile", "SELECT count(*) AS \"rows\", count(DISTINCT record_id) AS unique_records, epoch_ms(min(occurred_at)) AS min_occurred_at, epoch_ms(max(occurred_at)) AS max_occurred_at, epoch_ms(max(received_at) + INTERVAL '1' SECOND) AS max_ingested_at, count(*) - count(DISTINCT record_id) AS duplicates, (epoch_ms(max(received_at) + INTERVAL '1' SECOND) - epoch_ms(max(occurred_at))) / 1000.0 AS lag_seconds FROM accepted")
def _(spark, sf):
    return serving.landing_profile(landing(spark, sf))


@query("a10_relation_confidence", "SELECT DISTINCT 'traced' AS confidence_class FROM rel")
def _(spark, sf):
    return serving.relation_confidence(relations(spark, sf))


@query("a11_batch_verdict", f"SELECT arrival_seq // 8 AS request, CASE max(CASE WHEN outcome IN ('conflict', 'semantic_conflict') THEN 2 WHEN outcome = 'rejected' THEN 1 ELSE 0 END) WHEN 2 THEN 'conflict' WHEN 1 THEN 'permanent' ELSE 'ok' END AS verdict, count(*) AS records FROM ({_OUTCOMES}) o GROUP BY 1")
def _(spark, sf):
    return serving.batch_verdict(classified(spark, sf).outcomes().withColumn("request", F.expr("arrival_seq div 8")), "request")


@query("a12_throughput_window", "SELECT epoch_ms(received_at) // 15000 * 15000 AS window_start, count(*) AS records, count(*) / 15.0 AS records_per_second FROM tin GROUP BY 1")
def _(spark, sf):
    return serving.throughput_window(records(spark, sf), "received_at")


@query("a13_entity_relation_degree", "SELECT source_urn AS entity_urn, 'out' AS direction, count(DISTINCT relation_id) AS relations, count(DISTINCT target_urn) AS neighbours FROM rel GROUP BY 1 UNION ALL SELECT target_urn, 'in', count(DISTINCT relation_id), count(DISTINCT source_urn) FROM rel GROUP BY 1")
def _(spark, sf):
    return serving.entity_relation_degree(relations(spark, sf))


# Windows and classification
@query("w1_latest_by_version", "SELECT record_id, arrival_seq, record_hash FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY received_at DESC, arrival_seq DESC) AS rn FROM tin) x WHERE rn = 1")
def _(spark, sf):
    return tables.latest_by_version(records(spark, sf), ["record_id"], "received_at", "arrival_seq").select("record_id", "arrival_seq", "record_hash")


@query("w2_classify_records", "SELECT arrival_seq, status, CASE WHEN status <> 'new' THEN h1 END AS accepted_hash FROM cls")
def _(spark, sf):
    r = mapping.resolve_source_mapping(validate.validate_envelopes(records(spark, sf)), fixtures.mappings(spark)).filter("error_code IS NULL AND mapping IS NOT NULL")
    return classify.classify_records(r).select("arrival_seq", "status", "accepted_hash")


@query("w3_provider_identity", "SELECT arrival_seq, replace(provider_id || '|' || instance_id || '|' || record_type || '|' || coalesce(task_id, external_command_id, resource_id, external_execution_id, provider_event_id), '|', '/') AS identity FROM tin")
def _(spark, sf):
    return records(spark, sf).select("arrival_seq", F.replace(classify.provider_identity(), F.lit(classify.SEPARATOR), F.lit("/")).alias("identity"))


def _assessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = mapping.resolve_source_mapping(validate.validate_envelopes(records(spark, sf_dir)), fixtures.mappings(spark)).filter("error_code IS NULL AND mapping IS NOT NULL")
    return classify.with_identity(classify.classify_records(r).filter("status = 'new'"))


@query("w4_revision_conflict", "SELECT arrival_seq, local_id IS NOT NULL AND row_number() OVER (PARTITION BY provider_id, instance_id, record_type, local_id, src % 1000 ORDER BY arrival_seq) > 1 AS blocked FROM ident")
def _(spark, sf):
    # Only this rule is to act: a record that another one blocks would leave no trace here.
    r = _assessed(spark, sf).withColumns({"revision": (F.col("src") % 1000).cast("string"), "terminal": F.lit(None).cast("string"), "provider_event_sequence": F.lit(None).cast("bigint")})
    return classify.assess(r).select("arrival_seq", F.coalesce(F.col("blocking_code") == classify.REVISION, F.lit(False)).alias("blocked"))


@query("w5_terminal_conflict", "SELECT arrival_seq, coalesce(t <> first_value(t IGNORE NULLS) OVER (PARTITION BY provider_id, instance_id, record_type, local_id ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AND local_id IS NOT NULL AS blocked FROM (SELECT *, CASE WHEN src % 3 = 0 THEN 'done' WHEN src % 31 = 1 THEN 'failed' END AS t FROM ident) x")
def _(spark, sf):
    t = F.when(F.col("src") % 3 == 0, "done").when(F.col("src") % 31 == 1, "failed")
    r = _assessed(spark, sf).withColumns({"terminal": t, "revision": F.lit(None).cast("string"), "provider_event_sequence": F.lit(None).cast("bigint")})
    return classify.assess(r).select("arrival_seq", F.coalesce(F.col("blocking_code") == classify.TERMINAL, F.lit(False)).alias("blocked"))


_W8 = "SELECT arrival_seq, CASE WHEN NOT has_identity THEN 'not_applicable' WHEN blocking_code IS NOT NULL THEN 'conflict' WHEN reason IS NOT NULL THEN 'accepted_with_quality_issue' ELSE 'accepted' END AS quality_status, coalesce(blocking_code, reason, '') AS reason_codes FROM judged"


@query("w6_sequence_conflict", "SELECT arrival_seq, blocking_code FROM judged WHERE blocking_code IS NOT NULL")
def _(spark, sf):
    return classify.assess(_assessed(spark, sf)).filter("blocking_code IS NOT NULL").select("arrival_seq", "blocking_code")


@query("w7_sequence_quality", "SELECT arrival_seq, CASE WHEN local_id IS NOT NULL AND provider_event_sequence < t THEN 'SMPP_PROVIDER_EVENT_OUT_OF_ORDER' WHEN local_id IS NOT NULL AND provider_event_sequence > t + 1 THEN 'SMPP_PROVIDER_EVENT_SEQUENCE_GAP' END AS sequence_reason FROM (SELECT *, max(provider_event_sequence) OVER (PARTITION BY provider_id, instance_id, record_type, local_id ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS t FROM ident) x")
def _(spark, sf):
    return classify.sequence_quality(_assessed(spark, sf)).select("arrival_seq", "sequence_reason")


@query("w8_assess_provider_events", _W8)
def _(spark, sf):
    return classify.assess(_assessed(spark, sf)).select("arrival_seq", "quality_status", "reason_codes")


@query("w8_assess_sequential", "SELECT arrival_seq, status AS outcome FROM cls WHERE status <> 'new' UNION ALL SELECT arrival_seq, CASE WHEN NOT has_identity THEN 'not_applicable' WHEN blocking_code IS NOT NULL THEN 'semantic_conflict' WHEN reason IS NOT NULL THEN 'accepted_with_quality_issue' ELSE 'accepted' END FROM judged")
def _(spark, sf):
    r = mapping.resolve_source_mapping(validate.validate_envelopes(records(spark, sf)), fixtures.mappings(spark)).filter("error_code IS NULL AND mapping IS NOT NULL")
    return classify.assess_sequential(classify.with_identity(r)).select("arrival_seq", "outcome")


# Sorts and limits
@query("l2_task_timeline", f"SELECT fact_id, epoch_ms(occurred_at) AS occurred_at FROM core WHERE core_table = 'task_lifecycle_fact' AND task_urn = '{_URN}' ORDER BY core.occurred_at, fact_id LIMIT 1000")
def _(spark, sf):
    return serving.task_timeline(core(spark, sf, "task_lifecycle_fact"), _URN).select("fact_id", "occurred_at")


@query("l3_topology", "SELECT relation_id, epoch_ms(occurred_at) AS valid_from FROM rel WHERE tenant_id = 't1' ORDER BY rel.occurred_at DESC, relation_id LIMIT 5000")
def _(spark, sf):
    return serving.topology(relations(spark, sf), "t1").select("relation_id", "valid_from")


@query("l4_record_lookup", "SELECT fact_id, record_id AS source_record_id FROM facts WHERE record_id = (SELECT min(record_id) FROM facts WHERE src % 97 = 5) ORDER BY fact_id LIMIT 10")
def _(spark, sf):
    f = written_facts(spark, sf)
    c = project.canonical_rows(f)
    # The id that a caller would look up.
    least = f.join(records(spark, sf).filter("src % 97 = 5").select("arrival_seq"), "arrival_seq", "left_semi").agg(F.min("source_record_id").alias("m")).first()["m"]
    return serving.record_lookup(c, C.SOURCE_SYSTEM, least).select("fact_id", "source_record_id")


@query("l5_provider_health", f"SELECT * FROM ({_latest_sql('provider', 'resource_health_fact')}) h WHERE provider_entity_urn = 'urn:telemetry:t1:smpp:dep-1:provider:provider-1' LIMIT 1")
def _(spark, sf):
    return _latest(serving.provider_health(core(spark, sf, "resource_health_fact"), "urn:telemetry:t1:smpp:dep-1:provider:provider-1"))


@query("l5_resource_state", f"SELECT * FROM ({_latest_sql('resource', 'resource_state_fact')}) h WHERE resource_entity_urn = 'urn:telemetry:t1:smpp:dep-1:resource:res-1' LIMIT 1")
def _(spark, sf):
    return _latest(serving.resource_state(core(spark, sf, "resource_state_fact"), "urn:telemetry:t1:smpp:dep-1:resource:res-1"))


@query("l7_dashboard_activity", f"SELECT * FROM ({_A1}) a ORDER BY last_occurred_at DESC, tenant_id, provider_entity_urn, fact_type LIMIT 100")
def _(spark, sf):
    return serving.dashboard_activity(core(spark, sf))


@query("l8_dashboard_topology", "SELECT relation_id FROM rel ORDER BY occurred_at DESC, relation_id LIMIT 100")
def _(spark, sf):
    return serving.dashboard_topology(relations(spark, sf)).select("relation_id")


@query("l9_pending", "SELECT arrival_seq FROM tin WHERE arrival_seq > 500 ORDER BY arrival_seq LIMIT 200")
def _(spark, sf):
    return tables.pending(records(spark, sf), 500).select("arrival_seq")


# Sets
@query("g3_catalog_equality", "SELECT true AS equal")
def _(spark, sf):
    known = spark.createDataFrame([(t,) for t in C.PAYLOAD_CATALOG], "record_type string")
    return verify.catalog_equality(records(spark, sf), known, "record_type")


@query("g4_origin_id_set", "SELECT arrival_seq, array_to_string(list_sort(list_distinct(['x' || (src % 5), 'x' || (src % 3), 'x' || (src % 5)])), ',') AS ids FROM tin")
def _(spark, sf):
    x = lambda n: F.concat(F.lit("x"), (F.col("src") % n).cast("string"))
    return records(spark, sf).select("arrival_seq", S.origin_ids(F.array(x(5), x(3), x(5))).alias("ids"))


@query("g5_relation_identity_parity", "SELECT count(DISTINCT relation_id) AS relations, count(DISTINCT relation_id) >= 48 AS passed FROM rel")
def _(spark, sf):
    f = written_facts(spark, sf, "relations", "environment", "source_instance")
    return verify.relation_identity_parity(project.project_core_relations(f), project.project_shared_relations(f, F.col("created_at")), 48)


# Scalar functions
@query("f1_canonical_json", "SELECT arrival_seq, '{\"a\":' || (arrival_seq % 10) || ',\"b\":{\"k\":[1,\"x\"],\"z\":null}}' AS canonical FROM tin")
def _(spark, sf):
    text = F.concat(F.lit('{ "b": {"z": null, "k": [1, "x"]}, "a": '), (F.col("arrival_seq") % 10).cast("string"), F.lit(" }"))
    return records(spark, sf).select("arrival_seq", S.canonical_json(text).alias("canonical"))


@query("f2_record_hash", "SELECT arrival_seq, sha256('{\"payload\":{\"k\":' || json_extract_string(payload_json, '$.k') || ',\"state\":\"' || json_extract_string(payload_json, '$.state') || '\"},\"recordId\":\"' || record_id || '\"}') AS hash FROM tin")
def _(spark, sf):
    text = F.concat(F.lit('{"recordId":"'), "record_id", F.lit('","emittedAt":"x","instanceId":"'), "instance_id", F.lit('","recordHash":"y","payload":'), "payload_json", F.lit("}"))
    return records(spark, sf).select("arrival_seq", S.record_hash(text).alias("hash"))


@query("f3_uuid_v5", f"SELECT arrival_seq, {uuid5('payload_json')} AS id FROM tin")
def _(spark, sf):
    return records(spark, sf).select("arrival_seq", S.uuid_v5(F.col("payload_json")).alias("id"))


@query("f4_fact_id", "SELECT record_id, fact_id FROM facts")
def _(spark, sf):
    return facts(spark, sf).select(F.col("source_record_id").alias("record_id"), "fact_id")


@query("f5_fact_hash")
def _(spark, sf):
    return facts(spark, sf).select("fact_id", "fact_hash")


@query("f6_relation_id", "SELECT fact_id, relation_id FROM rel")
def _(spark, sf):
    return relations(spark, sf).select(F.col("causation_fact_id").alias("fact_id"), "relation_id")


@query("f7_entity_urn", "SELECT fact_id, runtime_urn AS source_instance_urn FROM facts")
def _(spark, sf):
    return facts(spark, sf).select("fact_id", "source_instance_urn")


@query("f8_encode_uri_component", "SELECT arrival_seq, replace(replace(replace(replace(replace(replace(url_encode(payload_json), '%21', '!'), '%27', ''''), '%28', '('), '%29', ')'), '%2A', '*'), '%7E', '~') AS encoded FROM tin")
def _(spark, sf):
    return records(spark, sf).select("arrival_seq", S.encode_uri_component(F.col("payload_json")).alias("encoded"))


@query("f9_parse_urn", "SELECT fact_id, tenant_id, 'runtime' AS entity_type, instance_id AS entity_id FROM facts")
def _(spark, sf):
    return facts(spark, sf).select("fact_id", S.parse_urn(F.col("source_instance_urn")).alias("u")).select("fact_id", "u.tenant_id", "u.entity_type", "u.entity_id")


@query("f11_primary_entity_urn", "SELECT fact_id, primary_urn FROM core")
def _(spark, sf):
    return facts(spark, sf).select("fact_id", S.primary_entity_urn(F.col("entity_refs"), F.col("source_instance_urn")).alias("primary_urn"))


@query("f12_local_id", "SELECT fact_id, coalesce(task_id, '') AS task FROM facts")
def _(spark, sf):
    return facts(spark, sf).select("fact_id", S.local_id(F.col("entity_refs"), "task").alias("task"))


@query("f13_safe_int", "SELECT arrival_seq, CASE WHEN CAST(9007199254740000 AS HUGEINT) + arrival_seq <= 9007199254740991 THEN CAST(9007199254740000 + arrival_seq AS VARCHAR) ELSE '\"' || (9007199254740000 + arrival_seq) || '\"' END AS token FROM tin")
def _(spark, sf):
    return records(spark, sf).select("arrival_seq", S.safe_int((F.col("arrival_seq") + F.lit(9007199254740000)).cast("string")).alias("token"))


@query("f14_iso_timestamp", "SELECT arrival_seq, epoch_ms(occurred_at) AS ms FROM tin")
def _(spark, sf):
    return records(spark, sf).select("arrival_seq", S.iso_timestamp(F.date_format("occurred_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("ms"))


@query("f15_revision_text", "SELECT arrival_seq, CASE WHEN arrival_seq % 3 = 0 THEN CAST(arrival_seq AS VARCHAR) WHEN arrival_seq % 3 = 1 THEN 'r' || arrival_seq ELSE CAST(src AS VARCHAR) END AS revision FROM tin")
def _(spark, sf):
    seq = F.col("arrival_seq").cast("string")
    payload = F.when(F.col("arrival_seq") % 3 == 0, F.concat(F.lit('{"providerRevision":'), seq, F.lit("}"))).when(F.col("arrival_seq") % 3 == 1, F.concat(F.lit('{"providerRevision":"r'), seq, F.lit('"}'))).otherwise(F.lit("{}"))
    return records(spark, sf).select("arrival_seq", S.revision_text(payload, F.lit(None).cast("bigint"), F.col("src")).alias("revision"))


# Normalization and projection
@query("n1_normalize", "SELECT fact_id, record_type AS fact_type, record_id AS source_record_id, tenant_id, epoch_ms(occurred_at) AS occurred_at, epoch_ms(emitted_at) AS observed_at, epoch_ms(normalized_at) AS normalized_at FROM facts")
def _(spark, sf):
    return facts(spark, sf).select("fact_id", "fact_type", "source_record_id", "tenant_id", "occurred_at", "observed_at", "normalized_at")


@query("n2_source_payload", "SELECT fact_id, provider_id, task_id, json_extract_string(payload_json, '$.state') AS state FROM facts")
def _(spark, sf):
    g = lambda p: F.get_json_object("payload_json", p)
    return facts(spark, sf).select("fact_id", g("$.providerId").alias("provider_id"), g("$.taskId").alias("task_id"), g("$.payload.state").alias("state"))


@query("n3_entity_refs", "SELECT fact_id, 'runtime' AS entity_type, runtime_urn AS entity_urn FROM facts UNION ALL SELECT fact_id, 'provider', provider_urn FROM facts UNION ALL SELECT fact_id, 'task', task_urn FROM facts WHERE task_id IS NOT NULL UNION ALL SELECT fact_id, 'resource', resource_urn FROM facts WHERE resource_id IS NOT NULL UNION ALL SELECT fact_id, 'execution', execution_urn FROM facts WHERE external_execution_id IS NOT NULL")
def _(spark, sf):
    return normalize.entity_ref_rows(facts(spark, sf)).select("fact_id", "entity_type", "entity_urn")


@query("n4_derive_relations", "SELECT fact_id, 'invokes' AS relation_type, source_urn AS source_entity_urn, target_urn AS target_entity_urn FROM rel")
def _(spark, sf):
    return relations(spark, sf).select(F.col("causation_fact_id").alias("fact_id"), "relation_type", "source_entity_urn", "target_entity_urn")


@query("n5_relation_fact", "SELECT relation_id, 'traced' AS confidence_class, 'provider_correlation_metadata' AS binding_source, fact_id AS evidence_fact_ids, epoch_ms(occurred_at) AS valid_from, epoch_ms(received_at) AS created_at, CAST(2 AS BIGINT) AS projection_version FROM rel")
def _(spark, sf):
    return relations(spark, sf).select("relation_id", "confidence_class", "binding_source", "evidence_fact_ids", "valid_from", "created_at", "projection_version")


@query("n6_project_core", "SELECT fact_id, primary_urn AS primary_entity_urn, provider_urn AS provider_entity_urn, task_urn AS task_entity_urn, resource_urn AS resource_entity_urn, core_table, epoch_ms(projected_at) AS projected_at FROM core")
def _(spark, sf):
    return core(spark, sf).select("fact_id", "primary_entity_urn", "provider_entity_urn", "task_entity_urn", "resource_entity_urn", "core_table", "projected_at")


@query("n7_project_core_relations", "SELECT relation_id, tenant_id, source_urn AS source_entity_urn, target_urn AS target_entity_urn, fact_id AS causation_fact_id, trace_id FROM rel")
def _(spark, sf):
    return relations(spark, sf).select("relation_id", "tenant_id", "source_entity_urn", "target_entity_urn", "causation_fact_id", "trace_id")


@query("n8_project_shared_provider", "SELECT fact_id, smpp_source_id, coalesce(task_id, '') AS external_task_id, CASE WHEN record_type = 'provider.resource.state' THEN json_extract_string(payload_json, '$.state') ELSE '' END AS lifecycle_status, '2.0.0' AS runtime_revision, CASE WHEN src % 4 = 0 THEN array_to_string(list_sort(list_distinct(['st-' || (src % 7), 'st-' || (src % 3)])), ',') ELSE '' END AS origin_sdar_task_ids, epoch_ms(emitted_at) AS observed_at FROM facts")
def _(spark, sf):
    return project.project_shared_provider(diverted(spark, sf)[0], pipeline.projected_at()).select("fact_id", "smpp_source_id", "external_task_id", "lifecycle_status", "runtime_revision", "origin_sdar_task_ids", "observed_at")


@query("n9_project_shared_relations", "SELECT relation_id, 'task' AS source_entity_type, origin_id AS source_entity_id, CASE WHEN task_id IS NULL THEN 'provider' ELSE 'task' END AS target_entity_type, coalesce(task_id, provider_id) AS target_entity_id FROM rel")
def _(spark, sf):
    return project.project_shared_relations(facts(spark, sf), F.col("created_at")).select("relation_id", "source_entity_type", "source_entity_id", "target_entity_type", "target_entity_id")


@query("n10_check_target_schema", "SELECT c.target, c.code, n.n FROM (VALUES ('same', ''), ('renamed column', 'SMPP_SCHEMA_DRIFT'), ('other type', 'SMPP_SCHEMA_DRIFT'), ('other order', 'SMPP_SCHEMA_DRIFT'), ('lost column', 'SMPP_SCHEMA_DRIFT')) c(target, code), (SELECT count(*) AS n FROM facts) n")
def _(spark, sf):
    from pyspark.sql import types as T

    shared = project.project_shared_provider(facts(spark, sf), pipeline.projected_at())
    fields = list(shared.schema)
    targets = {"same": fields, "renamed column": [T.StructField("x", fields[0].dataType), *fields[1:]], "other type": [T.StructField(fields[0].name, T.BinaryType()), *fields[1:]], "other order": fields[::-1], "lost column": fields[1:]}
    codes = []
    for name, wanted in targets.items():
        try:
            project.check_target_schema(shared, T.StructType(wanted))
            codes.append((name, ""))
        except ValueError as error:
            codes.append((name, str(error)))
    found = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.lit(c).alias("code")) for t, c in codes])).alias("c")
    return shared.agg(F.count("*").alias("n")).select(found, "n").select("c.target", "c.code", "n")


@query("n11_normalization_dead_letter", "SELECT record_id AS source_record_id, 'SMPP_PAYLOAD_CONTRACT_INVALID' AS error_code FROM facts WHERE record_type = 'provider.resource.state' AND src % 3 = 0")
def _(spark, sf):
    f = facts(spark, sf).join(records(spark, sf).select("arrival_seq", "src"), "arrival_seq")
    f = f.withColumn("raw_payload_json", F.when(F.col("src") % 3 == 0, F.lit('{"state":3}')).otherwise(F.col("raw_payload_json")))
    return normalize.dead_letters(f, project.shared_error(f), pipeline.projected_at())[1].select("source_record_id", "error_code")


# Tables
@query("s8_apply_retention", "SELECT arrival_seq FROM tin WHERE occurred_at > TIMESTAMP '2024-07-15' - INTERVAL 180 DAY")
def _(spark, sf):
    return tables.apply_retention(records(spark, sf), "occurred_at", C.RETENTION_DAYS["landing"], F.lit("2024-07-15 00:00:00").cast("timestamp")).select("arrival_seq")


@query("s9_partition_by_month", "SELECT strftime(occurred_at, '%Y%m') AS month, count(*) AS n FROM tin GROUP BY 1")
def _(spark, sf):
    return tables.with_month(records(spark, sf), "occurred_at").groupBy("month").agg(F.count("*").alias("n"))


@query("s10_evolve_schema", "SELECT arrival_seq, CAST(NULL AS VARCHAR) AS zone, record_id FROM tin")
def _(spark, sf):
    from pyspark.sql import types as T

    target = T.StructType([T.StructField("arrival_seq", T.LongType()), T.StructField("zone", T.StringType()), T.StructField("record_id", T.StringType())])
    return tables.evolve_schema(records(spark, sf), target)


@query("s11_raw_compat_view", "SELECT record_id, record_hash, schema_name, instance_id FROM accepted")
def _(spark, sf):
    return tables.raw_compat_view(landing(spark, sf)).select("record_id", "record_hash", "schema_name", "instance_id")


@query("s12_provider_ops_activity", "SELECT record_id AS source_record_id, event_category, delivery_class, operation_name FROM accepted")
def _(spark, sf):
    return tables.provider_ops_activity(landing(spark, sf)).select("source_record_id", "event_category", "delivery_class", "operation_name")


@query("s13_meta_checkpoint", "SELECT 'target-' || (arrival_seq % 3) AS target_id, 'main' AS checkpoint_name, max(arrival_seq) AS arrival_seq FROM tin GROUP BY 1")
def _(spark, sf):
    rows = records(spark, sf).select(F.concat(F.lit("target-"), (F.col("arrival_seq") % 3).cast("string")).alias("target_id"), F.lit("main").alias("checkpoint_name"), "arrival_seq", (F.col("received_at") + F.make_dt_interval(secs=F.col("arrival_seq"))).alias("updated_at"))
    return tables.meta_table(spark, "projection_checkpoint", rows).drop("updated_at")


# Verification
@query("v1_shadow_parity", f"SELECT count(*) AS a_count, count(*) FILTER (WHERE {_N} % 50 <> 0) AS b_count, CAST(count(*) FILTER (WHERE {_N} % 50 = 0) AS BIGINT) AS missing, CAST(count(*) FILTER (WHERE {_N} % 50 = 1) AS BIGINT) AS hash_mismatch, 'failed' AS status FROM facts")
def _(spark, sf):
    f = written_facts(spark, sf, "fact_id", "source_record_id", "source_record_hash", "received_at", "fact_type", "relations")
    a, b = _two(spark, sf, f)
    return verify.shadow_parity(a, b, project.project_core_relations(f), f, 5000, 0.0).select("a_count", "b_count", "missing", "hash_mismatch", "status")


@query("v2_e2e_checks", f"SELECT count(*) FILTER (WHERE {_N} % 50 = 0) = 0 AS count_parity, count(*) FILTER (WHERE {_N} % 50 IN (0, 1)) = 0 AS fact_hash_parity, epoch_ms(max(projected_at)) - epoch_ms(max(projected_at) FILTER (WHERE {_N} % 50 <> 0)) + 1000 <= 5000 AS watermark_parity, count(DISTINCT record_type) = 16 AS all_types, true AS projection_identity, (SELECT count(*) >= 48 AND count(*) FILTER (WHERE {_N} % 50 = 0) = 0 FROM rel) AS relation_identity FROM core")
def _(spark, sf):
    f = written_facts(spark, sf)
    a, b = _two(spark, sf, f)
    r = project.project_core_relations(f)
    there = project.project_core_relations(f.join(b.select("fact_id"), "fact_id", "left_semi"))
    parity = verify.shadow_parity(a, b, r, f, 5000, 0.0)
    c = core_of(f)
    return verify.e2e_checks(parity, c, r, there, c).select("count_parity", "fact_hash_parity", "watermark_parity", "all_types", "projection_identity", "relation_identity")


@query("v3_migration_consistency", "SELECT 'record_ids' AS metric, CAST(count(DISTINCT record_id) AS VARCHAR) AS value FROM accepted UNION ALL SELECT 'record_hash_sum', CAST(sum(CAST('0x' || substr(record_hash, 1, 8) AS HUGEINT)) AS VARCHAR) FROM accepted UNION ALL SELECT 'min_occurred_at', CAST(epoch_ms(min(occurred_at)) AS VARCHAR) FROM accepted UNION ALL SELECT 'max_occurred_at', CAST(epoch_ms(max(occurred_at)) AS VARCHAR) FROM accepted UNION ALL SELECT 'conflicts', CAST(count(*) AS VARCHAR) FROM (" + _CONFLICT_SQL + ") UNION ALL SELECT 'not_normalizable', '0' UNION ALL SELECT 'core_facts', CAST(count(DISTINCT fact_id) AS VARCHAR) FROM facts UNION ALL SELECT 'normalized_facts', CAST(count(DISTINCT fact_id) AS VARCHAR) FROM facts UNION ALL SELECT 'records_' || record_type, CAST(count(*) AS VARCHAR) FROM accepted GROUP BY record_type")
def _(spark, sf):
    c = classified(spark, sf)
    f = stored(pipeline.facts_of(c.accepted), "facts")
    dead = normalize.dead_letters(f, project.shared_error(f), pipeline.projected_at())[1]
    return verify.migration_consistency(project.landing_rows(c.accepted, pipeline.projected_at()), f, core_of(f), project.conflict_rows(c.conflicts), dead)
