"""DuckDB SQL that states the same results over the same derived records."""

from __future__ import annotations

from telmark import contracts as C
from telmark.plans.fixtures import telemetry_sql


def uuid5(name: str) -> str:
    return (
        f"(SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) "
        f"FROM (SELECT sha1(unhex('{C.UUID_NAMESPACE}') || encode({name})) AS h))"
    )


_CORE = ", ".join(f"('{k}', '{v}')" for k, v in C.CORE_TABLE_OF.items())
PRELUDE = f"""
WITH tin AS ({telemetry_sql("duckdb")}),
val AS (SELECT *, CASE
  WHEN schema_version <> '1.1.0' THEN 'SCHEMA_VERSION_UNSUPPORTED'
  WHEN NOT regexp_full_match(trace_id, '[a-f0-9]{{32}}') THEN 'TRACE_ID_INVALID'
  WHEN emitted_at < occurred_at THEN 'SMPP_EVENT_TIME_INVALID'
  WHEN record_type = 'provider.task.lifecycle' AND task_id IS NULL THEN 'PROVIDER_LOCAL_IDENTITY_MISSING'
  WHEN record_type = 'provider.command.lifecycle' AND external_command_id IS NULL THEN 'PROVIDER_LOCAL_IDENTITY_MISSING'
  WHEN record_type LIKE 'provider.resource.%' AND resource_id IS NULL THEN 'PROVIDER_LOCAL_IDENTITY_MISSING'
  WHEN record_type = 'provider.execution.progress' AND external_execution_id IS NULL THEN 'PROVIDER_LOCAL_IDENTITY_MISSING'
  WHEN record_type LIKE 'provider.business_event.%' AND provider_event_id IS NULL THEN 'PROVIDER_LOCAL_IDENTITY_MISSING' END AS code FROM tin),
dim AS (SELECT 'provider-' || p AS provider_id, tenant_id, a AS valid_from, b AS valid_to, 'src-' || p AS smpp_source_id FROM (VALUES (0), (1), (2), (3)) x(p), (VALUES ('t1', TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-15'), ('t2', TIMESTAMP '2024-01-15', NULL)) y(tenant_id, a, b)),
mapped AS (SELECT v.*, d.tenant_id, 'p1' AS project_id, d.smpp_source_id, coalesce(code, CASE WHEN d.tenant_id IS NULL THEN 'SOURCE_UNMAPPED' END) AS error_code
  FROM val v LEFT JOIN dim d ON d.provider_id = v.provider_id AND d.valid_from <= v.received_at AND (d.valid_to IS NULL OR v.received_at < d.valid_to)),
cls AS (SELECT *, CASE WHEN rn = 1 THEN 'new' WHEN h1 = record_hash THEN 'duplicate' ELSE 'conflict' END AS status FROM (
  SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY arrival_seq) AS rn, first_value(record_hash) OVER (PARTITION BY record_id ORDER BY arrival_seq) AS h1 FROM mapped WHERE error_code IS NULL) z),
ident AS (SELECT *, coalesce(task_id, external_command_id, resource_id, external_execution_id, provider_event_id) AS local_id FROM cls WHERE status = 'new'),
rep AS (SELECT *, local_id IS NOT NULL AS has_identity, CASE WHEN local_id IS NOT NULL AND provider_event_sequence IS NOT NULL AND row_number() OVER (PARTITION BY provider_id, instance_id, record_type, local_id, provider_event_sequence ORDER BY arrival_seq) > 1 THEN 'SMPP_PROVIDER_EVENT_SEQUENCE_CONFLICT' END AS blocking_code FROM ident),
qual AS (SELECT *, max(CASE WHEN blocking_code IS NULL THEN provider_event_sequence END) OVER (PARTITION BY provider_id, instance_id, record_type, local_id ORDER BY arrival_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM rep),
judged AS (SELECT *, CASE WHEN blocking_code IS NULL AND has_identity AND provider_event_sequence < top THEN 'SMPP_PROVIDER_EVENT_OUT_OF_ORDER' WHEN blocking_code IS NULL AND has_identity AND provider_event_sequence > top + 1 THEN 'SMPP_PROVIDER_EVENT_SEQUENCE_GAP' END AS reason FROM qual),
accepted AS (SELECT * FROM judged WHERE blocking_code IS NULL),
facts AS (SELECT *, {uuid5("'smpp|' || record_id || '|' || record_type")} AS fact_id,
  'urn:telemetry:' || tenant_id || ':smpp:dep-1:runtime:' || instance_id AS runtime_urn, 'urn:telemetry:' || tenant_id || ':smpp:dep-1:provider:' || provider_id AS provider_urn,
  'urn:telemetry:' || tenant_id || ':smpp:dep-1:task:' || task_id AS task_urn, 'urn:telemetry:' || tenant_id || ':smpp:dep-1:resource:' || resource_id AS resource_urn,
  'urn:telemetry:' || tenant_id || ':smpp:dep-1:execution:' || external_execution_id AS execution_urn,
  received_at + INTERVAL '1' SECOND AS normalized_at, received_at + INTERVAL '2' SECOND AS projected_at FROM accepted),
core AS (SELECT f.*, coalesce(task_urn, resource_urn, provider_urn) AS primary_urn, t.core_table FROM facts f LEFT JOIN (VALUES {_CORE}) t(record_type, core_table) USING (record_type)),
origin AS (SELECT f.*, unnest(list_sort(list_distinct(['st-' || (src % 7), 'st-' || (src % 3)]))) AS origin_id FROM facts f WHERE src % 4 = 0),
rel AS (SELECT *, {uuid5("fact_id || '|' || source_urn || '|' || target_urn || '|invokes'")} AS relation_id FROM (
  SELECT *, 'urn:telemetry:' || tenant_id || ':sdar:o-1:task:' || origin_id AS source_urn, coalesce(task_urn, provider_urn) AS target_urn FROM origin) o)
"""


def oracle(select: str) -> str:
    return PRELUDE + select
