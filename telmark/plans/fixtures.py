"""Telemetry records derived from the ``events`` table by per-row arithmetic, as envelope columns.

The same expressions serve Spark and the SQL oracle; ``dialect`` fills in the few differences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telmark import contracts as C
from telmark.operators.mapping import MAPPING_SCHEMA

DIALECTS = {
    "spark": {"sha": lambda x: f"sha2({x}, 256)", "div": lambda a, b: f"(({a}) div ({b}))", "pick": lambda items, i: f"element_at(array({items}), cast({i} AS INT))", "ts": "date_trunc('MILLISECOND', cast(ts AS TIMESTAMP))", "string": "STRING", "list": lambda items: f"array({items})"},
    "duckdb": {"sha": lambda x: f"sha256({x})", "div": lambda a, b: f"(({a}) // ({b}))", "pick": lambda items, i: f"([{items}])[{i}]", "ts": "date_trunc('milliseconds', ts)", "string": "VARCHAR", "list": lambda items: f"[{items}]"},
}


def telemetry_sql(dialect: str) -> str:
    """SELECT of all envelope columns from ``events``."""
    d = DIALECTS[dialect]
    s = d["string"]
    types = ", ".join(f"'{t}'" for t in C.RECORD_TYPES)
    cats = ", ".join(f"'{c}'" for c in C.CATEGORY_OF.values())
    t = lambda x: f"CAST({x} AS {s})"
    return f"""
SELECT arrival_seq, src, 'smpp' AS source_system, '{C.SCHEMA_NAME}' AS schema_name,
  CASE WHEN arrival_seq % 103 = 5 THEN '2.0.0' ELSE '{C.SCHEMA_VERSION}' END AS schema_version,
  concat(substr(rh, 1, 8), '-', substr(rh, 9, 4), '-5', substr(rh, 14, 3), '-a', substr(rh, 18, 3), '-', substr(rh, 21, 12)) AS record_id,
  {d["sha"](f"concat('hash|', {t('src')}, CASE WHEN arrival_seq % 100 = 99 THEN '|x' ELSE '' END)")} AS record_hash,
  {d["pick"](types, "src % 16 + 1")} AS record_type, {d["pick"](cats, "src % 16 + 1")} AS event_category,
  CASE WHEN src % 2 = 0 THEN 'audit' ELSE 'operational' END AS delivery_class,
  CASE WHEN src % 16 >= 9 THEN 'provider-0' ELSE concat('provider-', {t('src % 5')}) END AS provider_id,
  CASE WHEN src % 16 >= 9 THEN 'runtime-0' ELSE concat('runtime-', {t('src % 2')}) END AS instance_id,
  '2.0.0' AS runtime_version, 'gateway-1' AS collector_id, 'local' AS trust_domain, 'dep-1' AS deployment_id,
  CASE WHEN faultless AND src % 16 IN (0, 1) THEN concat('task-', {t('src % 97')}) END AS task_id,
  CASE WHEN faultless AND src % 16 IN (5, 6, 7) THEN concat('res-', {t('src % 41')}) END AS resource_id,
  CASE WHEN faultless AND src % 16 = 8 THEN concat('exec-', {t('src % 61')}) END AS external_execution_id,
  CASE WHEN faultless AND src % 16 = 1 THEN concat('cmd-', {t('src % 89')}) END AS external_command_id,
  CASE WHEN faultless AND src % 16 >= 9 THEN 'bev' END AS provider_event_id,
  CASE WHEN src % 16 >= 9 THEN CASE WHEN k % 10 = 3 THEN k + 5 ELSE k END END AS provider_event_sequence,
  CASE WHEN arrival_seq % 107 = 3 THEN upper(concat('F', substr(rh, 2, 31))) ELSE substr(rh, 1, 32) END AS trace_id, substr(rh, 33, 16) AS span_id,
  concat('op-', {t('src % 7')}) AS operation_name,
  occurred_at, occurred_at + CASE WHEN arrival_seq % 101 = 7 THEN INTERVAL '-1' SECOND ELSE INTERVAL '120' MILLISECOND END AS emitted_at, occurred_at + INTERVAL '1' SECOND AS received_at,
  CASE WHEN src % 4 = 0 THEN concat('{{"correlation":{{"originSystem":"sdar","originDeploymentId":"o-1","originTaskIds":["st-', {t('src % 7')}, '","st-', {t('src % 3')}, '","st-', {t('src % 7')}, '"]}}}}') ELSE '{{}}' END AS attributes_json,
  concat('{{"state":"', {d["pick"]("'ready', 'busy', 'degraded', 'offline'", "user_id % 4 + 1")}, '","k":', regexp_extract(props, '[0-9]+', 0), '}}') AS payload_json, value
FROM (SELECT *, {d["sha"](f"concat('rec|', {t('src')})")} AS rh, {d["div"]("src", "16")} AS k, arrival_seq % 109 <> 2 AS faultless
  FROM (SELECT event_id AS arrival_seq, CASE WHEN event_id % 50 = 49 AND (event_id - 1) % 16 < 9 THEN event_id - 1 ELSE event_id END AS src, {d["ts"]} AS occurred_at, user_id, props, value FROM events) x) y
"""


#: Events that a task takes at most, and at least as long as cores are idle.
TASK_ROWS, LEAST_ROWS = 100_000, 5_000


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table, dealt to tasks by rows: a file is read in as few tasks as it has row groups, and each event becomes work of many times its size."""
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = df.count()
    tasks = max(-(-rows // TASK_ROWS), min(-(-rows // LEAST_ROWS), 2 * spark.sparkContext.defaultParallelism))
    # By a hash of the key: a task that is tried again gets the rows that it had.
    return df.repartition(tasks, "event_id") if tasks > 1 else df


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = telemetry_sql("spark").replace("INTERVAL '120' MILLISECOND", "INTERVAL '0.120' SECOND")
    view = f"events_{uuid.uuid4().hex}"
    events(spark, sf_dir).createOrReplaceTempView(view)
    df = spark.sql(sql.replace("FROM events)", f"FROM {view})"))
    spark.catalog.dropTempView(view)
    nothing = ("correlation_id", "causation_record_id", "priority", "resource_type", "event_type", "execution_mode", "simulation_id", "argument_hash", "authorization_context_hash", "adapter_revision")
    return df.withColumns({c: F.lit(None).cast("string") for c in nothing} | {c: F.lit(None).cast("bigint") for c in ("observation_revision", "command_sequence")})


def mapping_rows() -> list[tuple]:
    """Providers 0 to 3, one tenant before and one from the middle of January 2024; provider 4 has none."""
    import datetime

    utc = datetime.timezone.utc
    cut, start = datetime.datetime(2024, 1, 15, tzinfo=utc), datetime.datetime(2024, 1, 1, tzinfo=utc)
    out = []
    for p in range(4):
        for i, (tenant, a, b) in enumerate((("t1", start, cut), ("t2", cut, None))):
            out.append((2 * p + i, "gateway-1", "local", "dep-1", f"provider-{p}", "*", f"src-{p}", tenant, "p1", "test", "product", 4, 1, ["standalone-smpp"], "active", a, b))
    return out


def mappings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(mapping_rows(), MAPPING_SCHEMA)
