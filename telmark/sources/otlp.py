"""Telemetry log exports: nested request JSON to one row per log record, selection and trusted attributes."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telmark import contracts as C
from telmark.functions import scalars as S


def read_envelopes(spark: SparkSession, path: str, stream: bool = False, format: str = "text") -> DataFrame:  # noqa: A002
    """S3. Envelope JSON lines (or a Parquet table with ``envelope_json``) as a batch or stream."""
    reader = spark.readStream if stream else spark.read
    if format == "text":
        return reader.format("text").load(path).withColumnRenamed("value", "envelope_json")
    return reader.schema("envelope_json string, received_at timestamp, arrival_seq bigint").format(format).load(path)


def _plain(value: object) -> object:
    if not isinstance(value, dict):
        return None
    if "stringValue" in value:
        return value["stringValue"]
    if "boolValue" in value:
        return bool(value["boolValue"])
    if "intValue" in value:
        try:
            n = int(value["intValue"])
        except (TypeError, ValueError):
            return str(value["intValue"])
        return n if abs(n) <= 2**53 - 1 else str(value["intValue"])
    if "doubleValue" in value:
        return float(value["doubleValue"])
    if "bytesValue" in value:
        return value["bytesValue"]
    if value.get("arrayValue"):
        return [_plain(v) for v in value["arrayValue"].get("values") or []]
    if value.get("kvlistValue"):
        return {e.get("key"): _plain(e.get("value")) for e in value["kvlistValue"].get("values") or []}
    return None


_ENCODER = json.JSONEncoder(ensure_ascii=False, separators=(",", ":"))


@F.pandas_udf(T.StringType())
def _plain_json(values: pd.Series) -> pd.Series:
    return values.map(lambda t: None if t is None else _ENCODER.encode(_plain(json.loads(t))))


def _anyvalue_forms(value: Column) -> Column:
    """``struct(odd, plain)``: the plain JSON of a string, or the tagged value if it is none."""
    return S.let(F.get_json_object(value, "$.stringValue"), lambda t: F.struct(F.when(t.isNull(), value).alias("odd"), F.when(t.isNotNull(), F.to_json(t.cast("variant"))).alias("plain")))


def _anyvalue_of(forms: Column) -> Column:
    return F.coalesce(forms["plain"], _plain_json(forms["odd"]))


def anyvalue_to_json(value: Column) -> Column:
    """S2. A tagged value's JSON text to plain JSON text. Strings, which most are, stay in the JVM."""
    return _anyvalue_of(_anyvalue_forms(value))


def _attributes(json_array: Column) -> Column:
    """A list of key and tagged value to a map of texts; the last of equal keys wins."""
    items = F.from_json(json_array, "array<struct<key:string,value:string>>")
    value = lambda v: F.coalesce(F.get_json_object(v, "$.stringValue"), F.get_json_object(v, "$.intValue"), F.get_json_object(v, "$.doubleValue"), F.get_json_object(v, "$.boolValue"), F.get_json_object(v, "$.bytesValue"))
    entries = F.transform(items, lambda i: F.struct(i["key"].alias("key"), value(i["value"]).alias("value")))

    def merged(e: Column) -> Column:
        keys = F.array_distinct(F.transform(e, lambda x: x["key"]))
        last = lambda k: F.element_at(F.filter(e, lambda x: x["key"] == k), -1)["value"]
        return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), last(k).alias("value"))))

    # The list is parsed once, not again for each of its keys.
    return F.coalesce(S.let(entries, merged), F.create_map().cast("map<string,string>"))


def flatten_otlp_logs(requests: DataFrame, column: str = "request_json") -> DataFrame:
    """S1. One row per log record with resource and scope copied down; camelCase and snake_case keys."""
    items = lambda text: F.from_json(text, "array<string>")
    text = lambda c, default: F.coalesce(c, F.lit(default))
    # Each text is read in one pass for all its members; resource and scope are read once for all their records.
    r = requests.select(F.json_tuple(column, "resourceLogs", "resource_logs").alias("_a", "_b")).select(F.explode(items(F.coalesce("_a", "_b"))).alias("rl"))
    s = r.select(F.json_tuple("rl", "resource", "scopeLogs", "scope_logs").alias("_r", "_a", "_b")).select(F.get_json_object("_r", "$.attributes").alias("ra"), F.explode(items(F.coalesce("_a", "_b"))).alias("sl"))
    s = s.select("ra", F.json_tuple("sl", "scope", "logRecords", "log_records").alias("_s", "_a", "_b"))
    name = lambda k: text(F.get_json_object("_s", f"$.{k}"), "").alias(k)
    s = s.select(_attributes(F.col("ra")).alias("resource"), F.struct(name("name"), name("version")).alias("scope"), F.coalesce("_a", "_b").alias("records"))
    g = s.select("resource", "scope", F.explode(items(F.col("records"))).alias("lr"))
    pairs = [("eventName", "event_name", ""), ("timeUnixNano", "time_unix_nano", "0"), ("traceId", "trace_id", ""), ("spanId", "span_id", "")]
    members = ["body", "attributes", *[k for camel, snake, _ in pairs for k in (camel, snake)]]
    g = g.select("resource", "scope", F.json_tuple("lr", *members).alias(*[f"_{k}" for k in members]))
    g = S.settled(g, {"_body": _anyvalue_forms(F.col("_body"))})
    either = {snake: text(F.coalesce(f"_{camel}", f"_{snake}"), default).alias(snake) for camel, snake, default in pairs}
    return g.select(
        "resource", "scope", either["event_name"], _anyvalue_of(F.col("_body")).alias("body_json"), _attributes(F.col("_attributes")).alias("attributes"),
        either["time_unix_nano"], either["trace_id"], either["span_id"],
    )


def select_provider_ops(logs: DataFrame) -> DataFrame:
    """P1. Records that carry the contract's attributes and an object body of its schema."""
    a = F.col("attributes")
    # A filter that reaches the scan would parse the attributes again for each of its terms.
    made = S.settled(logs, {"attributes": a, "body_json": F.col("body_json")}).select(logs.columns)
    return made.filter(
        a["sdar.record.id"].isNotNull() & a["sdar.record.hash"].isNotNull() & a["sdar.schema.name"].eqNullSafe(C.SCHEMA_NAME) & a["sdar.schema.version"].eqNullSafe(C.SCHEMA_VERSION) & F.get_json_object("body_json", "$.schemaName").eqNullSafe(C.SCHEMA_NAME)
    )


def _upsert(column: str, values: dict[str, Column]) -> Column:
    kept = F.map_filter(F.coalesce(F.col(column), F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(list(values)))
    return F.map_concat(kept, F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)]))


def stamp_trusted_ingress(logs: DataFrame, trusted: dict[str, str]) -> DataFrame:
    """P2. Overwrites the five trusted resource attributes, whatever the sender claims."""
    names = {"telemetry.source.system": C.SOURCE_SYSTEM, "telemetry.source.collector_id": trusted["collector_id"], "telemetry.source.trust_domain": trusted["trust_domain"], "telemetry.source.deployment_id": trusted["deployment_id"], "telemetry.ingress.mode": trusted.get("ingress_mode", "gateway")}
    return logs.withColumn("resource", _upsert("resource", {k: F.lit(v) for k, v in names.items()}))


def stamp_contract(logs: DataFrame) -> DataFrame:
    """P3. Channel and contract attributes, from the schema attributes."""
    a = F.col("attributes")
    return logs.withColumn("attributes", _upsert("attributes", {"telemetry.channel": F.lit(C.CHANNEL), "telemetry.contract.name": a["sdar.schema.name"], "telemetry.contract.version": a["sdar.schema.version"]}))


def stamp_runtime_metrics(metrics: DataFrame, trusted: dict[str, str]) -> DataFrame:
    """P4. Five trusted resource attributes on metric rows."""
    names = {"telemetry.source.system": C.SOURCE_SYSTEM, "telemetry.channel": "smpp.runtime_metrics", "telemetry.source.deployment_id": trusted["deployment_id"], "telemetry.source.runtime_instance_id": trusted["runtime_instance_id"], "telemetry.source.provider_id": trusted["provider_id"]}
    return metrics.withColumn("resource", _upsert("resource", {k: F.lit(v) for k, v in names.items()}))
