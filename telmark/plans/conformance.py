"""Conformance inputs derived from ``events``: export requests in each mode, and payloads of each record type, with their expected codes."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telmark import contracts as C
from telmark.functions import scalars as S
from telmark.operators import classify, mapping, validate
from telmark.sources import otlp

#: Seven records in a row are one source record in each mode.
MODES = ("original", "conflict", "outage-recovery", "malformed", "oversized", "sensitive", "unselected")
TRUSTED = {"collector_id": "gateway-1", "trust_domain": "local", "deployment_id": "dep-1"}

#: A payload that the catalog takes, and one that it does not, by record type.
PAYLOADS: dict[str, tuple[dict, dict]] = {
    "provider.task.lifecycle": ({"currentState": "completed", "observedAt": "2026-08-18T01:02:03.004Z", "terminalStatus": "completed"}, {"observedAt": "yesterday"}),
    "provider.command.lifecycle": ({"externalCommandId": "cmd-1", "currentState": "sent"}, {"externalCommandId": 7}),
    "provider.scheduler.decision": ({"reasonCode": "QUEUE", "providerRevision": "r1"}, {"reasonCode": False}),
    "provider.recovery.lifecycle": ({"currentState": "done", "providerSubstate": "idle"}, {"currentState": []}),
    "provider.ttl.lifecycle": ({"currentState": "expired"}, {"terminalStatus": None}),
    "provider.resource.state": ({"state": "ready", "observedAt": "2026-08-18T01:02:03Z"}, {"state": 3}),
    "provider.resource.metric": ({"value": 3, "providerRevision": "r2"}, {"providerRevision": {}}),
    "provider.resource.health": ({"status": "ok", "reasonCode": "NONE"}, {"status": ""}),
    "provider.execution.progress": ({"progressPercent": 50}, {"progressPercent": 101}),
    "provider.business_event.source.lifecycle": ({"currentState": "open"}, {"currentState": {"a": 1}}),
    "provider.business_event.ingest.lifecycle": ({"reasonCode": "x" * 512}, {"reasonCode": "x" * 513}),
    "provider.business_event.publication.lifecycle": ({"providerRevision": "3"}, {"providerRevision": 3}),
    "provider.business_event.stream.lifecycle": ({"observedAt": "2026-08-18T01:02:03.123456789Z"}, {"observedAt": "2026-08-18T01:02:03"}),
    "provider.business_event.continuity": ({}, {"observedAt": "2026-13-18T01:02:03Z"}),
    "provider.business_event.delivery.lifecycle": ({"terminalStatus": "delivered"}, {"terminalStatus": True}),
    "provider.business_event.relation.lifecycle": ({"currentState": "linked", "extra": 1}, {"currentState": None}),
}


def payloads(records: DataFrame) -> DataFrame:
    """V4. ``(arrival_seq, record_type, payload_json, valid)``: each record with one of its type's two payloads."""
    pick = F.create_map(*[x for t, (good, bad) in PAYLOADS.items() for x in (F.lit(t), F.array(F.lit(json.dumps(good)), F.lit(json.dumps(bad))))])
    odd = F.expr("arrival_seq div 16 % 2").cast("int")
    return records.select("arrival_seq", "record_type", F.element_at(pick[F.col("record_type")], odd + 1).alias("payload_json"), (odd == 0).alias("valid"))


_ATTRIBUTES = '{"source":"provider_telemetry_ingress"}'


def _by_mode(mode: Column, made: Callable[[Column], Column]) -> Column:
    """What is made of a mode's payload, a constant."""
    state = lambda reason, state: F.lit(json.dumps({"reasonCode": reason, "state": state}, separators=(",", ":")))
    long = F.concat(F.lit('{"diagnostic":"'), F.repeat(F.lit("x"), F.lit(20_000)), F.lit('"}'))
    out = made(state("HEALTHY", "ready"))
    for i, text in ((1, state("CONFLICT", "degraded")), (2, state("RECOVERED", "ready")), (4, long), (5, F.lit('{"password":"must-not-persist"}'))):
        out = F.when(mode == i, made(text)).otherwise(out)
    return out


def envelopes(records: DataFrame) -> DataFrame:
    """Envelopes of the modes, as fields, with their true hashes. Only the original of a group of seven and its recovery are to be accepted."""
    group, mode = F.expr("arrival_seq div 7"), (F.col("arrival_seq") % 7).cast("int")
    recovered = mode == 2
    own = F.when(mode.isin(0, 1), F.concat(F.lit("group|"), group.cast("string"))).otherwise(F.concat(F.lit("one|"), F.col("arrival_seq").cast("string")))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    fields: dict[str, Column] = {
        "schemaName": F.lit(C.SCHEMA_NAME), "schemaVersion": F.lit(C.SCHEMA_VERSION), "recordId": S.uuid_v5(own), "recordType": F.lit("provider.resource.state"), "eventCategory": F.lit("resource.state"),
        "deliveryClass": F.when(mode != 3, "audit"), "providerId": F.lit("provider-1"), "runtimeVersion": F.lit("2.0.0"), "instanceId": F.lit("runtime-1"), "resourceId": F.concat(F.lit("res-"), group.cast("string")),
        "providerEventId": F.when(recovered, "recovery").otherwise("source"), "occurredAt": iso("occurred_at"), "emittedAt": iso(F.col("occurred_at") + F.expr("INTERVAL 0.25 SECOND")),
    }
    sequence = F.when(recovered, 2).otherwise(1)
    out = records.select("arrival_seq", mode.alias("mode"), *[v.alias(k) for k, v in fields.items()], sequence.cast("long").alias("providerEventSequence"), _by_mode(mode, lambda text: text).alias("payload"))
    members = {k: F.col(k) for k in [*fields, "providerEventSequence"]} | {"attributes": F.parse_json(F.lit(_ATTRIBUTES)), "payload": _by_mode(F.col("mode"), F.parse_json)}
    # The hashed members in order, which is the canonical text. Settled, so that hashes are made once; not written, since the texts are many times the records.
    hashed = F.to_json(F.struct(*[members[k].alias(k) for k in sorted(members) if k not in C.HASH_EXCLUDED]))
    return S.settled(out, {k: F.col(k) for k in fields} | {"recordHash": F.sha2(hashed, 256)})


def requests(records: DataFrame) -> DataFrame:
    """V5. Export requests with one log record for each envelope; ``timeUnixNano`` carries the arrival."""
    e = envelopes(records)
    none = lambda kind: F.lit(None).cast(kind)
    kv = "array<struct<key:string,value:struct<stringValue:string>>>"
    value = lambda text=None, number=None, items=None: F.struct((none("string") if text is None else text).alias("stringValue"), (none("string") if number is None else number).alias("intValue"), (none(f"struct<values:{kv}>") if items is None else items).alias("kvlistValue"))
    pair = lambda key, v: F.struct(F.lit(key).alias("key"), v.alias("value"))
    flat = lambda text: F.struct(F.transform(F.map_entries(F.from_json(text, "map<string,string>")), lambda x: F.struct(x["key"].alias("key"), F.struct(x["value"].alias("stringValue")).alias("value"))).cast(kv).alias("values"))
    names = [c for c in e.columns if c not in ("arrival_seq", "mode", "payload", "providerEventSequence")]
    body = [F.when(F.col(c).isNotNull(), pair(c, value(F.col(c)))) for c in names]
    body += [pair("providerEventSequence", value(number=F.col("providerEventSequence").cast("string"))), pair("attributes", value(items=flat(F.lit(_ATTRIBUTES)))), pair("payload", value(items=_by_mode(F.col("mode"), flat)))]
    plain = lambda key, v: F.struct(F.lit(key).alias("key"), F.struct(v.alias("stringValue")).alias("value"))
    unselected = F.col("mode") == 6
    attributes = F.array(
        plain("sdar.schema.name", F.when(unselected, "example.unselected").otherwise(F.col("schemaName"))), plain("sdar.schema.version", F.when(unselected, "1.0.0").otherwise(F.col("schemaVersion"))),
        plain("sdar.record.id", F.col("recordId")), plain("sdar.record.hash", F.col("recordHash")),
    )
    log = F.struct(attributes.alias("attributes"), F.col("arrival_seq").cast("string").alias("timeUnixNano"), F.struct(F.struct(F.array_compact(F.array(*body)).alias("values")).alias("kvlistValue")).alias("body"))
    resource = F.struct(F.array(plain("service.name", F.lit("provider"))).alias("attributes"))
    request = F.struct(F.array(F.struct(resource.alias("resource"), F.array(F.struct(F.struct(F.lit("s").alias("name")).alias("scope"), F.array(log).alias("logRecords"))).alias("scopeLogs"))).alias("resourceLogs"))
    return e.select(F.to_json(request).alias("request_json"))


def through_the_chain(requests: DataFrame, mappings: DataFrame, received_at: Column) -> DataFrame:
    """Requests flattened, selected, stamped, checked, mapped and assessed: ``arrival_seq, outcome, error_code`` of each record that is selected."""
    logs = otlp.stamp_contract(otlp.stamp_trusted_ingress(otlp.select_provider_ops(otlp.flatten_otlp_logs(requests)), TRUSTED))
    logs = validate.validate_ingress(logs).filter("ingress_code IS NULL")
    rows = logs.select(F.col("time_unix_nano").cast("long").alias("arrival_seq"), received_at.alias("received_at"), F.col("body_json").alias("envelope_json"), F.col("attributes").alias("otlp"), F.col("context.deployment_id").alias("deployment_id"), F.col("context.collector_id").alias("collector_id"), F.col("context.trust_domain").alias("trust_domain"))
    checked = mapping.resolve_source_mapping(validate.validate_envelopes(validate.parse_envelopes(rows)), mappings)
    checked = checked.withColumn("error_code", F.coalesce("error_code", F.when(F.col("mapping").isNull(), "SOURCE_UNMAPPED")))
    # Only what is judged is written: texts are many times as large.
    judged = classify.with_identity(checked).select("arrival_seq", *[c for c in classify.JUDGED if c in checked.columns], "identity", "revision", "terminal", "error_code")
    out = classify.assess(judged, F.col("error_code").isNull())
    return out.select("arrival_seq", F.coalesce("outcome", F.lit("rejected")).alias("outcome"), F.coalesce("error_code", "blocking_code").alias("error_code"))
