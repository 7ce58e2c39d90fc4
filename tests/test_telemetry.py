"""Telemetry operators against vectors of the data contract and small fixtures."""

import datetime
import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from telmark import contracts as C
from telmark.functions import scalars as S
from telmark.operators import classify, mapping, normalize, project, serving, validate, verify
from telmark.plans import fixtures, pipeline
from telmark.sources import otlp, tables

SF = "/root/testdata/sf0.001"
GOLDEN = {
    "schemaName": "sdar.provider.ops.event", "schemaVersion": "1.1.0", "recordId": "6eb4e972-be6e-5708-98ef-95dd5f263b96", "recordHash": "57afebfcb2fcd7b2eb7a7ea2b79f7348d57b279ebf06cb87fe0a03621440dfee",
    "recordType": "provider.resource.state", "eventCategory": "resource.state", "deliveryClass": "audit", "providerId": "isr.vehicle.ugv.ugv1", "runtimeVersion": "2.0.0-rc.1", "instanceId": "any",
    "resourceId": "ugv-01", "resourceType": "ugv", "providerEventId": "source-vector-001", "providerEventSequence": 1, "eventType": "resource.state", "traceId": "0123456789abcdef0123456789abcdef",
    "spanId": "0123456789abcdef", "occurredAt": "2026-08-12T08:00:00.000Z", "emittedAt": "2026-08-12T08:00:00.100Z", "attributes": {"source": "provider_telemetry_ingress"}, "payload": {"state": "ready", "reasonCode": "HEALTHY"},
}


def one(spark, columns, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], names) if names else spark.range(1)
    return df.select(*columns).first()


def test_record_hash_golden(spark):
    df = spark.createDataFrame([(json.dumps(GOLDEN),), (json.dumps(GOLDEN | {"emittedAt": "x", "instanceId": "y"}),)], "t string")
    assert [r[0] for r in df.select(S.record_hash(F.col("t"))).collect()] == [GOLDEN["recordHash"]] * 2


@pytest.mark.parametrize(("text", "canonical"), [
    ('{"b":1,"a":2}', '{"a":2,"b":1}'), ('{"x":1e21,"y":1e-7}', '{"x":1e+21,"y":1e-7}'), ('[1.0,100.50,-0]', "[1,100.5,0]"), ('{"n":12345678901234567890}', '{"n":12345678901234567000}'), ("nope", None),
])
def test_canonical_json(spark, text, canonical):
    assert one(spark, [S.canonical_json(F.col("t")).alias("c")], t=text)["c"] == canonical


def test_uuid_v5_matches_standard(spark):
    names = ["a", "smpp|x|y", "ü€"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "t string").select(S.uuid_v5(F.col("t"))).collect()]
    assert got == [str(uuid.uuid5(uuid.UUID(C.UUID_NAMESPACE), n)) for n in names]
    S.register_sql_functions(spark)
    assert spark.sql("SELECT uuid_v5('smpp|x|y')").first()[0] == got[1]


def test_urn_round_trip_and_rejects(spark):
    ids = ["task-1", "a b", "x+y", "é/ü", "%", "(a)!*'~"]
    df = spark.createDataFrame([(i,) for i in ids], "i string")
    urn = S.entity_urn(F.lit("t 1"), F.lit("smpp"), F.lit("dep-1"), F.lit("task"), F.col("i"))
    assert [r["e"] for r in df.select(S.parse_urn(urn)["entity_id"].alias("e")).collect()] == ids
    bad = ["", "urn:telemetry:t1:smpp:dep-1:task", "urn:telemetry:t1:SMPP:dep-1:task:task-1", "urn:telemetry:t1:smpp:dep-1:task:%74ask-1", None]
    assert all(r[0] is None for r in spark.createDataFrame([(b,) for b in bad], "u string").select(S.parse_urn(F.col("u"))).collect())


VALID = [
    ("provider.task.lifecycle", '{"currentState":"completed","observedAt":"2026-08-18T01:02:03.004Z","terminalStatus":"completed"}'), ("provider.command.lifecycle", '{"externalCommandId":"cmd-1"}'),
    ("provider.resource.state", '{"state":"available"}'), ("provider.execution.progress", '{"progressPercent":50}'), ("provider.business_event.continuity", "{}"),
]
INVALID = [
    ("provider.task.lifecycle", '{"observedAt":"not-utc"}'), ("provider.command.lifecycle", '{"externalCommandId":7}'), ("provider.scheduler.decision", '{"reasonCode":false}'), ("provider.recovery.lifecycle", '{"currentState":[]}'),
    ("provider.ttl.lifecycle", '{"terminalStatus":null}'), ("provider.resource.state", '{"state":3}'), ("provider.resource.metric", '{"providerRevision":{}}'), ("provider.execution.progress", '{"progressPercent":101}'), ("provider.resource.health", "[]"),
]


def test_payload_catalog(spark):
    df = spark.createDataFrame(VALID + INVALID, "t string, p string").select(S.payload_semantics(F.col("t"), F.col("p"))["error_code"].alias("e"))
    codes = [r["e"] for r in df.collect()]
    assert codes == [None] * len(VALID) + ["SMPP_PAYLOAD_CONTRACT_INVALID"] * len(INVALID)


OTLP = {"sdar.schema.name": C.SCHEMA_NAME, "sdar.schema.version": "1.1.0", "sdar.record.id": GOLDEN["recordId"], "sdar.record.hash": GOLDEN["recordHash"], "telemetry.contract.version": "1.1.0"}


def rehash(spark, envelope):
    h = one(spark, [S.record_hash(F.col("t")).alias("h")], t=json.dumps(envelope))["h"]
    return envelope | {"recordHash": h}


CASES = [
    ({}, {}, None), ({"schemaName": "x"}, {}, "SCHEMA_NAME_INVALID"), ({"schemaVersion": "2"}, {}, "SCHEMA_VERSION_UNSUPPORTED"), ({"recordId": "x"}, {}, "RECORD_ID_INVALID"), ({"recordType": "x"}, {}, "RECORD_TYPE_UNSUPPORTED"),
    ({"deliveryClass": "durable"}, {}, "DELIVERY_CLASS_UNSUPPORTED"), ({"providerId": ""}, {}, "SOURCE_IDENTITY_MISSING"), ({"traceId": "ABC"}, {}, "TRACE_ID_INVALID"), ({"emittedAt": "2026-08-12T07:00:00Z"}, {}, "SMPP_EVENT_TIME_INVALID"),
    ({"occurredAt": "soon"}, {}, "TIMESTAMP_INVALID"), ({"eventCategory": "command.dispatch"}, {}, "RECORD_EVENT_CATEGORY_MISMATCH"), ({"resourceId": ""}, {}, "PROVIDER_LOCAL_IDENTITY_MISSING"),
    ({"payload": {"episodeId": 1}}, {}, "SMPP_EVALUATION_DOMAIN_IDENTITY_FORBIDDEN"), ({"attributes": {"originTaskId": "x"}}, {}, "SMPP_ORIGIN_METADATA_INVALID"),
    ({"attributes": {"correlation": {"originTaskIds": ["a"]}}}, {}, "SMPP_ORIGIN_SYSTEM_MISSING"), ({"attributes": {"correlation": {"originTaskIds": ["a"], "originSystem": "sdar"}}}, {}, "SMPP_ORIGIN_DEPLOYMENT_MISSING"),
    ({"attributes": {"correlation": {"originTaskIds": [f"a{i}" for i in range(65)], "originSystem": "x"}}}, {}, "SMPP_ORIGIN_METADATA_TOO_LARGE"),
    ({}, {"sdar.record.id": ""}, "OTLP_CONTRACT_ATTRIBUTE_MISSING"), ({}, {"sdar.schema.version": "1"}, "OTLP_SCHEMA_VERSION_MISMATCH"), ({"eventType": "changed"}, "keep", "RECORD_HASH_MISMATCH"),
    ({"payload": {"password": "x"}}, {}, "SENSITIVE_KEY_DETECTED"), ({"payload": {"a": "Bearer abc"}}, {}, "SENSITIVE_VALUE_DETECTED"), ({"payload": {"a": "x" * 20000}}, {}, "STRING_TOO_LONG"), ({"payload": {"a": list(range(1001))}}, {}, "ARRAY_TOO_LONG"),
    ({"payload": json.loads("[" * 14 + "]" * 14)}, {}, "PAYLOAD_TOO_DEEP"),
]


def test_validation_chain(spark):
    rows = []
    for change, attrs, _ in CASES:
        e = GOLDEN | change
        e = e if attrs == "keep" else rehash(spark, e)
        o = OTLP | {"sdar.record.id": e["recordId"], "sdar.record.hash": e["recordHash"], "sdar.schema.version": e["schemaVersion"], "sdar.schema.name": e["schemaName"]} | ({} if attrs == "keep" else attrs)
        rows.append((len(rows), json.dumps(e), o))
    missing = {k: v for k, v in GOLDEN.items() if k not in ("payload", "runtimeVersion")}
    rows += [(100, json.dumps(missing), OTLP), (101, "[1]", OTLP), (102, None, OTLP), (103, "{", OTLP)]
    df = spark.createDataFrame(rows, "i int, envelope_json string, otlp map<string,string>")
    got = {r["i"]: (r["error_code"], r["error_message"]) for r in validate.validate_envelopes(validate.parse_envelopes(df)).select("i", "error_code", "error_message").collect()}
    assert [got[i][0] for i in range(len(CASES))] == [c for _, _, c in CASES]
    assert got[100] == ("REQUIRED_FIELD_MISSING", "runtimeVersion")
    assert [got[i][0] for i in (101, 102, 103)] == ["ENVELOPE_NOT_OBJECT"] * 3


def events(spark, rows):
    schema = "arrival_seq long, provider_id string, record_id string, record_hash string, identity string, revision string, terminal string, provider_event_sequence long"
    return spark.createDataFrame([(i, "p", *r) for i, r in enumerate(rows)], schema)


VECTORS = [
    ([("a", "1", "i", None, None, 1), ("b", "2", "i", None, None, 3), ("c", "3", "i", None, None, 2), ("d", "4", "i", None, None, 3)], ["accepted", "accepted_with_quality_issue", "accepted_with_quality_issue", "semantic_conflict"], ["", classify.GAP, classify.OUT_OF_ORDER, classify.SEQUENCE]),
    ([("a", "1", "i", "7", "completed", None), ("b", "2", "i", "7", "completed", None), ("c", "3", "i", "8", "failed", None)], ["accepted", "semantic_conflict", "semantic_conflict"], ["", classify.REVISION, classify.TERMINAL]),
    ([("a", "1", None, None, None, None), ("a", "1", None, None, None, None), ("a", "2", None, None, None, None)], ["not_applicable", "duplicate", "conflict"], ["", "", ""]),
    # A blocked first arrival leaves no trace: its id is new again.
    ([("a", "1", "i", None, None, 1), ("b", "2", "i", None, None, 1), ("b", "2", "i", None, None, 1)], ["accepted", "semantic_conflict", "semantic_conflict"], ["", classify.SEQUENCE, classify.SEQUENCE]),
]


@pytest.mark.parametrize(("rows", "outcomes", "reasons"), VECTORS)
def test_sequential_assessment(spark, rows, outcomes, reasons):
    got = classify.assess_sequential(events(spark, rows)).orderBy("arrival_seq").collect()
    assert [r["outcome"] for r in got] == outcomes
    assert [",".join(r["reason_codes"]) for r in got] == reasons


@pytest.mark.parametrize(("rows", "outcomes", "reasons"), VECTORS)
def test_assessment(spark, rows, outcomes, reasons):
    got = classify.assess(events(spark, rows)).orderBy("arrival_seq").collect()
    assert [r["outcome"] for r in got] == outcomes
    assert [",".join(r["reason_codes"]) for r in got] == reasons


def test_assessment_of_random_streams(spark):
    """Blocked first arrivals, chains of them, and record ids under several identities, against the fold over all."""
    rng = random.Random(3)
    rows = [(f"r{rng.randrange(60)}", f"h{rng.randrange(3)}", rng.choice(["i", "j", "k", None]), rng.choice([None, "1", "2", "3"]), rng.choice([None, None, "done", "failed"]), rng.choice([None, 1, 2, 3, 5])) for _ in range(250)]
    # The terminal state that blocks is blocked itself.
    rows += [("x1", "h1", "z", "7", "done", 1), ("x2", "h2", "z", "7", "failed", 2), ("x3", "h3", "z", "8", "failed", 1), ("x4", "h4", "z", "8", "done", 3)]
    store, want = classify.DictStore(), []
    names = ("record_id", "record_hash", "identity", "revision", "terminal", "provider_event_sequence")
    for r in rows:
        want.append(classify.fold(store, dict(zip(names, r, strict=True))))
    got = classify.assess(events(spark, rows)).orderBy("arrival_seq").collect()
    assert [(r["outcome"], r["accepted_hash"], list(r["reason_codes"])) for r in got] == want
    assert len({o for o, _, _ in want}) == 6


def test_windowed_equals_sequential(spark):
    r = mapping.resolve_source_mapping(validate.validate_envelopes(fixtures.telemetry(spark, SF)), fixtures.mappings(spark)).filter("error_code IS NULL AND mapping IS NOT NULL")
    ident = classify.with_identity(r)
    seq = {x["arrival_seq"]: x["outcome"] for x in classify.assess_sequential(ident).select("arrival_seq", "outcome").collect()}
    win = {x["arrival_seq"]: x["outcome"] for x in pipeline.classify_all(fixtures.telemetry(spark, SF), fixtures.mappings(spark)).outcomes().filter("outcome <> 'rejected'").collect()}
    assert seq == win and len(seq) > 500


def test_mapping_keeps_every_record(spark):
    """Null and repeated arrival numbers, providers without an entry, wildcards, and the first of several fits."""
    at = datetime.datetime(2024, 1, 20, tzinfo=datetime.timezone.utc)
    rows = [(None, p, at) for p in ("provider-1", "provider-9", None, "provider-1")] + [(7, "provider-2", at)] * 3
    records = spark.createDataFrame(rows, "arrival_seq long, provider_id string, received_at timestamp")
    got = mapping.resolve_source_mapping(records, fixtures.mappings(spark)).collect()
    assert sorted((r["provider_id"] or "", r["mapping"] and r["mapping"]["tenant_id"]) for r in got) == [("", None), ("provider-1", "t2"), ("provider-1", "t2"), ("provider-2", "t2"), ("provider-2", "t2"), ("provider-2", "t2"), ("provider-9", None)]
    first = fixtures.mapping_rows()[3]
    star = [(100, *first[1:4], "*", *first[5:7], "any", *first[8:]), (0, *first[1:4], "provider-2", *first[5:7], "early", *first[8:])]
    got = mapping.resolve_source_mapping(records, fixtures.mappings(spark).union(spark.createDataFrame(star, mapping.MAPPING_SCHEMA))).collect()
    assert {(r["provider_id"], r["mapping"]["tenant_id"]) for r in got} == {(None, "any"), ("provider-1", "t2"), ("provider-2", "early"), ("provider-9", "any")}


def test_escapes_do_not_hide_keys_and_values(spark):
    texts = [r'{"payload":{"pass\u0077ord":"x"}}', r'{"a":"Be\u0061rer abcdef"}', r'{"a":"fine\n"}', r'{"gr\u0061de":1}', '{"a":[{"grade":1}]}', "[" * 14 + '{"grade":1}' + "]" * 14, None, "{"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", validate.scan_sensitive(F.col("t")).alias("a"), validate.forbid_evaluation_identity(F.col("t")).alias("b")).orderBy("i").collect()
    assert [r["a"] for r in got] == ["SENSITIVE_KEY_DETECTED", "SENSITIVE_VALUE_DETECTED", None, None, None, "PAYLOAD_TOO_DEEP", None, None]
    assert [r["b"] is not None for r in got] == [False, False, False, True, True, False, False, False]


def test_mapping_file(spark, tmp_path):
    item = {"collectorId": "c", "trustDomain": "t", "deploymentId": "d", "providerId": "p", "instanceId": "i", "smppSourceId": "s", "tenantId": "t1", "projectId": "p1", "environment": "e", "mappingVersion": 4, "status": "active"}
    def write(**change):
        f = tmp_path / "m.json"
        f.write_text(json.dumps({"version": change.pop("version", 4), "mappings": [item | change]}))
        return str(f)
    rows = mapping.load_source_mappings(spark, write()).collect()
    assert rows[0]["route_ids"] == ["standalone-smpp"] and rows[0]["policy_version"] == 1
    for change, code in (({"version": 3}, "SOURCE_MAPPINGS_V4_REQUIRED"), ({"smppSourceId": ""}, "SMPP_SOURCE_MAPPING_ID_MISSING"), ({"instanceId": "*"}, "SOURCE_MAPPING_WILDCARD_FORBIDDEN"), ({"mappingVersion": 3}, "SOURCE_MAPPING_VERSION_INVALID")):
        with pytest.raises(ValueError, match=code):
            mapping.load_source_mappings(spark, write(**change))


def test_n_to_n_relations(spark):
    r = fixtures.telemetry(spark, SF).filter("record_type = 'provider.task.lifecycle' AND task_id IS NOT NULL").limit(2)
    corr = '{"correlation":{"originSystem":"sdar","originDeploymentId":"o","originTaskIds":["s2","s1","s1"],"originInvocationIds":["v"],"originRuntimeInstanceIds":["r"]}}'
    r = mapping.resolve_source_mapping(validate.normalize_correlation(r.withColumn("attributes_json", F.lit(corr)).withColumn("provider_id", F.lit("provider-1"))).drop("correlation_code"), fixtures.mappings(spark))
    edges = project.project_core_relations(normalize.normalize(r, F.lit("2024-02-01").cast("timestamp"))).collect()
    assert len(edges) == 8 and len({e["relation_id"] for e in edges}) == 8
    kinds = {e["relation_type"]: e["target_entity_urn"].split(":")[5] for e in edges}
    assert kinds == {"invokes": "task", "delegates_to": "task", "served_by": "provider"}


def test_fact_hash_ignores_normalization_time(spark):
    acc = pipeline.classify_all(fixtures.telemetry(spark, SF), fixtures.mappings(spark)).accepted.limit(5)
    at = lambda d: {r[0]: r[1] for r in pipeline.facts_of(acc, d).select("fact_id", "fact_hash").collect()}
    assert at("1 second") == at("9 seconds")


def test_parity_bounds_and_conflicts(spark):
    f = spark.createDataFrame([("a", "h", 0), ("b", "h", 0)], "fact_id string, fact_hash string, t long").withColumn("projected_at", F.timestamp_seconds("t"))
    rel = spark.createDataFrame([(["a", "b"],)], "evidence_fact_ids array<string>")
    row = verify.shadow_parity(f, f.withColumn("projected_at", F.col("projected_at") - F.expr("INTERVAL 0.5 SECOND")), rel, f, 1000, 1.0).first()
    assert row["status"] == "passed" and row["watermark_lag_ms"] == 500
    late = f.filter("fact_id = 'a'").withColumn("fact_hash", F.lit("x")).withColumn("projected_at", F.col("projected_at") - F.expr("INTERVAL 60 SECOND"))
    row = verify.shadow_parity(f, late, rel.limit(0), f, 1000, 1.0).first()
    assert (row["status"], row["missing"], row["hash_mismatch"], row["coverage"]) == ("failed", 1, 1, 0.0)
    with pytest.raises(ValueError, match="BOUND"):
        verify.shadow_parity(f, f, rel, f, -1, 1.0)
    with pytest.raises(Exception, match="CONTENT"):
        verify.shadow_parity(f.union(f.withColumn("fact_hash", F.lit("z"))), f, rel, f, 1, 1.0).collect()


def test_event_search_parameters(spark):
    df = spark.createDataFrame([], "occurred_at timestamp, source_record_id string, tenant_id string")
    for kw, name in (({"filters": {"tenantId": ""}}, "tenantId"), ({"filters": {"nope": "x"}}, "nope"), ({"filters": {}, "limit": 0}, "limit"), ({"filters": {"tenantId": "x" * 513}}, "tenantId")):
        with pytest.raises(ValueError, match=f"INVALID_{name}"):
            serving.event_search(df, **kw)


def test_otlp_flatten_defaults(spark):
    req = {"resource_logs": [{"resource": {"attributes": [{"key": "k", "value": {"stringValue": "a"}}, {"key": "k", "value": {"stringValue": "b"}}]}, "scope_logs": [{"log_records": [{"body": {"kvlistValue": {"values": [{"key": "big", "value": {"intValue": "9007199254740993"}}, {"key": "l", "value": {"arrayValue": {"values": [{"boolValue": True}, {}]}}}]}}}]}]}]}
    row = otlp.flatten_otlp_logs(spark.createDataFrame([(json.dumps(req),)], "request_json string")).first()
    assert row["resource"] == {"k": "b"} and row["attributes"] == {} and row["scope"]["name"] == "" and row["time_unix_nano"] == "0"
    assert json.loads(row["body_json"]) == {"big": "9007199254740993", "l": [True, None]}


def test_targets_and_schema(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"targets": [{"targetId": "a", "enabled": True, "writeLayers": ["landing"]}, {"targetId": "b", "enabled": False}]}))
    assert [t.target_id for t in tables.load_targets(str(tmp_path / "t.json"))] == ["a"]
    (tmp_path / "t.json").write_text("{}")
    with pytest.raises(ValueError, match="PROJECTION_TARGETS_INVALID"):
        tables.load_targets(str(tmp_path / "t.json"))
    with pytest.raises(ValueError, match="TABLE_MAP_FORBIDDEN"):
        project.Target("x", "sdar_shared_warehouse", table_map={"a": "b"})
    with pytest.raises(ValueError, match="SCHEMA_DRIFT"):
        project.check_target_schema(spark.range(1), spark.createDataFrame([], "id int").schema)


def test_idempotent_write_and_latest(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-05"), (2, "2024-02-05")], "id long, d string").withColumn("ts", F.to_timestamp("d"))
    for _ in range(2):
        tables.write_layer(df, str(tmp_path), "t", "ts", batch_id=0)
    back = spark.read.parquet(f"{tmp_path}/t/batch_id=0")
    assert back.count() == 2
    plan = back.filter(tables.month_bounds("ts", F.lit("2024-02-01").cast("timestamp"), None))
    assert plan.count() == 1
    assert tables.apply_retention(df, "ts", 20, F.lit("2024-02-10").cast("timestamp")).count() == 1


def test_stream_equals_batch(spark, tmp_path):
    from telmark.streaming import stateful, targets

    stateful.use_rocksdb(spark)
    src, cols = str(tmp_path / "in"), None
    r = mapping.resolve_source_mapping(validate.validate_envelopes(fixtures.telemetry(spark, SF)), fixtures.mappings(spark)).filter("error_code IS NULL AND mapping IS NOT NULL AND arrival_seq < 300")
    for i in range(3):
        r.filter(f"arrival_seq div 100 = {i}").coalesce(1).write.mode("append").parquet(src)
    cols = spark.read.parquet(src).schema
    stream = spark.readStream.schema(cols).option("maxFilesPerTrigger", 10).parquet(src)
    q = stateful.stateful_classify(stream).writeStream.format("memory").queryName("folded").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(300)
    got = {x["arrival_seq"]: x["outcome"] for x in spark.table("folded").collect()}
    want = {x["arrival_seq"]: x["outcome"] for x in classify.assess_sequential(classify.with_identity(spark.read.parquet(src))).select("arrival_seq", "outcome").collect()}
    assert got == want

    kinds = spark.read.parquet(src).withColumns({"kind": F.lit("accepted"), "accepted_hash": F.lit(None).cast("string"), "blocking_code": F.lit(None).cast("string")})
    kinds.coalesce(1).write.parquet(str(tmp_path / "kinds"))
    ready = spark.readStream.schema(kinds.schema).parquet(str(tmp_path / "kinds"))
    started, failed = targets.run_targets(ready, [project.Target("standalone-smpp", write_layers=["landing", "core", "relation"]), project.Target("off", enabled=False)], str(tmp_path / "out"))
    for s in started:
        s.awaitTermination(300)
        assert s.exception() is None
    assert not failed
    root = str(tmp_path / "out" / "standalone-smpp")
    n = kinds.count()
    assert targets.read_table(spark, root, "core.provider_operation_fact").count() == n
    assert targets.read_table(spark, root, "landing.provider_ops", "landing").count() == kinds.select("record_id", "record_hash", "mapping.tenant_id").distinct().count()


DATES = {
    "2024-01-05T10:00:00.123456Z": "2024-01-05T10:00:00.123Z", "2024-01-05T10:00Z": "2024-01-05T10:00:00.000Z", "2024-01-05": "2024-01-05T00:00:00.000Z", "2024-02": "2024-02-01T00:00:00.000Z", "2024": "2024-01-01T00:00:00.000Z",
    "2024-01-05T10:00:00+05:30": "2024-01-05T04:30:00.000Z", "2024-01-05 10:00:00-0100": "2024-01-05T11:00:00.000Z", "2024-01-05T24:00:00Z": "2024-01-06T00:00:00.000Z", "2024-02-30": "2024-03-01T00:00:00.000Z", "+002024-01-05T00:00:00Z": "2024-01-05T00:00:00.000Z",
    "1969-12-31T23:59:59.999Z": "1969-12-31T23:59:59.999Z", "0001-01-01T00:00:00Z": "0001-01-01T00:00:00.000Z", "Fri, 5 Jan 2024 10:00:00 GMT": "2024-01-05T10:00:00.000Z", "5 January 2024 10:00:00 +0100": "2024-01-05T09:00:00.000Z",
    "Fri Jan 05 2024 10:00:00 GMT+0100 (Central European Standard Time)": "2024-01-05T09:00:00.000Z", "Jan 5, 2024": "2024-01-05T00:00:00.000Z", "2024/1/5 7:08": "2024-01-05T07:08:00.000Z", "1/5/2024": "2024-01-05T00:00:00.000Z",
}
NO_DATES = ["", "soon", "2024-13-01", "2024-00-01", "2024-01-32", "2024-01-05T25:00:00Z", "2024-01-05T24:00:01Z", "2024-01-05T10:60:00Z", "2024-01-05T10:00:00Zulu", "24-01-05", "2024-1", "Fri", "13/1/2024", "5 Foo 2024", "2024-01-05T10", "+999999-01-01T00:00:00Z", None]


def test_date_forms(spark):
    df = spark.createDataFrame([(t,) for t in [*DATES, *NO_DATES]], "t string")
    got = {r["t"]: r["ms"] for r in df.select("t", F.unix_millis(S.iso_timestamp(F.col("t"))).alias("ms")).collect()}
    epoch = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
    want = {t: (datetime.datetime.fromisoformat(x.replace("Z", "+00:00")) - epoch) // datetime.timedelta(milliseconds=1) for t, x in DATES.items()}
    assert got == want | dict.fromkeys(NO_DATES)


def test_events_are_dealt_to_tasks_by_rows(spark):
    """A file of one row group is one task; the records derived from it are not."""
    r = fixtures.telemetry(spark, "/root/testdata/sf0.01")
    assert r.rdd.getNumPartitions() > 1
    assert r.count() == r.select("arrival_seq").distinct().count() == 10_000


def test_usual_envelopes_stay_in_the_jvm(spark):
    """An envelope of usual length with few values is not walked; odd ones get the codes of a walk."""
    usual = {"payload": {"state": "x" * 2000}} | {f"k{i}": "v" for i in range(30)}
    texts = [usual, usual | {"k1": "Bearer abc.def"}, usual | {"token": 1}, {"a": ["x"] * 1001}, {"a": "x" * 16_385}, {"a": "\U0001f600" * 8200}, {f"k{i}": 1 for i in range(501)}]
    df = spark.createDataFrame([(i, json.dumps(t, ensure_ascii=False)) for i, t in enumerate(texts)], "i int, t string")
    want = [None, "SENSITIVE_VALUE_DETECTED", "SENSITIVE_KEY_DETECTED", "ARRAY_TOO_LONG", "STRING_TOO_LONG", "STRING_TOO_LONG", "OBJECT_TOO_WIDE"]
    rows = df.select("i", validate._harmless(F.col("t"), C.LIMITS).alias("h"), validate.scan_sensitive(F.col("t")).alias("c")).orderBy("i").collect()
    assert [r["h"] for r in rows] == [True] + [False] * 6
    assert [r["c"] for r in rows] == want


@pytest.mark.parametrize("text", ["-----BEGIN PRIVATE KEY-----", "-----begin rsa prİvate key-----", "a BEARER x", "postgres://a:b@c", "bearer", "http://a:b@c", "plain"])
def test_forbidden_value_prefilter_changes_nothing(text):
    import re

    assert validate._forbidden_value(text) == (re.search(C.FORBIDDEN_VALUE, text) is not None)


def test_settled_columns_are_no_expressions(spark):
    """What is settled is worked out below a generator, and later projections read its result."""
    df = S.settled(spark.createDataFrame([("a", 1)], "t string, n int"), {"h": F.sha2("t", 256), "n": F.col("n") + 1}).select((F.col("h") == "x").alias("a"), F.concat("h", "h").alias("b"), "n")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha2(") <= 1 and df.first()["n"] == 2
