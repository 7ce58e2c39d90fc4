"""Work that the findings of round 3 named: done once, with the same results."""

import json

from pyspark.sql import functions as F

from telmark.functions import scalars as S
from telmark.operators import classify
from telmark.plans import queries as Q
from telmark.sources import otlp


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_layer_filter_classifies_once(spark, monkeypatch):
    """F6."""
    calls, real = [], classify.assess
    monkeypatch.setattr(classify, "assess", lambda *a, **k: calls.append(1) or real(*a, **k))
    assert {r["table_name"] for r in Q.QUERIES["p13_layer_filter"](spark, "/root/testdata/sf0.001").collect()} == {"landing.provider_ops", "edges"}
    assert len(calls) == 1


def test_otlp_texts_are_parsed_once(spark):
    """F10."""
    attr = lambda k, **v: {"key": k, "value": v}
    record = {"attributes": [attr("a", stringValue="1"), attr("b", intValue=2), attr("a", stringValue="3"), attr("c", boolValue=True), attr("d", kvlistValue={})], "trace_id": "t", "timeUnixNano": "7", "body": {"stringValue": 'x"y'}}
    request = {"resourceLogs": [{"resource": {"attributes": [attr("r", stringValue="s")]}, "scopeLogs": [{"scope": {"name": "n"}, "logRecords": [record, {}]}, {"log_records": [{"event_name": "e"}]}]}]}
    logs = otlp.flatten_otlp_logs(spark.createDataFrame([(json.dumps(request),), ("no json",)], "request_json string"))
    rows = {(r["trace_id"], r["event_name"]): r for r in logs.collect()}
    assert len(rows) == 3
    assert rows["t", ""]["attributes"] == {"a": "3", "b": "2", "c": "true", "d": None}
    assert (rows["t", ""]["time_unix_nano"], rows["t", ""]["body_json"], rows["t", ""]["scope"]["name"]) == ("7", '"x\\"y"', "n")
    assert all(r["resource"] == {"r": "s"} for r in rows.values()) and rows["", "e"]["scope"]["name"] == "" and rows["", ""]["attributes"] == {}
    chosen = otlp.select_provider_ops(logs).groupBy(F.col("attributes")["sdar.schema.version"]).count()
    # Three lists of the request, the resource's and the record's attributes.
    assert _plan(chosen).count("from_json") <= 5


def test_fact_hash_is_written_in_order(spark):
    """F5, F7, F8, F9, F11."""
    df = spark.sql(
        """SELECT * FROM VALUES
        ('z', named_struct('b', 1, 'a', 'é"\\n', 'c', array('y', NULL)), array(named_struct('q', timestamp'2024-01-05 10:00:00.120', 'B', true), NULL), 9007199254740993L),
        (NULL, NULL, array(), -1L) AS t(y, s, l, a)"""
    )
    fact = F.struct("y", "s", "l", "a")
    out = df.select(S.fact_hash(fact).alias("old"), S.fact_hash(fact, df.schema).alias("new"))
    assert all(r["old"] == r["new"] for r in out.collect())
    assert "parseJson" not in _plan(out.select("new"))
    # Numbers that a writer may print in several ways take the longer way.
    odd = spark.createDataFrame([(1.5, "x")], "b double, a string")
    assert "parseJson" in _plan(odd.select(S.fact_hash(F.struct("b", "a"), odd.schema)))


def test_keys_spelled_with_escapes_are_found(spark):
    """F5 to F9, F11: payloads without the key are not parsed."""
    df = spark.createDataFrame([('{"provider\\u0052evision":"7"}',), ('{"providerRevision":8}',), ('{"k":1}',), ("providerRevision",), (None,)], "p string")
    got = df.select(S.revision_text(F.col("p"), F.lit(5), F.lit(None).cast("int")).alias("r"), S.may_hold(F.col("p"), "providerRevision").isNull().alias("skipped")).collect()
    assert [tuple(r) for r in got] == [("7", False), ("8", False), ("5", True), ("5", False), ("5", True)]


def test_payloads_are_parsed_once(spark):
    """F5."""
    df = spark.createDataFrame([("provider.resource.state", '{"state":"ready"}'), ("provider.resource.state", '{"state":3}'), ("provider.resource.state", "[]"), ("none", "{}"), (None, None)], "t string, p string")
    out = df.select(S.payload_semantics(F.col("t"), F.col("p")).alias("s"))
    assert [(r["s"]["error_code"], r["s"]["lifecycle_status"]) for r in out.collect()] == [
        (None, "ready"), ("SMPP_PAYLOAD_CONTRACT_INVALID", "3"), ("SMPP_PAYLOAD_CONTRACT_INVALID", None), ("SMPP_PAYLOAD_CONTRACT_MISSING", None), ("SMPP_PAYLOAD_CONTRACT_MISSING", None),
    ]
    assert _plan(out.select("s.error_code")).count("parseJson") == 1
