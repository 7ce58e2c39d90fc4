"""Work that the findings of round 4 named: done once, on less disk, with the same results."""

import glob
import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telmark import contracts as C
from telmark.functions import scalars as S
from telmark.operators import classify, validate
from telmark.plans import chain_queries
from telmark.plans import queries as Q
from telmark.sources import tables
from telmark.sources.store import _CLEANUP, discard, stored
from telmark.sources.versions import Versions
from telmark.streaming import targets

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_conformance_writes_what_is_judged(spark, monkeypatch):
    """no text of a request or an envelope is written."""
    written, real = [], classify.stored
    monkeypatch.setattr(classify, "stored", lambda df, name: written.append((name, df.columns)) or real(df, name))
    out = Q.QUERIES["v5_conformance_modes"](spark, SF)
    assert {r["outcome"]: r["count"] for r in out.groupBy("outcome").count().collect()}["accepted"] > 0
    records = next(columns for name, columns in written if name == "records")
    assert not {"envelope_json", "payload_json", "attributes_json", "otlp", "present_keys", "mapping"} & set(records)


def test_validation_is_one_pass_through_python(spark):
    """the hash and both walks share it, a text is parsed once for its hash, and texts of faults are not written."""
    df = chain_queries.faulty(Q.records(spark, SF))
    assert "faulty" not in _plan(df)
    checked = validate.validate_envelopes(validate.parse_envelopes(df)).select("arrival_seq", "error_code")
    assert _plan(checked).count("ArrowEvalPython") == 1
    assert _plan(df.select(S.record_hash(F.col("envelope_json"), native=True).alias("h"))).count("parseJson(envelope_json") == 1


def test_hash_of_odd_members(spark):
    """numbers of long texts are found by their members; control characters are written as in the canonical form."""
    texts = [{"b": {"n": 1.0, "t": "x" * 2000}, "a": [1e21, -0.0]}, {"t": "x" * 2000 + ":1.0,"}, {"z": 1, "t": "\x1f\x0b\n"}, {"recordHash": "7", "k": "é\U0001f600"}, {"deep": [[{"n": 1e-7}], "y" * 1500]}]
    rows = spark.createDataFrame([(json.dumps(t),) for t in texts], "t string").select(S.record_hash(F.col("t")).alias("h")).collect()
    assert [r["h"] for r in rows] == [hashlib.sha256(S.canonical_text({k: v for k, v in t.items() if k not in C.HASH_EXCLUDED}).encode()).hexdigest() for t in texts]


def test_evaluation_keys_are_found_in_place(spark):
    """a key of the evaluation domain, not a value that spells one or a longer key."""
    texts = ['{"a":{"episodeId":1}}', '{"a" : {"M12" :1}}', '{"a":"grade","b":["caseId"]}', '{"regrade":1,"caseIds":2,"m":3}', '{"GRADE":1}', '{"CaseId":1}']
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(validate.forbid_evaluation_identity(F.col("t")).isNotNull().alias("x")).collect()
    assert [r["x"] for r in rows] == [True, True, False, False, True, False]


def test_replay_reads_its_scope_once(spark, monkeypatch):
    """the scope's rows are parsed and written once for all tables, of the scope alone, and no cache is kept."""
    written, cached, real = [], [], targets.stored
    monkeypatch.setattr(targets, "stored", lambda df, name: written.append((name, set(df.columns))) or real(df, name))
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: cached.append(1) or self)
    out = Q.QUERIES["t5_replay"](spark, SF)
    assert out.filter("NOT same_hash").isEmpty() and not out.isEmpty() and not cached
    assert [n for n, columns in written if "envelope_json" in columns] == ["scope"]


def test_writes_leave_no_shuffle_files(spark):
    """files of an exchange go with the write that it served; the session's setting stays as it was."""
    found = lambda: {f for d in glob.glob(f"{spark.conf.get('spark.local.dir')}/blockmgr-*") for f in glob.glob(f"{d}/*/shuffle_*")}
    before, setting = found(), spark.conf.get(_CLEANUP, None)
    df = stored(spark.range(1000).repartition(3), "test")
    assert not found() - before and spark.conf.get(_CLEANUP, None) == setting
    assert df.count() == 1000
    discard(df)


def test_compaction_keeps_the_latest_of_each_key_over_batches(spark, tmp_path):
    """with one exchange for the window and the order of files."""
    root = str(tmp_path)
    for b in range(2):
        rows = spark.sql(f"SELECT 't' AS tenant_id, 'p' AS project_id, 'smpp' AS source_system, concat('r', id % 40) AS source_record_id, concat('h', id % 40) AS source_record_hash, {b} * 100L + id AS ingest_version, timestamp_seconds(1704067200 + id % 40 * 86400) AS occurred_at FROM range({b * 20}, 80)")
        tables.write_layer(rows, root, "landing.provider_ops", "occurred_at", b)
        targets.mark(spark, root, b)
    targets.compact(spark, root)
    got = Versions(spark, root).snapshot().read("landing.provider_ops")
    assert {(r["source_record_id"], r["ingest_version"], r["batch_id"]) for r in got.collect()} == {(f"r{k}", 100 + k + 40, 1) for k in range(40)}
    assert got.count() == 40
