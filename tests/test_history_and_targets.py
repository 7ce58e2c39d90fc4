"""Evidence across batches, versioned tables, compaction, replay, retention, supervision and preflight of targets."""

import datetime
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telmark import contracts as C
from telmark.operators import classify, history, mapping, normalize, project, validate
from telmark.plans import fixtures
from telmark.sources.store import file_system
from telmark.sources.versions import Change, CommitConflict, Versions
from telmark.streaming import supervise, targets

SF = "/root/testdata/sf0.001"
EVENT = "arrival_seq long, provider_id string, record_id string, record_hash string, identity string, revision string, terminal string, provider_event_sequence long"
UTC = datetime.timezone.utc


def events(seed, n):
    """Records whose ids come under several identities and repeat with other hashes."""
    rng = random.Random(seed)
    return [
        (i, "p", f"r{rng.randrange(n // 3)}", f"h{rng.randrange(3)}", rng.choice([None, "a", "b", "c"]), rng.choice([None, "1", "2", "3"]), rng.choice([None, None, None, "x", "y"]), rng.choice([None, *range(8)]))
        for i in range(n)
    ]


def one_by_one(rows):
    store, out = classify.DictStore(), {}
    for r in rows:
        out[r[0]] = classify.fold(store, dict(zip([c.split()[0] for c in EVENT.split(", ")], r, strict=True)))
    return out


def outcomes(df):
    return {r["arrival_seq"]: (r["outcome"], r["accepted_hash"], r["reason_codes"]) for r in df.collect()}


@pytest.mark.parametrize("seed", [3, 4])
def test_any_cut_into_batches_gives_the_outcomes_of_one(spark, tmp_path, seed):
    rows = events(seed, 150)
    want = one_by_one(rows)
    df = spark.createDataFrame(rows, EVENT).repartition(3)
    assert outcomes(classify.assess(df)) == want
    cuts = sorted(random.Random(seed).sample(range(1, 150), 2))
    evidence, got = history.Evidence(spark, f"{tmp_path}/evidence", buckets=3), {}
    for b, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, 150], strict=True)):
        part = df.filter(f"arrival_seq >= {lo} AND arrival_seq < {hi}")
        own = outcomes(history.assess_batch(part, evidence, batch_id=b))
        version = evidence.versions.snapshot().version
        if b == 1:
            # A batch that is tried again gives what it gave, and adds nothing.
            assert outcomes(history.assess_batch(part, evidence, batch_id=b)) == own
            assert evidence.versions.snapshot().version == version
        got |= own
    assert got == want


def test_batch_reads_and_replaces_only_its_buckets(spark, tmp_path):
    evidence = history.Evidence(spark, f"{tmp_path}/evidence", buckets=200)
    for b, names in enumerate((range(40), range(2))):
        rows = [(100 * b + i, "p", f"r{b}-{i}", "h", f"id{i}", None, None, b) for i in names]
        before = evidence.versions.snapshot().manifest["tables"]["evidence"]["parts"]
        history.assess_batch(spark.createDataFrame(rows, EVENT), evidence, batch_id=b)
    after = evidence.versions.snapshot().manifest["tables"]["evidence"]["parts"]
    same = [k for k in before if after[k] == before[k]]
    assert len(same) >= len(before) - 4 and len(after) > 40
    top = {r["key"]: r["value"] for r in evidence.versions.snapshot().read("evidence").filter("kind = 'top'").collect()}
    assert top["id0"] == "1" and top["id7"] == "0"


def test_rejected_rows_take_no_part_in_any_exchange(spark):
    rows = [(i, None, None, None, None, None, None, None) for i in range(500)] + [(1000, "p", "r", "h", "a", None, None, 1)]
    df = spark.createDataFrame(rows, EVENT)
    out = classify.assess(df, F.col("record_id").isNotNull())
    assert out.filter("outcome IS NULL").count() == 500 and out.filter("outcome = 'accepted'").count() == 1
    plan = out.select("arrival_seq", "outcome")._jdf.queryExecution().executedPlan().toString()
    # The valid rows' join is the only exchange; the others are read beside it.
    assert "Union" in plan and "Window" not in plan


def test_stream_equals_assess_for_ids_under_two_identities(spark, tmp_path):
    rows = events(9, 120)
    df = spark.createDataFrame(rows, EVENT)
    for i in range(3):
        df.filter(f"arrival_seq div 40 = {i}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    evidence = history.Evidence(spark, f"{tmp_path}/evidence", buckets=2)

    def run(batch, batch_id):
        history.assess_batch(batch, evidence, batch_id=batch_id).write.mode("overwrite").parquet(f"{tmp_path}/out/b={batch_id}")

    q = stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None
    assert outcomes(spark.read.parquet(f"{tmp_path}/out")) == one_by_one(rows)


def test_filter_on_the_error_code_does_not_copy_the_rules(spark):
    checked = validate.validate_envelopes(fixtures.telemetry(spark, SF))
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    assert size(checked.filter("error_code IS NULL")) < 1.1 * size(checked)
    plan = checked.filter("arrival_seq < 5")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Filter") > plan.index("Generate")


def test_versions_are_whole_and_read_by_snapshot(spark, tmp_path):
    v = Versions(spark, f"{tmp_path}/t")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("month", T.StringType())])
    v.declare("a", schema, "month")
    v.declare("b", schema, "month")
    rows = lambda *x: spark.createDataFrame(list(x), schema)
    first = v.commit({"a": Change(rows((1, "202401"), (2, "202402"))), "b": Change(rows((9, "202401")))})
    second = v.commit({"a": Change(rows((3, "202402")), ["202402"]), "b": Change(None, ["202401"])})
    ids = lambda s, t, keys=None: sorted(r["id"] for r in s.read(t, keys).collect())
    assert (ids(first, "a"), ids(first, "b"), ids(second, "a"), ids(second, "b")) == ([1, 2], [9], [1, 3], [])
    assert ids(second, "a", ["202401", "209901"]) == [1]
    with pytest.raises(CommitConflict):
        v.commit({"a": Change(rows((4, "202402")), ["202402"])}, on=first)
    with pytest.raises(ValueError, match="does not replace"):
        v.commit({"a": Change(rows((4, "202403")), ["202402"])})
    # A torn manifest is passed over, and its number is not used again.
    fs, path = file_system(spark, f"{tmp_path}/t/manifests/v{second.version + 1:012d}.json")
    stream = fs.create(path, False)
    stream.write(bytearray(b'{"version": 9'))
    stream.close()
    assert v.snapshot().version == second.version
    third = v.commit({"a": Change(rows((5, "202405")), ["202405"])})
    assert third.version == second.version + 2 and ids(v.snapshot(), "a") == [1, 3, 5]
    removed = v.vacuum(1)
    assert any(x.startswith("b/") for x in removed) and ids(v.snapshot(), "a") == [1, 3, 5]


def test_added_columns_read_their_defaults_in_old_files_only(spark, tmp_path):
    v = Versions(spark, f"{tmp_path}/t")
    old = T.StructType([T.StructField("id", T.LongType()), T.StructField("month", T.StringType())])
    new = T.StructType([T.StructField("id", T.LongType()), T.StructField("zone", T.StringType(), False), T.StructField("n", T.IntegerType()), T.StructField("month", T.StringType())])
    v.declare("a", old, "month")
    v.commit({"a": Change(spark.createDataFrame([(1, "202401")], old), ["202401"])})
    with pytest.raises(ValueError, match="SCHEMA_DEFAULT_MISSING"):
        v.declare("a", new, "month")
    v.declare("a", new, "month", {"zone": "'none'"})
    v.commit({"a": Change(spark.createDataFrame([(2, "z", None, "202402")], new), ["202402"])})
    got = {r["id"]: (r["zone"], r["n"], r["month"]) for r in v.snapshot().read("a").collect()}
    assert got == {1: ("none", None, "202401"), 2: ("z", None, "202402")}


def kinds(spark, until=200):
    """Accepted records with their envelopes, conflicts among them."""
    r = mapping.resolve_source_mapping(validate.validate_envelopes(fixtures.telemetry(spark, SF)), fixtures.mappings(spark)).filter(f"error_code IS NULL AND mapping IS NOT NULL AND src = arrival_seq AND arrival_seq < {until}")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    fields = []
    for c, key in C.ENVELOPE_FIELDS:
        if key in ("occurredAt", "emittedAt"):
            fields.append(iso("occurred_at" if key == "occurredAt" else "emitted_at").alias(key))
        elif key in ("attributes", "payload"):
            fields.append(F.parse_json(c).alias(key))
        elif c in r.columns:
            fields.append(F.col(c).alias(key))
    envelope = F.to_json(F.struct(*fields))
    parsed = validate.parse_envelopes(r.select("arrival_seq", "received_at", "deployment_id", "collector_id", "mapping", envelope.alias("envelope_json"), "source_system"))
    out = validate.normalize_correlation(parsed).drop("correlation_code", "is_object", "present_keys")
    issue = F.col("arrival_seq") % 5 == 0
    return out.withColumns({
        "kind": F.when(F.col("arrival_seq") % 17 == 0, "conflict").otherwise("accepted"), "accepted_hash": F.lit(None).cast("string"), "blocking_code": F.lit(None).cast("string"), "error_code": F.lit(None).cast("string"), "error_message": F.lit(None).cast("string"),
        "quality_status": F.when(issue, "accepted_with_quality_issue").otherwise("accepted"), "reason_codes": F.when(issue, F.array(F.lit(classify.GAP))).otherwise(F.array().cast("array<string>")),
    })


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("kinds"))
    df = kinds(spark).persist()
    for i in range(4):
        df.filter(f"arrival_seq % 4 = {i}").coalesce(1).write.mode("append").parquet(path)
    schema = df.schema
    df.unpersist()
    return path, schema


def stream(spark, source, files=1):
    return spark.readStream.schema(source[1]).option("maxFilesPerTrigger", files).parquet(source[0])


def test_compaction_replay_and_retention(spark, source, tmp_path):
    shared = project.Target("standalone-smpp", "sdar_shared_warehouse")
    target, fact_table = shared, "core.external_provider_fact"
    root = f"{tmp_path}/{target.target_type}"
    q = targets.run_target(stream(spark, source, 2), target, root, f"{root}-cp")
    q.awaitTermination(300)
    assert q.exception() is None
    # A table without a row has no month yet.
    names = [n for n in targets._names(spark, root) if n != "batches" and targets._appended(spark, root, n, [0, 1, 2, 3]) is not None]
    key = targets._key_of(fact_table)
    rows = lambda n: sorted(map(str, targets.read_table(spark, root, n, targets._key_of(n)).drop("batch_id").collect()))
    before = {n: rows(n) for n in names}
    assert len(before[fact_table]) > 100 and before["landing.conflict"]
    assert set(targets.compact(spark, root)) == set(names)
    # One file for each month, however many batches there were.
    now = Versions(spark, root).snapshot()
    files = now.read(fact_table).select(F.input_file_name().alias("f"), "month").distinct().collect()
    assert len(files) == len({r["month"] for r in files}) == len(now.keys(fact_table))
    assert {n: rows(n) for n in names} == before
    assert targets.compact(spark, root) == []

    # The same code over a scope: ids and hashes stay, other rows are not touched, old readers see old rows.
    held = Versions(spark, root).snapshot()
    hashes = lambda s: {r["fact_id"]: r["fact_hash"] for r in s.read(fact_table).collect()}
    old = hashes(held)
    later = F.lit("2031-01-01 00:00:00").cast("timestamp")
    done = targets.replay(spark, root, target, F.col("arrival_seq") % 2 == 0, later)
    assert done[fact_table] and hashes(held) == old
    new = Versions(spark, root).snapshot()
    assert hashes(new) == old and new.version == held.version + 1
    times = {r["source_record_id"]: r["projected_at"] for r in targets.read_table(spark, root, fact_table, key).collect()}
    scope = {r["source_record_id"]: r["arrival_seq"] % 2 == 0 for r in new.read("landing.provider_ops").collect()}
    assert all((times[i].year == 2031) == scope[i] for i in times) and len(set(scope.values())) == 2

    # What the projection no longer takes is diverted: the source id is missing from a part of the shared target's landing.
    landing = new.read("landing.provider_ops")
    bad = landing.withColumn("smpp_source_id", F.when(F.col("arrival_seq") % 4 != 0, F.col("smpp_source_id")))
    n_bad = bad.filter("smpp_source_id IS NULL").count()
    Versions(spark, root).commit({"landing.provider_ops": Change(bad)})
    targets.replay(spark, root, shared, F.lit(True), later)
    assert targets.read_table(spark, root, "normalized.dead_letter").filter("error_code = 'SMPP_SOURCE_MAPPING_ID_MISSING'").count() == n_bad > 0
    assert targets.read_table(spark, root, fact_table).count() == len(old) - n_bad

    whole = targets.read_table(spark, root, "landing.provider_ops").persist()
    n_whole = whole.count()
    middle = datetime.datetime(2024, 1, 4, tzinfo=UTC)
    now = middle + datetime.timedelta(days=C.RETENTION_DAYS["landing"])
    want = sorted(r["source_record_id"] for r in whole.filter(F.col("occurred_at") > F.lit(middle.isoformat(sep=" ")).cast("timestamp")).collect())
    gone = targets.expire(spark, root, now)
    assert gone["landing.provider_ops"][1] == "202401"
    assert sorted(r["source_record_id"] for r in targets.read_table(spark, root, "landing.provider_ops").collect()) == want and 0 < len(want) < n_whole
    assert targets.expire(spark, root, now + datetime.timedelta(days=4000))["landing.provider_ops"][0]
    assert targets.read_table(spark, root, "landing.provider_ops").count() == 0
    assert not any(n.startswith("commit=") for n in targets._names(spark, f"{root}/data/landing.provider_ops"))


def test_supervisor_restarts_the_failing_target_alone(spark, source, tmp_path):
    root, good, bad = str(tmp_path / "out"), project.Target("standalone-smpp"), project.Target("flaky", accept_all_mappings=True)
    calls = []

    def run(src, target, path, checkpoint, trigger):
        if target is good:
            return targets.run_target(src, target, path, checkpoint, trigger)
        # Fails in the middle of its third batch, twice: some tables are written by then.
        def write(batch, batch_id):
            batch.persist()
            for name, df in list(targets.target_tables(batch, target, F.current_timestamp()).items()):
                targets.tables.write_layer(df, path, name, targets.time_column(name, target), batch_id)
                if batch_id == 2 and name == "landing.conflict" and calls.count(2) < 2:
                    calls.append(2)
                    raise RuntimeError("store is away")
            targets.mark(spark, path, batch_id)

        name = f"target-{target.target_id}"
        seen = src.observe(name, F.count(F.lit(1)).alias("rows"), F.max("arrival_seq").alias("arrival_seq"), F.count_if(F.col("kind") == "accepted").alias("accepted"))
        return seen.writeStream.queryName(name).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

    s = supervise.Supervisor(spark, stream(spark, source), [good, bad, project.Target("off", enabled=False)], root, attempts=4, backoff=0.2, run=run)
    states = {k: w.state for k, w in s.run(timeout=300).items()}
    assert states == {"standalone-smpp": "done", "flaky": "done"}
    table = "core.provider_operation_fact"
    ids = lambda t: sorted(r[0] for r in targets.read_table(spark, f"{root}/{t}", table).select("fact_id").collect())
    assert ids("flaky") == ids("standalone-smpp") and len(ids("flaky")) > 100
    src = spark.read.schema(source[1]).parquet(source[0])
    got = {r["target_id"]: (r["batches"], r["failures"], r["records"], r["pending"]) for r in supervise.projection_progress(supervise.progress(spark, root), src, [good, bad]).collect()}
    n = src.count()
    assert got == {"standalone-smpp": (4, 0, n, 0), "flaky": (4, 2, n, 0)}


def test_supervisor_tells_required_from_optional_at_run_time(spark, source, tmp_path):
    def run(src, target, path, checkpoint, trigger):
        if target.target_id == "late":
            raise RuntimeError("no preflight")
        return targets.run_target(src, target, path, checkpoint, trigger)

    good = project.Target("standalone-smpp", write_layers=["landing"])
    s = supervise.Supervisor(spark, stream(spark, source), [good, project.Target("late")], str(tmp_path / "a"), attempts=2, backoff=0.1, run=run)
    states = s.run(timeout=300)
    assert (states["late"].state, states["late"].attempts, states["standalone-smpp"].state) == ("failed", 2, "done") and "preflight" in states["late"].error
    with pytest.raises(supervise.TargetFailed, match="late"):
        supervise.Supervisor(spark, stream(spark, source), [project.Target("late", required=True)], str(tmp_path / "b"), attempts=2, backoff=0.1, run=run).run(timeout=300)


def test_preflight_runs_before_the_first_write(spark, source, tmp_path):
    target, root, calls = project.Target("standalone-smpp", write_layers=["landing"]), str(tmp_path / "out"), []

    def preflight():
        calls.append(targets._names(spark, root))
        if len(calls) == 1:
            raise ValueError("SMPP_SCHEMA_DRIFT: release")

    for _ in range(2):
        q = targets.run_target(stream(spark, source, 4), target, root, f"{root}-cp", preflight=preflight)
        try:
            q.awaitTermination(300)
        except Exception as error:
            assert "SMPP_SCHEMA_DRIFT" in str(error)
    assert calls == [[], []] and targets.read_table(spark, root, "landing.provider_ops").count() > 100


def test_preflight_raises_on_each_drift(spark):
    core, meta = f"c{uuid.uuid4().hex}", f"m{uuid.uuid4().hex}"
    expected = {"external_provider_fact": T.StructType([T.StructField("fact_id", T.StringType()), T.StructField("n", T.IntegerType())])}
    check = lambda: project.check_target_catalog(spark, core, meta, expected)

    def drifted(what):
        with pytest.raises(ValueError, match=f"SMPP_SCHEMA_DRIFT.*{what}"):
            check()

    for db in (core, meta):
        spark.sql(f"CREATE DATABASE {db}")
    try:
        drifted("no release")
        view = f"{meta}.{C.SHARED_RELEASE_VIEW}"
        columns = lambda r: ", ".join(f"'{v}' AS {k}" for k, v in r.items())
        for wrong in ({**C.SHARED_RELEASE, "migration_range": "00..27"}, {k: v for k, v in C.SHARED_RELEASE.items() if k != "release_version"}):
            spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns(wrong)}")
            drifted("release")
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns(C.SHARED_RELEASE)} UNION ALL SELECT {columns(C.SHARED_RELEASE)}")
        drifted("release")
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns(C.SHARED_RELEASE)}")
        drifted("external_provider_fact")
        for wrong in ("n INT, fact_id STRING", "fact_id STRING, n BIGINT", "fact_id STRING", "fact_id STRING, n INT, more STRING"):
            spark.sql(f"CREATE OR REPLACE VIEW {core}.external_provider_fact AS SELECT {', '.join(f'CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}' for c in wrong.split(', '))}")
            drifted("")
        spark.sql(f"CREATE OR REPLACE VIEW {core}.external_provider_fact AS SELECT CAST(NULL AS STRING) AS fact_id, CAST(NULL AS INT) AS n")
        for view in C.SHARED_VIEWS:
            drifted(view)
            spark.sql(f"CREATE VIEW {core}.{view} AS SELECT 1 AS one")
        check()
    finally:
        for db in (core, meta):
            spark.sql(f"DROP DATABASE {db} CASCADE")


def test_rows_go_to_the_normalizer_of_their_schema_and_version(spark):
    r = kinds(spark, 60).withColumn("schema_version", F.element_at(F.array(*map(F.lit, ("1.1.0", "1.1.9", "1.10.0", "2.0.0", "x"))), (F.col("arrival_seq") % 5 + 1).cast("int")))
    now = F.col("received_at")
    other = lambda df, at: normalize.normalize(df, at).withColumn("fact_version", F.lit("2.0.0"))
    entries = [project.NormalizerEntry("smpp", C.SCHEMA_NAME, "1.1.0", "1.2.0", normalize.normalize), project.NormalizerEntry("smpp", C.SCHEMA_NAME, "1.2.0", "2.0.0", other)]
    facts, unknown = project.normalize_by_schema(r, now, entries)
    got = {(x["source_schema_version"], x["fact_version"]) for x in facts.collect()}
    assert got == {("1.1.0", "1.0.0"), ("1.1.9", "1.0.0"), ("1.10.0", "2.0.0")}
    assert {x["error_summary"].split()[1] for x in unknown.collect()} == {"2.0.0", "x"} and facts.count() + unknown.count() == r.count()


def test_relations_of_a_bad_urn_are_diverted(spark):
    facts = normalize.normalize(kinds(spark, 100), F.col("received_at"))
    broken = facts.withColumn("relations", F.transform("relations", lambda x: x.withField("source_entity_urn", F.when(F.col("arrival_seq") % 8 == 0, "urn:x").otherwise(x["source_entity_urn"]))))
    good, dead = normalize.dead_letters(broken, project.relation_error(broken), F.col("received_at"))
    n = broken.filter("size(relations) > 0 AND arrival_seq % 8 = 0").count()
    assert dead.filter("error_code = 'SMPP_RELATION_URN_INVALID'").count() == n > 0 and good.count() == facts.count() - n
