"""What was accepted before: a table of evidence that seeds the assessment of each batch and takes in its accepted records.

Evidence is ``(kind, key, value)``: a record id's hash; an identity's hash by revision and by sequence, its terminal state and its
largest sequence. It lies in buckets by record id or identity. A batch reads the buckets of its own keys alone, looks up its keys in one
join, and replaces the buckets in which something was accepted, in one commit. A batch that is tried again finds the version
before its own and gives the outcomes that it gave.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from telmark.operators import classify
from telmark.sources.versions import Change, Snapshot, Versions

TABLE = "evidence"
SCHEMA = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])
KINDS = ("record", "revision", "terminal", "sequence", "top")
ACCEPTED = ("accepted", "accepted_with_quality_issue", "not_applicable")


def record_key(columns: list[str]) -> list[str]:
    return [c for c in ("source_system", "record_id") if c in columns]


class Evidence:
    """The table under ``root``. ``buckets`` is fixed when the table is made; so many that a bucket is one task's work."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.versions, self.spark = Versions(spark, root), spark
        now = self.versions.snapshot()
        if TABLE not in now.tables():
            self.versions.declare(TABLE, SCHEMA, "bucket")
            self.versions.commit({}, {"buckets": buckets, "batch": None})
        self.buckets = self.versions.snapshot().note["buckets"]

    def _stacked(self, rows: DataFrame, *more: str) -> DataFrame:
        """A row for each piece of evidence that a record has or asks for."""
        record = F.concat_ws(classify.SEPARATOR, *record_key(rows.columns))
        identity, sequence = F.col("identity"), F.col("provider_event_sequence").cast("string")
        joined = lambda c: F.concat(identity, F.lit(classify.SEPARATOR), c)
        keys: dict[str, tuple[Column, Column, Column]] = {
            "record": (record, record, F.col("record_hash")), "revision": (identity, joined(F.col("revision")), F.col("record_hash")), "terminal": (identity, identity, F.col("terminal")),
            "sequence": (identity, joined(sequence), F.col("record_hash")), "top": (identity, identity, sequence),
        }
        bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(self.buckets)).cast("int").alias("bucket")
        parts = F.array(*[F.struct(bucket(home), F.lit(k).alias("kind"), key.alias("key"), value.alias("value")) for k, (home, key, value) in keys.items()])
        return rows.select(*more, F.explode(parts).alias("e")).select(*more, "e.*").filter("key IS NOT NULL")

    def _read(self, keyed: DataFrame, now: Snapshot) -> tuple[DataFrame, list[str]]:
        # No more rows than there are buckets.
        touched = sorted(str(r["bucket"]) for r in keyed.select("bucket").distinct().collect())
        return now.read(TABLE, touched), touched

    def seeds(self, rows: DataFrame, now: Snapshot) -> DataFrame:
        """``rows`` (with ``_row``) with the evidence for their keys: ``_h_record, _h_revision, _h_terminal, _h_sequence, _h_top``."""
        if not now.keys(TABLE):
            return rows
        keyed = self._stacked(rows, "_row").drop("value")
        known, _ = self._read(keyed, now)
        found = keyed.join(known, ["bucket", "kind", "key"]).groupBy("_row").agg(*[F.max(F.when(F.col("kind") == k, F.col("value"))).alias(f"_h_{k}") for k in KINDS])
        return rows.join(found, "_row", "left").withColumn("_h_top", F.col("_h_top").cast("bigint"))

    def before(self, batch_id: int | None) -> tuple[Snapshot, bool]:
        """The version that a batch is judged against, and whether the batch is in a later one already."""
        now = self.versions.snapshot()
        if batch_id is None or now.note["batch"] is None or now.note["batch"] < batch_id:
            return now, False
        while now.note.get("batch") is not None and now.note["batch"] >= batch_id:
            earlier = self.versions.snapshot(now.version - 1)
            if not earlier.version:
                raise ValueError(f"the version before batch {batch_id} is gone")
            now = earlier
        return now, True

    def absorb(self, assessed: DataFrame, now: Snapshot, batch_id: int | None = None) -> Snapshot:
        """Takes in the accepted records of an assessed batch."""
        new = self._stacked(assessed.filter(F.col("outcome").isin(*ACCEPTED))).filter("value IS NOT NULL")
        old, touched = self._read(new, now)
        number = F.col("value").cast("bigint")
        value = F.when(F.first("kind") == "top", F.max(F.when(F.col("kind") == "top", number)).cast("string")).otherwise(F.min("value"))
        merged = old.unionByName(new.select(old.columns)).groupBy("bucket", "kind", "key").agg(value.alias("value"))
        rows = merged.repartition("bucket").sortWithinPartitions("bucket", "kind", "key")
        return self.versions.commit({TABLE: Change(rows, touched)}, {"batch": batch_id}, on=now)


def assess_batch(records: DataFrame, evidence: Evidence, valid: Column | None = None, order: str = "arrival_seq", batch_id: int | None = None) -> DataFrame:
    """J2 with W8. ``classify.assess`` of a batch after all batches before it; any cut of a stream gives the outcomes of one batch.

    Batches come in arrival order. With ``batch_id`` (ascending) a batch that is tried again changes nothing.
    """
    now, done = evidence.before(batch_id)
    out = classify.assess(records, valid, order, seeds=lambda rows: evidence.seeds(rows, now))
    if not done:
        evidence.absorb(out, now, batch_id)
    return out


def assess_stream(stream: DataFrame, evidence: Evidence, write: Callable[[DataFrame, int], None], checkpoint: str, valid: Column | None = None, trigger: dict | None = None) -> StreamingQuery:
    """T4 for record ids that come under several identities: each micro-batch is assessed exactly, then written.

    A stage keyed by record id before one keyed by identity could not take back a record that the second blocks without a loop; the
    assessment's fixpoint settles both at once, and its state is the evidence table. ``write`` gets a batch's outcomes and id, and may get them again.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        write(assess_batch(classify.with_identity(batch), evidence, valid, batch_id=batch_id), batch_id)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
