"""Targets that fail alone: their queries are watched, restarted with growing delays, and their progress is kept as a table."""

from __future__ import annotations

import datetime
import threading
import time
import uuid
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from telmark.operators.project import Target
from telmark.streaming.targets import run_target

PROGRESS = "target_id string, batch_id long, failed boolean, num_rows long, accepted long, arrival_seq long, error string, at timestamp"


class TargetFailed(RuntimeError):
    """A required target used up its attempts."""


class _Listener(StreamingQueryListener):
    """Gathers the progress of queries by run id; events come on another thread."""

    def __init__(self) -> None:
        self.lock, self.rows, self.targets, self.ended, self.batches = threading.Lock(), [], {}, set(), Counter()

    def onQueryStarted(self, event: object) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event: object) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event: object) -> None:  # noqa: N802
        p = event.progress
        with self.lock:
            target = self.targets.get(str(p.runId))
            seen = p.observedMetrics.get(p.name) if target else None
            if seen is not None and seen["rows"]:
                self.batches[str(p.runId)] += 1
                self.rows.append((target, p.batchId, False, seen["rows"], seen["accepted"], seen["arrival_seq"], None, datetime.datetime.now(datetime.timezone.utc)))

    def onQueryTerminated(self, event: object) -> None:  # noqa: N802
        with self.lock:
            self.ended.add(str(event.runId))

    def take(self) -> list[tuple]:
        with self.lock:
            out, self.rows = self.rows, []
            return out


@dataclass
class Worker:
    """A target's query, its failures in a row, and when it starts again."""

    target: Target
    query: StreamingQuery | None = None
    attempts: int = 0
    due: float = 0.0
    state: str = "waiting"
    error: str | None = None


class Supervisor:
    """T2, A7. Runs the queries of all enabled targets over one source.

    A query that fails, at its start or later, starts again from its own checkpoint after ``backoff`` seconds, twice as long each time it
    fails again without a batch between, up to ``most`` seconds; the others go on. After ``attempts`` failures in a row an optional target is
    given up and reported, and a required one raises ``TargetFailed`` after the other queries are stopped. Progress and failures go to a table under ``root``.
    """

    def __init__(self, spark: SparkSession, source: DataFrame, targets: list[Target], root: str, trigger: dict | None = None, attempts: int = 5, backoff: float = 1.0, most: float = 60.0, run: Callable[..., StreamingQuery] = run_target):
        self.spark, self.source, self.root, self.trigger = spark, source, root, trigger
        self.attempts, self.backoff, self.most, self.run_one = attempts, backoff, most, run
        self.workers = {t.target_id: Worker(t) for t in targets if t.enabled}
        self.listener, self.failures = _Listener(), []

    def _start(self, w: Worker) -> None:
        t = w.target
        try:
            w.query = self.run_one(self.source, t, f"{self.root}/{t.target_id}", f"{self.root}/_checkpoints/{t.target_id}", self.trigger)
            w.state = "running"
            with self.listener.lock:
                self.listener.targets[str(w.query.runId)] = t.target_id
        except Exception as error:
            self._failed(w, str(error))

    def _failed(self, w: Worker, error: str, progressed: bool = False) -> None:
        # A run that got a batch through begins a new row of failures.
        w.attempts, w.error = 1 if progressed else w.attempts + 1, error[:256]
        self.failures.append((w.target.target_id, None, True, 0, 0, None, w.error, datetime.datetime.now(datetime.timezone.utc)))
        w.state = "failed" if w.attempts >= self.attempts else "waiting"
        w.due = time.monotonic() + min(self.most, self.backoff * 2 ** (w.attempts - 1))

    def _check(self, w: Worker) -> None:
        if w.state == "waiting" and time.monotonic() >= w.due:
            self._start(w)
        elif w.state == "running" and not w.query.isActive:
            error = w.query.exception()
            if error is None:
                w.state, w.error = "done", None
            else:
                run = str(w.query.runId)
                self._settle({run})
                self._failed(w, str(error), self.listener.batches[run] > 0)

    def _flush(self) -> None:
        rows, self.failures = self.listener.take() + self.failures, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(f"{self.root}/_progress")

    def run(self, timeout: float | None = None, poll: float = 0.1) -> dict[str, Worker]:
        """Until every target is done (a trigger that ends) or given up, or the time is over. Queries that still run then are stopped."""
        self.spark.streams.addListener(self.listener)
        end = None if timeout is None else time.monotonic() + timeout
        try:
            while any(w.state in ("waiting", "running") for w in self.workers.values()) and (end is None or time.monotonic() < end):
                for w in self.workers.values():
                    self._check(w)
                    if w.state == "failed" and w.target.required:
                        raise TargetFailed(f"{w.target.target_id}: {w.error}")
                self._flush()
                time.sleep(poll)
            self._settle({str(w.query.runId) for w in self.workers.values() if w.query is not None and not w.query.isActive})
        finally:
            for w in self.workers.values():
                if w.query is not None and w.query.isActive:
                    w.query.stop()
            self.spark.streams.removeListener(self.listener)
            self._flush()
        return self.workers

    def _settle(self, own: set[str], seconds: float = 10.0) -> None:
        """Waits for the events of runs that ended; they come after the progress of their last batches."""
        end = time.monotonic() + seconds
        while time.monotonic() < end:
            with self.listener.lock:
                if own <= self.listener.ended:
                    return
            time.sleep(0.05)


def progress(spark: SparkSession, root: str) -> DataFrame:
    """A row for each batch and failure. A batch that was tried again after it was written counts once."""
    df = spark.read.schema(PROGRESS).parquet(f"{root}/_progress")
    done = df.filter("NOT failed").groupBy("target_id", "batch_id").agg(*[F.max_by(c, "at").alias(c) for c in ("failed", "num_rows", "accepted", "arrival_seq", "error")], F.max("at").alias("at"))
    return done.select(df.columns).unionByName(df.filter("failed"))


def projection_progress(progress: DataFrame, source: DataFrame, targets: list[Target]) -> DataFrame:
    """A7 from real progress: batches, failures and records of each target, the last arrival it took and how many records are pending."""
    done = progress.groupBy("target_id").agg(F.count_if(~F.col("failed")).alias("batches"), F.count_if("failed").alias("failures"), F.sum("num_rows").alias("records"), F.max("arrival_seq").alias("checkpoint"))
    # A row a target, from configuration; the source is counted for all of them in one pass.
    found = {r["target_id"]: r for r in done.collect()}
    ids = [t.target_id for t in targets if t.enabled]
    after = lambda r: F.count_if(F.lit(True) if r is None or r["checkpoint"] is None else F.col("arrival_seq") > r["checkpoint"])
    per = [F.struct(F.lit(i).alias("target_id"), *[F.lit(found[i][c] if i in found else 0).cast("long").alias(c) for c in ("batches", "failures", "records")], F.lit(found[i]["checkpoint"] if i in found else None).cast("long").alias("checkpoint"), after(found.get(i)).alias("pending")) for i in ids]
    return source.agg(F.array(*per).alias("t")).select(F.inline("t"))


def unique_root(folder: str) -> str:
    return f"{folder}/targets-{uuid.uuid4().hex}"
