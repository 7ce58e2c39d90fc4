"""Intermediate tables in the folder that all machines share."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, SparkSession] = {}


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; only in local mode one is made here where that is unset."""
    sc = spark.sparkContext
    found = sc._jsc.sc().getCheckpointDir()
    if found.isEmpty():
        given = spark.conf.get("spark.checkpoint.dir", None)
        if not given and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir is not set; it must name a folder that all machines share")
        sc.setCheckpointDir(given or tempfile.mkdtemp(prefix="spark-checkpoint-"))
        found = sc._jsc.sc().getCheckpointDir()
    return found.get()


def file_system(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path, as Hadoop objects; any store that Spark reads has one."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def no_leftovers(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes within go when each write ends, and not when the driver happens to collect its garbage. Nothing reads them again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once as a table and read back, so that each later use reads only the columns it needs.

    The table goes with the process that made it, or earlier by ``discard``.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with no_leftovers(df.sparkSession):
        df.write.parquet(path)
    _made[path] = df.sparkSession
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(df: DataFrame) -> None:
    """Removes a table of ``stored`` that nothing reads any more."""
    path = getattr(df, "stored_path", None)
    if path is not None and (spark := _made.pop(path, None)) is not None:
        fs, p = file_system(spark, path)
        fs.delete(p, True)


@atexit.register
def _discard_all() -> None:
    while _made:
        path, spark = _made.popitem()
        try:
            fs, p = file_system(spark, path)
            fs.delete(p, True)
        except Exception:  # The process ends; the JVM may be gone already.
            return
