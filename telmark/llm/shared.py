"""Helpers used by several operators: durable checkpoints and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telmark.sources.store import checkpoint_folder, discard, stored


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint in the shared folder; the files survive a lost executor."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As ``durable``, by a table in the shared folder: its rows are worked out once, where an eager checkpoint counts them first."""
    return stored(df, "written")


def free_name(columns: list[str], name: str) -> str:
    """The name, with underscores before it as long as a column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def connected_components(edges: DataFrame, max_rounds: int = 60, task_rows: int = 100_000) -> DataFrame:
    """``(a long, b long)`` undirected edges to ``(node, component)``, the smallest node reachable.

    Alternating large-star and small-star steps: each turns the edges into stars around
    smaller nodes until nothing changes. A node with a very large neighbourhood costs a
    partial-aggregated minimum and a join whose hot side adaptive execution can split; no
    neighbourhood is gathered in one row. Each step runs in a task for each ``task_rows`` edges at most, since
    many exchanges of few rows over many partitions would cost a file for each. Nodes without an edge are
    absent. Self edges and nulls are ignored; an empty input gives an empty result.
    """

    def stars(e: DataFrame, large: bool, tasks: int) -> DataFrame:
        both = e if not large else e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Both sides are dealt by a already; a broadcast a step would pile up in the executors' memory.
        j = both.join(low.hint("merge"), "a")
        if large:
            out = j.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        return out.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).coalesce(tasks).distinct().coalesce(tasks)

    def mark(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    e = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e)
    before = mark(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        tasks = -(-before[0] // task_rows)
        last, e = e, written(stars(stars(e.coalesce(tasks), True, tasks), False, tasks))
        discard(last)
        now = mark(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not converge")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
