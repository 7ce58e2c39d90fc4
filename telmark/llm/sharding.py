"""Operator 8: an exact uniform shuffle into shards by a hypergeometric communication matrix.

Rows are dealt into blocks by a hash. Given the blocks' sizes and the shards' sizes (which
differ by one at most), the matrix of how many rows each block sends to each shard is drawn
from the multivariate hypergeometric law, exactly the law it has under a uniform permutation.
Each block then permutes its rows locally and cuts the order by its row of the matrix; each
shard permutes what it gets. Blocks and parts of shards are sized from the count, so no task
holds a whole shard.

Only counts reach the driver: one per block. All work on rows is DataFrame expressions.

Defined results: a null text has no bytes, size 1 and checksum 0. Rows that are equal in all
of doc_id and text are interchangeable, each gets a slot of its own. Null doc_ids are rows
like others. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` without replacement are good: inversion outward from the mode."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    choose = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    p = math.exp(choose(good, mode) + choose(bad, draws - mode) - choose(good + bad, draws))
    u, up, down, pu, pd = rng.random() - p, mode, mode, p, p
    while u > 0:
        moved = False
        if up < high:
            pu *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up, u, moved = up + 1, u - pu, True
            if u <= 0:
                return up
        if down > low:
            pd *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down, u, moved = down - 1, u - pd, True
            if u <= 0:
                return down
        if not moved or (pu < 1e-300 and pd < 1e-300):
            return mode
    return mode


def communication_matrix(blocks: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows sum to ``blocks``, columns to ``shards``; drawn block by block, shard by shard."""
    rng = random.Random(seed)
    left, out = list(shards), []
    for size in blocks:
        row, rest, pool = [], size, sum(left)
        for have in left:
            pool -= have
            x = hypergeometric(rng, have, pool, rest)
            row.append(x)
            rest -= x
        left = [a - b for a, b in zip(left, row, strict=True)]
        out.append(row)
    return out


def shuffle_into_shards(docs: DataFrame, n_shards: int = 16, seed: int = 7, block_rows: int = 65536) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of each row; law ``rows``."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).alias("text_crc32"),
    )
    total = docs.count()
    n_blocks = max(1, min(8192, -(-total // block_rows)))
    key = lambda salt: F.xxhash64("doc_id", "text_crc32", "size", F.lit(seed * 1000 + salt))
    rows = rows.withColumn("block", F.pmod(key(1), F.lit(n_blocks)).cast("int"))
    sizes = {r["block"]: r["n"] for r in rows.groupBy("block").agg(F.count("*").alias("n")).collect()}
    blocks = [sizes.get(b, 0) for b in range(n_blocks)]
    shards = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    matrix = communication_matrix(blocks, shards, seed)
    cuts = [(b, s, sum(row[:s]), sum(row[: s + 1])) for b, row in enumerate(matrix) for s in range(n_shards) if row[s]]
    sends = spark.createDataFrame(cuts, T.StructType([T.StructField("block", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("from", T.LongType()), T.StructField("to", T.LongType())]))
    table = sends.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("from", "to", "shard"))).alias("sends"))
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("block").orderBy(key(2), "doc_id", "text_crc32", "size")) - 1)
    # The table has n_blocks rows, 8,192 at most, of n_shards entries each.
    sent = ranked.join(F.broadcast(table), "block").withColumn("shard", F.filter("sends", lambda x: (x["from"] <= F.col("r")) & (F.col("r") < x["to"]))[0]["shard"]).drop("sends", "r", "block")
    # Second permutation: by a fresh key, in parts of each shard, offset by the parts before.
    n_parts = max(1, -(-total // (n_shards * block_rows)))
    sent = sent.withColumn("k", key(3)).withColumn("part", F.floor((F.shiftrightunsigned("k", 11) / F.lit(float(2**53))) * n_parts).cast("int"))
    inside = Window.partitionBy("shard", "part").orderBy("k", "doc_id", "text_crc32", "size")
    if n_parts == 1:
        placed = sent.withColumn("slot", (F.row_number().over(inside) - 1).cast("long"))
    else:
        from telmark.llm.shared import durable

        sent = durable(sent)
        before = sent.groupBy("shard", "part").agg(F.count("*").alias("n")).withColumn("base", F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).drop("n")
        placed = sent.withColumn("slot", F.row_number().over(inside) - 1).join(before, ["shard", "part"]).withColumn("slot", (F.col("slot") + F.col("base")).cast("long"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
