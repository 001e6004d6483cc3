"""Sharding by a hypergeometric communication matrix.

Rows sit in source blocks. For each block the number of its rows that go to each shard is drawn from the
multivariate hypergeometric law, given the shards' exact sizes, so that the whole is a uniform shuffle. Rows
are permuted inside their block, cut by these counts, exchanged, and permuted again inside the shard.
Law `rows`: shard sizes differ by one at most.

Only the matrix (blocks x shards, blocks at most `max_blocks`) is on the driver. The narrow rows are written
once with the number of their source block, so a lost executor can't change a draw. Nulls: a null text has
size 8 and crc32 0; null and repeated ids are rows like any other; very long texts are read for their size and sum
alone and never moved. An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Number of good ones among draws without replacement, for populations of any size."""
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    n = good + bad
    low, high = max(0, draws - bad), min(good, draws)
    mean = draws * good / n
    sd = math.sqrt(max(1.0, mean * (bad / n) * ((n - draws) / max(1, n - 1))))
    a, b = max(low, int(mean - 12 * sd)), min(high, int(mean + 12 * sd) + 1)
    k = np.arange(a, b, dtype=np.float64)  # log of the ratio of neighbouring probabilities, summed from a
    steps = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.exp(logs - logs.max())
    return a + int(np.searchsorted(np.cumsum(weights), rng.random() * weights.sum()))


def communication_matrix(blocks: list[int], shards: list[int], seed: int) -> np.ndarray:
    """Counts by (block, shard): row sums are the blocks' sizes, column sums the shards'."""
    rng, left = np.random.default_rng(seed), [int(x) for x in shards]
    out = np.zeros((len(blocks), len(shards)), dtype=np.int64)
    for i, size in enumerate(blocks):
        need, rest = int(size), sum(left)
        for j in range(len(left)):
            rest -= left[j]
            out[i, j] = take = need if rest == 0 else hypergeometric(rng, left[j], rest, need) if need and left[j] else 0
            left[j] -= take
            need -= take
    return out


def shard_documents(docs: DataFrame, n_shards: int = 24, seed: int = 20, max_blocks: int = 4096, slot_rows: int = 50_000) -> DataFrame:
    """docs(doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard. Slots count from 0 without
    gaps in each shard; they come from pieces of about slot_rows rows, so no task sorts a whole shard."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = scratch(
        docs.select(
            "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
            F.pmod(F.spark_partition_id(), F.lit(max_blocks)).alias("block"), F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    sizes = [(r.block, r.n) for r in rows.groupBy("block").agg(F.count("*").alias("n")).orderBy("block").collect()]
    total = sum(n for _, n in sizes)
    shards = [total // n_shards + (j < total % n_shards) for j in range(n_shards)]
    matrix = communication_matrix([n for _, n in sizes], shards, seed).cumsum(axis=1)
    cuts = spark.createDataFrame([(b, [int(x) for x in line]) for (b, _), line in zip(sizes, matrix, strict=True)], "block int, cuts array<long>")
    local = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed), "row"), "row")
    placed = (
        rows.withColumn("rank", F.row_number().over(local))
        .join(F.broadcast(cuts), "block")  # at most max_blocks rows of n_shards numbers
        .withColumn("shard", F.size(F.filter("cuts", lambda c: c < F.col("rank"))))
        .drop("cuts", "rank")
    )
    pieces = max(1, -(-total // (n_shards * slot_rows)))
    order = F.xxhash64(F.lit(seed + 1), "row")
    placed = scratch(placed.withColumns({"order": order, "piece": F.pmod(F.shiftright(order, 20), F.lit(pieces)).cast("int")}), "shard-placed")
    before = placed.groupBy("shard", "piece").agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(Window.partitionBy("shard").orderBy("piece")) - F.col("n")
    ).drop("n")
    piece = Window.partitionBy("shard", "piece").orderBy("order", "row")
    return (
        placed.withColumn("within", F.row_number().over(piece) - 1)
        .join(before, ["shard", "piece"])
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("before") + F.col("within")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
