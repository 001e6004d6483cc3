"""Exact deduplication by deterministic block naming.

A normalised text is cut into blocks of `block_bytes`. Distinct blocks are sorted and get integer names; then
adjacent names are paired, distinct pairs sorted and named, until one name per document is left. Texts are
equal exactly if byte length and last name are equal. A name is a rank among sorted bytes (or pairs), not a hash:
hashes only carry names back to the documents, and where two different blocks share their 128 bits, the join
is on the blocks themselves.

Nulls and ties: a null text counts as empty, which is a text like any other; rows with a null id form groups as
others do and are never the row that stays unless all ids of the group are null; repeated rows of the id that
stays are all kept, as one document. Very long texts are named whole. No rows give no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, scratch

NAME_BITS = 40
PAD = -1


def normalise(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _names(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Adds name: the rank of the row in its bucket's sorted keys, after the bucket's number. Equal keys are one
    row before this, so a hot block or pair is one row too. Buckets hold a bounded share of the rows, and a
    lost task sorts the same rows into the same names."""
    spark = distinct.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) * 4
    by = Window.partitionBy("bucket").orderBy(*keys)
    rows = distinct.withColumn("bucket", F.pmod(F.xxhash64(F.lit(7), *keys), F.lit(buckets)))
    return rows.withColumn("name", F.shiftleft(F.col("bucket"), NAME_BITS) + F.row_number().over(by)).drop("bucket")


def _block_column(block_bytes: int) -> Column:
    """All blocks of the binary column `bytes`; one empty block for an empty text."""
    starts = F.sequence(F.lit(1), F.greatest(F.octet_length("bytes"), F.lit(1)), F.lit(block_bytes))
    return F.transform(starts, lambda s: F.substring("bytes", s, F.lit(block_bytes)))


def _named_blocks(texts: DataFrame, block_bytes: int) -> DataFrame:
    """(h1, h2, name, alike): a row per distinct block; alike counts blocks with these 128 bits."""
    blocks = texts.select(F.explode(_block_column(block_bytes)).alias("block"))
    distinct = blocks.groupBy("block").agg(F.count("*").alias("n"))
    named = _names(distinct.select("block"), ["block"])
    return named.select(F.xxhash64("block").alias("h1"), F.xxhash64(F.lit(3), "block").alias("h2"), "name", "block")


def identities(docs: DataFrame, block_bytes: int = 4096) -> DataFrame:
    """docs(doc_id, text): doc_id, n_bytes, sha256 and identity of each row."""
    texts = docs.select("doc_id", normalise(F.col("text")).cast("binary").alias("bytes"))
    hashes = F.transform(_block_column(block_bytes), lambda b: F.struct(F.xxhash64(b).alias("h1"), F.xxhash64(F.lit(3), b).alias("h2")))
    rows = scratch(
        texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.octet_length("bytes").alias("n_bytes"), F.sha2("bytes", 256).alias("sha256"), hashes.alias("hashes")),
        "naming-rows",
    )
    table = scratch(_named_blocks(texts, block_bytes).drop("block"), "naming-blocks")
    clash = table.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    if clash:  # two blocks share 128 bits: names go back by the blocks themselves
        # row numbers are data here too: rows are written anew with their bytes
        held = scratch(texts.withColumn("row", F.monotonically_increasing_id()), "naming-texts")
        rows = held.select("row", "doc_id", F.octet_length("bytes").alias("n_bytes"), F.sha2("bytes", 256).alias("sha256"), hashes.alias("hashes"))
        parts = held.select("row", F.posexplode(_block_column(block_bytes)).alias("at", "block"))
        sequence = parts.join(_named_blocks(held, block_bytes).select("block", "name"), "block").select("row", "at", "name")
    else:
        parts = rows.select("row", F.posexplode("hashes").alias("at", "h")).select("row", "at", "h.h1", "h.h2")
        sequence = parts.join(table, ["h1", "h2"]).select("row", "at", "name")
    sequence = scratch(sequence, "naming-level0")
    done = sequence.where("at = 0").join(rows.where(F.size("hashes") == 1).select("row"), "row").select("row", "name", F.lit(0).alias("level"))
    longest = rows.agg(F.max(F.size("hashes"))).first()[0] or 0
    left, level = sequence.join(rows.where(F.size("hashes") > 1).select("row"), "row"), 0
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        half = left.groupBy("row", F.shiftright("at", 1).alias("at")).agg(
            F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(PAD)).alias("b")
        )
        half = scratch(half, f"naming-pairs{level}")
        pairs = _names(half.select("a", "b").groupBy("a", "b").agg(F.count("*").alias("n")).drop("n"), ["a", "b"])
        left = scratch(half.join(pairs, ["a", "b"]).select("row", "at", "name"), f"naming-level{level}")
        size = left.groupBy("row").agg(F.max("at").alias("last"), F.max("name").alias("name"))
        done = done.unionByName(size.where("last = 0").select("row", "name", F.lit(level).alias("level")))
        left = left.join(size.where("last > 0").select("row"), "row", "left_semi")
    return rows.join(done, "row").select("doc_id", "n_bytes", "sha256", F.struct("n_bytes", "level", "name").alias("identity"))


def deduplicate(docs: DataFrame, block_bytes: int = 4096) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256. Groups of several rows are a table
    of their own, joined back (AQE splits a hot group), never windowed."""
    found = scratch(identities(docs, block_bytes), "naming-identities")
    groups = found.groupBy("identity").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1")
    joined = found.join(scratch(groups, "naming-groups"), "identity", "left")
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return joined.select("doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), F.col("sha256").alias("text_sha256"))
