"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame operations only.

Items are partitioned by the number of their distinct shingles. An item's sketch is its k smallest shingle hashes (a
bottom-k MinHash of one permutation). A partition sets k: the most shingles that may be missing from a document that
contains its items, and `spare` times its greatest size more, at least one. Of a document that contains an item, all of
the sketch but the shingles that may be missing must be there; this number, `need`, is the item's, at least one and
more in partitions of larger items. The document's sketch is all its shingles with a hash up to the greatest of any
sketch. A document with `need` hashes of a sketch, and shingles enough to contain the item, is a candidate; a candidate
is verified by counting the item's distinct shingles, as text, in the document's whole text. No link is lost, and
a shingle that is common in the corpus makes candidates only of items that are hardly more than it.
(One MinHash coordinate agrees with a chance of the Jaccard index, 0.001 for a short item in a document of 20 000 words, so
banded coordinates lose items, however their bands are tuned by size; README has the figures.)

Nulls and ties: null, empty and wordless texts contain nothing and are contained in nothing; a text with fewer
words than a shingle is one shingle; rows with a null id are compared like others; repeated rows give repeated
results; items that share an id are items of their own. Very long texts are searched whole. No documents or no items
give no rows. Columns of the inputs other than those named are carried by `clean`, with any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LONG_MAX, WHITE, ascii_lower, scratch


def _words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WHITE), lambda w: w != "")


def _hashed(words: str, size: int) -> Column:
    """Hashes of the shingles of an array column of words, made of the words' hashes. These are bound as a lambda's
    variable: written in the inner lambda they would be made anew for each shingle."""
    n = F.size(words)
    starts = F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)))
    bound = F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), lambda h: F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, size))))
    return F.when(n == 0, F.array().cast("array<long>")).otherwise(F.element_at(bound, 1))


def _shingles(words: str, size: int) -> Column:
    n = F.size(words)
    starts = F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1)))
    return F.when(n == 0, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " "))))


def _item_key():
    return F.xxhash64(F.col("item_id").cast("string"), F.lit("|"), F.col("text")).alias("item_key")


def item_sketches(items: DataFrame, size: int = 5, percent: int = 80, spare: float = 0.1) -> DataFrame:
    """items(item_id, text): (item_key, partition, n, need, hash), the bottom-k sketch of each item; partition p holds items
    of more than 2**(p - 1) and up to 2**p distinct shingles."""
    hashed = items.select(_item_key(), _words(F.col("text")).alias("words")).select("item_key", F.array_sort(F.array_distinct(_hashed("words", size))).alias("hashes"))
    hashed = hashed.where(F.size("hashes") > 0).dropDuplicates(["item_key"]).withColumn("n", F.size("hashes"))
    hashed = hashed.withColumn("partition", F.ceil(F.log2("n")).cast("int"))
    most = F.pow(F.lit(2), F.col("partition"))
    k = F.floor(most * (100 - percent) / 100).cast("int") + F.ceil(most * spare).cast("int")
    sketch = F.slice("hashes", F.lit(1), k)
    need = F.size(sketch) - F.floor(F.col("n") * (100 - percent) / 100).cast("int")
    return hashed.select("item_key", "partition", "n", need.alias("need"), F.explode(sketch).alias("hash"))


def contaminated(docs: DataFrame, items: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, k1, k2, item_id, n_shared, n_shingles) for every document and item with at least percent/100 of the
    item's distinct shingles in the document. k1 and k2 are the key made by `keys`."""
    sketch = scratch(item_sketches(items, size, percent), "leak-sketch")
    most = sketch.agg(F.max("hash")).first()[0]
    hashes = scratch(sketch.select("hash").distinct(), "leak-hashes")
    keyed = docs.select("doc_id", *keys(docs), "text")
    probes = keyed.select("k1", "k2", _words(F.col("text")).alias("words")).select("k1", "k2", F.size("words").alias("n_words"), F.explode(_hashed("words", size)).alias("hash"))
    probes = probes.where(F.col("hash") <= F.lit(most if most is not None else -LONG_MAX - 1))
    # the planner broadcasts the sketch where its file is small and sorts both sides where it isn't
    hits = probes.join(hashes, "hash").groupBy("k1", "k2", "hash").agg(F.max("n_words").alias("n_words"))
    shared = hits.join(sketch.select("item_key", "n", "need", "hash"), "hash").groupBy("k1", "k2", "item_key").agg(F.count("*").alias("found"), F.max("n").alias("n"), F.max("need").alias("need"), F.max("n_words").alias("n_words"))
    # a text of w words has w - size + 1 shingles at most, and one at least
    enough = F.greatest(F.col("n_words") - size + 1, F.lit(1)) * 100 >= F.col("n") * percent
    candidates = scratch(shared.where((F.col("found") >= F.col("need")) & enough).select("k1", "k2", "item_key"), "leak-candidates")
    wanted = scratch(candidates.select("k1", "k2").distinct(), "leak-wanted")
    shingled = items.select("item_id", _item_key(), _words(F.col("text")).alias("words")).select("item_id", "item_key", _shingles("words", size).alias("shingles"))
    shingled = scratch(shingled.where(F.size("shingles") > 0).select("item_id", "item_key", F.size("shingles").alias("n_shingles"), "shingles"), "leak-items")
    texts = keyed.join(wanted, ["k1", "k2"], "left_semi").select("doc_id", "k1", "k2", _words(F.col("text")).alias("words"))
    found = texts.select("doc_id", "k1", "k2", _shingles("words", size).alias("doc_shingles")).join(candidates, ["k1", "k2"]).join(shingled, "item_key")
    found = found.withColumn("n_shared", F.size(F.array_intersect("doc_shingles", "shingles")))
    return found.where(F.col("n_shared") * 100 >= F.col("n_shingles") * percent).select("doc_id", "k1", "k2", "item_id", "n_shared", "n_shingles")


def keys(docs: DataFrame) -> list[Column]:
    """A null-free key of a document, which only repeated rows share."""
    return [F.coalesce(F.col("doc_id"), F.lit(LONG_MAX)).cast("long").alias("k1"), F.xxhash64("text").alias("k2")]


def clean(docs: DataFrame, items: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """docs without the contaminated ones; columns stay as they are."""
    found = scratch(contaminated(docs, items, size, percent).select(F.col("k1").alias("__leak_k1"), F.col("k2").alias("__leak_k2")).distinct(), "leak-found")
    k1, k2 = keys(docs)
    held = docs.withColumns({"__leak_k1": k1, "__leak_k2": k2}).join(found, ["__leak_k1", "__leak_k2"], "left_anti")
    return held.select(*(F.col(f"`{c}`") for c in docs.columns))
