"""Mixing sources to target weights by hash-threshold histograms, in DataFrame operations only.

Every document has a 36-bit hash. Sizes are summed by source and the hash's first 12 bits; where the running
sum passes a source's budget lies the boundary bucket, and only its rows are summed again by the next 12
bits, then by the last 12. The result is one threshold per source, and documents below it are taken: no sort,
no gather. The document at the threshold is taken too where that comes nearer to the budget. Targets above a source's size take every document once and spend the rest the same way. A source's long,
middling and short documents have thresholds of their own, in this order, each making up for what the ones before
left of the budget.

Nulls and ties: a null text has size 0; very long texts are counted whole; a null source is a source of its own, the last; rows that agree in id,
source and text share a hash, and are taken or left together. Empty tables and sources of size 0 give target
0 and taken 0. Columns of the input other than those named are carried by `take`, with any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, scratch

BITS = 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_hash(doc_id: Column, source: Column, text: Column) -> Column:
    """36 bits of an md5 of id, source and text."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", doc_id.cast("string"), source, F.md5(text.cast("binary"))).cast("binary")), 1, 9), 16, 10).cast("long")


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """sizes(src, source_size): adds target. Sources in order of code point, null last, get the weights in turn,
    and share `share` of all sizes; a target stops at `most` times its source's size and the excess goes to the
    others by weight. The level at which this ends is found in closed form over sources sorted by where they
    stop. One row per source, which is what the ranking needs."""
    everything = Window.partitionBy()
    name = Window.orderBy(F.col("src") == "n", F.col("src").cast("binary"))
    stop = Window.orderBy(F.col("source_size") / F.col("w"), F.col("place"))
    ranked = sizes.withColumn("place", F.row_number().over(name) - 1)
    ranked = ranked.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long"))
    before = ranked.withColumns({
        "cap": F.col("source_size") * most, "all": F.sum("source_size").over(everything) * share, "all_w": F.sum("w").over(everything),
        "size_before": F.sum("source_size").over(stop) - F.col("source_size"), "w_before": F.sum("w").over(stop) - F.col("w"),
    })
    level = (F.col("all") - F.col("size_before") * most) / (F.col("all_w") - F.col("w_before"))
    # the level is that of the first source, in order of stopping, that doesn't reach its stop
    free = before.withColumn("level", F.when(level * F.col("w") <= F.col("cap"), level))
    free = free.withColumn("level", F.first("level", ignorenulls=True).over(stop.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.coalesce(F.least(F.col("level") * F.col("w"), F.col("cap")), F.col("cap")).cast("double")
    return free.select("src", "source_size", target.alias("target"))


def _thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """rows(src, size, h) and budgets(src, left double): (src, cut): documents with h < cut come as near to the budget
    as a threshold can; of equally near ones the lesser."""
    state = budgets.select("src", "left", F.lit(0).cast("long").alias("cut"))
    for step in (2, 1, 0):
        width = 1 << (BITS * step)
        inside = rows.join(state, "src")
        if step < 2:
            inside = inside.where((F.col("h") >= F.col("cut")) & (F.col("h") < F.col("cut") + F.lit(width << BITS)))
        bucket = F.floor(F.col("h") / width).cast("long")
        sums = inside.groupBy("src", bucket.alias("bucket")).agg(F.sum("size").alias("n"))
        run = sums.withColumn("upto", F.sum("n").over(Window.partitionBy("src").orderBy("bucket"))).join(state, "src")
        found = run.groupBy("src").agg(
            F.max(F.when(F.col("upto") <= F.col("left"), F.col("upto"))).alias("spent"),
            F.min(F.when(F.col("upto") > F.col("left"), F.struct("bucket", "n"))).alias("at"),
        )
        past = F.col("cut") + F.lit(width << BITS)  # no bucket passes the budget: everything inside is taken
        left = F.col("left") - F.coalesce(F.col("spent"), F.lit(0))
        nearer = F.when(F.col("at.n") < 2 * left, 1).otherwise(0) if step == 0 else F.lit(0)
        state = scratch(state.join(found, "src", "left").select("src", left.alias("left"), F.coalesce(F.col("at.bucket") * width + nearer, past).alias("cut")), f"mix-cuts-{step}")
    return state.select("src", "cut")


#: Documents above a 32nd of their source, those above a 512th, and the rest.
STRATA = (32, 512)


def _stratum(size: Column, source_size: Column) -> Column:
    return F.when(size * STRATA[0] > source_size, 0).when(size * STRATA[1] > source_size, 1).otherwise(2)


def plan(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """(rows, goal) of docs(doc_id, text, source): rows(doc_id, src, size, h), and by source goal(src, source_size,
    target, whole, cuts): whole passes, then the documents whose hash is below their stratum's cut once more. Strata
    of smaller documents make up for what those of larger ones miss, so that a source whose words lie in a few long
    documents still comes near its target."""
    rows = scratch(docs.select("doc_id", _key(F.col("source")).alias("src"), n_words(F.col("text")).alias("size"), mix_hash(F.col("doc_id"), F.col("source"), F.col("text")).alias("h")), "mix-rows")
    goal = scratch(targets(rows.groupBy("src").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("whole", whole).withColumn("rest", (F.col("target") - F.col("whole") * F.col("source_size")) / F.greatest("source_size", F.lit(1)))
    kept = rows.join(goal.select("src", "source_size"), "src").withColumn("stratum", _stratum(F.col("size"), F.col("source_size"))).drop("source_size")
    sums = kept.groupBy("src").agg(*(F.coalesce(F.sum(F.when(F.col("stratum") <= k, F.col("size"))), F.lit(0)).alias(f"upto{k}") for k in range(3)))
    goal = scratch(goal.join(sums, "src").withColumn("spent", F.lit(0).cast("long")), "mix-strata")
    for k in range(3):
        part = kept.where(F.col("stratum") == k).select("src", "size", "h")
        cuts = _thresholds(part, goal.select("src", (F.col("rest") * F.col(f"upto{k}") - F.col("spent")).alias("left")))
        took = part.join(cuts, "src").where(F.col("h") < F.col("cut")).groupBy("src").agg(F.sum("size").alias("took"))
        goal = scratch(goal.join(cuts.withColumnRenamed("cut", f"cut{k}"), "src").join(took, "src", "left").withColumn("spent", F.col("spent") + F.coalesce("took", F.lit(0))).drop("took"), f"mix-goal{k}")
    return rows, goal.select("src", "source_size", "target", "whole", F.array("cut0", "cut1", "cut2").alias("cuts"))


def _times(h: Column, size: Column, most: float) -> Column:
    cut = F.element_at("cuts", _stratum(size, F.col("source_size")) + 1)
    return F.least(F.col("whole") + (h < cut).cast("long"), F.lit(int(most)))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """docs(doc_id, text, source): doc_id, size, source_size, target, taken, times."""
    rows, goal = plan(docs, weights, share, most)
    times = _times(F.col("h"), F.col("size"), most)
    return rows.join(goal, "src").select("doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"), times.alias("times"))


def take(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """docs itself as mixed: a row for each time that a document is taken, with the columns of docs."""
    _, goal = plan(docs, weights, share, most)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    keyed = docs.select(row, _key(F.col("source")).alias("src"), n_words(F.col("text")).alias("size"), mix_hash(F.col("doc_id"), F.col("source"), F.col("text")).alias("h")).join(goal, "src")
    timed = keyed.select("row", _times(F.col("h"), F.col("size"), most).alias("times")).where("times > 0")
    return timed.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select(*(F.col(f"row.`{c}`") for c in docs.columns))
