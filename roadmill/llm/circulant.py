"""Near-duplicates by circulant MinHash.

A document's word shingles are hashed to 64 bits. Two permutations of 0 to 2**32 - 1 make the whole signature: the
first relabels the shingles, the second, shifted by k places round the circle, gives coordinate k. Both are invertible
mixes, computed and not stored, so the universe is wide enough for texts of millions of words. Bands of the signature
bring documents together, and every link is confirmed on the full shingle sets.

Documents with the same set are one class. In a band's bucket of up to `small` classes all are compared; in a
larger one, each is compared with the bucket's cleanest class (the fewest shingles of its own), and then, while a
bucket still holds several components, with pivots from outside its largest component, until each class outside it
has been compared with all others of the bucket. Pairs are left out only if the numbers of shingles that neither
shares with anyone rule a link out. So no link of a bucket is lost. A larger bucket is dealt by chunks of `chunk`
classes: what holds for the whole bucket (its cleanest class, its largest component, a round's pivots) goes to every
chunk, so that no task holds a bucket.

Nulls and ties: documents without words are linked with nothing; rows with a null id are linked like others
but name no component; repeated rows share a class. Very long texts are taken whole, by slices of bounded size. No rows
give no rows. Columns other than doc_id and text are not read by `near_duplicates`; `keep_one` carries them, with any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LONG_MAX, pieces, scratch, use_worker
from .components import connected_components

#: Groups of shingles, by their hashes' first bits, whose counts bound an intersection.
GROUP_BITS = 6
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """An invertible mix of 32-bit numbers, in place: a permutation of 0 to 2**32 - 1."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    x ^= x >> np.uint32(16)
    return x


class Signer:
    """Shingle sets and signatures."""

    def __init__(self, shingle: int, coordinates: int, seed: int):
        rng = np.random.default_rng(seed)
        self.shingle, self.coordinates = shingle, coordinates
        self.first, self.second = (np.uint32(x) for x in rng.integers(0, 1 << 32, 2, np.uint64))
        self.shifts = np.arange(coordinates, dtype=np.uint32)

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the text's shingles, A-Z lower-cased; with fewer words than a shingle
        has, one of the whole sequence."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        size = min(self.shingle, len(words))
        out = np.full(len(words) - size + 1, len(words) if size < self.shingle else 0, np.uint64)
        for i in range(size):
            out = (out ^ h[i : i + len(out)]) * _MULTIPLY
            out ^= out >> np.uint64(29)
        return np.unique(out)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        at = _mix((shingles >> np.uint64(32)).astype(np.uint32) ^ self.first)
        out = np.full(self.coordinates, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(at), 256):  # a slice of bounded size
            moved = at[i : i + 256, None] + self.shifts  # round the circle: sums wrap
            moved ^= self.second
            np.minimum(out, _mix(moved).min(axis=0), out=out)
        return out

    def bands(self, shingles: np.ndarray, rows: int) -> np.ndarray:
        parts = self.signature(shingles).astype(np.uint64).reshape(-1, rows)
        out = np.zeros(len(parts), np.uint64)
        for i in range(rows):
            out = (out ^ parts[:, i]) * _MULTIPLY
            out ^= out >> np.uint64(31)
        return out.view(np.int64)


_signers: dict[tuple, Signer] = {}


def _signer(*key) -> Signer:
    if key not in _signers:
        _signers[key] = Signer(*key)
    return _signers[key]


def _fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    data = shingles.tobytes()
    return xxhash.xxh64_intdigest(data, 1) - 2**63, xxhash.xxh64_intdigest(data, 2) - 2**63


def _sign(shingle: int, coordinates: int, rows: int, seed: int):
    schema = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_worker("circulant", _signers.clear)
        signer = _signer(shingle, coordinates, seed)
        for batch in batches:
            for ids, k1, k2, texts in pieces(batch, "doc_id", "k1", "k2", "text"):
                n, fp, bands = [], [], []
                for t in texts:
                    s = signer.shingles(t)
                    n.append(len(s))
                    fp.append(_fingerprint(s))
                    bands.append(signer.bands(s, rows) if len(s) else [])
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((ids, k1, k2, n, [a for a, _ in fp], [b for _, b in fp], bands), schema, strict=True)], schema=schema)

    return run, "doc_id long, k1 long, k2 long, n long, fp1 long, fp2 long, bands array<long>"


def _sets(shingle: int, coordinates: int, seed: int):
    schema = pa.schema([("cid", pa.int64()), ("shingles", pa.list_(pa.int64())), ("groups", pa.list_(pa.int64()))])
    shift, size = np.uint64(64 - GROUP_BITS), 1 << GROUP_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use_worker("circulant", _signers.clear)
        signer = _signer(shingle, coordinates, seed)
        for batch in batches:
            for cid, texts in pieces(batch, "cid", "text"):
                sets = [signer.shingles(t) for t in texts]
                groups = [np.bincount((x >> shift).astype(np.int64), minlength=size) for x in sets]
                yield pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())), pa.array(groups, pa.list_(pa.int64()))], schema=schema)

    return run, "cid long, shingles array<long>, groups array<long>"


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text with a null-free key, which only repeated rows share."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(k.alias(n) for k, n in zip(_keys(), ("k1", "k2"), strict=True)), "text")


def _keys() -> tuple:
    return F.coalesce(F.col("doc_id"), F.lit(LONG_MAX)).cast("long"), F.xxhash64("text")


def _enough(both, percent: int):
    """Whether sets of n and n2 shingles with at most so many in common can be alike enough."""
    return both * 100 >= (F.col("n") + F.col("n2") - both) * percent


def _possible(percent: int):
    """Whether a class (n, alone, groups) and another (n2, alone2, groups2) can be linked: shared shingles are at most
    those that anyone shares, in all and group by group."""
    rough = F.least(F.col("n") - F.col("alone"), F.col("n2") - F.col("alone2"))
    fine = F.aggregate(F.zip_with("groups", "groups2", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda s, x: s + x)
    return _enough(rough, percent) & _enough(fine, percent)


def _pairs(a: str, b: str) -> list:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


class _Verifier:
    """Confirms pairs of classes on full sets; sets are made once for each class that is in a pair."""

    def __init__(self, docs: DataFrame, classes: DataFrame, shingle: int, coordinates: int, seed: int, percent: int):
        self.docs, self.classes, self.percent = _keyed(docs), classes, percent
        self.make, self.schema = _sets(shingle, coordinates, seed)
        self.sets: DataFrame | None = None

    def prepare(self, nodes: DataFrame) -> DataFrame:
        """Makes the sets of nodes(cid) that aren't there yet; returns the sets of all nodes."""
        fresh = nodes if self.sets is None else nodes.join(self.sets.select("cid"), "cid", "left_anti")
        keys = self.classes.join(fresh, "cid", "left_semi").select("cid", "k1", "k2")
        texts = self.docs.select("k1", "k2", "text").join(keys, ["k1", "k2"]).select("cid", "text")
        made = texts.mapInArrow(self.make, self.schema)
        made = scratch(made.groupBy("cid").agg(F.first("shingles").alias("shingles"), F.first("groups").alias("groups")), "near-sets")
        self.sets = made if self.sets is None else self.sets.unionByName(made)
        return self.sets.join(nodes, "cid", "left_semi")

    def links(self, pairs: DataFrame) -> DataFrame:
        sets = self.prepare(pairs.select(F.explode(F.array("u", "v")).alias("cid")).distinct())
        a = sets.select(F.col("cid").alias("u"), F.col("shingles").alias("a"))
        b = sets.select(F.col("cid").alias("v"), F.col("shingles").alias("b"))
        both = pairs.join(a, "u").join(b, "v").withColumn("both", F.size(F.array_intersect("a", "b")))
        return scratch(both.where(F.col("both") * 100 >= (F.size("a") + F.size("b") - F.col("both")) * self.percent).select("u", "v"), "near-links")


def _crowded(members: DataFrame, verifier: _Verifier, percent: int, chunk: int, pivots: int) -> DataFrame:
    """(b, salts, salt, cid, n, alone, groups) of large buckets. alone counts a set's shingles that no other set in these
    buckets has, groups the other ones by group: they bound its similarity with any of them from above, exactly,
    and a class that can't reach the percentage with any goes. Sums meet in aggregates, so shingles that all share
    cost no more than others."""
    sets = verifier.prepare(members.select("cid").distinct())
    once = sets.select("cid", F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("c"), F.min("cid").alias("cid")).where("c = 1")
    by_group = once.groupBy("cid", F.shiftrightunsigned("s", 64 - GROUP_BITS).cast("int").alias("g")).agg(F.count("*").alias("c"))
    alone = by_group.groupBy("cid").agg(F.sum("c").alias("alone"), F.map_from_entries(F.collect_list(F.struct("g", "c"))).alias("own"))
    told = sets.select("cid", "groups").join(alone, "cid", "left")
    left = F.transform("groups", lambda x, g: x - F.coalesce(F.try_element_at(F.col("own"), g), F.lit(0)))
    told = scratch(told.select("cid", F.coalesce("alone", F.lit(0)).cast("long").alias("alone"), F.when(F.col("own").isNull(), F.col("groups")).otherwise(left).alias("groups")), "near-alone")
    held = members.withColumn("salts", _chunks(F.col("size"), chunk, pivots)).select("b", "salts", F.pmod(F.xxhash64("cid"), "salts").cast("int").alias("salt"), "cid", "n").join(told, "cid")
    return scratch(held.where((F.col("n") - F.col("alone")) * 100 >= F.col("n") * percent).select("b", "salts", "salt", "cid", "n", "alone", "groups"), "near-crowded")


def _chunks(size, chunk: int, pivots: int):
    """Chunks of a bucket: one for every `chunk` classes, but no more than a round's pivots, as each gives one."""
    return F.least(F.ceil(size / F.lit(chunk)), F.lit(pivots)).cast("int")


def _everywhere(df: DataFrame) -> DataFrame:
    """A row for each chunk of the row's bucket: salt from 0 to salts."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))


def _signed(docs: DataFrame, shingle: int, bands: int, rows: int, seed: int) -> DataFrame:
    sign, schema = _sign(shingle, bands * rows, rows, seed)
    return scratch(_keyed(docs).mapInArrow(sign, schema), "near-signed")


def _classes(signed: DataFrame) -> DataFrame:
    classes = signed.where("n > 0").groupBy("fp1", "fp2", "n").agg(F.min(F.struct("k1", "k2")).alias("k"), F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"))
    return scratch(classes.select(F.monotonically_increasing_id().alias("cid"), "fp1", "fp2", "n", "k.k1", "k.k2", "first_id", "bands"), "near-classes")


def _labels(docs: DataFrame, classes: DataFrame, shingle: int, percent: int, bands: int, rows: int, seed: int, small: int, pivots: int, chunk: int) -> DataFrame:
    """(node, component) of the classes that are linked with others."""
    placed = classes.select("cid", "n", F.posexplode("bands").alias("band", "key"))
    buckets = placed.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    buckets = scratch(buckets.select(F.monotonically_increasing_id().alias("b"), "band", "key", "size"), "near-buckets")
    members = scratch(placed.join(buckets, ["band", "key"]).select("b", "size", "cid", "n"), "near-members")
    verifier = _Verifier(docs, classes, shingle, bands * rows, seed, percent)
    few = members.where(F.col("size") <= small)
    other = few.select("b", F.col("cid").alias("cid2"), F.col("n").alias("n2"))
    pairs = few.join(other, "b").where((F.col("cid") < F.col("cid2")) & _enough(F.least("n", "n2"), percent)).select(*_pairs("cid", "cid2"))
    many = _crowded(members.where(F.col("size") > small), verifier, percent, chunk, pivots)
    pivot = [F.col("p.cid").alias("pivot"), F.col("p.n").alias("n2"), F.col("p.alone").alias("alone2"), F.col("p.groups").alias("groups2")]
    centre = scratch(many.groupBy("b").agg(F.max("salts").alias("salts"), F.min(F.struct("alone", "cid", "n", "groups")).alias("p")).select("b", "salts", *pivot), "near-centres")
    star = many.join(_everywhere(centre).drop("salts"), ["b", "salt"]).where((F.col("cid") != F.col("pivot")) & _possible(percent))
    pairs = scratch(pairs.unionByName(star.select(*_pairs("cid", "pivot"))).distinct(), "near-pairs")
    links = verifier.links(pairs)
    labels = connected_components(links)
    used, tried = centre.select("b", F.col("pivot").alias("cid")), pairs
    while True:
        told = many.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
        told = scratch(told.join(used.withColumn("used", F.lit(True)), ["b", "cid"], "left"), "near-told")
        # each bucket's largest component, and whether there is another
        parts = told.groupBy("b", "component").agg(F.count("*").alias("members"), F.max("salts").alias("salts"))
        largest = parts.groupBy("b").agg(F.max(F.struct("members", "component")).alias("most"), F.max("salts").alias("salts"), F.count("*").alias("parts")).where("parts > 1")
        largest = scratch(largest.select("b", "salts", F.col("most.component").alias("largest")), "near-largest")
        # a round's pivots: the cleanest few of every chunk outside the largest component
        outside = told.join(_everywhere(largest).drop("salts"), ["b", "salt"]).where((F.col("component") != F.col("largest")) & F.col("used").isNull())
        turn = F.row_number().over(Window.partitionBy("b", "salt").orderBy("alone", "cid"))
        now = outside.withColumn("turn", turn).where(F.col("turn") <= F.floor(F.lit(pivots) / F.col("salts")))
        now = scratch(now.select("b", "salts", F.col("component").alias("of"), F.col("cid").alias("pivot"), F.col("n").alias("n2"), F.col("alone").alias("alone2"), F.col("groups").alias("groups2")), "near-pivots")
        if not now.limit(1).count():
            return labels
        more = told.join(_everywhere(now).drop("salts"), ["b", "salt"]).where((F.col("component") != F.col("of")) & _possible(percent)).select(*_pairs("cid", "pivot")).distinct()
        more = scratch(more.join(tried, ["u", "v"], "left_anti"), "near-pairs")
        used = scratch(used.unionByName(now.select("b", F.col("pivot").alias("cid"))), "near-used")
        if more.limit(1).count():
            tried = scratch(tried.unionByName(more), "near-tried")
            found = verifier.links(more)
            if found.limit(1).count():
                links = scratch(links.unionByName(found), "near-links")
                labels = connected_components(links)


def _named(docs: DataFrame, shingle: int, percent: int, bands: int, rows: int, seed: int, small: int, pivots: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """(signed, named): the rows with their fingerprints, and of each fingerprint the least id of its component and the
    least key."""
    signed = _signed(docs, shingle, bands, rows, seed)
    classes = _classes(signed)
    labels = _labels(docs, classes, shingle, percent, bands, rows, seed, small, pivots, chunk)
    told = classes.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = told.groupBy("component").agg(F.min("first_id").alias("component_id"), F.min(F.struct("k1", "k2")).alias("first"))
    return signed, scratch(told.join(least, "component").select("fp1", "fp2", "n", "component_id", "first"), "near-named")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 32, rows: int = 4, seed: int = 8, small: int = 8, pivots: int = 512, chunk: int = 128) -> DataFrame:
    """docs(doc_id, text): doc_id, n_shingles, component_id, kept; documents with intersection over union of at
    least percent/100 are linked, a component's smallest id names it. With 32 bands of 4, a pair at 0.8 shares
    no band with a chance of 5e-8."""
    signed, named = _named(docs, shingle, percent, bands, rows, seed, small, pivots, chunk)
    out = signed.where("n > 0").select("doc_id", "n", "fp1", "fp2").join(named.drop("first"), ["fp1", "fp2", "n"]).select("doc_id", "n", "component_id")
    alone = signed.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 32, rows: int = 4, seed: int = 8, small: int = 8, pivots: int = 512, chunk: int = 128) -> DataFrame:
    """docs with one row of each component: the one of the least (id, hash of the text), a null id being the last; of
    rows that agree in both, the one with the least hash of all columns. Rows without words all stay. Decisions go by id
    and text, so rows that share an id only, or have none, are told apart. Columns stay as they are."""
    signed, named = _named(docs.select("doc_id", "text"), shingle, percent, bands, rows, seed, small, pivots, chunk)
    told = signed.where("n > 0").select("k1", "k2", "fp1", "fp2", "n").join(named.select("fp1", "fp2", "n", "first"), ["fp1", "fp2", "n"])
    counted = told.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.max((F.struct("k1", "k2") != F.col("first")).cast("int")).alias("gone"))
    marked = scratch(counted.where("gone = 1 or copies > 1").select(F.col("k1").alias("__near_k1"), F.col("k2").alias("__near_k2"), "copies", "gone"), "near-marked")
    keyed = docs.withColumns({"__near_k1": _keys()[0], "__near_k2": _keys()[1]})
    columns = [F.col(f"`{c}`") for c in docs.columns]
    on = ["__near_k1", "__near_k2"]
    single = keyed.join(marked.select(*on), on, "left_anti").select(*columns)
    several = keyed.join(marked.where("gone = 0").select(*on), on, "left_semi").withColumn("__near_row", F.xxhash64(*columns))
    turn = F.row_number().over(Window.partitionBy(*on).orderBy("__near_row"))
    return single.unionByName(several.withColumn("__near_turn", turn).where("__near_turn = 1").select(*columns))
