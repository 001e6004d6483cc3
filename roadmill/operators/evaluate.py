"""Coverage: which listed exits of a ground truth the corridors have.

truth(highway, ref, lat, lon) may list an exit several times; own(highway, ref, lat, lon) are corridor exits.
"""

from __future__ import annotations

import contextlib
import json
import sqlite3
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadmill.functions import geo, refs

from .spatial import range_join

#: Proximity in metres and degrees, least corridors of a national build.
NEAR_M, NEAR_BOX, LEAST_CORRIDORS = 500.0, 0.01, 262


def ground_truth(exits: DataFrame, request_exits: DataFrame, exits_requests: DataFrame, highway_in_states: DataFrame, highways: DataFrame) -> DataFrame:
    """Distinct (highway, ref, lat, lon) of Interstates, without signs that are no exits."""
    joined = exits.join(request_exits, "exit_id").join(exits_requests, "cache_key").join(highway_in_states, "highway_in_state_id").join(highways, "highway_id")
    held = joined.where((F.col("highway_type") == "Interstate") & F.col("sign_number").isNotNull() & (F.col("sign_number") != "") & F.col("display_name").like("I-%"))
    ref = F.trim("sign_number")
    return held.where((ref != "") & ~refs.is_non_exit(ref)).select(F.col("display_name").alias("highway"), ref.alias("ref"), F.col("exit_latitude").alias("lat"), F.col("exit_longitude").alias("lon")).distinct()


#: The ground truth's tables, and the columns that are read.
TRUTH = {
    "exits": "exit_id, sign_number, exit_latitude, exit_longitude", "request_exits": "exit_id, cache_key", "exits_requests": "cache_key, highway_in_state_id",
    "highway_in_states": "highway_in_state_id, highway_id", "highways": "highway_id, display_name, highway_type",
}


def read_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """`ground_truth` of an SQLite file on the driver: a list of a country's exits, some ten thousands of rows."""
    types = {"exit_latitude": "double", "exit_longitude": "double", "sign_number": "string", "display_name": "string", "highway_type": "string"}
    tables = []
    with contextlib.closing(sqlite3.connect(f"file:{path}?mode=ro", uri=True)) as db:
        for name, columns in TRUTH.items():
            kinds = [(c, types.get(c, "string")) for c in columns.split(", ")]
            rows = [tuple(None if v is None else float(v) if t == "double" else str(v) for v, (_, t) in zip(r, kinds, strict=True)) for r in db.execute(f"select {columns} from {name}")]
            tables.append(spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in kinds)))
    return ground_truth(*tables)


def corridor_pairs(corridor_exits: DataFrame, corridors: DataFrame) -> DataFrame:
    """(highway, ref, lat, lon) of corridors' exits with a ref."""
    return corridor_exits.join(corridors.select("corridor_id", "highway"), "corridor_id").where(F.col("highway").startswith("I-") & (F.coalesce("ref", F.lit("")) != "")).select("highway", F.trim("ref").alias("ref"), "lat", "lon")


def expand_pairs(own: DataFrame) -> DataFrame:
    """Distinct (highway, ref): as they are, and under a suffixed highway's base; also by the number before a
    letter."""
    base_highway, base = refs.strip_highway_suffix(F.col("highway")), F.regexp_extract("ref", r"^(\d+)[A-Z]$", 1)
    names = F.filter(F.array("highway", base_highway), lambda h: h.isNotNull())
    numbers = F.filter(F.array(F.col("ref"), F.nullif(base, F.lit(""))), lambda r: r.isNotNull())
    return own.select(F.explode(names).alias("highway"), "ref").select("highway", F.explode(numbers).alias("ref")).distinct()


def _covered(pairs: DataFrame, own: DataFrame, key: list[str]) -> DataFrame:
    """key of pairs(key..., highway, ref) that own has, by ref or by the number before its one letter."""
    base = F.nullif(F.regexp_extract("ref", r"^(\d+)[A-Z]$", 1), F.lit(""))
    forms = pairs.select(*key, "highway", F.explode(F.filter(F.array(F.col("ref"), base), lambda r: r.isNotNull())).alias("ref"))
    return forms.join(own, ["highway", "ref"], "left_semi").select(*key).distinct()


def match(truth: DataFrame, own: DataFrame) -> DataFrame:
    """Distinct (highway, ref) of truth with `how`: exact; parts, if all expansions of the ref are there; number, by the
    number before a letter; decimal, by the whole part; suffix, under the base of a suffixed highway; near, within
    500 m of any exit of the highway or of one that it is the base of. Null: not matched. The first that fits counts."""
    pairs = truth.select("highway", "ref").distinct()
    have = expand_pairs(own)
    key = ["highway", "ref"]
    mine = pairs.select(*key, F.col("highway").alias("h"), F.col("ref").alias("r"))

    def same(found: DataFrame, how: str) -> DataFrame:
        return found.select(F.col("h").alias("highway"), F.col("r").alias("ref"), F.lit(how).alias("how"))

    exact = pairs.join(have, key, "left_semi").withColumn("how", F.lit("exact"))
    parts = mine.select("h", "r", "highway", F.explode(F.array_distinct(refs.expand_truth_ref(F.col("ref")))).alias("ref"))
    lacking = parts.join(_covered(parts.withColumn("part", F.col("ref")), have, ["h", "r", "part"]).withColumnRenamed("part", "ref"), ["h", "r", "ref"], "left_anti").select("h", "r").distinct()
    whole = parts.select("h", "r").distinct().join(lacking, ["h", "r"], "left_anti")
    number = _covered(mine, have, ["h", "r"])
    floor = mine.withColumn("ref", F.nullif(F.regexp_extract("ref", r"^(\d+)\.\d+$", 1), F.lit(""))).join(have, key, "left_semi").select("h", "r")
    suffix = _covered(mine.withColumn("highway", refs.strip_highway_suffix(F.col("highway"))).where("highway is not null"), have, ["h", "r"])
    near = proximity(truth, own).select(F.col("highway").alias("h"), F.col("ref").alias("r"))
    ranked = [exact, same(whole, "parts"), same(number, "number"), same(floor, "decimal"), same(suffix, "suffix"), same(near, "near")]
    order = ("exact", "parts", "number", "decimal", "suffix", "near")
    found = None
    for rows in ranked:
        found = rows if found is None else found.unionByName(rows)
    place: Column = F.lit(0)
    for k, how in enumerate(order):
        place = F.when(F.col("how") == how, k).otherwise(place)
    best = found.groupBy(*key).agg(F.min_by("how", place).alias("how"))
    return pairs.join(best, key, "left")


def proximity(truth: DataFrame, own: DataFrame) -> DataFrame:
    """Distinct (highway, ref) of located truth within 500 m of an exit of the highway."""
    there = truth.where("lat is not null and lon is not null and lat <> 0 and lon <> 0").distinct()
    names = F.filter(F.array("highway", refs.strip_highway_suffix(F.col("highway"))), lambda h: h.isNotNull())
    spots = own.select(F.explode(names).alias("h2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2")).distinct()
    pairs = range_join(there, spots, NEAR_BOX, ("lat", "lon"), ("lat2", "lon2")).where(F.col("highway") == F.col("h2"))
    far = geo.haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"), form="asin")
    return pairs.where(far <= NEAR_M).select("highway", "ref").distinct()


def score(matched: DataFrame) -> DataFrame:
    """One row: n_pairs, n_matched, percent."""
    n, hit = F.count("*"), F.count("how")
    return matched.agg(n.alias("n_pairs"), hit.alias("n_matched"), F.when(n > 0, F.round(100.0 * hit / n, 2)).otherwise(0.0).alias("percent"))


def regressions(before: DataFrame, matched: DataFrame) -> DataFrame:
    """(highway, ref) that were matched before and are not now."""
    return before.select("highway", "ref").subtract(matched.where("how is not null").select("highway", "ref"))


def gates(n_corridors: int, n_regressions: int, least: int = LEAST_CORRIDORS) -> dict[str, bool]:
    return {"corridors": n_corridors >= least, "regressions": n_regressions == 0}


def save_baseline(matched: DataFrame, path: Path) -> int:
    """The matched pairs and the score as JSON, to be held against later runs; returns the number of pairs."""
    pairs = sorted((r.highway, r.ref) for r in matched.where("how is not null").select("highway", "ref").toLocalIterator())
    told = score(matched).first()
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"score": told.percent, "matched_count": len(pairs), "matched_pairs": pairs}, indent=2) + "\n")
    return len(pairs)


def load_baseline(spark: SparkSession, path: Path) -> DataFrame:
    """(highway, ref) of a saved baseline; none if there is no file."""
    pairs = json.loads(path.read_text())["matched_pairs"] if path.exists() else []
    return spark.createDataFrame([tuple(p) for p in pairs], "highway string, ref string")
