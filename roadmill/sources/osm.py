"""OpenStreetMap entities: prefilter, classifiers, way geometry and text readers.

nodes(id, lat, lon, tags), ways(id, node_ids, tags), relations(id, tags, members); tags is a map of strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadmill.functions import refs

NODES = "id long, lat double, lon double, tags map<string,string>"
WAYS = "id long, node_ids array<long>, tags map<string,string>"
RELATIONS = "id long, tags map<string,string>, members array<struct<type:string,id:long,role:string>>"

HIGH_CLASSES = ("motorway", "motorway_link", "trunk", "trunk_link")
#: What the prefilter keeps, by tag.
NODE_FILTER = {"highway": ("motorway_junction", "rest_area", "services"), "amenity": ("fuel", "restaurant", "fast_food", "cafe", "toilets", "charging_station"), "tourism": ("hotel", "motel", "guest_house"), "shop": ("gas",), "leisure": ("dog_park", "park")}
WAY_FILTER = NODE_FILTER | {"highway": (*HIGH_CLASSES, "construction", "rest_area", "services")}


def tag(name: str) -> Column:
    return F.col("tags")[name]


def prefilter(entities: DataFrame, wanted: dict[str, tuple[str, ...]]) -> DataFrame:
    """Entities with one of the tags, or with any cuisine."""
    keep = tag("cuisine").isNotNull()
    for name, values in wanted.items():
        keep = keep | F.coalesce(tag(name).isin(*values), F.lit(False))
    return entities.where(keep)


def poi_category(tags: Column) -> Column:
    """The first that fits of gas, lodging, food, restArea, restroom, evCharging, dogPark, park; else null. A park
    needs "park" in its name."""
    got = lambda k: F.coalesce(tags[k], F.lit(""))
    return (
        F.when((got("amenity") == "fuel") | (got("shop") == "gas"), "gas")
        .when(got("tourism").isin("hotel", "motel", "guest_house"), "lodging")
        .when(got("amenity").isin("restaurant", "fast_food", "cafe") | tags["cuisine"].isNotNull(), "food")
        .when(got("highway").isin("rest_area", "services"), "restArea")
        .when(got("amenity") == "toilets", "restroom")
        .when(got("amenity") == "charging_station", "evCharging")
        .when(got("leisure") == "dog_park", "dogPark")
        .when((got("leisure") == "park") & F.lower(got("name")).contains("park"), "park")
    )


def has_interstate_ref(tags: Column) -> Column:
    """Whether a part of ref, or where that is blank of int_ref, is an Interstate."""
    ref = F.coalesce(F.nullif(tags["ref"], F.lit("")), F.nullif(tags["int_ref"], F.lit("")), F.lit(""))
    return F.exists(F.split(ref, ";"), lambda p: F.trim(p).rlike(r"^[Ii][\s-]*[0-9]+[A-Za-z]?$"))


def highway_class(tags: Column) -> Column:
    """A high class, also of a road under construction; one with an Interstate ref is a motorway. Else null."""
    building = F.coalesce(tags["highway"] == "construction", F.lit(False))
    return F.when(tags["highway"].isin(*HIGH_CLASSES), tags["highway"]).when(building & tags["construction"].isin(*HIGH_CLASSES), tags["construction"]).when(building & has_interstate_ref(tags), "motorway")


def exit_nodes(nodes: DataFrame) -> DataFrame:
    """Motorway junctions. An empty tag counts as present here."""
    return nodes.where(tag("highway") == "motorway_junction").select(
        F.col("id").alias("node_id"), F.coalesce(tag("ref"), tag("junction:ref")).alias("ref"),
        F.coalesce(tag("name"), tag("exit:name"), tag("destination"), tag("destination:ref")).alias("name"), "tags", "lat", "lon",
    )


def _places(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("category", poi_category(F.col("tags"))).where("category is not null").select(
        F.col("id").alias(key), "category", F.coalesce(tag("name"), tag("brand")).alias("name"), F.coalesce(tag("brand"), tag("name")).alias("display_name"), tag("brand").alias("brand"), "tags", "lat", "lon"
    )


def poi_nodes(nodes: DataFrame) -> DataFrame:
    return _places(nodes, "node_id")


def way_points(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """ways with points, in the order of node_ids. A way that lacks the place of a node, or has fewer than two, goes."""
    steps = ways.select("id", F.posexplode("node_ids").alias("at", "node"))
    found = steps.join(nodes.select(F.col("id").alias("node"), "lat", "lon"), "node")
    lines = found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "lat", "lon"))).alias("p"))
    lines = lines.select("id", F.transform("p", lambda x: F.struct(x.lat.alias("lat"), x.lon.alias("lon"))).alias("points"))
    return ways.join(lines, "id").where((F.size("points") == F.size("node_ids")) & (F.size("points") >= 2))


def highways(ways: DataFrame) -> DataFrame:
    """ways with points to the highways table."""
    return ways.withColumn("highway", highway_class(F.col("tags"))).where("highway is not null").select(
        F.col("id").alias("way_id"), "highway", tag("ref").alias("ref"), tag("name").alias("name"), tag("oneway").alias("oneway"), "node_ids", "tags", "points"
    )


def surface_point(points: Column) -> Column:
    """A point inside a closed ring, on the line half-way between its lowest and highest point: the middle of the
    widest piece inside. For an open line the vertex nearest to its middle vertex."""
    n = F.size(points)
    closed = (n >= 4) & (F.element_at(points, 1) == F.element_at(points, -1))
    low, high = F.array_min(F.transform(points, lambda p: p.lat)), F.array_max(F.transform(points, lambda p: p.lat))
    lats = F.array_sort(F.array_distinct(F.transform(points, lambda p: p.lat)))
    middle = (low + high) / 2
    # a scan line through a vertex is moved between it and the next one above
    above = F.array_min(F.filter(lats, lambda y: y > middle))
    y = F.when(F.array_contains(lats, middle), (middle + above) / 2).otherwise(middle)
    legs = F.zip_with(F.slice(points, 1, F.greatest(n - 1, F.lit(1))), F.slice(points, 2, F.greatest(n - 1, F.lit(1))), lambda a, b: F.when((F.least(a.lat, b.lat) <= y) & (F.greatest(a.lat, b.lat) > y), a.lon + (y - a.lat) / (b.lat - a.lat) * (b.lon - a.lon)))
    xs = F.array_sort(F.filter(legs, lambda x: x.isNotNull()))
    pieces = F.transform(F.sequence(F.lit(0), F.greatest(F.floor(F.size(xs) / 2).cast("int") - 1, F.lit(0))), lambda i: F.struct((F.get(xs, 2 * i + 1) - F.get(xs, 2 * i)).alias("wide"), ((F.get(xs, 2 * i + 1) + F.get(xs, 2 * i)) / 2).alias("lon")))
    inside = F.struct(y.alias("lat"), F.array_max(pieces).lon.alias("lon"))
    vertex = F.element_at(points, F.floor((n + 1) / 2).cast("int"))
    return F.when(closed & (high > low) & (F.size(xs) >= 2), inside).otherwise(F.struct(vertex.lat.alias("lat"), vertex.lon.alias("lon")))


def poi_ways(ways: DataFrame) -> DataFrame:
    """ways with points to places on their surface."""
    at = surface_point(F.col("points"))
    return _places(ways.withColumn("__at", at).withColumns({"lat": F.col("__at.lat"), "lon": F.col("__at.lon")}), "osm_id")


# ---------------------------------------------------------------- relations as text lines


def _tags(raw: Column) -> Column:
    """k=v,k=v with percent escapes in the values; entries without = are left out, and of equal keys the last counts."""
    entries = F.filter(F.split(F.coalesce(raw, F.lit("")), ","), lambda e: e.contains("="))
    keys = F.transform(entries, lambda e: F.substring_index(e, "=", 1))
    return F.map_from_entries(F.transform(F.array_distinct(keys), lambda k: F.struct(k, refs.percent_decode(_value(F.element_at(F.filter(entries, lambda e: F.substring_index(e, "=", 1) == k), -1))))))


def _value(entry: Column) -> Column:
    return F.regexp_replace(entry, "^[^=]*=", "")


def _members(raw: Column) -> Column:
    """w12@role,r34@role: ways and relations with a numeric id."""
    entries = F.filter(F.split(F.coalesce(raw, F.lit("")), ","), lambda e: e.rlike("^[wr][0-9]+(@.*)?$"))
    return F.transform(entries, lambda e: F.struct(F.substring(e, 1, 1).alias("type"), F.regexp_extract(e, "^.([0-9]+)", 1).cast("long").alias("id"), refs.percent_decode(F.regexp_replace(e, "^[^@]*@?", "")).alias("role")))


def parse_relation_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Interstate route relations of lines such as `r1 v1 ... Tk=v,k=v Mw2@role`: relation_id, ref, direction, name,
    description, members. Others are left out."""
    line = F.col(column)
    head, rest = F.substring_index(line, " T", 1), F.when(F.instr(line, " T") > 0, F.substring(line, F.instr(line, " T") + 2, F.length(line)))
    raw = lines.where(line.startswith("r")).select(F.regexp_extract(F.substring_index(head, " ", 1), "^r([0-9]+)$", 1).alias("id"), F.substring_index(rest, " M", 1).alias("t"), F.when(F.instr(rest, " M") > 0, F.substring(rest, F.instr(rest, " M") + 2, F.length(rest))).alias("m"))
    found = raw.where("id <> '' and t <> ''").select(F.col("id").cast("long").alias("relation_id"), _tags(F.col("t")).alias("tags"), _members(F.col("m")).alias("members"))
    found = found.where((tag("network") == "US:I") & (tag("route") == "road")).withColumn("ref", refs.relation_ref(tag("ref")))
    return found.where("ref is not null").select("relation_id", "ref", refs.direction(tag("direction")).alias("direction"), tag("name").alias("name"), tag("description").alias("description"), "members")


def read_relation_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_relation_lines(spark.read.text(path))


CACHE = "way_id long, highway string, root_relation_id long, leaf_relation_id long, direction string, role string, sequence_index int"


def parse_relation_cache(lines: DataFrame) -> DataFrame:
    """Lines of the tab-separated relation cache. Headers, blank lines, short lines, lines whose ids are no numbers and refs
    that are no Interstates are left out; role and sequence may be missing."""
    p = F.split(F.col("value"), "\t")
    rows = lines.where(~F.col("value").startswith("way_id\t") & (F.size(p) >= 5))
    # inside a transform the field is a variable; written out, the filter on the result outgrows a compiled method
    highway = F.get(F.transform(F.array(F.get(p, F.lit(1))), refs.normalize_highway_ref), F.lit(0))
    rows = rows.select(
        F.get(p, F.lit(0)).try_cast("long").alias("way_id"), highway.alias("highway"), F.get(p, F.lit(2)).try_cast("long").alias("root_relation_id"), F.get(p, F.lit(3)).try_cast("long").alias("leaf_relation_id"),
        refs.direction(F.get(p, F.lit(4)), rich=False).alias("direction"), F.coalesce(F.get(p, F.lit(5)), F.lit("")).alias("role"), F.coalesce(F.get(p, F.lit(6)).try_cast("int"), F.lit(0)).alias("sequence_index"),
    )
    return rows.where(F.col("way_id").isNotNull() & F.col("root_relation_id").isNotNull() & F.col("leaf_relation_id").isNotNull() & refs.is_interstate(F.col("highway")))


def read_relation_cache(spark: SparkSession, path: str) -> DataFrame:
    return parse_relation_cache(spark.read.text(path))
