"""Exits, places and the links between them.

Tables: exit_nodes(node_id, ref, name, tags, lat, lon); poi_nodes and poi_ways(node_id or osm_id, category, name,
display_name, brand, tags, lat, lon), a way's point being one on its surface; highways(way_id, highway, ref, tags,
points). tags is a map of strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadmill.functions import geo, refs

from .spatial import range_join, segment_join, segments

#: Radii in metres, boxes in degrees, and the most places of a category at an exit.
ANCHOR_M, ANCHOR_BOX = 1200.0, 0.02
PLACE_M, PLACE_BOX, PLACE_NEAR_M, PLACE_RANK = 1600.0, 0.024, 800, 12
HIGHWAY_DEG = 0.001
#: Metres of a degree on the spheroid are no less, of latitude and of longitude at the equator.
LEAST_LAT_M, LEAST_LON_M = 110_500.0, 111_300.0
OPEN_CATEGORIES = ("park", "dogPark")
UNNAMED_CATEGORIES = ("restArea", "park", "dogPark")


def filled(*columns: Column, trim: bool = False) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(F.trim(c) if trim else c, F.lit("")) for c in columns))


def exit_ref(ref: Column, tags: Column) -> Column:
    return filled(ref, tags["ref"], tags["junction:ref"], trim=True)


def exit_name(name: Column, tags: Column) -> Column:
    return filled(name, tags["exit:name"], tags["name"], tags["destination"])


def is_rest_anchor(category: Column, display_name: Column, name: Column) -> Column:
    label = F.lower(F.trim(F.coalesce(F.nullif(display_name, F.lit("")), F.nullif(name, F.lit("")), F.lit(""))))
    return F.coalesce(category == "restArea", F.lit(False)) | label.contains("welcome center")


def rest_anchor_exits(exits: DataFrame, pois: DataFrame) -> DataFrame:
    """Distinct node_id of exits(node_id, lat, lon) that have a rest area or welcome centre of pois(category,
    display_name, name, lat, lon) inside both the box and the radius."""
    anchors = pois.where(is_rest_anchor(F.col("category"), F.col("display_name"), F.col("name"))).select(F.col("lat").alias("plat"), F.col("lon").alias("plon"))
    pairs = range_join(exits.select("node_id", "lat", "lon"), anchors, ANCHOR_BOX, ("lat", "lon"), ("plat", "plon"))
    near = geo.spheroid_m(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon")) <= ANCHOR_M
    return pairs.where(near).select("node_id").distinct()


def nearest_highway(exits: DataFrame, highways: DataFrame) -> DataFrame:
    """node_id and highway_pick: the first filled of ref, tags.ref and class of the nearest highway within 0.001
    degrees, motorways and trunks before links; ties by way id."""
    value = filled(F.trim(F.col("ref")), F.trim(F.col("tags")["ref"]), F.col("highway"))
    classed = highways.where(F.col("highway").isin("motorway", "trunk", "motorway_link", "trunk_link"))
    legs = segments(classed.select("way_id", value.alias("pick"), F.col("highway").isin("motorway_link", "trunk_link").cast("int").alias("link"), "points"), "points", "way_id", "pick", "link")
    pairs = segment_join(exits.select("node_id", "lat", "lon"), legs, HIGHWAY_DEG, ("lat", "lon"))
    far = geo.segment_deg(F.col("lat"), F.col("lon"), F.col("alat"), F.col("alon"), F.col("blat"), F.col("blon"))
    best = pairs.withColumn("far", far).where(F.col("far") <= HIGHWAY_DEG).groupBy("node_id").agg(F.min(F.struct("link", "far", "way_id", "pick")).alias("best"))
    return best.select("node_id", F.col("best.pick").alias("highway_pick"))


def admit_exits(exit_nodes: DataFrame, anchors: DataFrame, picks: DataFrame) -> DataFrame:
    """The exits table: those whose ref has a digit, and those at a rest anchor. One row per node."""
    ref = exit_ref(F.col("ref"), F.col("tags"))
    first = exit_nodes.withColumn("__n", F.row_number().over(Window.partitionBy("node_id").orderBy("lat", "lon"))).where("__n = 1").drop("__n")
    held = first.withColumns({"__ref": ref, "__name": exit_name(F.col("name"), F.col("tags"))}).join(anchors.withColumn("__anchor", F.lit(True)), "node_id", "left").join(picks, "node_id", "left")
    admitted = held.where(F.coalesce(F.col("__ref").rlike("[0-9]"), F.lit(False)) | F.col("__anchor").isNotNull())
    return admitted.select(
        F.concat(F.lit("node/"), F.col("node_id").cast("string")).alias("id"), F.lit("node").alias("osm_type"), F.col("node_id").alias("osm_id"),
        F.lit(None).cast("string").alias("state"), F.col("__ref").alias("ref"), F.col("__name").alias("name"), F.col("highway_pick").alias("highway"),
        F.lit(None).cast("string").alias("direction"), "lat", "lon", F.col("tags").alias("tags"),
    )


def place_names(category: Column, name: Column, display_name: Column, tags: Column) -> tuple[Column, Column]:
    """(name, display_name): rest areas without a name of their own are called Rest Area."""
    rest = F.coalesce(category == "restArea", F.lit(False))
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    untagged = blank(tags["name"]) & blank(tags["brand"])
    shown = F.when(rest & untagged, "Rest Area").otherwise(F.coalesce(F.nullif(display_name, F.lit("")), F.nullif(name, F.lit("")), F.when(rest, "Rest Area")))
    return F.when(rest & (blank(name) | untagged), "Rest Area").otherwise(name), shown


def union_places(poi_nodes: DataFrame, poi_ways: DataFrame) -> DataFrame:
    """The pois table, of nodes and ways."""

    def side(df: DataFrame, kind: str, key: str) -> DataFrame:
        name, shown = place_names(F.col("category"), F.col("name"), F.col("display_name"), F.col("tags"))
        return df.select(
            F.concat(F.lit(f"{kind}/"), F.col(key).cast("string")).alias("id"), F.lit(kind).alias("osm_type"), F.col(key).alias("osm_id"), F.lit(None).cast("string").alias("state"),
            "category", name.alias("name"), shown.alias("display_name"), "brand", "lat", "lon", "tags",
        )

    return side(poi_nodes, "node", "node_id").unionByName(side(poi_ways, "way", "osm_id"))


def is_linkable(category: Column, display_name: Column, name: Column) -> Column:
    label = F.lower(F.trim(F.coalesce(F.nullif(display_name, F.lit("")), F.nullif(name, F.lit("")), F.lit("Unknown"))))
    return category.isNotNull() & (category != "restroom") & (category.isin(*UNNAMED_CATEGORIES) | (label != "unknown"))


def _spot_links(exits: DataFrame, places: DataFrame, metres: float, box: float, most: int, near_m: int, open_categories: tuple[str, ...]) -> DataFrame:
    """lat, lon, poi_id, category, distance_m, rank: the links of each place that has exits."""
    # exits of one place have the same places near them, and of a place's rows in a category the `most` least ids can count
    spots = exits.select("lat", "lon").distinct()
    named = places.groupBy("plat", "plon", "category").agg(F.slice(F.array_sort(F.collect_list("poi_id")), 1, most).alias("ids"))
    held = named.groupBy("plat", "plon").agg(F.collect_list(F.struct("category", "ids")).alias("held")).withColumn("open", F.filter("held", lambda h: h.category.isin(*open_categories)))
    four = [F.col(c) for c in ("lat", "lon", "plat", "plon")]
    pairs = range_join(spots, held, box, ("lat", "lon"), ("plat", "plon")).withColumn("m", geo.spheroid_m(*four)).where(F.col("m") <= metres)
    # ranks count what is nearer in degrees, so beyond the degrees that near_m metres can be, closed categories are cut already
    degree_m = F.least(F.lit(LEAST_LAT_M), F.lit(LEAST_LON_M) * F.cos(F.radians(F.abs("lat") + box)))
    ranked_there = F.when(F.col("deg") * degree_m <= near_m + 0.5, F.col("held")).otherwise(F.col("open"))
    close = pairs.withColumn("deg", geo.planar_deg(*four)).select("lat", "lon", "m", "deg", F.explode(ranked_there).alias("h")).select("lat", "lon", "m", "deg", "h.*")
    by_deg = Window.partitionBy("lat", "lon", "category").orderBy("deg")
    # each nearer place has a row at least, so a place with `most` nearer ones is out
    near = close.withColumn("n", F.rank().over(by_deg)).where(F.col("n") <= most).select("lat", "lon", "m", "deg", "category", F.explode("ids").alias("poi_id"))
    rank = F.row_number().over(Window.partitionBy("lat", "lon", "category").orderBy("deg", "poi_id"))
    ranked = near.withColumn("rank", rank).where(F.col("rank") <= most).withColumn("distance_m", F.rint("m").cast("int"))
    return ranked.where(F.col("category").isin(*open_categories) | (F.col("distance_m") <= near_m)).select("lat", "lon", "poi_id", "category", "distance_m", "rank")


def exit_place_candidates(exits: DataFrame, places: DataFrame, *, metres: float = PLACE_M, box: float = PLACE_BOX, most: int = PLACE_RANK, near_m: int = PLACE_NEAR_M, open_categories: tuple[str, ...] = OPEN_CATEGORIES) -> DataFrame:
    """exits(exit_id, lat, lon) and places(poi_id, category, plat, plon): exit_id, poi_id, category, distance_m, rank.
    The rank in an exit's category is by distance in degrees, ties by id, and is not made anew after the cut at
    near_m metres. Spark keeps `most` rows of a group before the shuffle."""
    linked = _spot_links(exits, places, metres, box, most, near_m, open_categories)
    return exits.select("exit_id", "lat", "lon").join(linked.hint("merge"), ["lat", "lon"]).select("exit_id", "poi_id", "category", "distance_m", "rank")


def exit_place_lists(exits: DataFrame, places: DataFrame, *, metres: float = PLACE_M, box: float = PLACE_BOX, most: int = PLACE_RANK, near_m: int = PLACE_NEAR_M, open_categories: tuple[str, ...] = OPEN_CATEGORIES) -> DataFrame:
    """`exit_place_candidates` as a row for each exit that has any: the columns of exits but lat and lon, and links, an
    array of structs by poi_id."""
    linked = _spot_links(exits, places, metres, box, most, near_m, open_categories)
    lists = linked.groupBy("lat", "lon").agg(F.sort_array(F.collect_list(F.struct("poi_id", "category", "distance_m", "rank"))).alias("links"))
    return exits.join(lists.hint("merge"), ["lat", "lon"]).drop("lat", "lon")


def prune_directional_conflicts(candidates: DataFrame, labels: DataFrame, exits: DataFrame) -> DataFrame:
    """candidates without rest areas whose label names the opposite of the exit's direction. labels(poi_id, label) in
    lower case; exits(exit_id, direction), with as many rows as the exit has corridors."""
    rest = candidates.where("category = 'restArea'").select("exit_id", "poi_id").join(labels, "poi_id").join(exits, "exit_id")
    going = refs.exit_direction(F.col("direction"))
    says = {w: refs.names_direction(F.col("label"), w) for w in ("east", "west", "north", "south")}

    def against(a: str, b: str) -> Column:
        one = says[a].cast("int") + says[b].cast("int") == 1
        return going.isin(a, b) & one & ((says[a] & (going != a)) | (says[b] & (going != b)))

    wrong = rest.where(against("east", "west") | against("north", "south")).select("exit_id", "poi_id").distinct()
    return candidates.join(wrong, ["exit_id", "poi_id"], "left_anti")


def place_label(display_name: Column, name: Column, tags: Column) -> Column:
    return F.lower(F.trim(F.coalesce(F.nullif(display_name, F.lit("")), F.nullif(name, F.lit("")), F.nullif(tags["name"], F.lit("")), F.lit(""))))


def nearest_rest_area(candidates: DataFrame, places: DataFrame) -> DataFrame:
    """exit_id and the name of its nearest rest area of places(poi_id, name, display_name); ties by id."""
    rest = candidates.where("category = 'restArea'").join(places, "poi_id")
    label = F.coalesce(F.nullif(F.col("display_name"), F.lit("")), F.nullif(F.col("name"), F.lit("")), F.lit("Rest Area"))
    return rest.groupBy("exit_id").agg(F.min_by(label, F.struct("distance_m", "poi_id")).alias("rest_area"))


# ---------------------------------------------------------------- table effects


def insert_or_ignore(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, by order."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__n = 1").drop("__n")


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """old with the rows of new in place of those with the same key."""
    return old.join(new, key, "left_anti").unionByName(new)


def update_column(rows: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """rows with the greatest of values(key, column) in place of column where there is one."""
    best = values.groupBy(key).agg(F.max(column).alias("__new"))
    return rows.join(best, key, "left").withColumn(column, F.coalesce("__new", column)).drop("__new")


def require_tables(spark, *names: str) -> None:
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise LookupError(f"missing tables: {', '.join(missing)}")
