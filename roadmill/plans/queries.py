"""The engine's operators as queries over the test tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadmill.functions import geo, refs
from roadmill.operators import corridors as corridor_ops
from roadmill.operators import evaluate, exits, export, graph, projection, relations, routes
from roadmill.sources import osm

from . import synthetic as x
from .synthetic import pick, pick_sql, spot, with_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, recursive: bool = False):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = with_tables(sql, recursive)
        return f

    return add


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    return f"(6371000.0::double * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


def spheroid_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    m = f"radians(({lat1} + {lat2}) / 2)"
    w2 = f"(1 - 0.0066943799901413165::double * sin({m}) * sin({m}))"
    return (
        f"sqrt(pow(6378137.0::double * (1 - 0.0066943799901413165::double) / ({w2} * sqrt({w2})) * radians({lat2} - {lat1}), 2)"
        f" + pow(6378137.0::double / sqrt({w2}) * cos({m}) * radians({lon2} - {lon1}), 2))"
    )


def bearing_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    y = f"sin(radians({lon2} - {lon1})) * cos(radians({lat2}))"
    x = f"cos(radians({lat1})) * sin(radians({lat2})) - sin(radians({lat1})) * cos(radians({lat2})) * cos(radians({lon2} - {lon1}))"
    return f"((degrees(atan2({y}, {x})) + 360.0) % 360.0)"


# ---------------------------------------------------------------- exits and places

_PAIRS = f"""
pairs as (select exit_id, poi_id, category, name, brand, size, {spheroid_sql("lat", "lon", "plat", "plon")} as m, sqrt(pow(plat - lat, 2) + pow(plon - lon, 2)) as deg
  from x_exits join x_places on abs(lat - plat) <= 0.024::double and abs(lon - plon) <= 0.024::double)"""


@query(_PAIRS + """,
ranked as (select *, row_number() over (partition by exit_id, category order by deg, poi_id)::int as rank from pairs where m <= 1600)
;; select exit_id, poi_id, category, round_even(m, 0)::int as distance_m, rank from ranked where rank <= 12 and (category = 'PROMO' or round_even(m, 0) <= 800)""")
def exit_place_candidates(spark, sf_dir):
    return projection.exit_place_candidates(x.exits(spark, sf_dir), x.places(spark, sf_dir), open_categories=("PROMO",))


@query(f"""pairs as (select exit_id from x_exits join x_places on abs(lat - plat) <= 0.02::double and abs(lon - plon) <= 0.02::double
  where (category = 'PROMO' or name like '%blue%') and {spheroid_sql("lat", "lon", "plat", "plon")} <= 1200)
;; select distinct exit_id as node_id from pairs""")
def rest_anchor_semijoin(spark, sf_dir):
    return projection.rest_anchor_exits(*_anchor_inputs(spark, sf_dir))


def _anchor_inputs(spark, sf_dir):
    """PROMO parts are rest areas, blue ones welcome centres."""
    spots = x.places(spark, sf_dir)
    category = F.when(F.col("category") == "PROMO", "restArea").otherwise(F.col("category"))
    shown = F.when(F.col("name").contains("blue"), "Ohio Welcome Center ").otherwise(F.lit(""))
    return x.exits(spark, sf_dir).withColumnRenamed("exit_id", "node_id"), spots.select(category.alias("category"), shown.alias("display_name"), "name", F.col("plat").alias("lat"), F.col("plon").alias("lon"))


@query(f"""e as (select c_custkey as node_id, case when c_custkey % 3 = 0 then ' ' when c_custkey % 3 = 1 then 'B' else 'x' || c_custkey end as r, case when c_custkey % 6 = 0 then 'A' || c_custkey end as t from customer),
anchors as (select distinct exit_id from x_exits join x_places on abs(lat - plat) <= 0.02::double and abs(lon - plon) <= 0.02::double where (category = 'PROMO' or name like '%blue%') and {spheroid_sql("lat", "lon", "plat", "plon")} <= 1200),
n as (select node_id, coalesce(nullif(trim(r), ''), nullif(trim(t), '')) as ref from e)
;; select 'node/' || node_id as id, ref, case when node_id % 4 = 0 then 'I-' || node_id end as highway from n where coalesce(regexp_matches(ref, '[0-9]'), false) or node_id in (select exit_id from anchors)""")
def exit_admission(spark, sf_dir):
    k = F.col("node_id")
    nodes, pois = _anchor_inputs(spark, sf_dir)
    ref = F.when(k % 3 == 0, " ").when(k % 3 == 1, "B").otherwise(F.concat(F.lit("x"), k.cast("string")))
    tags = F.when(k % 6 == 0, F.create_map(F.lit("ref"), F.concat(F.lit("A"), k.cast("string")))).otherwise(F.create_map(F.lit("z"), F.lit("z")))
    full = nodes.withColumns({"ref": ref, "name": F.lit("n"), "tags": tags})
    picks = nodes.select("node_id", F.when(k % 4 == 0, F.concat(F.lit("I-"), k.cast("string"))).alias("highway_pick"))
    return projection.admit_exits(full, projection.rest_anchor_exits(nodes, pois), picks).select("id", "ref", "highway")


_HIGHWAY_KINDS = ["motorway", "trunk_link", "trunk", "motorway_link", "primary"]
_HIGHWAY_STEP = (0.002, 0.001)


@query(f"""h as (select poi_id as way_id, {pick_sql("poi_id % 5", _HIGHWAY_KINDS)} as highway, case when poi_id % 2 = 0 then ' ' else 'I ' || poi_id end as ref, plat as y, plon as x from x_places),
t as (select exit_id, lat, lon, way_id, (highway like '%_link')::int as link, coalesce(nullif(trim(ref), ''), highway) as pick, y, x,
  least(1.0::double, greatest(0.0::double, ((lon - x) * 0.001::double + (lat - y) * 0.002::double) / (0.001::double * 0.001::double + 0.002::double * 0.002::double))) as t from x_exits join h on highway <> 'primary' and abs(lat - y) < 0.01 and abs(lon - x) < 0.01),
d as (select *, sqrt(pow(lat - (y + t * 0.002::double), 2) + pow(lon - (x + t * 0.001::double), 2)) as far from t),
r as (select *, row_number() over (partition by exit_id order by link, far, way_id) as n from d where far <= 0.001)
;; select exit_id as node_id, pick as highway_pick from r where n = 1""")
def nearest_highway_pick(spark, sf_dir):
    k = F.col("poi_id")
    lines = F.array(F.struct(F.col("plat").alias("lat"), F.col("plon").alias("lon")), F.struct((F.col("plat") + _HIGHWAY_STEP[0]).alias("lat"), (F.col("plon") + _HIGHWAY_STEP[1]).alias("lon")))
    highways = x.places(spark, sf_dir).select(k.alias("way_id"), pick(k % 5, _HIGHWAY_KINDS).alias("highway"), F.when(k % 2 == 0, " ").otherwise(F.concat(F.lit("I "), k.cast("string"))).alias("ref"), F.create_map(F.lit("z"), F.lit("z")).alias("tags"), lines.alias("points"))
    return projection.nearest_highway(x.exits(spark, sf_dir).withColumnRenamed("exit_id", "node_id"), highways)


_GOING = ["N", "EB", "west", " s ", None]
_SAYS = ["Eastbound", "west  bound rest", "NB", "(southbound)", "eb/wb", "newbury", "sb east bound"]


@query(f"""c as (select l_orderkey as exit_id, l_partkey as poi_id, l_linenumber as n from lineitem),
l as (select exit_id, poi_id, n, lower(trim(coalesce({pick_sql("exit_id % 5", _GOING)}, ''))) as g, lower(p_name || ' ' || {pick_sql("p_size % 7", _SAYS)}) as label, case when n % 2 = 1 then 'restArea' else 'gas' end as category from c join part on p_partkey = poi_id),
w as (select *, case when g in ('west','w','wb') then 'west' when g in ('east','e','eb') then 'east' when g in ('north','n','nb') then 'north' when g in ('south','s','sb') then 'south' end as d,
  regexp_matches(label, '(^|[^a-z])(eastbound|east\\s*bound|eb)([^a-z]|$)') as e, regexp_matches(label, '(^|[^a-z])(westbound|west\\s*bound|wb)([^a-z]|$)') as we,
  regexp_matches(label, '(^|[^a-z])(northbound|north\\s*bound|nb)([^a-z]|$)') as no, regexp_matches(label, '(^|[^a-z])(southbound|south\\s*bound|sb)([^a-z]|$)') as s from l),
bad as (select exit_id, poi_id from w where category = 'restArea' and ((d in ('east','west') and e::int + we::int = 1 and ((e and d <> 'east') or (we and d <> 'west'))) or (d in ('north','south') and no::int + s::int = 1 and ((no and d <> 'north') or (s and d <> 'south')))))
;; select exit_id, poi_id, category from l where (exit_id, poi_id) not in (select (exit_id, poi_id) from bad)""")
def directional_conflict_prune(spark, sf_dir):
    rows = x.load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("exit_id"), F.col("l_partkey").alias("poi_id"), F.when(F.col("l_linenumber") % 2 == 1, "restArea").otherwise("gas").alias("category"))
    labels = x.load(spark, sf_dir, "part").select(F.col("p_partkey").alias("poi_id"), F.lower(F.concat("p_name", F.lit(" "), pick(F.col("p_size") % 7, _SAYS))).alias("label"))
    going = rows.select("exit_id").distinct().withColumn("direction", pick(F.col("exit_id") % 5, _GOING))
    return projection.prune_directional_conflicts(rows, labels, going)


@query("""c as (select l_orderkey as exit_id, l_partkey as poi_id, l_suppkey as distance_m from lineitem where l_linenumber % 2 = 1),
r as (select exit_id, coalesce(nullif(case when p_size % 3 = 0 then '' else p_brand end, ''), nullif(p_name, ''), 'Rest Area') as rest_area, row_number() over (partition by exit_id order by distance_m, poi_id) as n from c join part on p_partkey = poi_id)
;; select exit_id, rest_area from r where n = 1""")
def nearest_named_place(spark, sf_dir):
    rows = x.load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("exit_id"), F.col("l_partkey").alias("poi_id"), F.when(F.col("l_linenumber") % 2 == 1, "restArea").otherwise("gas").alias("category"), F.col("l_suppkey").alias("distance_m"))
    spots = x.load(spark, sf_dir, "part").select(F.col("p_partkey").alias("poi_id"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_brand")).alias("display_name"))
    return projection.nearest_rest_area(rows, spots)


@query("""n as (select 'node/' || p_partkey as id, case when p_type = 'PROMO' then 'restArea' else p_type end as category, case p_size % 3 when 0 then '' when 1 then p_name end as name, case when p_size % 2 = 0 then p_brand end as shown, case when p_size % 4 = 0 then p_brand end as tag from part
  union all select 'way/' || s_suppkey, 'restArea', s_name, null, null from supplier)
;; select id, category, case when category = 'restArea' and (coalesce(name, '') = '' or coalesce(tag, '') = '') then 'Rest Area' else name end as name,
  case when category = 'restArea' and coalesce(tag, '') = '' then 'Rest Area' else coalesce(nullif(shown, ''), nullif(name, ''), case when category = 'restArea' then 'Rest Area' end) end as display_name from n""")
def places_union(spark, sf_dir):
    k = F.col("p_partkey")
    brand = F.when(F.col("p_size") % 4 == 0, F.col("p_brand"))
    nodes = x.load(spark, sf_dir, "part").select(
        k.alias("node_id"), F.when(F.col("p_type") == "PROMO", "restArea").otherwise(F.col("p_type")).alias("category"), F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 1, F.col("p_name")).alias("name"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("display_name"), F.lit(None).cast("string").alias("brand"), F.create_map(F.lit("name"), brand).alias("tags"), spot(k, 7919, 40.0).alias("lat"), spot(k, 7919, 40.0).alias("lon"),
    )
    none = F.lit(None).cast("string")
    ways = x.load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("osm_id"), F.lit("restArea").alias("category"), F.col("s_name").alias("name"), none.alias("display_name"), none.alias("brand"), F.create_map(F.lit("z"), F.lit("z")).alias("tags"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))
    return projection.union_places(nodes, ways).select("id", "category", "name", "display_name")


# ---------------------------------------------------------------- references and directions

_INTERSTATE = "^[Ii][- ]*([0-9]+[A-Za-z]?)((?i)( expr| express| hov| texpress| flex| local| north| south| east| west))?$"


@query(f"""s as (select part_id, trim(regexp_replace(ref, '\\s+', ' ', 'g')) as s from x_refs),
p as (select *, regexp_matches(s, '{_INTERSTATE}') as i, regexp_matches(s, '^[Uu][Ss][- ]*[0-9]+[A-Za-z]?$') as u, regexp_matches(s, '^[A-Za-z][A-Za-z][- ]*[0-9]+[A-Za-z]? *((?i)toll)?$') as st from s),
q as (select *, upper(substr(s, 1, 2)) || '-' || upper(regexp_extract(s, '^[A-Za-z]{{2}}[- ]*([0-9]+[A-Za-z]?)', 1)) as state, lower(s) like '%toll' as toll from p)
;; select part_id, case when s = '' then null when i then 'I-' || upper(regexp_extract(s, '{_INTERSTATE}', 1)) when u then 'US-' || upper(regexp_extract(s, '^[Uu][Ss][- ]*([0-9]+[A-Za-z]?)$', 1))
  when st and toll then state || ' Toll' when st and state = 'CA-210' then 'I-210' when st and state = 'VA-164' then 'I-164' when st then state else s end as ref from q""")
def normalize_highway_ref(spark, sf_dir):
    return x.raw_refs(spark, sf_dir).select("part_id", refs.normalize_highway_ref(F.col("ref")).alias("ref"))


@query(f""";; select part_id, regexp_matches(ref, '{_INTERSTATE}') as is_interstate, regexp_matches(upper(trim(ref)), '^(?:I-?[0-9]+|I-?35[EW]|I-?69[CEW])$') as is_exported from x_refs""")
def interstate_filter(spark, sf_dir):
    return x.raw_refs(spark, sf_dir).select("part_id", refs.is_interstate(F.col("ref")).alias("is_interstate"), refs.is_exported(F.col("ref")).alias("is_exported"))


_ROLES = ["North", "southbound", "E", "west (thru)", "forward", "backward:x", "", "northeast", "east%20bound", "Southern", None, "w"]


@query(f"""r as (select p_partkey as part_id, lower(trim(replace({pick_sql("p_partkey % 12", _ROLES)}, '%20', ' '))) as v from part)
;; select part_id, case when v in ('north','northbound','n') then 'north' when v in ('south','southbound','s') then 'south' when v in ('east','eastbound','e') then 'east' when v in ('west','westbound','w') then 'west'
  else nullif(regexp_extract(v, '^(north|south|east|west)(bound)?([^a-z]|$)', 1), '') end as direction, nullif(regexp_extract(v, '^(forward|backward)([^a-z]|$)', 1), '') as flow from r""")
def normalize_direction(spark, sf_dir):
    k = F.col("p_partkey")
    role = pick(k % 12, _ROLES)
    return x.load(spark, sf_dir, "part").select(k.alias("part_id"), refs.direction(role).alias("direction"), refs.flow_role(role).alias("flow"))


_TAGS = [("amenity", "fuel"), ("tourism", "motel"), ("cuisine", "pizza"), ("highway", "services"), ("amenity", "toilets"), ("amenity", "charging_station"), ("leisure", "dog_park"), ("leisure", "park"), ("shop", "gas"), ("amenity", "bank")]


@query(""";; select p_partkey as part_id, case p_partkey % 10 when 0 then 'gas' when 1 then 'lodging' when 2 then 'food' when 3 then case when p_size % 2 = 0 then 'food' else 'restArea' end when 4 then case when p_size % 2 = 0 then 'food' else 'restroom' end
  when 5 then case when p_size % 2 = 0 then 'food' else 'evCharging' end when 6 then case when p_size % 2 = 0 then 'food' else 'dogPark' end when 7 then case when p_size % 2 = 0 then 'food' when p_size % 3 = 0 then 'park' end when 8 then 'gas' else case when p_size % 2 = 0 then 'food' end end as category from part""")
def poi_classify(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    keys, values = pick(k % 10, [a for a, _ in _TAGS]), pick(k % 10, [b for _, b in _TAGS])
    tags = F.map_concat(F.create_map(keys, values), F.create_map(F.lit("name"), F.when(size % 3 == 0, "Big PARK").otherwise("Plaza")))
    tags = F.when((size % 2 == 0) & (keys != "cuisine"), F.map_concat(tags, F.create_map(F.lit("cuisine"), F.lit("")))).otherwise(tags)
    return x.load(spark, sf_dir, "part").select(k.alias("part_id"), osm.poi_category(tags).alias("category"))


_CLASSES = ["motorway", "trunk_link", "construction", "primary", "construction", None]
_WORKS = ["trunk", "primary", None]
_WORK_REFS = ["US 1;I 95", "US 9", "", "i-5a"]


@query(f"""t as (select p_partkey as k, {pick_sql("p_partkey % 6", _CLASSES)} as h, {pick_sql("p_size % 3", _WORKS)} as c, {pick_sql("p_size % 4", _WORK_REFS)} as r from part)
;; select k as part_id, case when h in ('motorway', 'trunk_link') then h when h = 'construction' and c = 'trunk' then 'trunk' when h = 'construction' and r in ('US 1;I 95', 'i-5a', '') and (r <> '' or k % 2 = 0) then 'motorway' end as class from t""")
def effective_highway_class(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    tags = F.map_from_arrays(F.array(F.lit("highway"), F.lit("construction"), F.lit("ref"), F.lit("int_ref")), F.array(pick(k % 6, _CLASSES), pick(size % 3, _WORKS), pick(size % 4, _WORK_REFS), F.when(k % 2 == 0, "I 7").otherwise("E 7")))
    return x.load(spark, sf_dir, "part").select(k.alias("part_id"), osm.highway_class(tags).alias("class"))


@query("""t as (select p_partkey as k, p_size as s from part where p_partkey % 3 = 0)
;; select k as node_id, case when s % 2 = 0 then 'r' || k when s % 3 = 0 then 'j' || k end as ref, case when s % 5 = 0 then '' when s % 7 = 0 then 'd' || k end as name from t""")
def exit_projection(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size")
    tags = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit("highway"), F.when(k % 3 == 0, "motorway_junction").otherwise("stop")), F.struct(F.lit("ref"), F.when(s % 2 == 0, F.concat(F.lit("r"), k.cast("string")))), F.struct(F.lit("junction:ref"), F.when(s % 3 == 0, F.concat(F.lit("j"), k.cast("string")))),
        F.struct(F.lit("name"), F.when(s % 5 == 0, "")), F.struct(F.lit("destination"), F.when(s % 7 == 0, F.concat(F.lit("d"), k.cast("string")))),
    ), lambda e: e.col2.isNotNull()))
    nodes = x.load(spark, sf_dir, "part").select(k.alias("id"), F.lit(1.0).alias("lat"), F.lit(1.0).alias("lon"), tags.alias("tags"))
    return osm.exit_nodes(nodes).select("node_id", "ref", "name")


@query("""w as (select l_orderkey as id, list(l_partkey order by l_linenumber, l_partkey) as nodes, bool_and(p_size <> 13) as whole from lineitem join part on p_partkey = l_partkey group by 1 having count(*) >= 2)
;; select id, len(nodes)::int as n, round(list_sum(list_transform(nodes, lambda k: (k * 7919 % 100003) / 100003.0::double)) + 40.0::double * len(nodes), 6) as lat_sum, round(40.0::double + (nodes[1] * 7919 % 100003) / 100003.0::double, 9) as first_lat from w where whole""")
def way_geometry(spark, sf_dir):
    """Parts of size 13 have no place, so ways through one go."""
    k = F.col("p_partkey")
    nodes = x.load(spark, sf_dir, "part").where("p_size <> 13").select(k.alias("id"), spot(k, 7919, 40.0).alias("lat"), spot(k, 104729, -75.0).alias("lon"))
    ways = x.load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("s")).select(F.col("l_orderkey").alias("id"), F.transform("s", lambda e: e.l_partkey).alias("node_ids"))
    total = F.aggregate(F.transform("points", lambda p: p.lat), F.lit(0.0), lambda s, v: s + v)
    return osm.way_points(ways, nodes).select("id", F.size("points").alias("n"), F.round(total, 6).alias("lat_sum"), F.round(F.element_at("points", 1).lat, 9).alias("first_lat"))


# ---------------------------------------------------------------- graphs

_LAT, _LON = (lambda k: x.spot_sql(k, 15485863, 40.0)), (lambda k: x.spot_sql(k, 32452843, -75.0))


def _arcs(spark, sf_dir) -> DataFrame:
    return graph.directed_arcs(graph.way_steps(x.ways(spark, sf_dir), "route"), "route")


@query(f";; select way_id, route, src, dst, greatest(1, round({haversine_sql(_LAT('src'), _LON('src'), _LAT('dst'), _LON('dst'))}))::bigint as weight_m from x_arcs")
def way_arcs(spark, sf_dir):
    return _arcs(spark, sf_dir).select("way_id", "route", "src", "dst", "weight_m")


@query(";; select route, src, dst, array_to_string(list_sort(list_distinct(list(way_id))), ',') as way_ids from x_arcs group by all")
def arc_way_sets(spark, sf_dir):
    return graph.arc_way_sets(_arcs(spark, sf_dir), "route").withColumn("way_ids", F.array_join("way_ids", ","))


_DEGREES = """
p as (select distinct route, src, dst from x_arcs),
s as (select route, src as node, dst as other, 1 as o, 0 as i from p union all select route, dst, src, 0, 1 from p),
q as (select route, node, other, max(o) as o, max(i) as i from s group by all),
d as (select route, node, sum(i)::bigint as n_in, sum(o)::bigint as n_out, count(*) as n_near, sum(i * o)::bigint as n_both from q group by all)"""


@query(_DEGREES + ";; select * from d")
def node_degrees(spark, sf_dir):
    return graph.node_degrees(_arcs(spark, sf_dir), "route")


@query(_DEGREES + """,
g as (select distinct highway, way_id, root_relation_id, coalesce(direction, '~') as dir from (select 'I-' || (l_orderkey % 997) as highway, l_orderkey as way_id, l_suppkey % 3 as root_relation_id, null::varchar as direction from lineitem)),
t as (select a.route, a.src, a.dst, root_relation_id || ':' || dir as sign from x_arcs a left join g on g.highway = a.route and g.way_id = a.way_id),
sd as (select route, src as node, dst as other, sign from t union all select route, dst, src, sign from t),
bs as (select route, node, other, list_sort(list_distinct(list(sign))) as signs from sd group by all),
ch as (select route, node from bs group by all having count(*) <> 2 or count(distinct signs) > 1)
;; select route, node from d where not ((n_in = 1 and n_out = 1) or (n_in = 2 and n_out = 2 and n_both = 2)) union select route, node from d where node in (select s_suppkey from supplier) union select route, node from d semi join ch using (route, node)""")
def stop_nodes(spark, sf_dir):
    arcs = _arcs(spark, sf_dir)
    signs = x.load(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("I-"), (F.col("l_orderkey") % 997).cast("string")).alias("highway"), F.col("l_orderkey").alias("way_id")).agg(F.array_sort(F.collect_set(F.struct((F.col("l_suppkey") % 3).alias("root_relation_id"), F.lit(None).cast("string").alias("direction")))).alias("signature"))
    at = x.load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("node"))
    return graph.stop_nodes(graph.node_degrees(arcs, "route"), at, graph.signature_changes(arcs, signs), "route")


@query("""e as (select route, src as a, dst as b from x_steps union select route, dst, src from x_steps),
r as (select distinct route, a as node, a as low from e union select r.route, e.b, r.low from r join e on e.route = r.route and e.a = r.node and r.low < e.b),
m as (select route, node, min(low) as low from r group by all)
;; select route, node, (dense_rank() over (partition by route order by low) - 1)::int as component from m""", recursive=True)
def components(spark, sf_dir):
    return graph.components(_arcs(spark, sf_dir))


@query(f"""e as (select route as highway, (way_id % 3)::int as component, radians({bearing_sql(_LAT('node_ids[1]'), _LON('node_ids[1]'), _LAT('node_ids[len(node_ids)]'), _LON('node_ids[len(node_ids)]'))}) as h, way_id % 900 + 1 as m from x_ways),
a as (select highway, component, (degrees(atan2(sum(sin(h) * m), sum(cos(h) * m))) + 360.0) % 360.0 as angle from e group by all)
;; select highway, component, case when angle >= 315 or angle < 45 then 'N' when angle < 135 then 'E' when angle < 225 then 'S' else 'W' end as direction from a""")
def component_directions(spark, sf_dir):
    edges = x.ways(spark, sf_dir).select(F.col("route").alias("highway"), (F.col("way_id") % 3).cast("int").alias("component"), "points", (F.col("way_id") % 900 + 1).alias("length_m"))
    return graph.component_directions(edges)


@query(_DEGREES + f""",
st as (select route, node from d where not ((n_in = 1 and n_out = 1) or (n_in = 2 and n_out = 2 and n_both = 2))),
a as (select route, src, dst, coalesce({haversine_sql(_LAT("src"), _LON("src"), _LAT("dst"), _LON("dst"))}, 0) as m, (route, dst) in (select (route, node) from st) as last from p),
c as (select a.route, src as start_node, dst as first, src as before, dst as node, m, 1 as n, last from a semi join st on st.route = a.route and st.node = src
  union all select c.route, start_node, first, node, dst, c.m + a.m, n + 1, a.last from c join a on a.route = c.route and a.src = c.node and a.dst <> c.before where not c.last),
g as (select route, start_node, first, arg_max(node, n) as end_node, max(n) as n, arg_max(m, n) as m from c group by 1, 2, 3),
f as (select * from g where start_node <> end_node qualify row_number() over (partition by route, start_node, end_node order by first) = 1),
e as (select route, src as x, dst as y from x_steps union select route, dst, src from x_steps),
r as (select distinct route, x as node, x as low from e union select r.route, e.y, r.low from r join e on e.route = r.route and e.x = r.node and r.low < e.y),
k as (select route, node, (dense_rank() over (partition by route order by min(low)) - 1)::int as component from r group by 1, 2)
;; select 'edge/' || f.route || '/' || start_node || '/' || end_node as id, f.route as highway, component, start_node, end_node, greatest(1, floor(m + 0.5))::int as length_m, (n + 1)::int as n_points from f join k on k.route = f.route and k.node = start_node""", recursive=True)
def compressed_edges(spark, sf_dir):
    arcs = _arcs(spark, sf_dir)
    none = spark.createDataFrame([], "route string, node long")
    stops = graph.stop_nodes(graph.node_degrees(arcs, "route"), none, none, "route")
    return graph.compressed_edges(arcs, stops, graph.components(arcs)).select("id", "highway", "component", "start_node", "end_node", "length_m", F.size("points").alias("n_points"))


def _mixed_ways(spark, sf_dir) -> DataFrame:
    """Each fifth way lacks a ref; of those each second is a link."""
    k = F.col("way_id")
    kind = F.when(k % 10 == 0, "motorway_link").otherwise("motorway")
    refs_ = F.when(k % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("I-"), (k % 41).cast("string"))))
    return x.ways(spark, sf_dir).select("way_id", kind.alias("highway"), refs_.alias("refs"), "node_ids", "points", "oneway")


@query(""";; select 'I-' || (way_id % 41) as route, way_id from x_ways where way_id % 5 <> 0""")
def assigned_ways(spark, sf_dir):
    return graph.assign_ways(_mixed_ways(spark, sf_dir))


@query("""seed as (select unnest(node_ids) as node, 'I-' || (way_id % 41) as route from x_ways where way_id % 5 <> 0),
w as (select way_id, unnest(node_ids) as node from x_ways where way_id % 5 = 0 and way_id % 10 <> 0)
;; select distinct route, way_id from w join seed using (node) union select 'I-' || (way_id % 41), way_id from x_ways where way_id % 5 <> 0""")
def adopted_refless_ways(spark, sf_dir):
    """On these dense ways one round adopts all, so SQL has one round; chains of rounds are in the tests."""
    ways = _mixed_ways(spark, sf_dir)
    return graph.adopt_refless(graph.assign_ways(ways), ways, checkpoint=_cut)


def _cut(df: DataFrame) -> DataFrame:
    """A checkpoint in the session's shared folder; where none is set, as in a bare local session, the plan as it is.
    Rows are held meanwhile, as a checkpoint counts them and then makes them once more."""
    if not df.sparkSession.sparkContext.getCheckpointDir():
        return df.persist()
    held = df.persist(StorageLevel.DISK_ONLY)
    cut = held.checkpoint()
    held.unpersist()
    return cut


@query()
def connector_paths(spark, sf_dir):
    ways = _mixed_ways(spark, sf_dir)
    return graph.adopt_connector_paths(graph.assign_ways(ways), ways, checkpoint=_cut)


@query(f"""s as (select s_suppkey as k, i::int as i from supplier, range(50) t(i)),
g as (select k, min(i) as lo, max(i) as hi from s where (k + i) % 17 <> 0 group by 1),
v as (select k, j, {_LAT("k")} + j * 0.004::double as lat, {_LON("k")} + j * 0.001::double as lon from g, range(51) t(j) where j between lo and hi + 1),
l as (select k, {haversine_sql("lag(lat) over (partition by k order by j)", "lag(lon) over (partition by k order by j)", "lat", "lon")} as m from v),
d as (select k, hi - lo + 1 as n, 'I-' || (k % 40) as highway, {pick_sql("k % 3", ["north", "south", None])} as going, (select sum(m) from l where l.k = g.k) as m from g)
;; select row_number() over (order by k % 40, k)::int as corridor_id, highway, k as root_relation_id, coalesce(going, 'north') as canonical_direction, n::int as n_ways, 1 as n_lines, round(m)::bigint as length_m from d where m >= 3000""")
def corridor_drafts(spark, sf_dir):
    groups = relations.route_groups(_draft_members(spark, sf_dir))
    ways = _draft_ways(spark, sf_dir)
    drafts = corridor_ops.corridor_drafts(relations.filter_blank_groups(groups), ways, _cut)
    return drafts.select("corridor_id", "highway", "root_relation_id", "canonical_direction", F.size("way_ids").alias("n_ways"), F.size("lines").alias("n_lines"), F.round(corridor_ops.route_length_m(F.col("lines"))).cast("long").alias("length_m"))


def _draft_members(spark, sf_dir) -> DataFrame:
    """Suppliers' lines as roads: each of the fifty stretches of 400 m is a way."""
    k = F.col("s_suppkey")
    rows = x.load(spark, sf_dir, "supplier").select(k, F.explode(F.sequence(F.lit(0), F.lit(49))).alias("i")).where((k + F.col("i")) % 17 != 0)
    return rows.select((k * 100 + F.col("i")).alias("way_id"), F.concat(F.lit("I-"), (k % 40).cast("string")).alias("highway"), k.alias("root_relation_id"), k.alias("leaf_relation_id"), pick(k % 3, ["north", "south", None]).alias("direction"), F.lit("").alias("role"), F.col("i").alias("sequence_index"))


def _draft_ways(spark, sf_dir) -> DataFrame:
    """All stretches; those that no relation lists have no ref, so they are connectors."""
    k = F.col("s_suppkey")
    rows = x.load(spark, sf_dir, "supplier").select(k, F.explode(F.sequence(F.lit(0), F.lit(49))).alias("i"))
    at = lambda i: F.struct((spot(k, 15485863, 40.0) + i * 0.004).alias("lat"), (spot(k, 32452843, -75.0) + i * 0.001).alias("lon"))
    listed = (k + F.col("i")) % 17 != 0
    return rows.select(
        (k * 100 + F.col("i")).alias("way_id"), F.lit("motorway").alias("highway"), F.when(listed, F.array(F.concat(F.lit("I-"), (k % 40).cast("string")))).otherwise(F.array().cast("array<string>")).alias("refs"),
        F.array(k * 1000 + F.col("i"), k * 1000 + F.col("i") + 1).alias("node_ids"), F.array(at(F.col("i")), at(F.col("i") + 1)).alias("points"), (k % 2 == 0).alias("oneway"),
    )


# ---------------------------------------------------------------- relations


@query(";; select way_id, array_to_string(list_sort(list_distinct(list(highway))), ',') as refs from x_members group by 1")
def refs_by_way(spark, sf_dir):
    return relations.refs_by_way(x.members(spark, sf_dir)).select("way_id", F.array_join("refs", ",").alias("refs"))


@query(""";; select highway, way_id, array_to_string(list_sort(list_distinct(list(lpad(root_relation_id::varchar, 6, '0') || coalesce(direction, '')))), ',') as signature from x_members group by 1, 2""")
def route_signatures(spark, sf_dir):
    text = F.transform("signature", lambda s: F.concat(F.lpad(s.root_relation_id.cast("string"), 6, "0"), F.coalesce(s.direction, F.lit(""))))
    return relations.route_signatures(x.members(spark, sf_dir)).select("highway", "way_id", F.array_join(F.array_sort(text), ",").alias("signature"))


_GROUPS = "g as (select highway, root_relation_id, direction, count(*)::int as n, md5(array_to_string(list(sequence_index || ':' || leaf_relation_id || ':' || way_id order by sequence_index, leaf_relation_id, way_id), ',')) as members from x_members group by all)"


@query(_GROUPS + ";; select *, row_number() over (order by regexp_extract(highway, '[0-9]+')::int, highway, root_relation_id, direction nulls first)::int as group_order from g")
def route_groups(spark, sf_dir):
    text = F.transform("members", lambda m: F.concat_ws(":", m.sequence_index, m.leaf_relation_id, m.way_id))
    return relations.route_groups(x.members(spark, sf_dir)).select("highway", "root_relation_id", "direction", F.size("members").alias("n"), F.md5(F.array_join(text, ",")).alias("members"), "group_order")


@query(_GROUPS + """, m as (select highway, root_relation_id, sum(case when direction is not null then n end) as d from g group by all)
;; select highway, root_relation_id, direction, n from g join m using (highway, root_relation_id) where direction is not null or d is null or n > d""")
def blank_group_filter(spark, sf_dir):
    groups = relations.route_groups(x.members(spark, sf_dir))
    return relations.filter_blank_groups(groups).select("highway", "root_relation_id", "direction", F.size("members").alias("n"))


def _relation_tree(spark, sf_dir) -> DataFrame:
    """Suppliers as relations: of each ten the first is a root over the next three, and each has its lines' parts as ways."""
    k = F.col("l_suppkey")
    ways = x.load(spark, sf_dir, "lineitem").groupBy(k.alias("relation_id")).agg(F.array_sort(F.collect_set("l_partkey")).alias("ways"))
    role = lambda w: pick(w % 5, ["north", "", "forward", "south", ""])
    own = F.transform("ways", lambda w: F.struct(F.lit("w").alias("type"), w.alias("id"), role(w).alias("role")))
    r = F.col("relation_id")
    below = F.when(r % 10 == 0, F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda i: F.struct(F.lit("r").alias("type"), (r + i).alias("id"), F.lit("").alias("role")))).otherwise(F.array().cast("array<struct<type:string,id:bigint,role:string>>"))
    return ways.select("relation_id", F.concat(F.lit("I-"), (r / 10).cast("int").cast("string")).alias("ref"), F.when(r % 7 == 1, "north").alias("direction"), F.concat(F.lit("Road "), r.cast("string")).alias("name"), F.lit(None).cast("string").alias("description"), F.concat(below, own).alias("members"))


@query(f"""w as (select distinct l_suppkey as leaf, l_partkey as way_id, {pick_sql("l_partkey % 5", ["north", "", "forward", "south", ""])} as role from lineitem),
t as (select *, case when leaf % 10 between 1 and 3 and leaf - leaf % 10 in (select leaf from w) then leaf - leaf % 10 else leaf end as root from w),
d as (select *, case when leaf % 7 = 1 then 'north' when role in ('north', 'south') then role when root % 7 = 1 then 'north' else '' end as direction from t),
n as (select distinct leaf // 10 as ref, root, way_id, direction from d where direction <> ''),
k as (select root, count(*) as n from n group by 1),
i as (select a.root, b.root as other, count(*) as n from n a join n b on a.ref = b.ref and a.way_id = b.way_id and a.direction = b.direction and a.root <> b.root group by 1, 2),
gone as (select i.root from i join k on k.root = i.root join k o on o.root = i.other where i.n = k.n and (o.n > k.n or i.other < i.root))
;; select way_id, 'I-' || (leaf // 10) as highway, root as root_relation_id, leaf as leaf_relation_id, direction, role, (row_number() over (partition by root, direction order by leaf = root, leaf, way_id) - 1)::int as sequence_index from d where root not in (select root from gone)""")
def flattened_relations(spark, sf_dir):
    """All relations have ways of both directions, so none has a default, and SQL has no rule for it."""
    return relations.flatten_relations(_relation_tree(spark, sf_dir))


@query("""w as (select distinct l_suppkey as r, l_partkey as w from lineitem)
;; select r as relation_id, 'I-' || (r % 90) as ref, case when r % 4 = 0 then 'north' end as direction, 'N ' || r as name, count(*)::int as n_members, max(w) as greatest from w where r % 5 <> 0 group by r""")
def parsed_relation_lines(spark, sf_dir):
    """Relations written as text lines and read back; each fifth is of another network."""
    r = F.col("l_suppkey")
    lines = x.load(spark, sf_dir, "lineitem").groupBy(r).agg(F.array_join(F.transform(F.array_sort(F.collect_set("l_partkey")), lambda w: F.concat(F.lit("w"), w.cast("string"), F.lit("@forward"))), ",").alias("m"))
    tags = F.concat(F.lit("network=US:"), F.when(r % 5 == 0, "US").otherwise("I"), F.lit(",route=road,ref="), F.when(r % 3 == 0, "I ").otherwise(""), (r % 90).cast("string"), F.when(r % 4 == 0, ",direction=North").otherwise(""), F.lit(",name=N%20"), r.cast("string"))
    text = lines.select(F.concat(F.lit("r"), r.cast("string"), F.lit(" v1 dV c1 t i0 u T"), tags, F.lit(" Mn5@,"), "m").alias("value"))
    found = osm.parse_relation_lines(text)
    return found.select("relation_id", "ref", "direction", "name", F.size("members").alias("n_members"), F.array_max(F.transform("members", lambda m: m.id)).alias("greatest"))


# ---------------------------------------------------------------- exits of corridors


@query(r"""d as (select distinct corridor_id, ref as part from x_corridor_exits where not contains(ref, ';')),
p as (select corridor_id, exit_id, trim(unnest(string_split(ref, ';'))) as part from x_corridor_exits where contains(ref, ';'))
;; select corridor_id, exit_id, ref from x_corridor_exits where ref is null or not contains(ref, ';') union all select corridor_id, exit_id || ':' || part, part from p where part <> '' and (corridor_id, part) not in (select (corridor_id, part) from d)""")
def split_semicolon_refs(spark, sf_dir):
    return exits.split_semicolon_refs(x.corridor_exits(spark, sf_dir)).select("corridor_id", "exit_id", "ref")


@query(r"""d as (select distinct corridor_id, ref as part from x_corridor_exits where ref is not null),
l as (select corridor_id, exit_id, regexp_extract(ref, '^([0-9]+)', 1) as base, list_filter(list_transform(string_split(regexp_replace(ref, '^[0-9]+', ''), '-'), lambda s: trim(s)), lambda s: regexp_matches(s, '^[A-Z]$')) as letters from x_corridor_exits where regexp_matches(ref, '^[0-9]')),
b as (select *, least(ascii(letters[1]), ascii(letters[-1])) as lo, greatest(ascii(letters[1]), ascii(letters[-1])) as hi from l where len(letters) >= 2),
p as (select corridor_id, exit_id, base || chr(unnest(range(lo, hi + 1))::int) as part from b where hi - lo <= 5)
;; select corridor_id, exit_id, ref from x_corridor_exits union all select corridor_id, exit_id || ':' || part, part from p where (corridor_id, part) not in (select (corridor_id, part) from d)""")
def expand_letter_ranges(spark, sf_dir):
    return exits.expand_letter_ranges(x.corridor_exits(spark, sf_dir)).select("corridor_id", "exit_id", "ref")


@query(r"""d as (select distinct corridor_id, ref as part from x_corridor_exits where not contains(ref, ',')),
q as (select corridor_id, exit_id, regexp_extract(trim(string_split(ref, ',')[1]), '^([0-9]*)', 1) as base, trim(unnest(string_split(ref, ','))) as s from x_corridor_exits where contains(ref, ',')),
p as (select corridor_id, exit_id, case when regexp_matches(s, '^[0-9]') then s when base <> '' then base || s end as part from q where s <> '')
;; select corridor_id, exit_id, ref from x_corridor_exits union all select corridor_id, exit_id || ':' || part, part from p where part is not null and (corridor_id, part) not in (select (corridor_id, part) from d)""")
def expand_comma_refs(spark, sf_dir):
    return exits.expand_comma_refs(x.corridor_exits(spark, sf_dir)).select("corridor_id", "exit_id", "ref")


@query(r"""e as (select *, regexp_extract(ref, '^([0-9]+)[A-Z]$', 1) as base, right(ref, 1) as letter from x_corridor_exits where ref is not null),
l as (select * from e where base <> ''),
n as (select corridor_id, base, graph_node, base || string_agg(letter, '' order by letter, exit_id) as merged, first(exit_id order by letter, exit_id) as model from l group by 1, 2, 3 having count(*) >= 2),
w as (select corridor_id, base, base || array_to_string(list_sort(list_distinct(list(letter))), '') as merged, first(exit_id order by letter, exit_id) as model from l group by 1, 2 having count(*) >= 2 and count(distinct letter) between 2 and 3),
m as (select corridor_id, merged, model from n union all select corridor_id, merged, model from w where (corridor_id, merged) not in (select (corridor_id, merged) from n))
;; select corridor_id, exit_id, ref from x_corridor_exits union all select corridor_id, model || ':' || merged, merged from m where (corridor_id, merged) not in (select (corridor_id, ref) from e)""")
def merge_letter_refs(spark, sf_dir):
    return exits.merge_letter_refs(x.corridor_exits(spark, sf_dir)).select("corridor_id", "exit_id", "ref")


_BASE = "nullif(case when regexp_matches(regexp_replace(ref, '[A-Z]+$', ''), '^[0-9]+$') then regexp_replace(ref, '[A-Z]+$', '') end, '')"


@query(f"""o as (select corridor_id, {_BASE} as base, lat as la, lon as lo from x_corridor_exits),
a as (select *, {_BASE} as base from x_pool),
c as (select corridor_id, node_id, ref, {haversine_sql("la", "lo", "lat", "lon")} as m from o join a using (base) where (corridor_id, ref) not in (select (corridor_id, ref) from x_corridor_exits where ref is not null)),
r as (select *, row_number() over (partition by corridor_id, ref order by m, node_id) as n from c where m < 3000)
;; select corridor_id, 'node/' || node_id as exit_id, ref from r where n = 1""")
def sibling_exits(spark, sf_dir):
    return exits.sibling_exits(x.corridor_exits(spark, sf_dir), x.exit_pool(spark, sf_dir)).select("corridor_id", "exit_id", "ref")


_SEGMENT = "least(1.0::double, greatest(0.0::double, ((p.lon - a.lon) * (b.lon - a.lon) + (p.lat - a.lat) * (b.lat - a.lat)) / (pow(b.lon - a.lon, 2) + pow(b.lat - a.lat, 2))))"


@query(f"""s as (select a.corridor_id, p.node_id, p.ref, p.lat, p.lon, a.lat + {_SEGMENT} * (b.lat - a.lat) as y, a.lon + {_SEGMENT} * (b.lon - a.lon) as z
  from x_vertices a join x_vertices b on a.corridor_id = b.corridor_id and a.line = b.line and b.pos = a.pos + 1 join x_pool p on abs(p.lat - a.lat) < 0.1 and abs(p.lon - a.lon) < 0.1),
c as (select *, {haversine_sql("lat", "lon", "y", "z")} as m from s where (corridor_id, ref) not in (select (corridor_id, ref) from x_corridor_exits where ref is not null)),
r as (select *, row_number() over (partition by corridor_id, ref order by m, node_id) as n from c where m <= 3000)
;; select corridor_id, 'node/' || node_id as exit_id, ref from r where n = 1""")
def nearby_exits(spark, sf_dir):
    return exits.nearby_exits(x.corridor_exits(spark, sf_dir), x.exit_pool(spark, sf_dir), x.corridor_lines(spark, sf_dir)).select("corridor_id", "exit_id", "ref")


@query(f"""v as (select *, lag(lat) over (partition by corridor_id, line order by pos) as y, lag(lon) over (partition by corridor_id, line order by pos) as z from x_vertices),
c as (select *, sum(coalesce({haversine_sql("y", "z", "lat", "lon")}, 0)) over (partition by corridor_id order by line, pos) as metres from v),
k as (select e.corridor_id, e.exit_id, first(c.metres order by {haversine_sql("c.lat", "c.lon", "e.lat", "e.lon")}, c.line, c.pos) as m from x_corridor_exits e join c on e.corridor_id = c.corridor_id group by 1, 2),
o as (select corridor_id, exit_id, coalesce(m, 0) as m from x_corridor_exits left join k using (corridor_id, exit_id))
;; select corridor_id, exit_id, round(m)::bigint as sort_key_m, (row_number() over (partition by corridor_id order by m, exit_id) - 1)::int as corridor_index from o""")
def exits_along_route(spark, sf_dir):
    ordered = exits.order_along_route(x.corridor_exits(spark, sf_dir), x.corridor_lines(spark, sf_dir))
    return ordered.select("corridor_id", "exit_id", F.round("sort_key_m").cast("long").alias("sort_key_m"), "corridor_index")


@query("""w as (select l_suppkey as corridor_id, l_orderkey as way_id from lineitem), e as (select l_partkey as edge, l_orderkey as way_id from lineitem)
;; select distinct corridor_id, 'edge/' || edge as edge_id from w join e using (way_id)""")
def matched_edges(spark, sf_dir):
    rows = x.load(spark, sf_dir, "lineitem")
    drafts = rows.groupBy(F.col("l_suppkey").alias("corridor_id")).agg(F.collect_set("l_orderkey").alias("way_ids")).withColumn("highway", F.lit("I-1"))
    edges = rows.groupBy(F.concat(F.lit("edge/"), F.col("l_partkey").cast("string")).alias("id")).agg(F.collect_set("l_orderkey").alias("way_ids")).withColumn("highway", F.lit("I-1"))
    return corridor_ops.match_edges(drafts, edges)


# ---------------------------------------------------------------- routes


@query("""s as (select l_orderkey as corridor_id, l_linenumber as line, l_partkey as node, l_extendedprice / 20 as length_m from lineitem),
w as (select *, max(length_m) over (partition by corridor_id) as longest, count(*) over (partition by corridor_id) as n from s)
;; select corridor_id, line, node from w where n <= 1 or longest <= 0 or length_m >= 2000 or length_m >= longest * 0.05::double""")
def micro_segment_prune(spark, sf_dir):
    rows = x.load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("corridor_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("node"), (F.col("l_extendedprice") / 20).alias("length_m"))
    return routes.prune_micro_segments(rows, "corridor_id", "length_m").select("corridor_id", "line", "node")


def _long_corridors(spark, sf_dir) -> DataFrame:
    """Suppliers' corridors of 50 points, 0.02 degrees apart."""
    k = F.col("s_suppkey")
    lat, lon = spot(k, 15485863, 40.0), spot(k, 32452843, -75.0)
    line = F.transform(F.sequence(F.lit(0), F.lit(49)), lambda i: F.struct((lat + i * F.lit(0.02)).alias("lat"), (lon + i * F.lit(0.003)).alias("lon")))
    return x.load(spark, sf_dir, "supplier").select(k.cast("int").alias("corridor_id"), F.concat(F.lit("I-"), (k % 40).cast("string")).alias("highway"), pick(F.col("s_nationkey") % 4, x.CORRIDOR_DIRECTIONS).alias("canonical_direction"), F.array(line).alias("lines"))


_SAMPLED = f"""s as (select s_suppkey::int as k, {pick_sql("s_nationkey % 4", x.CORRIDOR_DIRECTIONS)} as going, {_LAT("s_suppkey")} as y0, {_LON("s_suppkey")} as x0 from supplier),
b as (select *, going in ('south', 'west') as turned from s),
v as (select k, i::int as i, y0 + (case when turned then 49 - i else i end) * 0.02::double as lat, x0 + (case when turned then 49 - i else i end) * 0.003::double as lon from b, range(50) t(i)),
l as (select k, i, lag(lat) over o as alat, lag(lon) over o as alon, lat as blat, lon as blon from v window o as (partition by k order by i)),
n as (select *, {haversine_sql("alat", "alon", "blat", "blon")} as m from l where i > 0),
u as (select *, sum(m) over (partition by k order by i) as upto, sum(m) over (partition by k) as total from n),
q as (select k, j, j * {routes.STEP_M}::double as mark from (select k, unnest(range(0, (total / {routes.STEP_M}::double)::bigint + 2)) as j from u where i = 1) where j * {routes.STEP_M}::double <= (select any_value(total) from u where u.k = k)),
z as (select q.k, j, alat + (mark - (upto - m)) / m * (blat - alat) as lat, alon + (mark - (upto - m)) / m * (blon - alon) as lon from q join u on u.k = q.k and mark <= upto and (mark > upto - m or (i = 1 and mark = 0))),
y as (select k, max(j) as j, arg_max(lat, j) as lat, arg_max(lon, j) as lon from z group by 1),
w as (select * from z union all select y.k, y.j + 1, v.lat, v.lon from y join v on v.k = y.k and v.i = 49 where {haversine_sql("y.lat", "y.lon", "v.lat", "v.lon")} > 10),
h as (select *, lead(lat) over o as nlat, lead(lon) over o as nlon from w window o as (partition by k order by j)),
c as (select k, j, lat, lon, {bearing_sql("lat", "lon", "nlat", "nlon")} as b from h),
e as (select k, j, radians(lat) as p, radians(lon) as q, radians((coalesce(b, lag(b) over (partition by k order by j)) + 90) % 360) as side, {routes.LANE_M}::double / 6371000 as far from c),
f as (select k, j, q, side, far, p, asin(sin(p) * cos(far) + cos(p) * sin(far) * cos(side)) as lat from e),
pts as (select k, j, degrees(lat) as lat, degrees(q + atan2(sin(side) * sin(far) * cos(p), cos(far) - sin(p) * sin(lat))) as lon from f),
steps as (select k, j, lat, lon, lag(lat) over o as plat, lag(lon) over o as plon from pts window o as (partition by k order by j)),
sums as (select k, sum({haversine_sql("plat", "plon", "lat", "lon")}) as metres, count(*) as n, arg_min(lat, j) as first_lat, arg_max(lon, j) as last_lon from steps group by 1)"""


@query(_SAMPLED + """,
r as (select s.k, 'I-' || (s.k % 40) as highway, upper(going[1]) || 'B' as code, upper(going[1]) || going[2:] || 'bound' as label, metres, n, first_lat, last_lon from sums join s using (k) where metres >= 50000)
;; select highway, code as direction_code, highway || ' ' || label as display_name, k as corridor_id, row_number() over (partition by highway, code order by metres desc, k)::int as variant_rank, round(metres, 3) as distance_m, n::int as point_count, n * 5.0::double as duration_s, round(first_lat, 6) as start_lat, round(last_lon, 6) as end_lon from r""")
def resampled_routes(spark, sf_dir):
    return routes.reference_routes(_long_corridors(spark, sf_dir)).select("highway", "direction_code", "display_name", "corridor_id", "variant_rank", F.round("distance_m", 3).alias("distance_m"), "point_count", "duration_s", F.round("start_lat", 6).alias("start_lat"), F.round("end_lon", 6).alias("end_lon"))


@query(_SAMPLED + ";; select k as corridor_id, j::int as anchor_index, round(lat, 6) as lat, round(lon, 6) as lon from pts join (select k, max(j) as top from pts group by 1) using (k) semi join (select k from sums where metres >= 50000) using (k) where j % 40 = 0 or j = top")
def route_anchors(spark, sf_dir):
    found = routes.reference_routes(_long_corridors(spark, sf_dir))
    anchors = routes.route_anchors(found).join(found.select(F.col("id").alias("route_id"), "corridor_id"), "route_id")
    return anchors.select("corridor_id", "anchor_index", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query(f"""v as (select l_orderkey as route, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey) as pos, {_LAT('l_partkey')} as lat, {_LON('l_partkey')} as lon from lineitem),
s as (select *, {haversine_sql("lag(lat) over (partition by route order by pos)", "lag(lon) over (partition by route order by pos)", "lat", "lon")} as m from v),
c as (select route, 1 + count(*) filter (m > 10000) as n_lines, count(*) as n_points from s group by 1)
;; select route, n_lines::int as n_lines, n_points::int as n_points from c where n_points >= 2""")
def gap_splits(spark, sf_dir):
    ways = x.ways(spark, sf_dir)
    lines = routes.split_gaps(F.col("points"))
    return ways.select(F.col("way_id").alias("route"), F.size(lines).alias("n_lines"), F.aggregate(F.transform(lines, F.size), F.lit(0), lambda s, n: s + n).alias("n_points"))


# ---------------------------------------------------------------- release tables

_EXPORTED = "c as (select * from x_corridors where regexp_matches(highway, '^(?:I-?[0-9]+|I-?35[EW]|I-?69[CEW])$'))"


@query(_EXPORTED + ";; select c.corridor_id, highway as interstate_name, canonical_direction as direction_code, upper(canonical_direction[1]) || substr(canonical_direction, 2) as direction_label, geometry_json as geometry_geojson, count(e.id) as edge_count from c left join x_edges e on e.corridor_id = c.corridor_id group by all")
def corridor_summary(spark, sf_dir):
    return export.corridors(x.corridors(spark, sf_dir), x.edges(spark, sf_dir))


def _coordinate(i: str):
    return F.round(F.get_json_object("geometry_geojson", f"$.coordinates{i}").cast("double"), 9)


@query(_EXPORTED + ";; select e.id as edge_id, e.corridor_id, highway as interstate_name, canonical_direction as direction_code, length_m, round(alon, 9) as lon, round(blat, 9) as end_lat from x_edges e join c on c.corridor_id = e.corridor_id")
def corridor_edges(spark, sf_dir):
    return export.corridor_edges(x.corridors(spark, sf_dir), x.edges(spark, sf_dir)).withColumns({"lon": _coordinate("[0][0]"), "end_lat": _coordinate("[1][1]")}).drop("geometry_geojson")


@query(_EXPORTED + ";; select exit_id, e.corridor_id, highway as interstate_name, canonical_direction as direction_code, corridor_index as sequence_index, ref as exit_number, name as exit_name, round(lat, 9) as lat, round(lon, 9) as lon from x_ordered e join c on c.corridor_id = e.corridor_id")
def corridor_exits(spark, sf_dir):
    return export.corridor_exits(x.corridors(spark, sf_dir), x.ordered_exits(spark, sf_dir)).withColumns({"lon": _coordinate("[0]"), "lat": _coordinate("[1]")}).drop("geometry_geojson")


def _links(spark, sf_dir) -> DataFrame:
    found = exit_place_candidates(spark, sf_dir)
    return found.withColumn("exit_id", F.concat(F.lit("node/"), F.col("exit_id").cast("string")))


def _pois(spark, sf_dir) -> DataFrame:
    return x.places(spark, sf_dir).select(F.col("poi_id").alias("id"), "category", "name", F.lit("shown").alias("display_name"), "brand", F.col("plat").alias("lat"), F.col("plon").alias("lon"))


_LINKS = _EXPORTED + "," + _PAIRS + """,
ranked as (select *, row_number() over (partition by exit_id, category order by deg, poi_id)::int as rank from pairs where m <= 1600),
links as (select 'node/' || exit_id as exit_id, poi_id, category, name, brand, round_even(m, 0)::int as distance_m, rank from ranked where rank <= 12 and (category = 'PROMO' or round_even(m, 0) <= 800)),
used as (select l.* from links l join x_ordered o on o.exit_id = l.exit_id join c on c.corridor_id = o.corridor_id)"""


@query(_LINKS + f";; select distinct poi_id as place_id, category, name, 'shown' as display_name, brand, round({_LON('poi_id')}, 9) as lon from used")
def places(spark, sf_dir):
    return export.places(x.corridors(spark, sf_dir), x.ordered_exits(spark, sf_dir), _links(spark, sf_dir), _pois(spark, sf_dir)).withColumn("lon", _coordinate("[0]")).drop("geometry_geojson")


@query(_LINKS + ";; select exit_id, poi_id as place_id, category, distance_m, rank from used")
def exit_place_links(spark, sf_dir):
    # exits that no exported corridor has go before links are made, and links stay lists until exits are sorted
    found = x.exits(spark, sf_dir).withColumn("exit_id", F.concat(F.lit("node/"), F.col("exit_id").cast("string")))
    on = export.linked_exits(x.corridors(spark, sf_dir), x.ordered_exits(spark, sf_dir))
    return export.place_links(projection.exit_place_lists(found.join(on.hint("merge"), "exit_id"), x.places(spark, sf_dir), open_categories=("PROMO",)))


@query(_EXPORTED + ";; select corridor_id, direction_code from (select corridor_id, canonical_direction as direction_code, highway from c) where highway = 'I-5'")
def corridors_of_interstate(spark, sf_dir):
    return export.corridors_of(export.corridors(x.corridors(spark, sf_dir), x.edges(spark, sf_dir)), "I-5").select("corridor_id", "direction_code")


@query(_EXPORTED + ";; select e.corridor_id, count(*) as exit_count from x_ordered e join c on c.corridor_id = e.corridor_id group by 1")
def exits_per_corridor(spark, sf_dir):
    return export.exits_per_corridor(export.corridor_exits(x.corridors(spark, sf_dir), x.ordered_exits(spark, sf_dir)))


@query(";; select null::varchar as canonical_exit_id, null::varchar as source_exit_id where false")
def exit_aliases(spark, sf_dir):
    return export.exit_aliases(spark)


@query()
def exported_routes(spark, sf_dir):
    found = export.reference_routes(routes.reference_routes(_long_corridors(spark, sf_dir)))
    return found.select("reference_route_id", "interstate_name", "direction_code", "display_name", "point_count", F.round("distance_m", 3).alias("distance_m"))


# ---------------------------------------------------------------- table effects


@query(""";; select o_custkey as id, arg_min(o_orderkey, o_orderkey) as first_order, arg_max(o_orderkey, o_orderkey) as last_order from orders group by 1""")
def first_and_last_writes(spark, sf_dir):
    rows = x.load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("n"))
    first = projection.insert_or_ignore(rows, ["id"], ["n"]).withColumnRenamed("n", "first_order")
    last = rows.groupBy("id").agg(F.max("n").alias("n"))
    return first.join(projection.upsert(first.withColumnRenamed("first_order", "n"), last, ["id"]).withColumnRenamed("n", "last_order"), "id")


@query("v as (select l_orderkey as id, max(l_suppkey) as v from lineitem group by 1);; select o_orderkey as id, coalesce(v, o_custkey) as value from orders left join v on v.id = o_orderkey")
def update_from_list(spark, sf_dir):
    rows = x.load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("value"))
    values = x.load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("value"))
    return projection.update_column(rows, values, "id", "value")


# ---------------------------------------------------------------- coverage

_TRUTH_REFS = ["{n}", "{n}A", "{n}.5", "{n}A,B", "{n}AB", "{n}A-C", "{n}E", "Rest Area {n}"]


def _truth(spark, sf_dir) -> DataFrame:
    k = F.col("s_suppkey")
    n = (k % 13 + 1).cast("string")
    ref = F.element_at(F.array(*(F.replace(F.lit(f), F.lit("{n}"), n) for f in _TRUTH_REFS)), (k % 8 + 1).cast("int"))
    highway = F.when(k % 5 == 0, "I-35W").otherwise(F.concat(F.lit("I-"), (k % 40).cast("string")))
    rows = x.load(spark, sf_dir, "supplier").select(highway.alias("highway"), ref.alias("ref"), spot(k, 7919, 40.0).alias("lat"), spot(k, 104729, -75.0).alias("lon"))
    return rows.where(~refs.is_non_exit(F.col("ref")))


def _own_exits(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    letter = pick(k % 4, ["", "A", "B", "C"])
    return x.load(spark, sf_dir, "customer").select(F.when(k % 7 == 0, "I-35").otherwise(F.concat(F.lit("I-"), (k % 40).cast("string"))).alias("highway"), F.concat(((k * 5) % 13 + 1).cast("string"), letter).alias("ref"), (spot(k, 7919, 40.0) + F.lit(0.001)).alias("lat"), spot(k, 104729, -75.0).alias("lon"))


_MATCH = f"""t as (select case when s_suppkey % 5 = 0 then 'I-35W' else 'I-' || (s_suppkey % 40) end as highway, replace({pick_sql("s_suppkey % 8", _TRUTH_REFS)}, '{{n}}', (s_suppkey % 13 + 1)::varchar) as ref, s_suppkey % 8 as kind, (s_suppkey % 13 + 1)::varchar as n, {x.spot_sql("s_suppkey", 7919, 40.0)} as lat, {x.spot_sql("s_suppkey", 104729, -75.0)} as lon from supplier where s_suppkey % 8 <> 7),
o0 as (select case when c_custkey % 7 = 0 then 'I-35' else 'I-' || (c_custkey % 40) end as highway, (c_custkey * 5 % 13 + 1) || {pick_sql("c_custkey % 4", ["", "A", "B", "C"])} as ref, {x.spot_sql("c_custkey", 7919, 40.0)} + 0.001::double as lat, {x.spot_sql("c_custkey", 104729, -75.0)} as lon from customer),
o as (select highway, ref from o0 union select highway, regexp_extract(ref, '^([0-9]+)[A-Z]$', 1) from o0 where regexp_matches(ref, '^[0-9]+[A-Z]$')),
alts as (select distinct highway, ref, unnest(case kind when 3 then [n || 'A', n || 'B'] when 4 then [n || 'A', n || 'B'] when 5 then [n || 'A', n || 'B', n || 'C'] when 6 then [n] end) as alt from t where kind in (3, 4, 5, 6)),
ok as (select highway, ref, alt, ((highway, alt) in (select (highway, ref) from o)) or (regexp_matches(alt, '^[0-9]+[A-Z]$') and (highway, regexp_extract(alt, '^([0-9]+)', 1)) in (select (highway, ref) from o)) as hit from alts),
parts as (select highway, ref from ok group by 1, 2 having bool_and(hit)),
near as (select distinct t.highway, t.ref from t join o0 on o0.highway = t.highway and abs(o0.lat - t.lat) <= 0.01::double and abs(o0.lon - t.lon) <= 0.01::double where {haversine_sql("t.lat", "t.lon", "o0.lat", "o0.lon")} <= 500),
p as (select distinct highway, ref, case when highway = 'I-35W' then 'I-35' end as base, regexp_extract(ref, '^([0-9]+)[A-Z]$', 1) as num, regexp_extract(ref, '^([0-9]+)\\.[0-9]+$', 1) as whole from t),
m as (select highway, ref, case when (highway, ref) in (select (highway, ref) from o) then 'exact' when (highway, ref) in (select (highway, ref) from parts) then 'parts' when num <> '' and (highway, num) in (select (highway, ref) from o) then 'number'
  when whole <> '' and (highway, whole) in (select (highway, ref) from o) then 'decimal' when base is not null and ((base, ref) in (select (highway, ref) from o) or (num <> '' and (base, num) in (select (highway, ref) from o))) then 'suffix'
  when (highway, ref) in (select (highway, ref) from near) then 'near' end as how from p)"""


@query(_MATCH + ";; select highway, ref, how from m")
def coverage_match(spark, sf_dir):
    return evaluate.match(_truth(spark, sf_dir), _own_exits(spark, sf_dir))


@query(_MATCH + ";; select count(*) as n_pairs, count(how) as n_matched, round(100.0::double * count(how) / count(*), 2) as percent from m")
def coverage_score(spark, sf_dir):
    return evaluate.score(coverage_match(spark, sf_dir))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


from . import stage_queries  # noqa: E402, F401  registers its own here
