"""More operators of the build as queries, and the same in SQL: loading, exits on the graph, discovery, conflicts,
fallbacks, places, the relation cache, texts of lines and coverage pairs. `queries` registers them."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadmill.functions import geo
from roadmill.operators import corridors as corridor_ops
from roadmill.operators import evaluate, exits, graph, routes
from roadmill.sources import osm

from . import synthetic as x
from .queries import _LAT, _LON, _cut, _mixed_ways, query
from .synthetic import pick, pick_sql, spot

# ---------------------------------------------------------------- loading

_CLASSES = ["motorway", "motorway_link", "trunk", "primary", "residential"]
_RAW_REFS = [None, "I 95", "US 1; i-10", " ; ", "NC 40", "I 5;I-5;US9"]
_ONEWAY = ["yes", "-1", "no", None]


@query(f"""h as (select way_id, node_ids, {pick_sql("way_id % 5", _CLASSES)} as highway, {pick_sql("way_id % 4", _ONEWAY)} as way, list_sort(list_distinct(list_concat(
  ([[]::varchar[], ['I-95'], ['US-1', 'I-10'], [], ['NC-40'], ['I-5', 'US-9']])[(way_id % 6)::int + 1], case when way_id % 7 = 0 then ['I-80'] else [] end, case when way_id % 3 = 0 then ['I-' || (way_id % 20)] else [] end))) as refs from x_ways)
;; select way_id, highway, array_to_string(refs, ',') as refs, len(node_ids)::int as n_nodes, case when way = '-1' then node_ids[len(node_ids)] else node_ids[1] end as first_node, case when way = 'no' then false when way is not null then true else highway in ('motorway', 'motorway_link') end as oneway
  from h where (highway in ('motorway', 'motorway_link', 'trunk') or way_id % 3 = 0) and (len(refs) = 0 or len(list_filter(refs, lambda r: r like 'I-%')) > 0)""")
def loaded_ways(spark, sf_dir):
    """Refs come from ref, int_ref and, for each third way, a relation."""
    k = F.col("way_id")
    ways = x.ways(spark, sf_dir)
    raw = ways.select("way_id", pick(k % 5, _CLASSES).alias("highway"), pick(k % 6, _RAW_REFS).alias("ref"), F.create_map(F.lit("int_ref"), F.when(k % 7 == 0, "I 80")).alias("tags"), pick(k % 4, _ONEWAY).alias("oneway"), "node_ids", "points")
    told = ways.where(k % 3 == 0).select("way_id", F.array(F.concat(F.lit("I-"), (k % 20).cast("string"))).alias("refs"))
    found = graph.load_ways(raw, told)
    return found.select("way_id", "highway", F.array_join("refs", ",").alias("refs"), F.size("node_ids").alias("n_nodes"), F.element_at("node_ids", 1).alias("first_node"), "oneway")


_LETTERS = ["N", "E", "S", "W", None]


@query(f"""p as (select distinct 'I-' || (l_suppkey % 7) as highway, l_partkey as node, l_linenumber::int as component, {pick_sql("(l_suppkey % 7 + l_linenumber) % 5", _LETTERS)} as direction from lineitem)
;; select 'node/' || c_custkey as exit_id, highway, node as graph_node, direction, component from customer join p on node = c_custkey qualify row_number() over (partition by highway, node order by component desc) = 1""")
def exit_entries(spark, sf_dir):
    """Customers as exits at the nodes of their number; a highway's components are line numbers."""
    rows = x.load(spark, sf_dir, "lineitem")
    highway, component = F.concat(F.lit("I-"), (F.col("l_suppkey") % 7).cast("string")), F.col("l_linenumber").cast("int")
    parts = rows.select(highway.alias("route"), F.col("l_partkey").alias("node"), component.alias("component")).distinct()
    directions = rows.select(highway.alias("highway"), component.alias("component"), pick((F.col("l_suppkey") % 7 + F.col("l_linenumber")) % 5, _LETTERS).alias("direction")).distinct()
    k = F.col("c_custkey")
    return graph.exit_entries(x.load(spark, sf_dir, "customer").select(F.concat(F.lit("node/"), k.cast("string")).alias("exit_id"), k.alias("osm_id")), parts, directions)


CACHE_DIRECTIONS = ["north", "S", "eastbound", ""]


@query(f"""c as (select *, (l_orderkey + l_linenumber) % 8 as kind from lineitem)
;; select l_partkey as way_id, 'I-' || (l_suppkey % 90) as highway, l_suppkey as root_relation_id, l_orderkey as leaf_relation_id,
  case when kind = 5 then null else ({pick_sql("l_linenumber % 4", ["north", "south", "east", None])}) end as direction, case when kind = 3 then '' else 'forward' end as role, (case when kind in (3, 7) then 0 else l_linenumber end)::int as sequence_index from c where kind not in (1, 2, 4, 6)""")
def relation_cache(spark, sf_dir):
    """Cache lines, some of them foreign, broken, short or headers."""
    number = lambda c: F.col(c).cast("string")
    kind = (F.col("l_orderkey") + F.col("l_linenumber")) % 8
    fields = [
        F.when(kind == 2, "x").when(kind == 6, "way_id").otherwise(number("l_partkey")), F.when(kind == 1, "US 1").otherwise(F.concat(F.lit("I "), (F.col("l_suppkey") % 90).cast("string"))), number("l_suppkey"), number("l_orderkey"),
        F.when(kind == 4, None).when(kind == 5, "North Bound").otherwise(pick(F.col("l_linenumber") % 4, CACHE_DIRECTIONS)), F.when(~kind.isin(3, 4), "forward"), F.when(kind == 7, "abc").when(~kind.isin(3, 4), number("l_linenumber")),
    ]
    return osm.parse_relation_cache(x.load(spark, sf_dir, "lineitem").select(F.concat_ws("\t", *fields).alias("value")))


# ---------------------------------------------------------------- places

_AMENITY, _TOURISM = ["fuel", "cafe", "toilets", "bank"], ["motel", "hotel", "museum"]


@query(f"""p as (select *, {pick_sql("p_partkey % 4", ["gas", "food", "restroom", None])} as category, case when p_partkey % 3 <> 0 then p_name end as own, case when p_partkey % 2 = 0 then p_brand end as mark from part)
;; select p_partkey as node_id, category, coalesce(own, mark) as name, coalesce(mark, own) as display_name, mark as brand, {_LAT("p_partkey")} as lat, {_LON("p_partkey")} as lon from p where category is not null""")
def poi_nodes(spark, sf_dir):
    k = F.col("p_partkey")
    tags = F.create_map(F.lit("amenity"), pick(k % 4, _AMENITY), F.lit("name"), F.when(k % 3 != 0, F.col("p_name")), F.lit("brand"), F.when(k % 2 == 0, F.col("p_brand")))
    nodes = x.load(spark, sf_dir, "part").select(k.alias("id"), spot(k, 15485863, 40.0).alias("lat"), spot(k, 32452843, -75.0).alias("lon"), tags.alias("tags"))
    return osm.poi_nodes(nodes).drop("tags")


@query(f"""f as (select way_id, case when way_id % 2 = 0 then list_append(node_ids, node_ids[1]) else node_ids end as ns from x_ways),
v as (select way_id, pos, {_LAT("node")} as lat, {_LON("node")} as lon from (select way_id, unnest(ns) as node, unnest(range(1, len(ns) + 1)) as pos from f)),
m as (select way_id, min(lat) as low, max(lat) as high, (min(lat) + max(lat)) / 2 as mid from v group by 1),
s as (select way_id, any_value(low) < any_value(high) as wide, case when bool_or(lat = mid) then (any_value(mid) + min(lat) filter (lat > mid)) / 2 else any_value(mid) end as y from v join m using (way_id) group by 1),
c as (select a.way_id, y, a.lon + (y - a.lat) / (b.lat - a.lat) * (b.lon - a.lon) as cut from v a join v b on a.way_id = b.way_id and b.pos = a.pos + 1 join s on s.way_id = a.way_id where wide and least(a.lat, b.lat) <= y and greatest(a.lat, b.lat) > y),
o as (select *, (row_number() over (partition by way_id order by cut) - 1) // 2 as piece from c),
w as (select way_id, y, max(cut) - min(cut) as span, (max(cut) + min(cut)) / 2 as lon from o group by way_id, y, piece having count(*) = 2 qualify row_number() over (partition by way_id order by span desc, lon desc) = 1),
g as (select f.way_id, len(ns) >= 4 and ns[1] = ns[len(ns)] and w.way_id is not null as ring, y, w.lon, ns[(len(ns) + 1) // 2] as node from f left join w on w.way_id = f.way_id)
;; select way_id as osm_id, 'lodging' as category, 'W' || way_id as name, round(case when ring then y else {_LAT("node")} end, 7) as lat, round(case when ring then lon else {_LON("node")} end, 7) as lon from g where way_id % 3 <> 2""")
def poi_ways(spark, sf_dir):
    """Each second way is closed to a ring; every third is a museum, which is no place to stop."""
    k, p = F.col("way_id"), F.col("points")
    ring = F.when(k % 2 == 0, F.concat(p, F.slice(p, 1, 1))).otherwise(p)
    tags = F.create_map(F.lit("tourism"), pick(k % 3, _TOURISM), F.lit("name"), F.concat(F.lit("W"), k.cast("string")))
    found = osm.poi_ways(x.ways(spark, sf_dir).select(k.alias("id"), ring.alias("points"), tags.alias("tags")))
    return found.select("osm_id", "category", "name", F.round("lat", 7).alias("lat"), F.round("lon", 7).alias("lon"))


# ---------------------------------------------------------------- discovery

_HOP = "h{n} as (select * from h{p} union select a.corridor_id, s.node from (select distinct h.corridor_id, t.way_id from h{p} h join sp t on t.node = h.node{extra}) a join sp s on s.way_id = a.way_id join box b on b.corridor_id = a.corridor_id where s.lat between y0 and y1 and s.lon between x0 and x1)"
_HOPS = ",\n".join(_HOP.format(n=n, p=n - 1, extra=" join c on c.corridor_id = h.corridor_id where link or ref = highway" if n == 1 else " where link") for n in (1, 2, 3))


@query(f"""w as (select way_id, unnest(node_ids) as node, case when way_id % 5 <> 0 then 'I-' || (way_id % 41) end as ref, way_id % 10 = 0 as link from x_ways),
sp as (select distinct *, {_LAT("node")} as lat, {_LON("node")} as lon from w),
c as (select s_suppkey::int as corridor_id, 'I-' || (s_suppkey % 41) as highway from supplier),
h0 as (select s_suppkey::int as corridor_id, s_suppkey + i as node from supplier, range(3) t(i)),
box as (select corridor_id, min(lat) - 0.02::double as y0, max(lat) + 0.02::double as y1, min(lon) - 0.02::double as x0, max(lon) + 0.02::double as x1 from h0 join sp using (node) group by 1),
{_HOPS};; select corridor_id, node from h3""")
def expanded_nodes(spark, sf_dir):
    """Suppliers' corridors hold the nodes of their number and the next two."""
    k = F.col("s_suppkey")
    suppliers = x.load(spark, sf_dir, "supplier")
    assigned = suppliers.select(k.cast("int").alias("corridor_id"), F.explode(F.array(k, k + 1, k + 2)).alias("node"))
    names = suppliers.select(k.cast("int").alias("corridor_id"), F.concat(F.lit("I-"), (k % 41).cast("string")).alias("highway"))
    return exits.expand_nodes(assigned, _mixed_ways(spark, sf_dir), names, _cut)


@query("""e as (select distinct l_suppkey::int as corridor_id, l_partkey as node from lineitem), n as (select distinct corridor_id from x_corridor_exits)
;; select corridor_id, exit_id, ref from x_corridor_exits union all select e.corridor_id, 'node/' || node, ref from e join n using (corridor_id) join x_pool on node_id = node + 1000000 where (e.corridor_id, node) not in (select (corridor_id, graph_node) from x_corridor_exits)""")
def unlisted_exits(spark, sf_dir):
    listed = x.corridor_exits(spark, sf_dir)
    nodes = x.load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("int").alias("corridor_id"), F.col("l_partkey").alias("node")).distinct()
    pool = x.exit_pool(spark, sf_dir).withColumn("node_id", F.col("node_id") - 1_000_000)
    return exits.unlisted_exits(listed, nodes, pool, listed.select("corridor_id", "highway").distinct()).select("corridor_id", "exit_id", "ref")


@query("""e as (select corridor_id, exit_id, ref, case when graph_node % 5 = 0 then '' when graph_node % 7 = 0 then null else name end as own from x_corridor_exits),
h as (select corridor_id, exit_id, ref, case when ref is null and coalesce(own, '') = '' then coalesce(s_name, own) else own end as name from e left join supplier on exit_id = 'node/' || s_suppkey)
;; select * from h where ref is not null or coalesce(name, '') <> ''""")
def rest_area_names(spark, sf_dir):
    """Suppliers as the nearest rest areas of the exits of their number."""
    n = F.col("graph_node")
    rows = x.corridor_exits(spark, sf_dir).withColumn("name", F.when(n % 5 == 0, "").when(n % 7 == 0, None).otherwise(F.col("name")))
    names = x.load(spark, sf_dir, "supplier").select(F.concat(F.lit("node/"), F.col("s_suppkey").cast("string")).alias("exit_id"), F.col("s_name").alias("rest_area"))
    return exits.inherit_rest_area_names(rows, names).select("corridor_id", "exit_id", "ref", "name")


# ---------------------------------------------------------------- conflicts and fallbacks


@query("""e as (select l_orderkey as k, list(distinct l_partkey) as edges from lineitem group by 1),
d as (select o_orderkey as k, o_custkey % 97 as h, o_orderkey % 5 as root, edges, row_number() over (partition by o_custkey % 97 order by o_orderkey) as n from orders join e on e.k = o_orderkey),
r as (select distinct h, 0::bigint as n, 0::bigint as k, false as gone, []::struct(e bigint, r bigint)[] as held from d
  union all select h, n, k, clash, case when clash then held else list_concat(held, list_transform(edges, lambda i: {'e': i, 'r': root})) end from (
    select d.h, d.n, d.k, d.edges, d.root, r.held, len(list_filter(r.held, lambda o: list_contains(d.edges, o.e) and o.r <> d.root)) > 0 as clash from r join d on d.h = r.h and d.n = r.n + 1))
;; select o_orderkey::int as corridor_id, 'I-' || (o_custkey % 97) as highway, o_orderkey % 5 as root_relation_id from orders where o_orderkey not in (select k from r where gone)""", recursive=True)
def conflict_free_drafts(spark, sf_dir):
    """Orders as drafts that match their parts as edges."""
    k = F.col("o_orderkey")
    drafts = x.load(spark, sf_dir, "orders").select(k.cast("int").alias("corridor_id"), F.concat(F.lit("I-"), (F.col("o_custkey") % 97).cast("string")).alias("highway"), (k % 5).alias("root_relation_id"))
    matched = x.load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("int").alias("corridor_id"), F.concat(F.lit("edge/"), F.col("l_partkey").cast("string")).alias("edge_id")).distinct()
    return corridor_ops.drop_conflicts(drafts, matched)


@query(""";; select 'edge/' || l_orderkey as edge_id, array_to_string(list_sort(list(distinct l_suppkey)), ',') as corridors from lineitem join supplier on s_suppkey = l_suppkey group by l_orderkey having count(distinct s_nationkey) > 1""")
def conflicting_claims(spark, sf_dir):
    drafts = x.load(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("int").alias("corridor_id"), F.col("s_nationkey").alias("root_relation_id"))
    matched = x.load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("int").alias("corridor_id"), F.concat(F.lit("edge/"), F.col("l_orderkey").cast("string")).alias("edge_id")).distinct()
    return corridor_ops.conflicting_claims(drafts, matched).select("edge_id", F.array_join("corridor_ids", ",").alias("corridors"))


@query(f"""e as (select id, 'I-' || (o_custkey % 60) as highway, (o_orderkey % 3)::int as component, coalesce({pick_sql("o_orderkey % 5", ["north", "east", "south", "west", None])}, 'north') as going, alat, alon, blat, blon from x_edges join orders on id = 'edge/' || o_orderkey),
h as (select distinct 'I-' || (s_suppkey % 50) as highway from supplier where s_suppkey % 9 <> 0 and s_suppkey % 50 not in (select n_nationkey from nation)),
k as (select e.*, case when going in ('east', 'west') then least(alon, blon) else least(alat, blat) end * case when going in ('south', 'west') then -1.0::double else 1.0::double end as key from e semi join h using (highway)),
g as (select highway, component, going, count(*) as n, string_agg(id, ',' order by id) as edges, string_agg(round(alat * 1000000)::bigint, ',' order by key, id) as starts from k group by 1, 2, 3)
;; select (row_number() over (order by highway, component, going) + (select max(n_nationkey) from nation))::int as corridor_id, highway, going as canonical_direction, component, n::int as n_ways, edges, starts from g""")
def fallback_corridors(spark, sf_dir):
    """Orders as edges; nations are drafts, and suppliers have exits on highways, some of which are no Interstates."""
    k, s = F.col("o_orderkey"), F.col("s_suppkey")
    edges = x.edges(spark, sf_dir).join(x.load(spark, sf_dir, "orders"), F.col("id") == F.concat(F.lit("edge/"), k.cast("string")))
    edges = edges.select("id", F.concat(F.lit("I-"), (F.col("o_custkey") % 60).cast("string")).alias("highway"), (k % 3).cast("int").alias("component"), pick(k % 5, _LETTERS).alias("direction"), F.array(k).alias("way_ids"), "points")
    entries = x.load(spark, sf_dir, "supplier").select(F.concat(F.when(s % 9 == 0, "US-").otherwise("I-"), (s % 50).cast("string")).alias("highway"))
    drafts = x.load(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("corridor_id"), F.concat(F.lit("I-"), F.col("n_nationkey").cast("string")).alias("highway"))
    found = corridor_ops.fallback_corridors(edges, entries, drafts)
    starts = F.transform("lines", lambda line: F.round(F.element_at(line, 1).lat * 1_000_000).cast("long").cast("string"))
    return found.select("corridor_id", "highway", "canonical_direction", "component", F.size("way_ids").alias("n_ways"), F.array_join("edge_ids", ",").alias("edges"), F.array_join(starts, ",").alias("starts"))


# ---------------------------------------------------------------- texts of lines, coverage


@query(""";; select corridor_id, count(distinct line)::int as n_lines, count(*)::int as n_points, round(min(lat), 9) as min_lat, round(max(lat), 9) as max_lat, round(min(lon), 9) as min_lon, round(max(lon), 9) as max_lon,
  round(arg_min(lat, line * 10 + pos), 9) as first_lat, round(arg_max(lon, line * 10 + pos), 9) as last_lon from x_vertices group by 1""")
def geojson_lines(spark, sf_dir):
    """Corridors' lines written as GeoJSON and read back, with their bounds."""
    rows = x.corridor_lines(spark, sf_dir).select("corridor_id", routes.parse_lines(routes.lines_geojson(F.col("lines"))).alias("lines"))
    points = F.flatten("lines")
    held = rows.select("corridor_id", F.size("lines").alias("n_lines"), F.size(points).alias("n_points"), *geo.bounds(points), F.element_at(points, 1).lat.alias("first_lat"), F.element_at(points, -1).lon.alias("last_lon"))
    return held.withColumns({c: F.round(c, 9) for c in held.columns[3:]})


@query(f""";; select way_id, len(node_ids)::int as n_points, round({_LON("node_ids[1]")}, 9) as first_lon, round({_LAT("node_ids[len(node_ids)]")}, 9) as last_lat from x_ways""")
def line_wkt(spark, sf_dir):
    """Ways written as WKT; the numbers are read from the text."""
    text = x.ways(spark, sf_dir).select("way_id", geo.linestring_wkt(F.col("points")).alias("wkt"))
    number = lambda pattern: F.round(F.regexp_extract("wkt", pattern, 1).cast("double"), 9)
    return text.select("way_id", F.size(F.split("wkt", ", ")).alias("n_points"), number(r"^LINESTRING\(([-0-9.]+) ").alias("first_lon"), number(r" ([-0-9.]+)\)$").alias("last_lat"))


@query(""";; select highway, trim(ref) as ref, round(lat, 9) as lat, round(lon, 9) as lon from x_ordered join x_corridors using (corridor_id) where highway like 'I-%' and ref <> ''""")
def corridor_pairs(spark, sf_dir):
    found = evaluate.corridor_pairs(x.ordered_exits(spark, sf_dir), x.corridors(spark, sf_dir))
    return found.withColumns({c: F.round(c, 9) for c in ("lat", "lon")})
