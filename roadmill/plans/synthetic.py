"""Road-like tables made from the general test tables by fixed formulas, the same in Spark and in SQL.

A point's place is a hash of its key inside one degree square. ROAD_SQL has the same tables as common table
expressions for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MODULUS = 100003


def spot(key: Column, factor: int, base: float) -> Column:
    return F.lit(base) + (key.cast("long") * factor % MODULUS) / F.lit(float(MODULUS))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(index: Column, values: list) -> Column:
    """values[index], which is inside."""
    return F.element_at(F.array(*(F.lit(v) for v in values)), (index + 1).cast("int"))


def exits(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    return load(spark, sf_dir, "customer").select(k.alias("exit_id"), spot(k, 7919, 40.0).alias("lat"), spot(k, 104729, -75.0).alias("lon"))


def places(spark, sf_dir) -> DataFrame:
    k = F.col("p_partkey")
    return load(spark, sf_dir, "part").select(k.alias("poi_id"), F.col("p_type").alias("category"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), spot(k, 15485863, 40.0).alias("plat"), spot(k, 32452843, -75.0).alias("plon"))


def ways(spark, sf_dir) -> DataFrame:
    """way_id, route, node_ids, points, oneway: an order's parts by line number."""
    k = F.col("l_partkey")
    step = F.struct("l_linenumber", k.alias("node"), spot(k, 15485863, 40.0).alias("lat"), spot(k, 32452843, -75.0).alias("lon"))
    steps = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(step)).alias("s")).where(F.size("s") >= 2)
    joined = steps.join(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select(
        F.col("l_orderkey").alias("way_id"), F.concat(F.lit("I-"), (F.col("l_orderkey") % 997).cast("string")).alias("route"),
        F.transform("s", lambda x: x.node).alias("node_ids"), F.transform("s", lambda x: F.struct(x.lat.alias("lat"), x.lon.alias("lon"))).alias("points"), (F.col("o_orderstatus") != "O").alias("oneway"),
    )


PREFIXES = ["I ", "i-", "US ", "NC ", "I-", "ca", "", "US-", "I  - ", "X"]
SUFFIXES = ["", " HOV", " BUS", " Toll", " express", "A", " East", "-"]


def raw_refs(spark, sf_dir) -> DataFrame:
    """part_id, ref: numbers between prefixes and suffixes of many kinds, some blank."""
    k = F.col("p_partkey")
    text = F.concat(pick(k % 10, PREFIXES), F.when(k % 17 == 0, "210").otherwise(F.col("p_size").cast("string")), pick((k / 10).cast("long") % 8, SUFFIXES))
    return load(spark, sf_dir, "part").select(k.alias("part_id"), F.when(k % 101 == 0, "  ").otherwise(text).alias("ref"))


MEMBER_DIRECTIONS = ["north", "south", None, "east"]


def members(spark, sf_dir) -> DataFrame:
    """way_id, highway, root_relation_id, leaf_relation_id, direction, role, sequence_index, from lineitem."""
    way, root = F.col("l_partkey"), F.col("l_suppkey")
    return load(spark, sf_dir, "lineitem").select(
        way.alias("way_id"), F.concat(F.lit("I-"), (root % 7).cast("string")).alias("highway"), root.alias("root_relation_id"), F.col("l_orderkey").alias("leaf_relation_id"),
        pick((root + F.col("l_linenumber")) % 4, MEMBER_DIRECTIONS).alias("direction"), F.lit("").alias("role"), F.col("l_linenumber").alias("sequence_index"),
    )


EXIT_REFS = ["{n}", "{n}A", "{n}B", "{n}A;{n}B", "{n}A-C", "{n}A,B", "{n}; {m}", "{n}C", None, "{m},{n}D", "{n}D-B", " {n}A ; "]


def corridor_exits(spark, sf_dir) -> DataFrame:
    """corridor_id, exit_id, highway, graph_node, ref, name, lat, lon, from customers, fifty to a corridor."""
    k = F.col("c_custkey")
    n, m = (k % 13 + 1).cast("string"), (k % 11 + 20).cast("string")
    forms = [None if f is None else F.replace(F.replace(F.lit(f), F.lit("{n}"), n), F.lit("{m}"), m) for f in EXIT_REFS]
    ref = F.element_at(F.array(*(F.lit(None).cast("string") if f is None else f for f in forms)), (k % 12 + 1).cast("int"))
    corridor = (k / 50).cast("int")
    return load(spark, sf_dir, "customer").select(
        corridor.alias("corridor_id"), F.concat(F.lit("node/"), k.cast("string")).alias("exit_id"), F.concat(F.lit("I-"), (corridor % 40).cast("string")).alias("highway"),
        (k / 2).cast("long").alias("graph_node"), ref.alias("ref"), F.col("c_name").alias("name"), spot(k, 7919, 40.0).alias("lat"), spot(k, 104729, -75.0).alias("lon"),
    )


def exit_pool(spark, sf_dir) -> DataFrame:
    """node_id, ref, name, lat, lon of all exits, from parts."""
    k = F.col("p_partkey")
    letter = pick(k % 4, ["", "A", "B", "E"])
    return load(spark, sf_dir, "part").select((k + 1_000_000).alias("node_id"), F.concat((k % 13 + 1).cast("string"), letter).alias("ref"), F.col("p_name").alias("name"), spot(k, 15485863, 40.0).alias("lat"), spot(k, 32452843, -75.0).alias("lon"))


def corridor_lines(spark, sf_dir) -> DataFrame:
    """corridor_id, highway, lines: two lines of six points each, a point every 0.01 degrees north, from suppliers."""
    k = F.col("s_suppkey")
    lat, lon = spot(k, 15485863, 40.0), spot(k, 32452843, -75.0)
    line = lambda away: F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.struct((lat + away + i * F.lit(0.01)).alias("lat"), (lon + away + i * F.lit(0.002)).alias("lon")))
    return load(spark, sf_dir, "supplier").select(k.cast("int").alias("corridor_id"), F.concat(F.lit("I-"), (k % 40).cast("string")).alias("highway"), F.array(line(0.0), line(0.08)).alias("lines"))


CORRIDOR_DIRECTIONS = ["north", "south", "east", "west"]


def corridors(spark, sf_dir) -> DataFrame:
    """corridor_id, highway, canonical_direction, root_relation_id, geometry_json, from suppliers; some are no Interstates."""
    k = F.col("s_suppkey")
    highway = F.when(k % 9 == 0, F.concat(F.lit("US-"), (k % 40).cast("string"))).when(k % 11 == 0, "I-35E").otherwise(F.concat(F.lit("I-"), (k % 40).cast("string")))
    return load(spark, sf_dir, "supplier").select(k.cast("int").alias("corridor_id"), highway.alias("highway"), pick(F.col("s_nationkey") % 4, CORRIDOR_DIRECTIONS).alias("canonical_direction"), F.lit(0).cast("long").alias("root_relation_id"), F.concat(F.lit("g"), k.cast("string")).alias("geometry_json"))


def edges(spark, sf_dir) -> DataFrame:
    """id, highway, corridor_id (null for a seventh), length_m, points, from orders."""
    k = F.col("o_orderkey")
    return load(spark, sf_dir, "orders").select(
        F.concat(F.lit("edge/"), k.cast("string")).alias("id"), F.lit("I-0").alias("highway"), F.when(k % 7 != 0, (k % 120).cast("int")).alias("corridor_id"), F.round("o_totalprice").cast("int").alias("length_m"),
        F.array(F.struct(spot(k, 7919, 40.0).alias("lat"), spot(k, 104729, -75.0).alias("lon")), F.struct(spot(k + 1, 7919, 40.0).alias("lat"), spot(k + 1, 104729, -75.0).alias("lon"))).alias("points"),
    )


def ordered_exits(spark, sf_dir) -> DataFrame:
    """corridor_id, exit_id, corridor_index, ref, name, lat, lon: the corridors' exits as written."""
    k = F.col("c_custkey")
    return load(spark, sf_dir, "customer").select((k % 130).cast("int").alias("corridor_id"), F.concat(F.lit("node/"), k.cast("string")).alias("exit_id"), (k / 130).cast("int").alias("corridor_index"), (k % 99).cast("string").alias("ref"), F.col("c_name").alias("name"), spot(k, 7919, 40.0).alias("lat"), spot(k, 104729, -75.0).alias("lon"))


# ---------------------------------------------------------------- the same in SQL


def spot_sql(key: str, factor: int, base: float) -> str:
    return f"({base}::double + ({key})::bigint * {factor} % {MODULUS} / {MODULUS}.0::double)"


def pick_sql(index: str, values: list) -> str:
    return "([" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + f"])[({index})::int + 1]"


def _corridor_exits_sql() -> str:
    forms = ", ".join("NULL" if f is None else "replace(replace('" + f + "', '{n}', (c_custkey % 13 + 1)::varchar), '{m}', (c_custkey % 11 + 20)::varchar)" for f in EXIT_REFS)
    return f"""select c_custkey // 50 as corridor_id, 'node/' || c_custkey as exit_id, 'I-' || (c_custkey // 50 % 40) as highway, c_custkey // 2 as graph_node,
    ([{forms}])[(c_custkey % 12)::int + 1] as ref, c_name as name, {spot_sql("c_custkey", 7919, 40.0)} as lat, {spot_sql("c_custkey", 104729, -75.0)} as lon from customer"""


ROAD_SQL = {
    "x_exits": f"select c_custkey as exit_id, {spot_sql('c_custkey', 7919, 40.0)} as lat, {spot_sql('c_custkey', 104729, -75.0)} as lon from customer",
    "x_places": f"select p_partkey as poi_id, p_type as category, p_name as name, p_brand as brand, p_size as size, {spot_sql('p_partkey', 15485863, 40.0)} as plat, {spot_sql('p_partkey', 32452843, -75.0)} as plon from part",
    "x_ways": "select l_orderkey as way_id, 'I-' || (l_orderkey % 997) as route, o_orderstatus <> 'O' as oneway, list(l_partkey order by l_linenumber, l_partkey) as node_ids from lineitem join orders on o_orderkey = l_orderkey group by all having count(*) >= 2",
    "x_steps0": "select way_id, route, oneway, node_ids, unnest(range(1, len(node_ids))) as step from x_ways",
    "x_steps": "select way_id, route, oneway, step, node_ids[step] as src, node_ids[step + 1] as dst from x_steps0",
    "x_arcs": "select way_id, route, src, dst from x_steps union all select way_id, route, dst, src from x_steps where not oneway",
    "x_refs": f"select p_partkey as part_id, case when p_partkey % 101 = 0 then '  ' else {pick_sql('p_partkey % 10', PREFIXES)} || case when p_partkey % 17 = 0 then '210' else p_size::varchar end || {pick_sql('p_partkey // 10 % 8', SUFFIXES)} end as ref from part",
    "x_members": f"select l_partkey as way_id, 'I-' || (l_suppkey % 7) as highway, l_suppkey as root_relation_id, l_orderkey as leaf_relation_id, {pick_sql('(l_suppkey + l_linenumber) % 4', MEMBER_DIRECTIONS)} as direction, '' as role, l_linenumber as sequence_index from lineitem",
    "x_corridor_exits": _corridor_exits_sql(),
    "x_pool": f"select p_partkey + 1000000 as node_id, (p_partkey % 13 + 1) || {pick_sql('p_partkey % 4', ['', 'A', 'B', 'E'])} as ref, p_name as name, {spot_sql('p_partkey', 15485863, 40.0)} as lat, {spot_sql('p_partkey', 32452843, -75.0)} as lon from part",
    "x_vertices": f"select s_suppkey::int as corridor_id, 'I-' || (s_suppkey % 40) as highway, line, pos, {spot_sql('s_suppkey', 15485863, 40.0)} + line * 0.08::double + pos * 0.01::double as lat, {spot_sql('s_suppkey', 32452843, -75.0)} + line * 0.08::double + pos * 0.002::double as lon from supplier, range(2) a(line), range(6) b(pos)",
    "x_corridors": f"select s_suppkey::int as corridor_id, case when s_suppkey % 9 = 0 then 'US-' || (s_suppkey % 40) when s_suppkey % 11 = 0 then 'I-35E' else 'I-' || (s_suppkey % 40) end as highway, {pick_sql('s_nationkey % 4', CORRIDOR_DIRECTIONS)} as canonical_direction, 'g' || s_suppkey as geometry_json from supplier",
    "x_edges": f"select 'edge/' || o_orderkey as id, case when o_orderkey % 7 <> 0 then (o_orderkey % 120)::int end as corridor_id, round(o_totalprice)::int as length_m, {spot_sql('o_orderkey', 7919, 40.0)} as alat, {spot_sql('o_orderkey', 104729, -75.0)} as alon, {spot_sql('o_orderkey + 1', 7919, 40.0)} as blat, {spot_sql('o_orderkey + 1', 104729, -75.0)} as blon from orders",
    "x_ordered": f"select (c_custkey % 130)::int as corridor_id, 'node/' || c_custkey as exit_id, (c_custkey // 130)::int as corridor_index, (c_custkey % 99)::varchar as ref, c_name as name, {spot_sql('c_custkey', 7919, 40.0)} as lat, {spot_sql('c_custkey', 104729, -75.0)} as lon from customer",
}


def with_tables(sql: str, recursive: bool = False) -> str:
    """sql, which may begin with its own list of tables after `;`, behind the road tables that it names."""
    own, _, body = sql.rpartition(";;")
    names: list[str] = []

    def need(text: str) -> None:
        for name, query in ROAD_SQL.items():
            if name in text and name not in names and any(f"{name}{c}" in text + " " for c in " )\n,.;"):
                need(query)
                if name not in names:
                    names.append(name)

    need(sql)
    tables = [f"{n} as ({ROAD_SQL[n]})" for n in names] + ([own.strip().rstrip(",")] if own.strip() else [])
    return (f"with {'recursive ' if recursive else ''}" + ",\n".join(tables) + "\n" if tables else "") + body
