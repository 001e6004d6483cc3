"""Sources, evaluation, export, release files, build, increments, and the driver's entry points."""

import dataclasses
import json
import shutil
import time
import zipfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from roadmill.operators import evaluate, export
from roadmill.plans import build as build_plan
from roadmill.sources import osm, release
from roadmill.streaming.increments import apply_increments

# ---------------------------------------------------------------- sources

PLACES = [
    ({"amenity": "fuel", "cuisine": "x"}, "gas"), ({"shop": "gas"}, "gas"), ({"tourism": "guest_house"}, "lodging"), ({"amenity": "cafe"}, "food"), ({"cuisine": "", "highway": "rest_area"}, "food"), ({"highway": "services"}, "restArea"),
    ({"amenity": "toilets"}, "restroom"), ({"amenity": "charging_station"}, "evCharging"), ({"leisure": "dog_park"}, "dogPark"), ({"leisure": "park", "name": "City PARK"}, "park"), ({"leisure": "park"}, None), ({}, None),
]
CLASSES = [
    ({"highway": "trunk"}, "trunk"), ({"highway": "construction", "construction": "motorway_link"}, "motorway_link"), ({"highway": "construction", "ref": "US 1; I 95"}, "motorway"), ({"highway": "construction", "ref": "", "int_ref": "i-5a"}, "motorway"),
    ({"highway": "construction", "ref": "US 1", "int_ref": "I 5"}, None), ({"highway": "primary", "ref": "I 5"}, None), ({}, None),
]


def test_classifiers(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(PLACES + CLASSES)], "k int, tags map<string,string>").select("k", osm.poi_category(F.col("tags")).alias("p"), osm.highway_class(F.col("tags")).alias("h"))
    got = {r.k: (r.p, r.h) for r in df.collect()}
    assert [got[k][0] for k in range(len(PLACES))] == [c for _, c in PLACES]
    assert [got[len(PLACES) + k][1] for k in range(len(CLASSES))] == [c for _, c in CLASSES]


def test_surface_points(spark):
    square = [(0.0, 0.0), (0.0, 4.0), (2.0, 4.0), (2.0, 0.0), (0.0, 0.0)]
    horseshoe = [(0.0, 0.0), (0.0, 9.0), (4.0, 9.0), (4.0, 6.0), (1.0, 6.0), (1.0, 2.0), (4.0, 2.0), (4.0, 0.0), (0.0, 0.0)]
    line = [(0.0, 0.0), (1.0, 5.0), (2.0, 0.0)]
    df = spark.createDataFrame([(square,), (horseshoe,), (line,)], "points array<struct<lat:double,lon:double>>")
    got = [(r.p.lat, r.p.lon) for r in df.select(osm.surface_point(F.col("points")).alias("p")).collect()]
    assert got == [(1.0, 2.0), (2.0, 7.5), (1.0, 5.0)]


def test_ways_without_all_places_go(spark):
    nodes = spark.createDataFrame([(1, 1.0, 2.0, {}), (2, 3.0, 4.0, {})], osm.NODES)
    ways = spark.createDataFrame([(10, [2, 1, 2], {"highway": "motorway"}), (11, [1, 3], {}), (12, [1], {})], osm.WAYS)
    got = osm.highways(osm.way_points(ways, nodes)).collect()
    assert [(r.way_id, [tuple(p) for p in r.points]) for r in got] == [(10, [(3.0, 4.0), (1.0, 2.0), (3.0, 4.0)])]


# ---------------------------------------------------------------- evaluation


def test_the_match_cascade(spark, tmp_path):
    own = spark.createDataFrame([("I-1", "19A", 0.0, 0.0), ("I-1", "19B", 0.0, 0.0), ("I-1", "121", 0.0, 0.0), ("I-1", "58", 0.0, 0.0), ("I-35", "25A", 0.0, 0.0), ("I-1", "7", 40.0, -75.0), ("I-1", "5A", 9.0, 9.0)], "highway string, ref string, lat double, lon double")
    truth = spark.createDataFrame(
        [("I-1", "19A", None, None), ("I-1", "19A,B", None, None), ("I-1", "19A,88", None, None), ("I-1", "121A", None, None), ("I-1", "58.5", None, None), ("I-35W", "25A", None, None), ("I-1", "99", 40.003, -75.0), ("I-1", "98", 40.006, -75.0), ("I-1", "5", None, None)],
        "highway string, ref string, lat double, lon double",
    )
    found = evaluate.match(truth, own)
    got = {r.ref: r.how for r in found.where("highway = 'I-1'").collect()}
    assert got == {"19A": "exact", "19A,B": "parts", "19A,88": None, "121A": "number", "58.5": "decimal", "99": "near", "98": None, "5": "exact"}
    assert found.where("highway = 'I-35W'").first().how == "suffix"
    assert tuple(evaluate.score(found).first()) == (9, 7, 77.78)
    before = spark.createDataFrame([("I-1", "19A"), ("I-1", "98")], "highway string, ref string")
    assert [tuple(r) for r in evaluate.regressions(before, found).collect()] == [("I-1", "98")]
    assert evaluate.load_baseline(spark, tmp_path / "b.json").count() == 0
    assert evaluate.save_baseline(found, tmp_path / "b.json") == 7
    assert evaluate.regressions(evaluate.load_baseline(spark, tmp_path / "b.json"), found).count() == 0
    assert evaluate.gates(262, 0) == {"corridors": True, "regressions": True} and not evaluate.gates(261, 1)["corridors"]


def test_ground_truth_joins(spark):
    exits = spark.createDataFrame([(1, " 5A ", 1.0, 2.0), (2, "Rest Area", 1.0, 2.0), (3, "", 1.0, 2.0), (4, "9", 1.0, 2.0)], "exit_id long, sign_number string, exit_latitude double, exit_longitude double")
    request = spark.createDataFrame([(1, "k"), (2, "k"), (3, "k"), (4, "j"), (1, "k")], "exit_id long, cache_key string")
    requests = spark.createDataFrame([("k", 7), ("j", 8)], "cache_key string, highway_in_state_id long")
    states = spark.createDataFrame([(7, 70), (8, 80)], "highway_in_state_id long, highway_id long")
    highways = spark.createDataFrame([(70, "I-95", "Interstate"), (80, "US-1", "US")], "highway_id long, display_name string, highway_type string")
    assert [tuple(r) for r in evaluate.ground_truth(exits, request, requests, states, highways).collect()] == [("I-95", "5A", 1.0, 2.0)]


# ---------------------------------------------------------------- release


def tables(spark):
    corridors = spark.createDataFrame([(2, "I-95", "north", "{}"), (1, "US-1", "south", "{}"), (3, "I-5", "south", "{}")], "corridor_id int, highway string, canonical_direction string, geometry_json string")
    edges = spark.createDataFrame([("e1", "I-95", "S", 2, 5, [(1.0, 2.0), (1.5, 2.5)]), ("e2", "I-95", "S", None, 5, [])], "id string, highway string, direction string, corridor_id int, length_m int, points array<struct<lat:double,lon:double>>")
    exits = spark.createDataFrame([(2, "node/1", 1, "5", "x, y", 1.0, 2.0), (2, "node/2", 0, None, None, 1.0, 2.123456789012), (3, "node/1", 0, "5", "x", 1.0, 2.0), (1, "node/9", 0, "5", "x", 1.0, 2.0)], "corridor_id int, exit_id string, corridor_index int, ref string, name string, lat double, lon double")
    links = spark.createDataFrame([("node/1", "node/7", "gas", 10, 1), ("node/9", "node/8", "gas", 10, 1)], "exit_id string, poi_id string, category string, distance_m int, rank int")
    pois = spark.createDataFrame([("node/7", "gas", "G", "G", None, 1.0, 2.0), ("node/8", "gas", "H", "H", None, 1.0, 2.0)], "id string, category string, name string, display_name string, brand string, lat double, lon double")
    routes = spark.createDataFrame([("u1", "I-95", "NB", "Northbound", "I-95 Northbound", 1.5, 10.0, 2, [[(1.0, 2.0), (1.05, 2.0), (9.0, 9.0)]])], "id string, highway string, direction_code string, direction_label string, display_name string, distance_m double, duration_s double, point_count int, lines array<array<struct<lat:double,lon:double>>>")
    return {
        "corridors": export.corridors(corridors, edges), "corridor_edges": export.corridor_edges(corridors, edges), "corridor_exits": export.corridor_exits(corridors, exits), "exit_aliases": export.exit_aliases(spark),
        "places": export.places(corridors, exits, links, pois), "exit_place_links": export.exit_place_links(corridors, exits, links), "reference_routes": export.reference_routes(routes),
    }, (corridors, exits, links)


def test_export_tables(spark):
    found, (corridors, exits, links) = tables(spark)
    assert [tuple(r) for r in found["corridors"].collect()] == [(3, "I-5", "south", "South", "{}", 0), (2, "I-95", "north", "North", "{}", 1)]
    assert [r.direction_code for r in found["corridor_edges"].collect()] == ["north"], "the corridor's direction, not the edge's"
    assert found["corridor_edges"].first().geometry_geojson == '{"type":"LineString","coordinates":[[2.0,1.0],[2.5,1.5]]}'
    assert [(r.exit_id, r.sequence_index) for r in found["corridor_exits"].collect()] == [("node/1", 0), ("node/2", 0), ("node/1", 1)]
    assert [r.place_id for r in found["places"].collect()] == ["node/7"]
    assert found["exit_place_links"].count() == 2 and export.exit_place_links(corridors, exits, links, dedupe=True).count() == 1
    assert json.loads(found["reference_routes"].first().geometry_geojson)["type"] == "MultiLineString"
    assert [tuple(r) for r in export.exits_per_corridor(found["corridor_exits"]).collect()] == [(2, 2), (3, 1)]
    assert [r.corridor_id for r in export.corridors_of(found["corridors"], "I-95").collect()] == [2]


def test_release_files(spark, tmp_path):
    found, _ = tables(spark)
    to = tmp_path / "release-1"
    manifest = release.write_release(found, to, "1")
    assert manifest["table_row_counts"]["corridors"] == 2 and len(manifest["files"]) == 9
    assert (to / "corridor_exits.csv").read_bytes().count(b"\r\n") == 4
    assert '"x, y"' in (to / "corridor_exits.csv").read_text()
    assert release.verify_checksums(to) == []
    (to / "places.csv").write_text("changed")
    assert release.verify_checksums(to) == ["places.csv"]
    with zipfile.ZipFile(to / "reference_routes_gpx.zip") as z:
        text = z.read("u1.gpx").decode()
    assert text.count("<trkseg>") == 2 and "<name>u1-1-1</name>" in text
    assert len(json.loads((to / "reference_routes_sample.geojson").read_text())["features"]) == 1
    back = release.read_csv(spark, str(to / "corridors.csv"), "corridor_id int, interstate_name string, direction_code string, direction_label string, geometry_geojson string, edge_count long")
    assert back.collect() == found["corridors"].collect()
    (to / ".DS_Store").write_text("x")
    import tarfile

    with tarfile.open(release.package(to, tmp_path / "r.tar.gz")) as tar:
        assert "release-1/manifest.json" in tar.getnames() and "release-1/.DS_Store" not in tar.getnames()


def test_source_metadata_is_cached_and_checked(tmp_path):
    file, cache = tmp_path / "a.pbf", tmp_path / "cache"
    file.write_bytes(b"abc")
    told = release.source_metadata(file, cache)
    assert told["sha256"].startswith("ba7816bf") and release.source_metadata(file, cache) == told
    next(cache.iterdir()).write_text("[]")
    with pytest.raises(ValueError):
        release.source_metadata(file, cache)
    got = []
    assert release.copy_stream([b"a", b"bc"], got.append)[0] == 3 and got == [b"a", b"bc"]


# ---------------------------------------------------------------- build


def write_entities(spark, top):
    """A motorway of 60 km with two exits, a gas station and a rest area, and the other carriageway."""
    n = 121
    nodes, ways = [], []
    for side, base in ((0, 1000), (1, 5000)):
        for i in range(n):
            tags = {"highway": "motorway_junction", "ref": str(i)} if i in (20, 80) and side == 0 else {}
            nodes.append((base + i, 40.0 + i * 0.005, -75.0 + side * 0.001, tags))
        ids = [base + i for i in range(n)]
        ids = ids if side == 0 else ids[::-1]
        ways += [(base * 10 + k, ids[k * 30 : k * 30 + 31], {"highway": "motorway", "ref": "I 95", "oneway": "yes"}) for k in range(4)]
    nodes += [(9001, 40.1005, -75.0, {"amenity": "fuel", "name": "Fuel"}), (9002, 40.4002, -75.0, {"highway": "rest_area"}), (9003, 40.1003, -75.0, {"amenity": "toilets"})]
    north = [("w", 10000 + k, "") for k in range(4)]
    south = [("w", 50000 + k, "") for k in range(4)]
    rows = [(1, "I-95", None, "I 95", None, [("r", 2, ""), ("r", 3, "")]), (2, "I-95", "north", None, None, north), (3, "I-95", "south", None, None, south)]
    spark.createDataFrame(nodes, osm.NODES).write.parquet(f"{top}/nodes")
    spark.createDataFrame(ways, osm.WAYS).write.parquet(f"{top}/ways")
    spark.createDataFrame(rows, "relation_id long, ref string, direction string, name string, description string, members array<struct<type:string,id:long,role:string>>").write.parquet(f"{top}/relations")


def test_build_end_to_end(spark, tmp_path):
    top = str(tmp_path)
    write_entities(spark, top)
    config = build_plan.Config.of(nodes=f"{top}/nodes", ways=f"{top}/ways", relations=f"{top}/relations", workspace=f"{top}/w", version="t")
    found = build_plan.build(spark, config)
    assert [(r.interstate_name, r.direction_code) for r in found["corridors"].collect()] == [("I-95", "north"), ("I-95", "south")]
    north = found["corridor_exits"].where("direction_code = 'north'").collect()
    assert [(r.exit_id, r.exit_number, r.sequence_index) for r in north] == [("node/1020", "20", 0), ("node/1080", "80", 1)]
    assert sorted({(r.exit_id, r.place_id, r.category) for r in found["exit_place_links"].collect()}) == [("node/1020", "node/9001", "gas"), ("node/1080", "node/9002", "restArea")]
    assert sorted(r.display_name for r in found["places"].collect()) == ["Fuel", "Rest Area"]
    routes_ = found["reference_routes"].collect()
    assert [r.direction_code for r in routes_] == ["NB", "SB"] and all(r.distance_m > 50_000 for r in routes_)
    assert found["corridor_edges"].count() == 4
    release.write_release(found, tmp_path / "release", "t")
    before = sorted(p.name for p in (tmp_path / "w/stages").iterdir())
    build_plan.build(spark, dataclasses.replace(config, version="u"))
    assert sorted(p.name for p in (tmp_path / "w/stages").iterdir()) == before, "nothing runs again, whatever the version"
    told = build_plan.sources(spark, config)
    assert {t["kind"] for t in told} == {"nodes", "ways", "relations"} and all(len(t["sha256"]) == 64 for t in told)
    # an input that changes in place is read again, and ids of components stay
    kept = next(p for p in (tmp_path / "w/stages").iterdir() if p.name.startswith("components-"))
    time.sleep(1.1)
    old = spark.read.parquet(f"{top}/nodes").collect()
    spark.createDataFrame([*old, (9009, 40.1004, -75.0, {"amenity": "fuel", "name": "New"})], osm.NODES).write.mode("overwrite").parquet(f"{top}/nodes")
    again = build_plan.build(spark, dataclasses.replace(config, previous=str(kept)))
    assert sorted(r.display_name for r in again["places"].collect()) == ["Fuel", "New", "Rest Area"]


def test_ways_that_no_rule_wants_are_never_placed(spark, tmp_path):
    ways = spark.createDataFrame([(1, [1, 2], {"highway": "motorway"}), (2, [1, 2], {"highway": "residential"}), (3, [1, 2], {"building": "yes"}), (4, [1, 2], {"amenity": "fuel"}), (5, [1, 2], {"highway": "construction", "construction": "motorway"})], osm.WAYS)
    assert sorted(r.id for r in osm.prefilter(ways, osm.WAY_FILTER).collect()) == [1, 4, 5]


def test_relations_come_as_parquet_lines_or_cache(spark, tmp_path):
    (tmp_path / "r.opl").write_text("r1 v1 dV c1 t i0 u Tnetwork=US:I,route=road,ref=95,direction=north Mw7@forward,w8@\nr2 v1 Tnetwork=US:US,route=road,ref=1 Mw9@\n")
    found = build_plan.relation_cache(spark, str(tmp_path / "r.opl")).collect()
    assert sorted((r.way_id, r.highway) for r in found) == [(7, "I-95"), (8, "I-95")]
    (tmp_path / "c.tsv").write_text("way_id\thighway\troot_relation_id\tleaf_relation_id\tdirection\trole\tsequence_index\n7\tI-95\t1\t1\tnorth\t\t3\n")
    assert [(r.way_id, r.sequence_index) for r in build_plan.relation_cache(spark, str(tmp_path / "c.tsv")).collect()] == [(7, 3)]


def test_component_ids_stay_over_builds(spark):
    rows = lambda *r: spark.createDataFrame([("I-1", n, c) for c, nodes in r for n in nodes], "route string, node long, component int")
    old = rows((0, [1, 2]), (1, [10, 11]), (4, [20, 21]))
    fresh = rows((0, [0, 5]), (1, [2, 3]), (2, [11, 20]), (3, [90, 91]))
    got = {r.node: r.component for r in build_plan.stable_components(fresh, old).collect()}
    # nodes 0 and 90 are new, 2 was in 0, and 11 and 20 bring 1 and 4 together
    assert got == {0: 5, 5: 5, 2: 0, 3: 0, 11: 1, 20: 1, 90: 6, 91: 6}


def test_a_ground_truth_is_read_from_its_file(spark, tmp_path):
    import sqlite3

    from roadmill.operators import evaluate

    db = sqlite3.connect(tmp_path / "t.db")
    for name, columns in evaluate.TRUTH.items():
        db.execute(f"create table {name} ({columns})")
    db.execute("insert into exits values (1, ' 12A ', 40.0, -75.0), (2, '', 1, 1), (3, '7', null, null)")
    db.execute("insert into request_exits values (1, 'k'), (2, 'k'), (3, 'k')")
    db.execute("insert into exits_requests values ('k', 5)")
    db.execute("insert into highway_in_states values (5, 6)")
    db.execute("insert into highways values (6, 'I-95', 'Interstate')")
    db.commit()
    assert sorted(tuple(r) for r in evaluate.read_ground_truth(spark, str(tmp_path / "t.db")).collect()) == [("I-95", "12A", 40.0, -75.0), ("I-95", "7", None, None)]


def test_a_store_needs_a_release_folder():
    assert build_plan.local_folder("file:///a/b") == "/a/b"
    with pytest.raises(ValueError):
        build_plan.local_folder("hdfs://x/y")


def test_settings_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("ROADMILL_VERSION", "9")
    monkeypatch.setenv("ROADMILL_NODES", "env")
    config = build_plan.Config.of(nodes="n", ways="w", relations="r", workspace="x", parity_fresh_db="yes")
    assert (config.nodes, config.version, config.parity_fresh_db) == ("n", "9", True)


def test_increments_keep_the_latest_rows(spark, tmp_path):
    schema = "id long, seq int, v string"
    for k, rows in enumerate([[(1, 1, "a"), (2, 1, "b")], [(1, 2, "c"), (3, 1, "d")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        writer = apply_increments(stream, str(tmp_path / "table"), ["id"], ["seq"], str(tmp_path / "ck"))
        run = writer.trigger(availableNow=True).start()
        run.awaitTermination(60)
        assert run.exception() is None
        got = sorted(map(tuple, spark.read.parquet(str(tmp_path / f"table/v{k}")).collect()))
    assert got == [(1, 2, "c"), (2, 1, "b"), (3, 1, "d")]
    # a version that is gone ends the stream, as its rows would be lost
    shutil.rmtree(tmp_path / "table/v1")
    spark.createDataFrame([(9, 1, "z")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run = apply_increments(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "table"), ["id"], ["seq"], str(tmp_path / "ck")).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="is gone"):
        run.awaitTermination(60)


# ---------------------------------------------------------------- entry points


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def compare(spark, db, name, sf_dir):
    from tools.compare import canonical

    df = entry.queries()[name](spark, sf_dir)
    found = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, found.fetchall())


@pytest.fixture(scope="module")
def db(sf_dir):
    import duckdb

    from tools.compare import TABLES

    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, db, sf_dir, name):
    compare(spark, db, name, sf_dir)


@pytest.mark.parametrize("name", sorted(n for n in set(entry.queries()) - set(entry.oracle_sql()) if not n.startswith(("op", "pipeline"))))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert entry.queries()[name](spark, sf_dir).count() > 0
