"""The build: entities to a release, stage by stage, each stage's output kept under the digest of its inputs.

python -m roadmill.plans.build build --nodes N --ways W --relations R --workspace DIR --version V
python -m roadmill.plans.build graph|corridors|routes ...   the stages up to there
python -m roadmill.plans.build evaluate --truth DB ...      the build, held against a ground truth

Relations are Parquet of parsed rows, text lines (.opl or .txt) or a relation cache (.tsv).
"""

from __future__ import annotations

import argparse
import hashlib
import json
import os
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadmill.functions import refs
from roadmill.operators import corridors, evaluate, export, graph, projection, relations, routes
from roadmill.sources import osm, release


@dataclass(frozen=True)
class Config:
    """Settings; an environment variable ROADMILL_<NAME> is used where nothing is given."""

    nodes: str
    ways: str
    relations: str
    workspace: str
    version: str = "dev"
    release_dir: str = ""  # a folder of the driver's; by default the workspace, which then has to be one
    previous: str = ""  # the components table of an earlier build, whose ids are kept
    truth: str = ""
    parity_fresh_db: bool = False  # leave out the directional prune, as a build on a fresh database does
    dedupe_links: bool = False

    @classmethod
    def of(cls, **given) -> Config:
        names = {f: given.get(f) for f in cls.__dataclass_fields__}
        told = {f: v if v is not None else os.environ.get(f"ROADMILL_{f.upper()}") for f, v in names.items()}
        for f in ("parity_fresh_db", "dedupe_links"):
            told[f] = str(told[f]).lower() in ("1", "true", "yes")
        return cls(**{f: v for f, v in told.items() if v is not None})


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, milliseconds of the last change) of a file or of all files of a folder, in any store."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(at, True)
    found = []
    while files.hasNext():
        f = files.next()
        if not f.getPath().getName().startswith(("_", ".")):
            found.append((f.getPath().toString(), int(f.getLen()), int(f.getModificationTime())))
    return sorted(found)


class Stages:
    """Stage outputs as Parquet under workspace/stages. A stage runs again if its signature, of settings, of the files
    that it reads (their names, sizes and times) and of the stages that it names, has changed; the state is replaced as
    a whole."""

    def __init__(self, spark: SparkSession, workspace: str, settings: dict):
        self.spark, self.top, self.settings = spark, workspace.rstrip("/"), settings
        self.signatures: dict[str, str] = {}
        self.ran: list[str] = []

    def __call__(self, name: str, make: Callable[[], DataFrame], after: tuple[str, ...] = (), reads: tuple[str, ...] = ()) -> DataFrame:
        files = [listing(self.spark, path) for path in reads]
        text = json.dumps([name, self.settings, files, [self.signatures[a] for a in after]], sort_keys=True)
        self.signatures[name] = signature = hashlib.sha256(text.encode()).hexdigest()[:16]
        path = f"{self.top}/stages/{name}-{signature}"
        fs_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not fs_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(fs_path):
            make().write.mode("overwrite").parquet(path)
            self.ran.append(name)
        return self.spark.read.parquet(path)


def relation_cache(spark: SparkSession, path: str) -> DataFrame:
    name = path.rstrip("/").lower()
    if name.endswith(".tsv"):
        return osm.read_relation_cache(spark, path)
    return relations.flatten_relations(osm.read_relation_lines(spark, path) if name.endswith((".opl", ".txt")) else spark.read.parquet(path))


def stable_components(parts: DataFrame, previous: DataFrame) -> DataFrame:
    """parts(route, node, component) with the ids of previous(route, node, component) where components share nodes. What
    is gathered for a route is its components and where they meet earlier ones, not their nodes."""
    least = parts.groupBy("route", "component").agg(F.min("node").alias("node")).withColumn("old", F.lit(None).cast("int"))
    met = parts.join(previous.select("route", "node", F.col("component").alias("old")), ["route", "node"]).groupBy("route", "component", "old").agg(F.min("node").alias("node"))
    most = previous.groupBy("route").agg(F.max("component").alias("most"))

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        fresh: dict[int, set[int]] = {}
        old: dict[int, set[int]] = {}
        for r in rows.itertuples():
            fresh.setdefault(int(r.component), set()).add(int(r.node))
            if not pd.isna(r.old):
                old.setdefault(int(r.node), set()).add(int(r.old))
        ids, _ = graph.stable_component_ids(fresh, old, -1 if pd.isna(rows["most"].iloc[0]) else int(rows["most"].iloc[0]))
        return pd.DataFrame({"route": rows["route"].iloc[0], "component": list(ids), "stable": list(ids.values())})

    ids = least.unionByName(met.select(*least.columns)).join(most, "route", "left").groupBy("route").applyInPandas(group, "route string, component int, stable int")
    return parts.join(ids, ["route", "component"]).select("route", "node", F.col("stable").alias("component"))


def corridor_edge_ids(edges: DataFrame, drafts: DataFrame, matched: DataFrame) -> DataFrame:
    """edges with corridor_id: of several corridors the last."""
    kept = matched.join(drafts.select("corridor_id"), "corridor_id", "left_semi").select(F.col("edge_id").alias("id"), "corridor_id")
    return projection.update_column(edges.withColumn("corridor_id", F.lit(None).cast("int")), kept, "id", "corridor_id")


def build(spark: SparkSession, config: Config, until: str = "release") -> dict[str, DataFrame]:
    """The release's tables; until graph, corridors or routes, the tables made up to there."""
    stage = Stages(spark, config.workspace, {"parity_fresh_db": config.parity_fresh_db, "dedupe_links": config.dedupe_links})
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{config.workspace.rstrip('/')}/checkpoints")
    cut = lambda df: df.checkpoint()
    nodes, ways = spark.read.parquet(config.nodes), spark.read.parquet(config.ways)

    placed = stage("way_points", lambda: osm.way_points(osm.prefilter(ways, osm.WAY_FILTER), nodes), reads=(config.ways, config.nodes))
    highways = stage("highways", lambda: osm.highways(placed), ("way_points",))
    junctions = stage("exit_nodes", lambda: osm.exit_nodes(osm.prefilter(nodes, osm.NODE_FILTER)), reads=(config.nodes,))
    pois = stage("pois", lambda: projection.union_places(osm.poi_nodes(osm.prefilter(nodes, osm.NODE_FILTER)), osm.poi_ways(placed)), ("way_points",))
    cache = stage("relation_cache", lambda: relation_cache(spark, config.relations), reads=(config.relations,))
    members = cache.withColumn("direction", refs.direction(F.col("direction"), rich=False))

    anchors = projection.rest_anchor_exits(junctions, pois)
    exits = stage("exits", lambda: projection.admit_exits(junctions, anchors, projection.nearest_highway(junctions, highways)), ("exit_nodes", "pois", "highways"))
    spots = pois.where(projection.is_linkable(F.col("category"), F.col("display_name"), F.col("name"))).select(F.col("id").alias("poi_id"), "category", F.col("lat").alias("plat"), F.col("lon").alias("plon"))
    candidates = stage("candidates", lambda: projection.exit_place_candidates(exits.select(F.col("id").alias("exit_id"), "lat", "lon"), spots), ("exits", "pois"))

    loaded = stage("graph_ways", lambda: graph.load_ways(highways, relations.refs_by_way(members)), ("highways", "relation_cache"))

    def assigned_ways() -> DataFrame:
        own = graph.adopt_refless(graph.assign_ways(loaded), loaded, cut)
        return graph.adopt_connector_paths(own, loaded, checkpoint=cut)

    assigned = stage("assigned", assigned_ways, ("graph_ways",))
    arcs = stage("arcs", lambda: graph.directed_arcs(graph.way_steps(assigned.join(loaded, "way_id"), "route"), "route"), ("assigned",))
    def numbered_parts() -> DataFrame:
        found = graph.components(arcs)
        return stable_components(found, spark.read.parquet(config.previous)) if config.previous else found

    parts = stage("components", numbered_parts, ("arcs",), (config.previous,) if config.previous else ())
    signs = relations.route_signatures(members)

    def edges_of() -> DataFrame:
        stops = graph.stop_nodes(graph.node_degrees(arcs, "route"), junctions.select(F.col("node_id").alias("node")), graph.signature_changes(arcs, signs), "route")
        return graph.compressed_edges(arcs, stops, parts, signs)

    plain = stage("plain_edges", edges_of, ("arcs", "components", "exit_nodes", "relation_cache"))
    directions = graph.component_directions(plain)
    edges = plain.join(directions, ["highway", "component"], "left")
    entries = stage("exit_corridors", lambda: graph.exit_entries(exits.select(F.col("id").alias("exit_id"), "osm_id"), parts, directions), ("plain_edges", "exits"))

    if until == "graph":
        return {"edges": edges, "exit_corridors": entries, "components": parts}

    links = candidates
    if not config.parity_fresh_db:
        labels = pois.select(F.col("id").alias("poi_id"), projection.place_label(F.col("display_name"), F.col("name"), F.col("tags")).alias("label"))
        links = projection.prune_directional_conflicts(candidates, labels, entries.select("exit_id", "direction"))
    links = stage("links", lambda: links, ("candidates", "exit_corridors"))
    rest_names = projection.nearest_rest_area(links, pois.select(F.col("id").alias("poi_id"), "name", "display_name"))

    route_ways = stage("route_ways", lambda: graph.load_ways(highways, None, corridors.CONNECTOR_CLASSES, interstates_only=False), ("highways",))
    groups = relations.filter_blank_groups(relations.route_groups(members))
    drafts = stage("drafts", lambda: corridors.corridor_drafts(groups, route_ways, cut), ("route_ways", "relation_cache"))
    matched = stage("matched", lambda: corridors.match_edges(drafts, plain), ("drafts", "plain_edges"))
    kept = stage("kept_drafts", lambda: corridors.drop_conflicts(drafts, matched), ("matched",))
    claimed = corridors.conflicting_claims(kept, matched.join(kept.select("corridor_id"), "corridor_id", "left_semi")).limit(5).collect()
    if claimed:
        raise ValueError(f"edges claimed by corridors of different roots: {[(r.edge_id, r.corridor_ids) for r in claimed]}")
    fallback = stage("fallbacks", lambda: corridors.fallback_corridors(edges, entries, kept), ("kept_drafts", "exit_corridors"))
    every_match = matched.unionByName(fallback.select("corridor_id", F.explode("edge_ids").alias("edge_id")))
    columns = ["corridor_id", "highway", "root_relation_id", "canonical_direction", "way_ids", "lines"]
    all_corridors = stage("corridors", lambda: corridors.with_geojson(kept.select(columns).unionByName(fallback.select(columns))), ("kept_drafts", "fallbacks"))

    pool = junctions.select("node_id", projection.exit_ref(F.col("ref"), F.col("tags")).alias("ref"), projection.exit_name(F.col("name"), F.col("tags")).alias("name"), "lat", "lon")
    listed = entries.join(exits.select(F.col("id").alias("exit_id"), "ref", "name", "lat", "lon"), "exit_id")
    ordered = stage("corridor_exits", lambda: corridors.corridor_exits(all_corridors, listed, pool, route_ways, rest_names, cut), ("corridors", "exit_corridors", "links"))
    numbered = stage("edges", lambda: corridor_edge_ids(edges, all_corridors, every_match), ("corridors", "plain_edges"))
    if until == "corridors":
        return {"corridors": all_corridors, "corridor_exits": ordered, "edges": numbered}
    found_routes = stage("reference_routes", lambda: routes.reference_routes(all_corridors), ("corridors",))
    if until == "routes":
        return {"reference_routes": found_routes, "route_anchors": routes.route_anchors(found_routes)}
    return {
        "corridors": export.corridors(all_corridors, numbered), "corridor_edges": export.corridor_edges(all_corridors, numbered), "corridor_exits": export.corridor_exits(all_corridors, ordered),
        "exit_aliases": export.exit_aliases(spark), "places": export.places(all_corridors, ordered, links, pois), "exit_place_links": export.exit_place_links(all_corridors, ordered, links, config.dedupe_links),
        "reference_routes": export.reference_routes(found_routes), "route_anchors": routes.route_anchors(found_routes),
    }


def sources(spark: SparkSession, config: Config) -> list[dict]:
    """Lineage: every input file with its size and time, and its digest where it is the driver's own file."""
    out = []
    for kind, path in (("nodes", config.nodes), ("ways", config.ways), ("relations", config.relations)):
        for name, size, changed in listing(spark, path):
            local = Path(name.removeprefix("file:")) if name.startswith("file:") else None
            told = release.source_metadata(local, Path(config.release_dir or local_folder(config.workspace)) / "metadata") if local else {"file_name": name.rpartition("/")[2], "size_bytes": size, "modified": changed}
            out.append({"kind": kind, "path": name, **told})
    return out


def local_folder(path: str) -> str:
    """The folder without its scheme; an error if it is in a store, where release files can't be written."""
    if "://" in path and not path.startswith("file://"):
        raise ValueError(f"{path} is in a store: name a local --release-dir for the release's files")
    return path.removeprefix("file://")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="roadmill")
    parser.add_argument("command", choices=["build", "graph", "corridors", "routes", "evaluate"])
    for name in Config.__dataclass_fields__:
        parser.add_argument(f"--{name.replace('_', '-')}")
    args = vars(parser.parse_args(argv))
    command = args.pop("command")
    config = Config.of(**args)
    top = Path(config.release_dir or local_folder(config.workspace))
    spark = SparkSession.builder.appName("roadmill").getOrCreate()
    if command in ("graph", "corridors", "routes"):
        for name, df in build(spark, config, command).items():
            print(f"{name}: {df.count()} rows")
        return
    tables = build(spark, config)
    if command == "evaluate":
        own = evaluate.corridor_pairs(*(build(spark, config, "corridors")[t] for t in ("corridor_exits", "corridors")))
        found = evaluate.score(evaluate.match(evaluate.read_ground_truth(spark, config.truth), own)).first()
        print(json.dumps(found.asDict()))
        return
    folder = top / f"release-{config.version}"
    release.write_release(tables, folder, config.version, sources(spark, config))
    release.package(folder, folder.with_suffix(".tar.gz"))


if __name__ == "__main__":
    main()
