"""Directional corridors: ordered members, gap filling, route segments, edges, conflicts, fallbacks.

A corridor is drafted per route group (highway, root relation, direction). Filling gaps is a loop whose every step
depends on the last, so a group is one Arrow-backed function; groups are independent. A group gets its own ways and the
ways near them, and again with a wider reach if a search went beyond it.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadmill.functions import geo, refs
from roadmill.sources.osm import HIGH_CLASSES

from . import exits as exit_ops
from . import graph, routes

#: Classes of the connector graph, least corridor, greatest fallback connector.
CONNECTOR_CLASSES = ("motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link", "tertiary", "tertiary_link", "service")
LEAST_ROUTE_M, FALLBACK_M = 3000.0, 10_000

_INTERSTATE = re.compile(r"I-([0-9]+)[A-Z]?\Z")
Point = tuple[float, float]


class Way:
    __slots__ = ("id", "kind", "nodes", "oneway", "points", "refs")

    def __init__(self, id: int, kind: str, refs: Iterable[str], nodes: Iterable[int], points: Iterable[Point], oneway: bool):
        self.id, self.kind, self.refs, self.oneway = int(id), kind, frozenset(refs), bool(oneway)
        self.nodes, self.points = [int(n) for n in nodes], list(points)

    def arcs(self) -> Iterable[tuple[int, int, int, int]]:
        for i in range(len(self.nodes) - 1):
            w = graph.whole_metres(graph._metres(self.points[i], self.points[i + 1]))
            yield self.nodes[i], self.nodes[i + 1], w, self.id
            if not self.oneway:
                yield self.nodes[i + 1], self.nodes[i], w, self.id


def family(ref: str) -> str | None:
    """35 for I-35, I-35E and I-35W; null for others."""
    m = _INTERSTATE.match(ref)
    return m[1] if m else None


def ordered_members(members: list[int], ways: dict[int, Way]) -> list[int]:
    """The known members in the given or the opposite order, whichever has fewer breaks; a break is a way that lacks
    the last node of the one before."""
    known = [m for m in members if m in ways]
    breaks = lambda order: sum(ways[a].nodes[-1] not in ways[b].nodes for a, b in zip(order, order[1:]))
    back = known[::-1]
    return back if breaks(back) < breaks(known) else known


def admission(allowed: set[str] | frozenset[str], assigned: set[int], ways: dict[int, Way], unassigned: bool, fallback: bool) -> Callable[[int], bool]:
    """Which ways a connector may use: Interstates only if assigned, or if the group has no direction; and then ways
    without ref or with an allowed one; as a fallback also motorways, trunks and their links."""

    def fits(i: int) -> bool:
        way = ways[i]
        if not unassigned and i not in assigned and any(family(r) for r in way.refs):
            return False
        return not way.refs or not way.refs.isdisjoint(allowed) or fallback and way.kind in HIGH_CLASSES

    return fits


def fill_pair_gaps(order: list[int], assigned: set[int], ways: dict[int, Way], net: graph.Connectors, unassigned: bool) -> set[int]:
    """assigned with connectors between neighbouring members that lie in different components. Components are those of
    the round's start, while ways that a round adopts count at once; rounds go on until one adopts none."""
    assigned = set(assigned)
    lines = {i: w.nodes for i, w in ways.items()}
    while len(parts := graph.node_components(lines, assigned)) > 1:
        part_of = {n: k for k, nodes in enumerate(parts) for n in nodes}
        before = len(assigned)
        for a, b in zip(order, order[1:]):
            sides = [{part_of[n] for n in ways[i].nodes if n in part_of} for i in (a, b)]
            if sides[0] & sides[1]:
                continue
            allowed = ways[a].refs | ways[b].refs
            ends = set(ways[a].nodes), set(ways[b].nodes)
            path = net.cheapest(*ends, admission(allowed, assigned, ways, unassigned, False))
            path = path or net.cheapest(*ends, admission(allowed, assigned, ways, unassigned, True), FALLBACK_M)
            if path:
                assigned.update(path[1])
        if len(assigned) == before:
            break
    return assigned


def fill_component_gaps(highway: str, assigned: set[int], ways: dict[int, Way], net: graph.Connectors, unassigned: bool) -> set[int]:
    """assigned with the cheapest connectors between its components. Allowed are the route's ref and the refs of the ways
    assigned at the start, foreign Interstates only of the route's number."""
    own = family(highway)
    allowed = {highway} | {r for i in assigned for r in ways[i].refs if family(r) in (None, own)}
    held = set(assigned)  # the rule sees ways as they are adopted
    lines = {i: w.nodes for i, w in ways.items()}
    while len(parts := graph.node_components(lines, held)) > 1:
        fits, fallback = (admission(allowed, held, ways, unassigned, wide) for wide in (False, True))
        best = None
        for k, part in enumerate(parts):
            others = set().union(*parts[:k], *parts[k + 1 :])
            path = net.cheapest(part, others, fits) or net.cheapest(part, others, fallback, FALLBACK_M)
            if path and (best is None or path[0] < best[0]):
                best = path
        if best is None or held.issuperset(best[1]):
            break
        held.update(best[1])
    return held


# ---------------------------------------------------------------- segments


def _coordinate(point: Point, direction: str) -> float:
    return point[1] if direction in ("east", "west") else point[0]


def _shortest(start: int, end: int, near: dict[int, list[tuple[int, int]]]) -> list[int] | None:
    cost, came, heap = {start: 0}, {}, [(0, start)]
    while heap:
        c, node = heapq.heappop(heap)
        if node == end:
            path = [end]
            while path[-1] != start:
                path.append(came[path[-1]])
            return path[::-1]
        if c == cost[node]:
            for other, w in near.get(node, ()):
                if c + w < cost.get(other, 1 << 62):
                    cost[other], came[other] = c + w, node
                    heapq.heappush(heap, (c + w, other))
    return None


def _length(points: list[Point]) -> float:
    a = np.array(points)
    return float(routes._legs(a[:, 0], a[:, 1]).sum()) if len(points) > 1 else 0.0


def route_segments(ways: Iterable[Way], direction: str) -> list[list[Point]]:
    """One line per component: the shortest path, as driven or else either way, from its lowest to its highest terminal
    along the direction's axis (the other way round to the south and west); lines in that order too. Terminals are
    dead ends, or all nodes if there are fewer than two; of equal ones the least id counts."""
    at: dict[int, Point] = {}
    driven: dict[int, list[tuple[int, int]]] = defaultdict(list)
    either: dict[int, dict[int, int]] = defaultdict(dict)
    for way in sorted(ways, key=lambda w: w.id):
        if len(way.nodes) == len(way.points):
            for n, p in zip(way.nodes, way.points, strict=True):
                at.setdefault(n, p)
            for a, b, w, _ in way.arcs():
                driven[a].append((b, w))
                for x, y in ((a, b), (b, a)):
                    either[x][y] = min(w, either[x].get(y, w))
    if not either:
        return []
    pairs = np.array([(a, b) for a, near in either.items() for b in near], np.int64)
    nodes, rank = graph.union_find(pairs[:, 0], pairs[:, 1])
    turned = direction in ("south", "west")
    lines = []
    for k in range(int(rank.max()) + 1):
        inside = nodes[rank == k].tolist()
        ends = [n for n in inside if len(either[n]) <= 1]
        ends = ends if len(ends) >= 2 else inside
        low, high = min(ends, key=lambda n: (_coordinate(at[n], direction), n)), max(ends, key=lambda n: (_coordinate(at[n], direction), -n))
        start, end = (high, low) if turned else (low, high)
        if start == end:
            continue
        path = _shortest(start, end, driven) or _shortest(start, end, {a: list(near.items()) for a, near in either.items()})
        if not path:
            continue
        points = [at[path[0]]]
        points += [at[n] for n in path[1:] if at[n] != points[-1]]
        if len(points) >= 2:
            first, last = _coordinate(points[0], direction), _coordinate(points[-1], direction)
            lines.append(points if (last <= first if turned else last >= first) else points[::-1])
    return sorted(lines, key=lambda p: min(_coordinate(p[0], direction), _coordinate(p[-1], direction)), reverse=turned)


def without_micro_segments(lines: list[list[Point]]) -> list[list[Point]]:
    lengths = [_length(p) for p in lines]
    longest = max(lengths, default=0.0)
    if len(lines) <= 1 or longest <= 0:
        return lines
    return [p for p, m in zip(lines, lengths, strict=True) if m >= routes.MICRO_M or m >= longest * routes.MICRO_SHARE]


def draft(highway: str, direction: str | None, members: list[int], ways: dict[int, Way], net: graph.Connectors | None = None) -> tuple[set[int], list[list[Point]]] | None:
    """(assigned ways, lines) of a group; null if it has no known way or less than 3 km."""
    order = ordered_members(members, ways)
    if not order:
        return None
    net, unassigned = net or graph.Connectors(a for w in ways.values() for a in w.arcs()), direction is None
    assigned = fill_pair_gaps(order, set(order), ways, net, unassigned)
    assigned = fill_component_gaps(highway, assigned, ways, net, unassigned)
    lines = without_micro_segments(route_segments([ways[i] for i in assigned], direction or "north"))
    return (assigned, lines) if sum(map(_length, lines)) >= LEAST_ROUTE_M else None


DRAFT = "group_order int, highway string, root_relation_id long, direction string, way_ids array<long>, lines array<array<struct<lat:double,lon:double>>>, sure boolean"


def corridor_drafts(groups: DataFrame, ways: DataFrame, checkpoint=lambda df: df.checkpoint()) -> DataFrame:
    """Drafts of groups(group_order, highway, root_relation_id, direction, members) over ways of all classes, numbered
    corridor_id in group order; without a direction a corridor counts as north."""
    plain = groups.select("group_order", "highway", "root_relation_id", "direction", F.col("members.way_id").alias("member_ids"))
    members = checkpoint(groups.select("group_order", F.explode("members.way_id").alias("way_id")).distinct())

    def run(offered: DataFrame, reach: float | None) -> DataFrame:
        def group(part: pd.DataFrame) -> list[tuple]:
            told = part["told"].to_numpy(bool)
            if told.all() or not told.any():
                return []
            order, highway, root, direction, member_ids = next(part.loc[told, ["group_order", "highway", "root_relation_id", "direction", "member_ids"]].itertuples(index=False, name=None))
            known, rim = {}, []
            for i, kind, names, nodes, lats, lons, oneway, partly in part.loc[~told, ["way_id", "kind", "refs", "node_ids", "lats", "lons", "oneway", "rim"]].itertuples(index=False, name=None):
                known[int(i)] = way = Way(i, kind, names, nodes.tolist(), zip(lats.tolist(), lons.tolist(), strict=True), oneway)
                if partly:
                    rim += way.nodes
            going = direction if isinstance(direction, str) else None
            net = graph.Connectors((a for x in known.values() for a in x.arcs()), reach, rim)
            found = draft(highway, going, member_ids.tolist(), known, net)
            lines = [[{"lat": a, "lon": b} for a, b in line] for line in found[1]] if found else None
            return [(int(order), highway, int(root), going or "north", sorted(found[0]) if found else None, lines, net.sure)]

        # a row for each group and one for each way that it is offered; ids are never null, as pandas would round them
        side = lambda c: F.transform("points", lambda p: p[c]).alias(c + "s")
        near = offered.join(ways.select("way_id", F.col("highway").alias("kind"), "refs", "node_ids", side("lat"), side("lon"), "oneway"), "way_id")
        zero, no = F.lit(0).cast("long"), F.lit(False)
        heads = plain.withColumns({"way_id": zero, "rim": no, "oneway": no, "told": F.lit(True)})
        rows = heads.unionByName(near.withColumns({"root_relation_id": zero, "told": no}), allowMissingColumns=True)
        return graph.by_key(rows, "group_order", group, DRAFT)

    drafts = graph.by_reach(members, ways, "group_order", run, checkpoint).where("lines is not null")
    # numbers are given to keys alone, as one task gives them
    numbers = drafts.select("group_order").withColumn("corridor_id", F.row_number().over(Window.orderBy("group_order")))
    return drafts.join(numbers, "group_order").select(*(c.split()[0] for c in DRAFT.split(", ")[:5]), "lines", "corridor_id").withColumnRenamed("direction", "canonical_direction")


def match_edges(drafts: DataFrame, edges: DataFrame) -> DataFrame:
    """(corridor_id, edge_id): edges of the corridor's highway that share a way with it, whatever their direction."""
    own = drafts.select("corridor_id", "highway", F.explode("way_ids").alias("way_id"))
    theirs = edges.select(F.col("id").alias("edge_id"), "highway", F.explode("way_ids").alias("way_id"))
    return own.join(theirs, ["highway", "way_id"]).select("corridor_id", "edge_id").distinct()


def drop_conflicts(drafts: DataFrame, matched: DataFrame) -> DataFrame:
    """drafts without those that match an edge which an earlier kept draft of another root has. Edges belong to a
    highway, so a highway's drafts are settled in order on their own."""
    rows = drafts.select("highway", "corridor_id", "root_relation_id").join(matched.groupBy("corridor_id").agg(F.collect_list("edge_id").alias("edges")), "corridor_id")

    def group(part: pd.DataFrame) -> pd.DataFrame:
        owner: dict[str, int] = {}
        gone = []
        for r in part.sort_values("corridor_id").itertuples():
            if any(owner.get(e, r.root_relation_id) != r.root_relation_id for e in r.edges):
                gone.append(r.corridor_id)
            else:
                owner.update((e, r.root_relation_id) for e in r.edges if e not in owner)
        return pd.DataFrame({"corridor_id": np.array(gone, np.int32)})

    return drafts.join(rows.groupBy("highway").applyInPandas(group, "corridor_id int"), "corridor_id", "left_anti")


def conflicting_claims(drafts: DataFrame, matched: DataFrame) -> DataFrame:
    """(edge_id, corridor_ids) of edges that corridors of different roots claim; empty when all is well."""
    claims = matched.join(drafts.select("corridor_id", "root_relation_id"), "corridor_id")
    return claims.groupBy("edge_id").agg(F.array_sort(F.collect_set("corridor_id")).alias("corridor_ids"), F.count_distinct("root_relation_id").alias("roots")).where("roots > 1").drop("roots")


def fallback_corridors(edges: DataFrame, entries: DataFrame, drafts: DataFrame) -> DataFrame:
    """Corridors of highways that have exits on their graph but no draft: one per component and direction, its edges'
    lines in order along the direction; ids count on. edges(id, highway, component, direction N/E/S/W, way_ids, points)."""
    orphans = entries.where(F.col("highway").startswith("I-")).select("highway").distinct().join(drafts.select("highway").distinct(), "highway", "left_anti")
    going = F.coalesce(refs.cardinal_word(F.col("direction")), F.lit("north"))
    held = edges.join(orphans, "highway", "left_semi").withColumn("canonical_direction", going)
    east = F.col("canonical_direction").isin("east", "west")
    side = lambda i: F.when(east, F.element_at("points", i).lon).otherwise(F.element_at("points", i).lat)
    key = F.least(side(1), side(-1)) * F.when(F.col("canonical_direction").isin("south", "west"), -1.0).otherwise(1.0)
    grouped = held.withColumn("key", key).groupBy("highway", "component", "canonical_direction").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("key", "id", "points"))), lambda e: e.points).alias("lines"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("way_ids")))).alias("way_ids"), F.array_sort(F.collect_list("id")).alias("edge_ids")
    )
    last = drafts.agg(F.coalesce(F.max("corridor_id"), F.lit(0)).alias("last"))
    number = F.row_number().over(Window.orderBy("highway", "component", "canonical_direction"))
    return grouped.withColumn("n", number).join(F.broadcast(last)).select((F.col("n") + F.col("last")).alias("corridor_id"), "highway", F.lit(0).cast("long").alias("root_relation_id"), "canonical_direction", "component", "way_ids", "edge_ids", "lines")


def corridor_exits(drafts: DataFrame, entries: DataFrame, all_exits: DataFrame, ways: DataFrame, rest_area_names: DataFrame, checkpoint=lambda df: df.checkpoint()) -> DataFrame:
    """The exits of drafts, in order: those on the graph, on links near by, siblings, near the line, near any way of the
    same ref; refs split, expanded and merged; names from rest areas. entries(exit_id, highway, graph_node, ref, name,
    lat, lon)."""
    names = drafts.select("corridor_id", "highway")
    assigned = drafts.select("corridor_id", F.explode("way_ids").alias("way_id")).join(ways.select("way_id", F.explode("node_ids").alias("node")), "way_id").select("corridor_id", "node").distinct()
    nodes = checkpoint(exit_ops.expand_nodes(assigned, ways, names))
    listed = entries.join(names, "highway").join(nodes.withColumnRenamed("node", "graph_node"), ["corridor_id", "graph_node"], "left_semi").select(*exit_ops.EXIT)
    found = checkpoint(exit_ops.unlisted_exits(listed, nodes, all_exits, names))
    found = checkpoint(found.unionByName(exit_ops.sibling_exits(found, all_exits)))
    lines = drafts.select("corridor_id", "highway", "lines")
    found = checkpoint(found.unionByName(exit_ops.nearby_exits(found, all_exits, lines)))
    same_ref = ways.select(F.explode("refs").alias("highway"), "points").join(names, "highway").select("corridor_id", "highway", "points")
    found = checkpoint(found.unionByName(exit_ops.exits_near_lines(found, all_exits, same_ref)))
    for step in (exit_ops.split_semicolon_refs, exit_ops.expand_letter_ranges, exit_ops.expand_comma_refs, exit_ops.merge_letter_refs):
        found = checkpoint(step(found))
    return exit_ops.order_along_route(exit_ops.inherit_rest_area_names(found, rest_area_names), lines)


def with_geojson(drafts: DataFrame) -> DataFrame:
    return drafts.withColumn("geometry_json", routes.lines_geojson(F.col("lines")))


def route_length_m(lines):
    """Metres of all lines of a column."""
    return F.aggregate(F.transform(lines, geo.path_m), F.lit(0.0), lambda s, x: s + x)
