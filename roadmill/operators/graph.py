"""Highway graphs: assignment of ways, arcs, components, stop nodes, compressed edges.

ways(way_id, highway, refs array<string>, node_ids array<long>, points array<struct<lat, lon>>, oneway boolean).
A highway such as I-95 is the parallel key: after ways are assigned nothing crosses highways.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadmill.functions import geo, refs
from roadmill.sources.osm import HIGH_CLASSES

# ---------------------------------------------------------------- loading


def is_oneway(oneway: Column, highway: Column) -> Column:
    return F.when(oneway == "no", False).when(oneway.isin("-1", "yes", "1"), True).otherwise(highway.isin("motorway", "motorway_link"))


def load_ways(highways: DataFrame, relation_refs: DataFrame | None, classes: Iterable[str] = HIGH_CLASSES, interstates_only: bool = True) -> DataFrame:
    """highways table and refs_by_way to ways: of a class or a relation; refs of tags and relations, sorted; those with
    refs but no Interstate go; oneway=-1 turns the way round."""
    raw = F.nullif(F.expr("trim(BOTH ';' FROM concat_ws(';', nullif(trim(ref), ''), nullif(trim(tags['int_ref']), '')))"), F.lit(""))
    if relation_refs is None:
        held = highways.where(F.col("highway").isin(*classes)).withColumn("refs", refs.split_refs(raw))
    else:
        told = highways.join(relation_refs.withColumnRenamed("refs", "told"), "way_id", "left").where(F.col("highway").isin(*classes) | F.col("told").isNotNull())
        held = told.withColumn("refs", F.array_sort(F.array_distinct(F.concat(refs.split_refs(raw), F.coalesce("told", F.array().cast("array<string>"))))))
    if interstates_only:
        held = held.where((F.size("refs") == 0) | F.exists("refs", refs.is_interstate))
    back = F.col("oneway") == "-1"
    turned = lambda c: F.when(back, F.reverse(c)).otherwise(F.col(c))
    fit = held.where((F.size("node_ids") >= 2) & (F.size("node_ids") == F.size("points")))
    return fit.select("way_id", "highway", "refs", turned("node_ids").alias("node_ids"), turned("points").alias("points"), is_oneway(F.col("oneway"), F.col("highway")).alias("oneway"))


def assign_ways(ways: DataFrame) -> DataFrame:
    """(route, way_id): ways by their Interstate refs; a shared stretch belongs to several."""
    return ways.select(F.explode(F.filter("refs", refs.is_interstate)).alias("route"), "way_id").distinct()


def adopt_refless(assigned: DataFrame, ways: DataFrame, checkpoint=lambda df: df.checkpoint()) -> DataFrame:
    """assigned with motorways that have no ref and share a node with an assigned way. In each round all ways that
    touch a label take all labels that they touch, at once; an adopted way is not looked at again. Rounds go on until
    none is adopted."""
    refless = checkpoint(ways.where((F.size("refs") == 0) & (F.col("highway") == "motorway")).select("way_id", F.explode("node_ids").alias("node")).distinct())
    nodes = ways.select("way_id", F.explode("node_ids").alias("node"))
    labels = checkpoint(assigned.join(nodes, "way_id").select("route", "node").distinct())
    found = assigned
    while True:
        now = checkpoint(refless.join(labels, "node").select("route", "way_id").distinct())
        if not now.limit(1).count():
            return found
        found = checkpoint(found.unionByName(now).distinct())
        labels = checkpoint(now.join(refless, "way_id").select("route", "node").distinct())
        refless = checkpoint(refless.join(now.select("way_id").distinct(), "way_id", "left_anti"))


def way_steps(ways: DataFrame, *keep: str) -> DataFrame:
    """A row for each neighbouring pair of nodes of a way, in its direction: keep..., way_id, step, src, dst, alat, alon,
    blat, blon, oneway. Positions pair nodes with points, so no window is needed."""
    n = F.size("node_ids")
    steps = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct(i.alias("step"), F.element_at("node_ids", i).alias("src"), F.element_at("node_ids", i + 1).alias("dst"), F.element_at("points", i).alias("a"), F.element_at("points", i + 1).alias("b")))
    rows = ways.where(n >= 2).select(*keep, "way_id", "oneway", F.explode(steps).alias("s"))
    return rows.select(*keep, "way_id", "oneway", "s.step", "s.src", "s.dst", F.col("s.a.lat").alias("alat"), F.col("s.a.lon").alias("alon"), F.col("s.b.lat").alias("blat"), F.col("s.b.lon").alias("blon"))


def directed_arcs(steps: DataFrame, *keep: str) -> DataFrame:
    """steps both ways unless oneway, with metres and whole weight."""
    ends = lambda a, b: F.struct(F.col(a).alias("src"), F.col(b).alias("dst"), F.col(f"{'a' if a == 'src' else 'b'}lat").alias("alat"), F.col(f"{'a' if a == 'src' else 'b'}lon").alias("alon"), F.col(f"{'b' if a == 'src' else 'a'}lat").alias("blat"), F.col(f"{'b' if a == 'src' else 'a'}lon").alias("blon"))
    both = F.when(F.col("oneway"), F.array(ends("src", "dst"))).otherwise(F.array(ends("src", "dst"), ends("dst", "src")))
    rows = steps.select(*keep, "way_id", F.explode(both).alias("e")).select(*keep, "way_id", "e.*")
    metres = geo.haversine_m(F.col("alat"), F.col("alon"), F.col("blat"), F.col("blon"))
    return rows.withColumn("metres", metres).withColumn("weight_m", geo.edge_weight_m(F.col("metres")))


def arc_way_sets(arcs: DataFrame, *keep: str) -> DataFrame:
    return arcs.groupBy(*keep, "src", "dst").agg(F.array_sort(F.collect_set("way_id")).alias("way_ids"))


def node_degrees(arcs: DataFrame, *keep: str) -> DataFrame:
    """keep..., node, n_in, n_out, n_near: distinct neighbours by arcs in, arcs out, and either."""
    pairs = arcs.select(*keep, "src", "dst").distinct()
    sides = pairs.select(*keep, F.explode(F.array(F.struct(F.col("src").alias("node"), F.col("dst").alias("other"), F.lit(1).alias("out")), F.struct(F.col("dst").alias("node"), F.col("src").alias("other"), F.lit(0).alias("out")))).alias("s")).select(*keep, "s.*")
    by_pair = sides.groupBy(*keep, "node", "other").agg(F.max("out").alias("o"), F.max(1 - F.col("out")).alias("i"))
    return by_pair.groupBy(*keep, "node").agg(F.sum("i").alias("n_in"), F.sum("o").alias("n_out"), F.count("*").alias("n_near"), F.sum(F.col("i") * F.col("o")).alias("n_both"))


def stop_nodes(degrees: DataFrame, exits: DataFrame, changes: DataFrame, *keep: str) -> DataFrame:
    """keep..., node: nodes that are no plain passage (one in and one out, or two and two with the same neighbours),
    exits(node) on the graph, and changes(keep..., node), where the route signature differs on the two sides."""
    simple = (F.col("n_in") == 1) & (F.col("n_out") == 1)
    both = (F.col("n_in") == 2) & (F.col("n_out") == 2) & (F.col("n_both") == 2)
    nodes = degrees.select(*keep, "node")
    branch = degrees.where(~(simple | both)).select(*keep, "node")
    return branch.unionByName(nodes.join(exits.select("node").distinct(), "node", "left_semi").select(*keep, "node")).unionByName(nodes.join(changes.select(*keep, "node"), [*keep, "node"], "left_semi").select(*keep, "node")).distinct()


def signature_changes(arcs: DataFrame, signatures: DataFrame) -> DataFrame:
    """(route, node) where the arcs on the node's two sides differ in route signature, or where it hasn't two sides.
    arcs(route, way_id, src, dst); signatures(highway, way_id, signature). A side's signature is that of the arcs to or
    from that neighbour, so the direction of travel and the order of ids don't matter."""
    told = arcs.select("route", "way_id", "src", "dst").join(signatures.select(F.col("highway").alias("route"), "way_id", F.explode("signature").alias("sign")), ["route", "way_id"], "left")
    sides = told.select("route", "sign", F.explode(F.array(F.struct(F.col("src").alias("node"), F.col("dst").alias("other")), F.struct(F.col("dst").alias("node"), F.col("src").alias("other")))).alias("s")).select("route", "sign", "s.*")
    by_side = sides.groupBy("route", "node", "other").agg(F.array_sort(F.collect_set("sign")).alias("signs"))
    return by_side.groupBy("route", "node").agg(F.count("*").alias("n"), F.count_distinct("signs").alias("kinds")).where("n <> 2 or kinds > 1").select("route", "node")


# ---------------------------------------------------------------- components


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes ascending, rank of their component by its least node)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    up = np.arange(len(nodes))
    x, y = at[: len(a)], at[len(a) :]
    while True:  # labels are places in ascending order, so a component ends with its least node's
        low = np.minimum(up[x], up[y])
        new = up.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, up[x], low)
        np.minimum.at(new, up[y], low)
        new = new[new]
        if (new == up).all():
            return nodes, np.unique(up, return_inverse=True)[1]
        up = new


def components(arcs: DataFrame, key: str = "route") -> DataFrame:
    """(key, node, component): connected components per key, numbered by their least node."""

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        nodes, rank = union_find(rows["src"].to_numpy(np.int64), rows["dst"].to_numpy(np.int64))
        return pd.DataFrame({key: rows[key].iloc[0], "node": nodes, "component": rank.astype(np.int32)})

    links = arcs.select(key, F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    return links.groupBy(key).applyInPandas(group, f"{key} string, node long, component int")


def stable_component_ids(fresh: dict[int, set[int]], old_by_node: dict[int, set[int] | int], greatest: int) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """Ids for fresh components of earlier ones that share nodes: the least earlier id, earlier ids that meet being
    merged into it; new ones count on from the greatest. Returns ids and merges (from, into)."""
    up: dict[int, int] = {}

    def top(i: int) -> int:
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    seen: dict[int, set[int]] = {}
    for c, nodes in fresh.items():
        seen[c] = set().union(*({x} if isinstance(x := old_by_node[n], int) else x for n in nodes if n in old_by_node))
        tops = sorted(map(top, seen[c]))
        for t in tops[1:]:
            up[t] = tops[0]
    out, following = {}, greatest
    for c in sorted(fresh, key=lambda c: min(fresh[c])):
        if seen[c]:
            out[c] = top(min(seen[c]))
        else:
            following += 1
            out[c] = following
    return out, sorted((i, top(i)) for i in up if top(i) != i)


# ---------------------------------------------------------------- connectors


class Connectors:
    """Weighted arcs by start; of arcs with one start, ties go by weight, then way. With `reach` the arcs are those of the
    ways within so many metres of the sources alone; `sure` then says whether every search so far stayed so near that
    ways farther off could not have changed it: a point at cost c is no farther than 1.5 c, as a step of less than a
    metre and a half counts as one metre. Farther nodes count as near too if they are not in `rim`, the nodes of ways
    that lie partly outside the offered cells: all ways at such a node are offered."""

    def __init__(self, arcs: Iterable[tuple[int, int, int, int]], reach: float | None = None, rim: Iterable[int] | None = None):
        self.reach, self.sure = reach, True
        self.rim = None if rim is None else frozenset(rim)
        self.at: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for src, dst, weight, way in sorted(arcs, key=lambda a: (a[0], a[2], a[3], a[1])):
            self.at[src].append((dst, weight, way))

    def holds(self, cost: int, node: int) -> bool:
        """Whether all ways at a node that is reached at this cost are among those offered."""
        return self.reach is None or 1.5 * cost <= self.reach or self.rim is not None and node not in self.rim

    def cheapest(self, sources: set[int], targets: set[int], allowed=None, most: int | None = None) -> tuple[int, list[int]] | None:
        """(cost, way ids along it, repeats in a row once) of the cheapest path from a source to a target that is no
        source; of equal costs the larger node is settled first."""
        cost = dict.fromkeys(sources, 0)
        came: dict[int, tuple[int, int]] = {}
        heap = [(0, -s) for s in sources]
        heapq.heapify(heap)
        while heap:
            c, node = heapq.heappop(heap)
            node = -node
            if c > cost[node]:
                continue
            self.sure = self.sure and self.holds(c, node)
            if node in targets and node not in sources:
                ways: list[int] = []
                while node not in sources:
                    node, way = came[node]
                    if not ways or ways[-1] != way:
                        ways.append(way)
                return c, ways[::-1]
            for dst, weight, way in self.at.get(node, ()):
                total = c + weight
                if (most is None or total <= most) and total < cost.get(dst, 1 << 62) and (allowed is None or allowed(way)):
                    cost[dst], came[dst] = total, (node, way)
                    heapq.heappush(heap, (total, -dst))
        return None

    def nearest_part(self, parts: list[set[int]]) -> int | None:
        """The component from which the cheapest path to another one starts; of several the first. One search from all
        components at once: a node keeps its two nearest components, as one of them may be the path's end."""
        part_of = {n: k for k, nodes in enumerate(parts) for n in nodes}
        seen: dict[int, tuple[int, ...]] = {}
        heap = [(0, k, n) for n, k in part_of.items()]
        heapq.heapify(heap)
        while heap:
            c, k, node = heapq.heappop(heap)
            known = seen.get(node, ())
            if k in known or len(known) == 2:
                continue
            seen[node] = (*known, k)
            self.sure = self.sure and self.holds(c, node)
            if part_of.get(node, k) != k:
                return k
            for dst, weight, _ in self.at.get(node, ()):
                if k not in seen.get(dst, ()):
                    heapq.heappush(heap, (c + weight, k, dst))
        return None


def node_components(ways: dict[int, list[int]], ids: Iterable[int]) -> list[set[int]]:
    """Node sets of the components of the ways, by least node."""
    pairs = [p for i in ids for p in zip(ways[i], ways[i][1:])]
    if not pairs:
        return []
    a, b = np.array(pairs, np.int64).T
    nodes, rank = union_find(a, b)
    out: list[set[int]] = [set() for _ in range(int(rank.max()) + 1)]
    for n, r in zip(nodes.tolist(), rank.tolist(), strict=True):
        out[r].add(n)
    return out


class _Search:
    """A component's search over connectors, which goes on where it stopped: the cost of nodes and where they were come to
    from. heap: (cost, -node)."""

    __slots__ = ("came", "cost", "heap", "least")

    def __init__(self, nodes: Iterable[int]):
        self.cost = dict.fromkeys(nodes, 0)
        self.came: dict[int, tuple[int, int, int]] = {}  # cost there, -node, way
        self.heap = [(0, -n) for n in self.cost]
        heapq.heapify(self.heap)
        self.least = min(self.cost)

    def offer(self, node: int, cost: int, came: tuple[int, int, int] | None) -> None:
        """Of equal costs the way from the node that is settled first counts: the nearer, then the larger."""
        known = self.cost.get(node)
        if known is None or cost < known:
            self.cost[node] = cost
            if came:
                self.came[node] = came
            else:
                self.came.pop(node, None)
            heapq.heappush(self.heap, (cost, -node))
        elif cost == known and came and node in self.came and came[:2] < self.came[node][:2]:
            self.came[node] = came

    def next(self) -> tuple[int, int] | None:
        """(cost, node) to settle next, which stays."""
        while self.heap:
            cost, node = self.heap[0]
            if cost == self.cost[-node]:
                return cost, -node
            heapq.heappop(self.heap)
        return None

    def ways_to(self, node: int) -> list[int]:
        """Ways of the path to a node, from there back."""
        ways = []
        while node in self.came:
            _, back, way = self.came[node]
            node = -back
            ways.append(way)
        return ways


def adopt_connectors(assigned: set[int], ways: dict[int, list[int]], net: Connectors) -> set[int]:
    """assigned with the ways of the cheapest path between any two of its components, again and again until there is
    one component or no path. Of equal paths that of the component with the least node counts, then the one to the
    larger node. Every component searches once: joined ones go on with what the larger has found, and take from the
    others what they found nearer."""
    assigned = set(assigned)
    searches = {k: _Search(nodes) for k, nodes in enumerate(node_components(ways, assigned))}
    part_of = {n: k for k, s in searches.items() for n in s.cost}
    up = list(range(len(searches)))
    seen: dict[int, list[int]] = defaultdict(list)  # by node outside: the components that have settled it

    def top(k: int) -> int:
        while up[k] != k:
            up[k] = k = up[up[k]]
        return k

    def outside(k: int, node: int) -> bool:
        return node in part_of and top(part_of[node]) != k

    queue: list[tuple[int, bool, int, int, int]] = []
    turn = [0] * len(searches)  # a component's last entry counts
    far = float("inf")

    def enqueue(k: int) -> None:
        """By cost; all that has a cost is settled before a path of that cost counts."""
        turn[k] += 1
        if found := searches[k].next():
            heapq.heappush(queue, (found[0], outside(k, found[1]), searches[k].least, k, turn[k]))

    for k in searches:
        enqueue(k)
    while queue and len(searches) > 1:
        cost, meets, _, k, n_turn = heapq.heappop(queue)
        if k not in searches or turn[k] != n_turn:
            continue
        search = searches[k]
        found = search.next()
        if outside(k, found[1]) != meets:
            enqueue(k)
            continue
        if not meets:  # settles all of this cost, or up to another component
            known = search.cost
            while found and found[0] == cost and not outside(k, found[1]):
                node = found[1]
                net.sure = net.sure and net.holds(cost, node)
                heapq.heappop(search.heap)
                if cost:
                    seen[node].append(k)
                for dst, weight, way in net.at.get(node, ()):
                    if known.get(dst, far) >= cost + weight:  # most are known to be nearer
                        search.offer(dst, cost + weight, (cost, -node, way))
                found = search.next()
            enqueue(k)
            continue
        node = found[1]
        net.sure = net.sure and net.holds(cost, node)
        fresh = {w for w in search.ways_to(node) if w not in assigned}
        if not fresh:
            break
        assigned |= fresh
        nodes = {n for w in fresh for n in ways[w]}
        joined = {k, top(part_of[node])} | {top(part_of[n]) for n in nodes if n in part_of}
        into = max(joined, key=lambda j: (len(searches[j].cost), -j))
        whole = searches[into]
        for j in joined - {into}:
            up[j] = into
            small = searches.pop(j)
            whole.least = min(whole.least, small.least)
            for n, c in small.cost.items():
                whole.offer(n, c, small.came.get(n))
        for n in nodes:
            if n not in part_of:
                part_of[n] = into
                whole.least = min(whole.least, n)
                whole.offer(n, 0, None)
                for j in {top(j) for j in seen.pop(n, ())} - {into}:  # these went past it
                    heapq.heappush(searches[j].heap, (searches[j].cost[n], -n))
                    enqueue(j)
        enqueue(into)
    return assigned


#: Nodes of ways that one union-find takes, and links that end in one.
CHUNK_NODES, LAST_LINKS = 1 << 22, 1 << 20


def _stars(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """(node, root) of lists of linked nodes: root is the least node that is reachable inside a chunk."""

    def flush(pairs: list[tuple[np.ndarray, np.ndarray]]) -> Iterable[pa.RecordBatch]:
        nodes, rank = union_find(*(np.concatenate(side) for side in zip(*pairs, strict=True)))
        roots = nodes[np.unique(rank, return_index=True)[1]][rank]
        for i in range(0, len(nodes), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 100_000], pa.int64()) for x in (nodes, roots)], names=["node", "root"])

    held, n = [], 0
    for b in batches:
        lists = b.column(0)
        nodes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        if len(nodes) < 2:
            continue
        inside = np.ones(len(nodes), bool)
        ends = np.cumsum([0, *lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)])[1:]
        inside[ends[ends > 0] - 1] = False  # a list's last node leads nowhere
        first = np.flatnonzero(inside)
        if not len(first):
            continue
        held.append((nodes[first], nodes[first + 1]))
        n += len(nodes)
        if n >= CHUNK_NODES:
            yield from flush(held)
            held, n = [], 0
    if held:
        yield from flush(held)


def linked_components(links: DataFrame, checkpoint=lambda df: df.checkpoint()) -> DataFrame:
    """(node, component) of links(src, dst), without a key: component is the least node that is reachable."""
    return linked_lists(links.select(F.array("src", "dst").alias("nodes")), checkpoint)


def linked_lists(lists: DataFrame, checkpoint=lambda df: df.checkpoint()) -> DataFrame:
    """(node, component) of lists(nodes) of neighbours. Chunks of lists are joined on their own first; then only the
    roots of chunks that share a node are linked: in one task if these links are few, else in rounds, so no task holds
    the net."""
    few = lists.coalesce(max(1, lists.sparkSession.sparkContext.defaultParallelism))
    stars = few.mapInArrow(_stars, "node long, root long")
    lows = checkpoint(stars.groupBy("node").agg(F.min("root").alias("low"), F.collect_set("root").alias("roots")).select("node", "low", F.when(F.size("roots") > 1, F.array_remove("roots", F.col("low"))).alias("others")))
    links = checkpoint(lows.where("others is not null").select(F.col("low").alias("src"), F.explode("others").alias("dst")).distinct())
    lows = lows.select("node", "low")
    n = links.count()
    if not n:
        return lows.withColumnRenamed("low", "component")
    if n <= LAST_LINKS:
        parts = links.select(F.array("src", "dst").alias("nodes")).coalesce(1).mapInArrow(_stars, "node long, root long").select(F.col("node").alias("low"), F.col("root").alias("component"))
    else:
        parts = linked_rounds(links, checkpoint).withColumnRenamed("node", "low")
    return checkpoint(lows.join(parts, "low", "left").select("node", F.coalesce("component", "low").alias("component")))


def linked_rounds(links: DataFrame, checkpoint=lambda df: df.checkpoint()) -> DataFrame:
    """linked_components in rounds: every node takes the least label near it, and labels take the label of the node that
    they name, so chains end in a logarithmic number of rounds; no node, key or component is gathered."""
    both = checkpoint(links.select(F.col("src").alias("node"), F.col("dst").alias("other")).unionByName(links.select(F.col("dst").alias("node"), F.col("src").alias("other"))).distinct())
    labels = checkpoint(both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        hooked = labels.join(near, "node").withColumn("new", F.least("label", "near"))
        # the node that a label names takes what its members have found
        told = hooked.groupBy("label").agg(F.min("new").alias("told")).select(F.col("label").alias("node"), "told")
        hooked = hooked.join(told, "node", "left").select("node", "label", F.least("new", F.coalesce("told", "new")).alias("new"))
        up = hooked.select(F.col("node").alias("new"), F.col("new").alias("above"))
        fresh = checkpoint(hooked.join(up, "new").select("node", F.least("new", "above").alias("new"), "label"))
        labels = fresh.select("node", F.col("new").alias("label"))
        if not fresh.where("new <> label").limit(1).count():
            return labels.withColumnRenamed("label", "component")


#: Metres round a group's own ways within which connectors are offered, pass by pass; at last all that are connected.
REACHES = (16_000.0, 128_000.0, None)
METRES_A_DEGREE = 110_500.0
#: A component of so many ways is one task's, for all routes; a group that is connected with so many is offered all of them.
TASK_WAYS, GROUP_WAYS = 200_000, 1000


def linked_ways(ways: DataFrame, checkpoint=lambda df: df.checkpoint()) -> DataFrame:
    """(way_id, component) of the ways that have nodes; a node without a step is a component of its own."""
    parts = linked_lists(ways.where(F.size("node_ids") >= 2).select("node_ids"), checkpoint)
    first = ways.where(F.size("node_ids") >= 1).select("way_id", F.element_at("node_ids", 1).alias("node"))
    return checkpoint(first.join(parts, "node", "left").select("way_id", F.coalesce("component", "node").alias("component")))


def offered_ways(own: DataFrame, ways: DataFrame, key: str, reach: float | None, linked: DataFrame | None = None, fit: Column | None = None) -> DataFrame:
    """(key, way_id, rim): for own(key, way_id) the group's ways, and those `fit` ways of the components of linked(way_id,
    component) that the group's lie in with a point within `reach` metres of one of the group's, by cells of that size,
    up to 70 degrees of latitude; rim tells ways that lie partly outside these cells. Without a reach, all of the
    components; without `linked`, near ways of any component."""
    if linked is None:
        linked = linked_ways(ways) if reach is None else ways.select("way_id", F.lit(0).cast("long").alias("component"))
    others = ways if fit is None else ways.where(fit)
    mine = own.join(ways.select("way_id"), "way_id", "left_semi").select(key, "way_id").distinct()
    if reach is None:
        touched = own.join(linked, "way_id").select(key, "component").distinct()
        near = touched.join(linked.join(others.select("way_id"), "way_id", "left_semi"), "component").select(key, "way_id", F.lit(False).alias("rim"))
    else:
        size = reach / METRES_A_DEGREE
        cells = F.array_distinct(F.transform("points", lambda p: F.struct(F.floor(p.lat / size).cast("long").alias("cy"), F.floor(p.lon / size).cast("long").alias("cx"))))
        placed = lambda df: df.select("way_id", cells.alias("cells")).join(linked, "way_id").select("way_id", "component", F.size("cells").alias("n_cells"), F.explode("cells").alias("c")).select("way_id", "component", "n_cells", "c.*")
        spread = own.join(placed(ways), "way_id").select(key, "component", "cy", "cx").distinct()
        # a degree of longitude is a third of one of latitude at 70 degrees
        for c, most in (("cy", 1), ("cx", 3)):
            spread = spread.withColumn(c, F.explode(F.sequence(F.col(c) - most, F.col(c) + most))).distinct()
        near = spread.join(placed(others), ["component", "cy", "cx"]).groupBy(key, "way_id").agg((F.count("*") < F.max("n_cells")).alias("rim"))
    return near.unionByName(mine.withColumn("rim", F.lit(False))).groupBy(key, "way_id").agg(F.min("rim").alias("rim"))


def by_key(rows: DataFrame, key: str, f: Callable[[pd.DataFrame], Iterable[tuple]], schema: str) -> DataFrame:
    """The rows that f gives for each key's rows, as of applyInPandas, but with many keys in a batch."""
    names = [c.split()[0] for c in re.split(r", (?=\w+ )", schema)]

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        out: list[tuple] = []
        for b in batches:
            if not len(b):
                continue
            keys = b[key].to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(b)]
            for i, j in zip(cuts, cuts[1:]):
                if held and held[0][key].iloc[0] != keys[i]:
                    out += f(pd.concat(held) if len(held) > 1 else held[0])
                    held = []
                held.append(b.iloc[i:j])
            if len(out) >= 2000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if held:
            out += f(pd.concat(held) if len(held) > 1 else held[0])
        if out:
            yield pd.DataFrame(out, columns=names)

    return rows.repartition(key).sortWithinPartitions(key).mapInPandas(run, schema)


def by_reach(own: DataFrame, ways: DataFrame, key: str, run: Callable[[DataFrame, float | None], DataFrame], checkpoint=lambda df: df.checkpoint(), fit: Column | None = None, linked: DataFrame | None = None) -> DataFrame:
    """The rows of run(offered, reach), which has a row or more with key and `sure` for every group. Groups that are
    connected with few ways are offered all of them. Of the others, groups whose
    searches went beyond a pass's reach are done again with the next one's, so that a group's input is its ways and the
    `fit` ones near it that are connected with it, and results are those of the whole graph. The last pass, which few
    groups need, offers all that is connected."""
    linked = linked_ways(ways, checkpoint) if linked is None else linked
    sizes = linked.groupBy("component").agg(F.count("*").alias("n"))
    touched = own.join(linked, "way_id", "left").select(key, "component").distinct().join(sizes, "component", "left")
    sized = checkpoint(touched.groupBy(key).agg((F.coalesce(F.sum("n"), F.lit(0)) <= GROUP_WAYS).alias("few")))
    kinds = {r.few for r in sized.select("few").distinct().collect()}
    found, left = None, own
    if True in kinds:
        few = own.join(sized.where("few"), key, "left_semi") if False in kinds else own
        found = checkpoint(run(offered_ways(few, ways, key, None, linked, fit), None)).drop("sure")
        if False not in kinds:
            return found
        left = checkpoint(own.join(sized.where("few"), key, "left_anti"))
    for reach in REACHES:
        made = checkpoint(run(offered_ways(left, ways, key, reach, linked, fit), reach))
        done = made.where("sure").drop("sure")
        found = done if found is None else found.unionByName(done)
        more = made.where("not sure").select(key).distinct()
        if not more.limit(1).count():
            break
        left = checkpoint(left.join(more, key, "left_semi"))
    return found


_FLAT = ("way_id", "node_ids", "lats", "lons", "oneway", "blank")


def adopt_connector_paths(assigned: DataFrame, ways: DataFrame, classes: Iterable[str] = HIGH_CLASSES, checkpoint=lambda df: df.checkpoint()) -> DataFrame:
    """(route, way_id) with ways without ref that join a route's components. No path leaves a component of all these ways,
    so a component is a task, whose blank ways serve all routes; only where one is larger than TASK_WAYS, a route is a group,
    with its own ways and the blank ways near them; `by_reach` says how far."""
    blank = (F.size("refs") == 0) & F.col("highway").isin(*classes)
    told = ways.withColumn("blank", blank).join(assigned.groupBy("way_id").agg(F.collect_set("route").alias("routes")), "way_id", "left").where(F.col("blank") | F.col("routes").isNotNull()).where(F.size("points") > 0)
    # places are for lengths, which only blank ways need
    side = lambda c: F.when(F.col("blank"), F.transform("points", lambda p: p[c]))
    near = told.select("way_id", "node_ids", side("lat").alias("lats"), side("lon").alias("lons"), "oneway", "blank", "routes").persist(StorageLevel.DISK_ONLY)
    near.count()  # before fewer tasks read it
    parts = linked_lists(near.where(F.size("node_ids") >= 2).select("node_ids"), checkpoint)
    first = near.withColumn("node", F.get("node_ids", F.lit(0)))
    component = F.coalesce("component", "node", F.lit(-1)).alias("component")
    sizes = first.groupBy("node").agg(F.count("*").alias("n")).join(parts, "node", "left").groupBy(component).agg(F.sum("n").alias("n"))
    large = checkpoint(sizes.where(F.col("n") > TASK_WAYS).select("component"))
    any_large = bool(large.limit(1).count())
    placed = first.join(parts, "node", "left").select(component, *_FLAT, "routes")
    whole = placed.join(large, "component", "left_anti") if any_large else placed

    def task(part: pd.DataFrame) -> list[tuple]:
        ids, free = part["way_id"].tolist(), part["blank"].to_numpy(bool)
        lines = dict(zip(ids, (n.tolist() for n in part["node_ids"]), strict=True))
        own: dict[str, set[int]] = defaultdict(set)
        for way, routes in zip(ids, part["routes"], strict=True):
            for route in () if routes is None else routes:
                own[route].add(way)
        net = Connectors(a for w in _weights([part[free]]) for a in _weighted(w, lines)) if own else None
        return [(route, way) for route, held in own.items() for way in sorted(adopt_connectors(held, lines, net))]

    found = checkpoint(by_key(whole, "component", task, "route string, way_id long"))
    if any_large:
        linked = checkpoint(placed.join(large, "component", "left_semi").select("way_id", "component"))
        inside = ways.withColumn("blank", blank).join(linked, "way_id", "left_semi")
        found = found.unionByName(_routes_by_reach(assigned.join(linked, "way_id", "left_semi"), inside, linked, checkpoint))
    near.unpersist()
    return found


def _routes_by_reach(assigned: DataFrame, ways: DataFrame, linked: DataFrame, checkpoint) -> DataFrame:
    """adopt_connector_paths with a route as a group, over ways(way_id, node_ids, points, oneway, blank)."""
    near = checkpoint(ways.select("way_id", "node_ids", "points", "oneway", "blank"))
    # lengths are taken once, not for each route
    flat = near.select("way_id", "node_ids", F.transform("points", lambda p: p.lat).alias("lats"), F.transform("points", lambda p: p.lon).alias("lons"), "oneway", "blank")
    plain = checkpoint(flat.mapInPandas(_weights, "way_id long, node_ids array<long>, weights array<long>, oneway boolean, blank boolean"))

    def run(offered: DataFrame, reach: float | None) -> DataFrame:
        rows = offered.join(assigned.withColumn("own", F.lit(True)), ["route", "way_id"], "left").withColumn("own", F.coalesce("own", F.lit(False)))
        rows = rows.join(plain, "way_id")

        def group(part: pd.DataFrame) -> pd.DataFrame:
            ids = part["way_id"].tolist()
            lines = dict(zip(ids, (n.tolist() for n in part["node_ids"]), strict=True))
            net = Connectors(_weighted(part[part["blank"]], lines), reach, (n for w in part.loc[part["rim"], "way_id"].tolist() for n in lines[w]))
            found = adopt_connectors(set(part.loc[part["own"], "way_id"].tolist()), lines, net)
            return pd.DataFrame({"route": part["route"].iloc[0], "way_id": sorted(found), "sure": net.sure})

        return rows.groupBy("route").applyInPandas(group, "route string, way_id long, sure boolean")

    return by_reach(assigned, near, "route", run, checkpoint, F.col("blank"), linked)


def _metres(a: tuple[float, float], b: tuple[float, float]) -> float:
    p, q = np.radians(a[0]), np.radians(b[0])
    s = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin(np.radians(b[1] - a[1]) / 2) ** 2
    return float(2 * geo.SPHERE_M * np.arctan2(np.sqrt(s), np.sqrt(1 - s)))


def whole_metres(x: float) -> int:
    """One at least, halves away from zero."""
    return max(1, int(np.floor(x + 0.5)))


def _weights(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
    """Ways with the whole metres of their steps in place of lats and lons."""
    for b in batches:
        b = b[[len(x) > 0 for x in b["lats"]]]
        if not len(b):
            continue
        sizes = np.minimum([len(x) for x in b["lats"]], [len(x) for x in b["node_ids"]])
        lat, lon = (np.concatenate([x[:n] for x, n in zip(b[c], sizes, strict=True)]).astype(float) for c in ("lats", "lons"))
        p, q = np.radians(lat[:-1]), np.radians(lat[1:])
        half = np.sin((q - p) / 2) ** 2 + np.cos(p) * np.cos(q) * np.sin(np.radians(lon[1:] - lon[:-1]) / 2) ** 2
        metres = 2 * geo.SPHERE_M * np.arctan2(np.sqrt(half), np.sqrt(1 - half))
        whole = np.maximum(1, np.floor(metres + 0.5)).astype(np.int64)
        first = np.cumsum(sizes) - sizes
        yield pd.DataFrame({"way_id": b["way_id"], "node_ids": b["node_ids"], "weights": [whole[a : a + n - 1] for a, n in zip(first.tolist(), sizes.tolist(), strict=True)], "oneway": b["oneway"], "blank": b["blank"]})


def _weighted(rows: pd.DataFrame, lines: dict[int, list[int]]) -> Iterable[tuple[int, int, int, int]]:
    for way, weights, oneway in zip(rows["way_id"].tolist(), rows["weights"], rows["oneway"].tolist(), strict=True):
        nodes = lines[way]
        for s, d, w in zip(nodes, nodes[1:], weights.tolist()):
            yield s, d, w, way
            if not oneway:
                yield d, s, w, way


# ---------------------------------------------------------------- compressed edges

EDGE = "id string, highway string, component int, start_node long, end_node long, length_m int, way_ids array<long>, points array<struct<lat:double,lon:double>>"
_CHAIN = "id string, highway string, component int, start_node long, end_node long, length_m int, way_ids array<long>, lats array<double>, lons array<double>"


def chain_heads(follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(head, steps from it) of each arc; follows is the place of the arc before it, or its own for a head. Places are
    doubled, so a chain of n arcs takes log n rounds. On a ring no arc's head is a head."""
    head, steps = follows.copy(), (follows != np.arange(len(follows))).astype(np.int64)
    for _ in range(len(follows).bit_length()):
        steps, above = steps + steps[head], head[head]
        if (above == head).all():
            break
        head = above
    return head, steps


def compress(route: str, arcs: pd.DataFrame, stops: np.ndarray, component: pd.Series) -> pd.DataFrame:
    """Chains of arcs between stop nodes, as edges. arcs(src, dst, alat, alon, blat, blon, metres, way_ids, sign), one per
    (src, dst); component by node. An arc follows another if it leads on from its end, which is no stop, to another node
    than the other's start, as the only one that does, and has the same signature. Chains begin at stops; those back to
    their start and those between components are dropped, and of chains with one start and end the one with the least
    second node stays."""
    a = arcs.sort_values(["src", "dst"], ignore_index=True)
    src, dst, sign = a["src"].to_numpy(np.int64), a["dst"].to_numpy(np.int64), pd.factorize(a["sign"])[0]
    at = np.arange(len(a))
    # arcs out of a node are neighbours, so the arcs on from an arc are a slice
    first, last = np.searchsorted(src, dst, "left"), np.searchsorted(src, dst, "right")
    passing = ~np.isin(dst, stops)
    width = np.where(passing, last - first, 0)
    before = np.repeat(at, width)
    after = np.arange(len(before)) - np.repeat(np.cumsum(width) - width, width) + first[before]
    onward = dst[after] != src[before]
    before, after = before[onward], after[onward]
    sole = np.bincount(before, minlength=len(a))[before] == 1
    joined = sole & (sign[before] == sign[after])
    follows = at.copy()
    # where stops leave a node out at which ways meet, the first arc into it goes on
    follows[after[joined][::-1]] = before[joined][::-1]
    head, steps = chain_heads(follows)
    begins = np.isin(src[head], stops) & (follows[head] == head)
    order = np.lexsort((steps, head))
    order = order[begins[order]]
    chains, start = np.unique(head[order], return_index=True)
    stop = np.append(start[1:], len(order))
    blat, blon, alat, alon, metres, ways = (a[c].to_numpy() for c in ("blat", "blon", "alat", "alon", "metres", "way_ids"))
    rows, known = [], set()
    part = component.to_dict()
    for h, i, j in zip(chains.tolist(), start.tolist(), stop.tolist()):
        run = order[i:j]
        x, y = int(src[h]), int(dst[run[-1]])
        if x == y or part.get(x) is None or part[x] != part.get(y) or (x, y) in known:
            continue
        known.add((x, y))
        rows.append((f"edge/{route}/{x}/{y}", route, part[x], x, y, whole_metres(sum(metres[run].tolist())), np.unique(np.concatenate(ways[run])), np.append(alat[h], blat[run]), np.append(alon[h], blon[run])))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _CHAIN.split(", ")])


def compressed_edges(arcs: DataFrame, stops: DataFrame, parts: DataFrame, signatures: DataFrame | None = None) -> DataFrame:
    """Edges of all routes. arcs(route, way_id, src, dst, alat, ..., metres), stops(route, node), parts(route, node,
    component), signatures(highway, way_id, signature)."""
    if signatures is None:
        signed = arcs.withColumn("sign", F.lit(None).cast("string"))
    else:
        signed = arcs.join(signatures.select(F.col("highway").alias("route"), "way_id", F.to_json("signature").alias("sign")), ["route", "way_id"], "left")
    first = F.min(F.struct("way_id", "alat", "alon", "blat", "blon", "metres"))
    one = signed.groupBy("route", "src", "dst").agg(first.alias("f"), F.array_sort(F.collect_set("way_id")).alias("way_ids"), F.array_join(F.array_sort(F.collect_set("sign")), "|").alias("sign"))
    one = one.select("route", "src", "dst", "f.alat", "f.alon", "f.blat", "f.blon", "f.metres", "way_ids", "sign")

    # a cogroup has two sides: stops and components come as one table
    marks = parts.join(stops.withColumn("stop", F.lit(True)), ["route", "node"], "left")

    def group(key, a: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        return compress(key[0], a, m.loc[m["stop"].notna(), "node"].to_numpy(np.int64), m.set_index("node")["component"])

    chains = one.groupBy("route").cogroup(marks.groupBy("route")).applyInPandas(group, _CHAIN)
    points = F.zip_with("lats", "lons", lambda a, b: F.struct(a.alias("lat"), b.alias("lon")))
    return chains.withColumn("points", points).drop("lats", "lons")


def component_directions(edges: DataFrame) -> DataFrame:
    """(highway, component, direction): N, E, S or W of the circular mean of the edges' bearings from start to end,
    weighted by length."""
    a, b = F.element_at("points", 1), F.element_at("points", -1)
    heading = F.radians(geo.bearing(a.lat, a.lon, b.lat, b.lon))
    mean = edges.groupBy("highway", "component").agg(F.sum(F.sin(heading) * F.col("length_m")).alias("y"), F.sum(F.cos(heading) * F.col("length_m")).alias("x"))
    angle = F.pmod(F.degrees(F.atan2("y", "x")) + 360.0, F.lit(360.0))
    return mean.select("highway", "component", geo.cardinal(angle).alias("direction"))


def exit_entries(exits: DataFrame, parts: DataFrame, directions: DataFrame) -> DataFrame:
    """(exit_id, highway, graph_node, direction, component) for exits(exit_id, osm_id) on a highway's graph; the last
    component of an exit and highway stays."""
    found = exits.join(parts.withColumnRenamed("route", "highway"), F.col("osm_id") == F.col("node")).join(directions, ["highway", "component"], "left")
    best = found.groupBy("exit_id", "highway").agg(F.max(F.struct("component", "node", "direction")).alias("b"))
    return best.select("exit_id", "highway", F.col("b.node").alias("graph_node"), "b.direction", "b.component")
