"""Graphs, corridors, exits and routes on small hand-made networks."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadmill.operators import corridors, exits, export, graph, projection, routes, spatial
from roadmill.operators.corridors import Way
from roadmill.plans import queries

WAYS = "way_id long, highway string, refs array<string>, node_ids array<long>, points array<struct<lat:double,lon:double>>, oneway boolean"


GROUP = "group_order int, highway string, root_relation_id long, direction string, members array<struct<sequence_index:int,leaf_relation_id:long,way_id:long,role:string>>"


def at(node):
    return (35.0 + node * 0.01, -80.0)


def way(i, nodes, refs=("I-95",), kind="motorway", oneway=True):
    return (i, kind, list(refs), list(nodes), [at(n) for n in nodes], oneway)


def ways_df(spark, *rows):
    return spark.createDataFrame(list(rows), WAYS)


def edges_of(spark, rows, exits_at=(), signatures=None, assigned=None):
    ways = ways_df(spark, *rows)
    own = graph.assign_ways(ways) if assigned is None else assigned(ways)
    arcs = graph.directed_arcs(graph.way_steps(own.join(ways, "way_id"), "route"), "route")
    signs = None
    changes = spark.createDataFrame([], "route string, node long")
    if signatures is not None:
        signs = spark.createDataFrame(signatures, "highway string, way_id long, signature array<struct<root_relation_id:long,direction:string>>")
        changes = graph.signature_changes(arcs, signs)
    at_exit = spark.createDataFrame([(n,) for n in exits_at], "node long")
    stops = graph.stop_nodes(graph.node_degrees(arcs, "route"), at_exit, changes, "route")
    return sorted((r.highway, r.start_node, r.end_node, r.component) for r in graph.compressed_edges(arcs, stops, graph.components(arcs), signs).collect())


def test_an_exit_splits_a_chain(spark):
    assert edges_of(spark, [way(1, [1, 2, 3])], exits_at=[2]) == [("I-95", 1, 2, 0), ("I-95", 2, 3, 0)]


def test_chain_heads_of_a_chain_and_a_ring():
    follows = np.array([0, 0, 1, 2, 3, 6, 5, 7])
    head, steps = graph.chain_heads(follows)
    assert head[:5].tolist() == [0] * 5 and steps[:5].tolist() == [0, 1, 2, 3, 4]
    assert (follows[head[5:7]] != head[5:7]).all() and (head[7], steps[7]) == (7, 0)


def test_components_are_numbered_by_their_least_node(spark):
    assert edges_of(spark, [way(10, [10, 11]), way(1, [1, 2])]) == [("I-95", 1, 2, 0), ("I-95", 10, 11, 1)]


def test_routes_other_than_interstates_are_dropped(spark):
    assert edges_of(spark, [way(1, [1, 2], ["US-101"]), way(2, [3, 4], ["I-280"])]) == [("I-280", 3, 4, 0)]


def test_a_connector_is_adopted(spark):
    rows = [way(1, [1, 2]), way(2, [2, 3], [], "motorway_link"), way(3, [3, 4]), way(4, [20, 21], [], "motorway_link")]
    adopt = lambda ways: graph.adopt_connector_paths(graph.assign_ways(ways), ways)
    assert edges_of(spark, rows, assigned=adopt) == [("I-95", 1, 4, 0)]


def network(rng, n_nodes, n_ways, square):
    """Ways between random places, a third of them with a ref."""
    places = {k: (35.0 + rng.random() * square, -80.0 + rng.random() * square) for k in range(n_nodes)}
    rows = []
    for i in range(n_ways):
        a = int(rng.integers(n_nodes))
        near = sorted(places, key=lambda k: (places[k][0] - places[a][0]) ** 2 + (places[k][1] - places[a][1]) ** 2)[1:6]
        nodes = [a, int(rng.choice(near))]
        refs = [f"I-{int(rng.integers(4))}"] if i % 3 == 0 else []
        rows.append((i, ["motorway", "motorway_link", "trunk"][i % 2 if refs else i % 3], refs, nodes, [places[n] for n in nodes], bool(rng.random() < 0.3)))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_connectors_near_by_give_the_results_of_the_whole_graph(spark, monkeypatch, seed):
    rng = np.random.default_rng(seed)
    rows = network(rng, 120, 260, 0.8)
    ways = ways_df(spark, *rows)
    own = graph.assign_ways(ways)
    members = {r: [w[0] for w in rows if w[2] == [r]] for r in ("I-0", "I-1", "I-2")}
    groups = spark.createDataFrame([(k, r, 9, ["north", None, "east"][k], [(j, 1, i, "") for j, i in enumerate(members[r][:6])]) for k, r in enumerate(members)], GROUP)
    found = []
    for reaches in ((None,), (4_000.0, 30_000.0, None)):
        monkeypatch.setattr(graph, "REACHES", reaches)
        found.append((sorted(map(tuple, graph.adopt_connector_paths(own, ways).collect())), sorted((r.group_order, r.way_ids, r.lines) for r in corridors.corridor_drafts(groups, ways).collect())))
    assert found[0] == found[1]
    # brute force: every group with all blank ways
    lines = {w[0]: w[3] for w in rows}
    net = graph.Connectors(a for w in rows if not w[2] for a in Way(w[0], w[1], w[2], w[3], w[4], w[5]).arcs())
    plain = sorted((r, i) for r in ("I-0", "I-1", "I-2", "I-3") for i in graph.adopt_connectors({w[0] for w in rows if w[2] == [r]}, lines, net))
    assert found[0][0] == plain and len(plain) > len(own.collect())
    whole = {w[0]: Way(w[0], w[1], w[2], w[3], w[4], w[5]) for w in rows}
    drafts = [(k, corridors.draft(r, ["north", None, "east"][k], members[r][:6], whole)) for k, r in enumerate(members)]
    assert [(k, i) for k, i, _ in found[0][1]] == [(k, sorted(d[0])) for k, d in drafts if d]


def test_offered_ways_are_those_near_by(spark):
    rows = [way(k, [k * 10, k * 10 + 1], ["I-95"] if k % 10 == 0 else []) for k in range(60)]
    ways = ways_df(spark, *rows)
    offered = graph.offered_ways(graph.assign_ways(ways), ways, "route", 16_000.0)
    ids = {r.way_id for r in offered.collect()}
    assert {1, 9, 11, 50} <= ids and len(ids) < 40, "a degree and more away nothing is offered"
    assert {r.way_id for r in graph.offered_ways(graph.assign_ways(ways), ways, "route", None).collect()} == {0, 10, 20, 30, 40, 50}


@pytest.mark.parametrize("seed", range(2))
def test_linked_components_equal_union_find(spark, seed):
    rng = np.random.default_rng(seed)
    a, b = np.concatenate([rng.integers(0, 80, 45), np.arange(200, 260)]), np.concatenate([rng.integers(0, 80, 45), np.arange(201, 261)])
    links = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b, strict=True)], "src long, dst long")
    nodes, rank = graph.union_find(a, b)
    least = {int(r): int(nodes[rank == r].min()) for r in set(rank)}
    assert {r.node: r.component for r in graph.linked_components(links).collect()} == {int(n): least[int(r)] for n, r in zip(nodes, rank, strict=True)}


@pytest.mark.parametrize("last", (0, 1 << 20))
def test_components_of_chunks_are_linked_at_their_roots(spark, monkeypatch, last):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(graph, "LAST_LINKS", last)
    rows = [([int(x) for x in rng.integers(0, 300, int(rng.integers(1, 5)))],) for _ in range(120)]
    pairs = np.array([p for (x,) in rows for p in zip(x, x[1:])])
    nodes, rank = graph.union_find(*pairs.T)
    least = {int(r): int(nodes[rank == r].min()) for r in set(rank)}
    plain = {int(n): least[int(r)] for n, r in zip(nodes, rank, strict=True)}
    assert {r.node: r.component for r in graph.linked_lists(spark.createDataFrame(rows, "nodes array<long>").repartition(4)).collect()} == plain
    # chunk by chunk: a null list and a list of one link nothing
    monkeypatch.setattr(graph, "CHUNK_NODES", 4)
    lists = [pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.int64()))], names=["nodes"]) for x in ([[1, 2, 3], None, [], [9]], [[3, 2]], [[5, 4], [7]])]
    assert [list(zip(*b.to_pydict().values(), strict=True)) for b in graph._stars(lists)] == [[(1, 1), (2, 1), (3, 1)], [(2, 2), (3, 2), (4, 4), (5, 4)]]


def test_chains_need_no_rounds(spark, monkeypatch):
    def fail(*_):
        raise AssertionError("rounds, each of which shuffles every link")

    monkeypatch.setattr(graph, "linked_rounds", fail)
    links = spark.range(0, 3000, 1, 4).where("id % 50 <> 49").selectExpr("id as src", "id + 1 as dst")
    assert {r.component for r in graph.linked_components(links).collect()} == {k * 50 for k in range(60)}


@pytest.mark.parametrize("seed", range(2))
def test_a_components_blank_ways_serve_all_routes_and_large_ones_go_by_reach(spark, monkeypatch, seed):
    ways = ways_df(spark, *network(np.random.default_rng(seed), 120, 260, 0.8))
    own, offered = graph.assign_ways(ways), []
    told = graph.offered_ways
    monkeypatch.setattr(graph, "offered_ways", lambda *a, **b: offered.append(a[3]) or told(*a, **b))
    plain = sorted(map(tuple, graph.adopt_connector_paths(own, ways).collect()))
    assert offered == [], "a row for each route and blank way grows with both"
    monkeypatch.setattr(graph, "TASK_WAYS", 0)
    monkeypatch.setattr(graph, "GROUP_WAYS", 0)
    monkeypatch.setattr(graph, "REACHES", (4_000.0, 30_000.0, None))
    assert sorted(map(tuple, graph.adopt_connector_paths(own, ways).collect())) == plain and offered[0] == 4_000.0
    # components of both kinds
    monkeypatch.setattr(graph, "TASK_WAYS", 100)
    apart = [way(1000 + k, [5000 + k, 5001 + k], ["I-1"] if k % 3 == 0 else []) for k in range(8)]
    both = ways.unionByName(ways_df(spark, *apart))
    got = sorted(map(tuple, graph.adopt_connector_paths(graph.assign_ways(both), both).collect()))
    assert got == sorted([*plain, *(("I-1", 1000 + k) for k in range(7))])


@pytest.mark.parametrize("seed", range(2))
def test_groups_connected_with_few_ways_are_drafted_in_one_pass(spark, monkeypatch, seed):
    rows = network(np.random.default_rng(seed), 120, 260, 0.8)
    high = 1 << 60  # ids that a float can't hold
    ways = ways_df(spark, *((i + high, *rest) for i, *rest in rows))
    members = {r: [w[0] + high for w in rows if w[2] == [r]] for r in ("I-0", "I-1", "I-2")}
    groups = spark.createDataFrame([(k, r, high + 7, ["north", None, "east"][k], [(j, 1, i, "") for j, i in enumerate(members[r][:6])]) for k, r in enumerate(members)] + [(9, "I-3", 5, "west", [(0, 1, -4, "")])], GROUP)
    passes, told = [], graph.offered_ways
    monkeypatch.setattr(graph, "offered_ways", lambda *a, **b: passes.append(a[3]) or told(*a, **b))
    drafts = lambda: sorted((r.corridor_id, r.group_order, r.root_relation_id, r.way_ids, r.lines) for r in corridors.corridor_drafts(groups, ways).collect())
    found = drafts()
    assert passes == [None], "cells and passes for groups that are connected with few ways"
    whole = {w[0] + high: Way(w[0] + high, *w[1:]) for w in rows}
    plain = [(k, corridors.draft(r, ["north", None, "east"][k], members[r][:6], whole)) for k, r in enumerate(members)]
    assert [(k, root, ids) for _, k, root, ids, _ in found] == [(k, high + 7, sorted(d[0])) for k, d in plain if d] and found
    assert [n for n, *_ in found] == list(range(1, len(found) + 1))
    monkeypatch.setattr(graph, "GROUP_WAYS", 0)
    monkeypatch.setattr(graph, "REACHES", (4_000.0, 30_000.0, None))
    assert drafts() == found and 4_000.0 in passes


def test_the_nearest_part_is_that_of_the_cheapest_path():
    rng = np.random.default_rng(8)
    for _ in range(60):
        arcs = [(int(a), int(b), int(w), k) for k, (a, b, w) in enumerate(zip(rng.integers(0, 40, 90), rng.integers(0, 40, 90), rng.integers(1, 30, 90), strict=True))]
        net = graph.Connectors(arcs)
        order = rng.permutation(40).tolist()
        parts = [set(order[:3]), set(order[3:5]), set(order[5:6]), set(order[6:12])]
        paths = [net.cheapest(p, set().union(*parts[:k], *parts[k + 1 :])) for k, p in enumerate(parts)]
        best = min((x[0] for x in paths if x), default=None)
        expected = next((k for k, x in enumerate(paths) if x and x[0] == best), None)
        assert net.nearest_part(parts) == expected


def by_rounds(assigned, ways, net):
    """Connectors round by round, each with searches of its own."""
    assigned = set(assigned)
    while len(parts := graph.node_components(ways, assigned)) > 1:
        k = net.nearest_part(parts)
        path = None if k is None else net.cheapest(parts[k], set().union(*parts[:k], *parts[k + 1 :]))
        if path is None or assigned.issuperset(path[1]):
            break
        assigned.update(path[1])
    return assigned


def test_searches_that_go_on_adopt_what_rounds_adopt():
    grew = 0
    for seed in range(300):
        rng = np.random.default_rng(seed)
        lines = {w: rng.choice(int(rng.integers(5, 60)), size=int(rng.integers(2, 5))).tolist() for w in range(int(rng.integers(4, 80)))}
        own = {w for w in lines if rng.random() < 0.3}
        arcs = []
        for w in sorted(set(lines) - own):
            for a, b in zip(lines[w], lines[w][1:]):
                weight = int(rng.integers(1, 3 if seed % 2 else 1000))
                arcs += [(a, b, weight, w), (b, a, weight, w)][: int(rng.integers(1, 3))]
        found = graph.adopt_connectors(own, lines, graph.Connectors(arcs))
        assert found == by_rounds(own, lines, graph.Connectors(arcs)), seed
        grew += len(found) > len(own)
    assert grew > 100


def test_connectors_between_many_components_are_not_searched_anew():
    net = graph.Connectors((a, b, 1, 10_000 + k) for k in range(3000) for a, b in ((2 * k + 1, 2 * k + 2), (2 * k + 2, 2 * k + 1)))
    settled = []
    net.holds = lambda cost, node: settled.append(node) or True
    lines = {k: [2 * k, 2 * k + 1] for k in range(3000)} | {10_000 + k: [2 * k + 1, 2 * k + 2] for k in range(3000)}
    assert len(graph.adopt_connectors(set(range(3000)), lines, net)) == 5999
    assert len(settled) < 100_000, "a search of all for each of 2999 connectors settles millions"


def test_a_search_that_has_all_ways_at_its_nodes_is_sure(spark, monkeypatch):
    monkeypatch.setattr(graph, "REACHES", (3_000.0,))
    rows = [way(1, [1, 2]), way(2, [50, 51]), way(3, [2, 3], [], "motorway_link"), way(4, [3, 4], [], "motorway_link"), way(5, [70, 71], [], "motorway_link")]
    ways = ways_df(spark, *rows)
    # one pass is enough where no path exists; far ways and other components aren't offered
    assert sorted(r.way_id for r in graph.adopt_connector_paths(graph.assign_ways(ways), ways).collect()) == [1, 2]
    offered = graph.offered_ways(graph.assign_ways(ways), ways, "route", 1e6, graph.linked_ways(ways))
    assert {r.way_id for r in offered.collect()} == {1, 2, 3, 4}


def test_refless_motorways_are_adopted_round_by_round(spark):
    rows = [way(1, [1, 2]), way(2, [2, 3], []), way(3, [3, 4], []), way(4, [4, 5], ["I-10"]), way(5, [9, 10], [])]
    ways = ways_df(spark, *rows)
    got = sorted(map(tuple, graph.adopt_refless(graph.assign_ways(ways), ways).collect()))
    assert got == [("I-10", 3), ("I-10", 4), ("I-95", 1), ("I-95", 2)], "each way goes to those that reach it first"


@pytest.mark.parametrize("nodes", [[1, 2, 3, 4], [4, 3, 2, 1]])
def test_a_change_of_signature_is_a_stop_whatever_the_ids(spark, nodes):
    rows = [way(1, nodes[:2], ["I-19"]), way(2, nodes[1:3], ["I-19"]), way(3, nodes[2:], ["I-19"])]
    signs = [("I-19", 1, [(7, "north")]), ("I-19", 2, [(7, "north")]), ("I-19", 3, [(7, "south")])]
    assert edges_of(spark, rows, signatures=signs) == sorted([("I-19", nodes[0], nodes[2], 0), ("I-19", nodes[2], nodes[3], 0)])


def test_two_way_chains_have_edges_both_ways(spark):
    rows = [way(1, [1, 2]), way(2, [2, 3, 4], oneway=False), way(3, [4, 5, 6], oneway=False), way(4, [6, 7])]
    assert edges_of(spark, rows) == [("I-95", 1, 2, 0), ("I-95", 2, 6, 0), ("I-95", 6, 2, 0), ("I-95", 6, 7, 0)]


def test_cycles_without_a_stop_have_no_edges(spark):
    assert edges_of(spark, [way(1, [1, 2, 3, 1])]) == []


def test_stable_ids():
    assert graph.stable_component_ids({0: {10, 11}, 1: {20, 21}}, {10: 7}, 9) == ({0: 7, 1: 10}, [])
    assert graph.stable_component_ids({0: {100, 101}}, {100: 9, 101: 3}, 12) == ({0: 3}, [(9, 3)])


def test_union_find_on_chains_and_stars():
    rng = np.random.default_rng(2)
    order = rng.permutation(500)
    nodes, rank = graph.union_find(order[:-1], order[1:])
    assert len(nodes) == 500 and set(rank) == {0}
    nodes, rank = graph.union_find(np.array([9, 9, 4, 3]), np.array([8, 7, 4, 2]))
    assert dict(zip(nodes.tolist(), rank.tolist(), strict=True)) == {2: 0, 3: 0, 4: 1, 7: 2, 8: 2, 9: 2}


def test_loading_turns_and_filters_ways(spark):
    rows = [
        (1, "motorway", "I 95;US 1", None, [1, 2], "yes", {}), (2, "motorway", "US 1", None, [1, 2], "no", {}), (3, "motorway", None, None, [3, 4], "-1", {"int_ref": "I 7"}), (4, "primary", None, None, [5, 6], None, {}), (5, "trunk", "", None, [7, 8], None, {}), (6, "motorway_link", " ", None, [9], None, {}),
    ]
    df = spark.createDataFrame(rows, "way_id long, highway string, ref string, name string, node_ids array<long>, oneway string, tags map<string,string>").withColumn("points", F.transform("node_ids", lambda n: F.struct((n * 1.0).alias("lat"), F.lit(0.0).alias("lon"))))
    told = spark.createDataFrame([(4, ["I-44"])], "way_id long, refs array<string>")
    got = {r.way_id: (r.refs, r.node_ids, r.points[0].lat, r.oneway) for r in graph.load_ways(df, told).collect()}
    assert got == {1: (["I-95", "US-1"], [1, 2], 1.0, True), 3: (["I-7"], [4, 3], 4.0, True), 4: (["I-44"], [5, 6], 5.0, False), 5: ([], [7, 8], 7.0, False)}


# ---------------------------------------------------------------- corridors


def net(*rows):
    ways = {r[0]: Way(r[0], r[1], r[2], r[3], r[4], r[5]) for r in rows}
    return ways, graph.Connectors(a for w in ways.values() for a in w.arcs())


def test_members_are_turned_where_that_breaks_less():
    ways, _ = net(way(1, [1, 2]), way(2, [2, 3]), way(3, [3, 4]))
    assert corridors.ordered_members([3, 2, 1], ways) == [1, 2, 3]
    assert corridors.ordered_members([1, 9, 2], ways) == [1, 2]


def test_who_may_be_a_connector():
    ways, _ = net(way(1, [1, 2]), way(2, [2, 3], ["I-10"]), way(3, [3, 4], []), way(4, [4, 5], ["US-9"], "primary"), way(5, [4, 5], ["US-9"], "trunk"))
    rule = lambda **k: [i for i in ways if corridors.admission(**({"allowed": {"I-95"}, "assigned": {1}, "ways": ways, "unassigned": False, "fallback": False} | k))(i)]
    assert rule() == [1, 3]
    assert rule(fallback=True) == [1, 3, 5]
    assert rule(unassigned=True, allowed={"I-10"}) == [2, 3]
    assert rule(allowed={"US-9"}) == [3, 4, 5]


def test_pair_gaps_are_filled():
    ways, graph_ = net(way(1, [1, 2]), way(12, [2, 3], []), way(2, [3, 4]))
    assert corridors.fill_pair_gaps([1, 2], {1, 2}, ways, graph_, False) == {1, 2, 12}
    ways, graph_ = net(way(1, [1, 2]), way(12, [2, 3], ["I-10"]), way(2, [3, 4]))
    assert corridors.fill_pair_gaps([1, 2], {1, 2}, ways, graph_, False) == {1, 2}


def test_short_fallbacks_are_taken_and_long_ones_not():
    short = [way(1, [1, 2]), way(3, [2, 3], ["US-1"], "trunk"), way(2, [3, 4])]
    ways, graph_ = net(*short)
    assert corridors.fill_component_gaps("I-95", {1, 2}, ways, graph_, False) == {1, 2, 3}
    ways, graph_ = net(way(1, [1, 2]), way(3, [2, 30], ["US-1"], "trunk"), way(2, [30, 31]))
    assert corridors.fill_component_gaps("I-95", {1, 2}, ways, graph_, False) == {1, 2}


def test_families():
    assert [corridors.family(r) for r in ("I-35", "I-35E", "US-35", "I-X")] == ["35", "35", None, None]


def test_segments_run_along_the_direction_without_micro_segments():
    rows = [way(1, [1, 2, 3]), way(2, [30, 31])]
    ways, _ = net(*rows)
    north, south = corridors.route_segments(ways.values(), "north"), corridors.route_segments(ways.values(), "south")
    assert [[round((p[0] - 35) * 100) for p in line] for line in north] == [[1, 2, 3], [30, 31]]
    assert [[round((p[0] - 35) * 100) for p in line] for line in south] == [[31, 30], [3, 2, 1]]
    long, tiny = [(35.0, -80.0), (36.0, -80.0)], [(37.0, -80.0), (37.001, -80.0)]
    assert corridors.without_micro_segments([long, tiny]) == [long]
    assert corridors.without_micro_segments([tiny]) == [tiny]


def test_drafts_fill_gaps_and_drop_short_ones(spark):
    rows = [way(1, [1, 2]), way(12, [2, 3], [], "motorway_link"), way(2, [3, 4]), way(7, [70, 71], ["I-5"])]
    groups = spark.createDataFrame([(1, "I-95", 5, "north", [(0, 1, 1, ""), (1, 1, 2, "")]), (2, "I-5", 6, None, [(0, 1, 7, "")]), (3, "I-6", 7, None, [(0, 1, 999, "")])], GROUP)
    got = corridors.corridor_drafts(groups, ways_df(spark, *rows)).collect()
    assert [(r.corridor_id, r.highway, r.canonical_direction, r.way_ids, len(r.lines)) for r in got] == [(1, "I-95", "north", [1, 2, 12], 1)]


def test_drafts_may_have_lines_of_different_lengths(spark):
    rows = [way(1, [1, 2, 3, 4]), way(2, [400, 401]), way(3, [600, 601, 602])]
    groups = spark.createDataFrame([(1, "I-95", 5, "south", [(k, 1, k, "") for k in (1, 2, 3)])], GROUP)
    row = corridors.corridor_drafts(groups, ways_df(spark, *rows)).first()
    assert [len(line) for line in row.lines] == [3, 2, 4] and row.lines[0][0].lat > row.lines[1][0].lat


def test_edges_match_whatever_their_direction_and_conflicts_are_dropped(spark):
    drafts = spark.createDataFrame([(1, "I-10", 5, [1, 2]), (2, "I-10", 6, [2, 3]), (3, "I-10", 5, [2]), (4, "I-10", 7, [9])], "corridor_id int, highway string, root_relation_id long, way_ids array<long>")
    edges = spark.createDataFrame([("edge/I-10/1/2", "I-10", [2]), ("edge/I-10/5/6", "I-10", [9]), ("edge/I-9/1/2", "I-9", [2])], "id string, highway string, way_ids array<long>")
    matched = corridors.match_edges(drafts, edges)
    assert sorted(map(tuple, matched.collect())) == [(1, "edge/I-10/1/2"), (2, "edge/I-10/1/2"), (3, "edge/I-10/1/2"), (4, "edge/I-10/5/6")]
    assert [tuple(r) for r in corridors.conflicting_claims(drafts, matched).collect()] == [("edge/I-10/1/2", [1, 2, 3])]
    kept = corridors.drop_conflicts(drafts, matched)
    assert sorted(r.corridor_id for r in kept.collect()) == [1, 3, 4]
    assert corridors.conflicting_claims(kept, corridors.match_edges(kept, edges)).count() == 0


def test_fallback_corridors(spark):
    edges = spark.createDataFrame([("e1", "I-5", 0, "N", [1], [at(1), at(2)]), ("e2", "I-5", 0, "N", [2], [at(0), at(1)]), ("e3", "I-9", 0, "W", [3], [at(0), at(1)]), ("e4", "I-5", 1, None, [4], [at(5), at(6)])], "id string, highway string, component int, direction string, way_ids array<long>, points array<struct<lat:double,lon:double>>")
    entries = spark.createDataFrame([("node/1", "I-5"), ("node/2", "I-9")], "exit_id string, highway string")
    drafts = spark.createDataFrame([(4, "I-9")], "corridor_id int, highway string")
    got = corridors.fallback_corridors(edges, entries, drafts).orderBy("corridor_id").collect()
    assert [(r.corridor_id, r.canonical_direction, r.way_ids, round(r.lines[0][0].lat, 2)) for r in got] == [(5, "north", [1, 2], 35.0), (6, "north", [4], 35.05)]


# ---------------------------------------------------------------- exits

EXIT = "corridor_id int, exit_id string, highway string, graph_node long, ref string, name string, lat double, lon double"


def exit_rows(spark, *refs, node=100):
    return spark.createDataFrame([(1, f"node/{node + k}", "I-95", node + k, r, "n", 35.0, -80.0) for k, r in enumerate(refs)], EXIT)


def refs_of(df):
    return sorted((r.exit_id, r.ref) for r in df.collect())


def test_semicolons(spark):
    assert refs_of(exits.split_semicolon_refs(exit_rows(spark, "23A;23B"))) == [("node/100:23A", "23A"), ("node/100:23B", "23B")]
    assert refs_of(exits.split_semicolon_refs(exit_rows(spark, "23A;23B", "23A"))) == [("node/100:23B", "23B"), ("node/101", "23A")]
    assert refs_of(exits.split_semicolon_refs(exit_rows(spark, " 5A ; 5B ; ", None))) == [("node/100:5A", "5A"), ("node/100:5B", "5B"), ("node/101", None)]
    assert refs_of(exits.split_semicolon_refs(exit_rows(spark, "1;2", "1", "2"))) == [("node/101", "1"), ("node/102", "2")]


def test_ranges_and_commas(spark):
    assert refs_of(exits.expand_letter_ranges(exit_rows(spark, "17A-B", "17B"))) == [("node/100", "17A-B"), ("node/100:17A", "17A"), ("node/101", "17B")]
    assert refs_of(exits.expand_comma_refs(exit_rows(spark, "11A,B", None))) == [("node/100", "11A,B"), ("node/100:11A", "11A"), ("node/100:11B", "11B"), ("node/101", None)]


def test_letters_merge(spark):
    assert ("node/100:214AB", "214AB") in refs_of(exits.merge_letter_refs(exit_rows(spark, "214A", "214B")))
    assert len(refs_of(exits.merge_letter_refs(exit_rows(spark, *(f"1{c}" for c in "ABCDEF"))))) == 6
    same = spark.createDataFrame([(1, "node/1", "I-1", 1, "214A", "n", 1.0, 1.0), (1, "node/2", "I-1", 1, "214A", "n", 1.0, 1.0)], EXIT)
    assert ("node/1:214AA", "214AA") in refs_of(exits.merge_letter_refs(same))


def test_siblings(spark):
    pool = spark.createDataFrame([(1, "100A", "a", 35.004, -80.0), (2, "100C", "c", 35.05, -80.0), (3, "100A", "far", 35.02, -80.0), (4, "101", "x", 35.0, -80.0)], "node_id long, ref string, name string, lat double, lon double")
    assert refs_of(exits.sibling_exits(exit_rows(spark, "100B"), pool)) == [("node/1", "100A")]


def test_nearby(spark):
    pool = spark.createDataFrame([(1, "7", "a", 35.05, -79.98), (2, "8", "b", 35.05, -79.5), (3, "9", "c", 35.0, -80.0), (4, "", "d", 35.0, -80.0), (5, None, "e", 35.0, -80.0)], "node_id long, ref string, name string, lat double, lon double")
    lines = spark.createDataFrame([(1, "I-95", [[(35.0, -80.0), (35.1, -80.0)]])], "corridor_id int, highway string, lines array<array<struct<lat:double,lon:double>>>")
    assert refs_of(exits.nearby_exits(exit_rows(spark, "9"), pool, lines)) == [("node/1", "7")]


def test_nearby_pairs_few_exits_with_legs_and_loses_none(spark, monkeypatch):
    """Against all pairs: dense refs, rare ones between 94 m and 3 km, ties, own nodes and refs, a line far north."""
    rng = np.random.default_rng(7)
    routes_ = [(c, f"I-{c}", [[(y + i * 0.01, -80.0 + c * 0.3 + i * 0.002) for i in range(4)] for y in (base, base + 0.06)]) for c, base in ((1, 35.0), (2, 35.02), (3, 70.0))]
    spots = [(k, f"{k % 3}", 35.0 + rng.random() * 0.1, [-79.7, -79.4][k % 2] + rng.random() * 0.06 - 0.02) for k in range(1500)]
    rare = [(2000 + k, f"r{k}", 35.0 + rng.random() * 0.14, -79.75 + rng.random() * 0.1) for k in range(40)] + [(2100 + k, f"n{k}", 70.02, -79.1 + 0.01 * k - 0.06) for k in range(20)]
    ties = [(3001, "tie", 35.02, -79.69), (3000, "tie", 35.02, -79.69), (2999, None, 35.02, -79.69), (2998, "", 35.02, -79.69), (3002, "held", 35.01, -79.698), (3003, "held", 35.01, -79.69), (3004, "known", 35.01, -79.698)]
    pool = spark.createDataFrame([(n, r, "x", y, z) for n, r, y, z in spots + rare + ties], "node_id long, ref string, name string, lat double, lon double")
    lines = spark.createDataFrame(routes_, "corridor_id int, highway string, lines array<array<struct<lat:double,lon:double>>>")
    own = spark.createDataFrame([(1, "node/3002", "I-1", 3002, None, "x", 35.01, -79.698), (1, "node/9", "I-1", 9, "known", "x", 35.0, -79.7)], EXIT)
    legs = spatial.segments(lines.select("corridor_id", F.explode("lines").alias("points")), "points", "corridor_id")
    box = legs.groupBy("corridor_id").agg(F.min("alon").alias("west"), F.max("blon").alias("east"))
    pairs = legs.join(box, "corridor_id").crossJoin(pool.where("ref <> ''")).where("lon between west - 0.06 and east + 0.06")
    pairs = pairs.withColumn("m", exits.geo.segment_m(*map(F.col, ("lat", "lon", "alat", "alon", "blat", "blon")))).where("m <= 3000 and not (corridor_id = 1 and (node_id = 3002 or ref = 'known'))")
    plain = sorted((r.corridor_id, f"node/{r.n}", r.ref) for r in pairs.groupBy("corridor_id", "ref").agg(F.min(F.struct("m", "node_id")).alias("b")).selectExpr("corridor_id", "ref", "b.node_id as n").collect())
    seen, first = [], exits._first_per_ref
    monkeypatch.setattr(exits, "_first_per_ref", lambda df: seen.append(df) or first(df))
    found = exits.nearby_exits(own, pool, lines)
    assert sorted((r.corridor_id, r.exit_id, r.ref) for r in found.collect()) == plain
    assert {(1, "node/3000", "tie"), (1, "node/3003", "held")} <= set(plain) and {c for c, _, _ in plain} == {1, 2, 3}
    assert sum(df.count() for df in seen) < pairs.count() / 5, "refs met near by are not searched farther"


def test_nearby_exits_broadcast_no_exploded_or_whole_table(spark, sf_dir):
    plan = queries.queries()["nearby_exits"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_nodes_expand_over_links(spark):
    rows = [way(1, [1, 2]), way(2, [2, 3], [], "motorway_link"), way(3, [3, 4], [], "motorway_link"), way(4, [4, 5], [], "motorway_link"), way(5, [5, 6], [], "motorway_link"), way(6, [2, 7], ["I-95"]), way(7, [7, 8], ["I-95"]), way(8, [1, 9], ["US-1"])]
    near = [(r[0], r[1], r[2], r[3], [(35 + n * 0.001, -80.0) for n in r[3]], r[5]) for r in rows]
    assigned = spark.createDataFrame([(1, 1), (1, 2)], "corridor_id int, node long")
    names = spark.createDataFrame([(1, "I-95")], "corridor_id int, highway string")
    got = sorted(r.node for r in exits.expand_nodes(assigned, ways_df(spark, *near), names).collect())
    assert got == [1, 2, 3, 4, 5, 7], "three hops over links; the route's own ways only in the first"
    far = [(r[0], r[1], r[2], r[3], [(35 + n * 0.05, -80.0) for n in r[3]], r[5]) for r in rows]
    assert sorted(r.node for r in exits.expand_nodes(assigned, ways_df(spark, *far), names).collect()) == [1, 2]


def test_order_and_names(spark):
    rows = spark.createDataFrame([(1, "node/3", "I-95", 3, "3", None, 35.2, -80.0), (1, "node/1", "I-95", 1, None, None, 35.0, -80.0), (1, "node/2", "I-95", 2, "", "", 35.1, -80.0), (2, "node/9", "I-95", 9, "9", None, 1.0, 1.0)], EXIT)
    named = exits.inherit_rest_area_names(rows, spark.createDataFrame([("node/1", "Plaza")], "exit_id string, rest_area string"))
    lines = spark.createDataFrame([(1, "I-95", [[(35.0, -80.0), (35.1, -80.0)], [(35.15, -80.0), (35.21, -80.0)]])], "corridor_id int, highway string, lines array<array<struct<lat:double,lon:double>>>")
    got = exits.order_along_route(named, lines).orderBy("corridor_id", "corridor_index").collect()
    assert [(r.corridor_id, r.exit_id, r.name, r.corridor_index) for r in got] == [(1, "node/1", "Plaza", 0), (1, "node/3", None, 1), (2, "node/9", None, 0)]
    assert got[1].sort_key_m == pytest.approx((0.1 + 0.06) * 111_195, rel=1e-3)


def test_unlisted_exits(spark):
    pool = spark.createDataFrame([(5, "5", "five", 1.0, 2.0), (100, "x", "y", 1.0, 2.0)], "node_id long, ref string, name string, lat double, lon double")
    nodes = spark.createDataFrame([(1, 5), (1, 6), (1, 100)], "corridor_id int, node long")
    got = exits.unlisted_exits(exit_rows(spark, "9"), nodes, pool, spark.createDataFrame([(1, "I-95")], "corridor_id int, highway string"))
    assert refs_of(got) == [("node/100", "9"), ("node/5", "5")]


# ---------------------------------------------------------------- routes


def test_resampling_equals_a_walk_along_the_line():
    rng = np.random.default_rng(4)
    lat, lon = 40 + np.cumsum(rng.normal(0, 0.01, 60)), -75 + np.cumsum(rng.normal(0, 0.01, 60))
    y, x = routes.resample(lat, lon)
    along = np.concatenate([[0], np.cumsum(routes._legs(lat, lon))])
    d, expected = 0.0, []
    while d <= along[-1]:
        i = next(k for k in range(len(lat) - 1) if along[k + 1] >= d or k == len(lat) - 2)
        t = (d - along[i]) / (along[i + 1] - along[i])
        expected.append((lat[i] + t * (lat[i + 1] - lat[i]), lon[i] + t * (lon[i + 1] - lon[i])))
        d += routes.STEP_M
    assert len(y) - len(expected) in (0, 1)
    assert np.allclose(np.column_stack([y, x])[: len(expected)], expected, atol=1e-12)
    assert len(routes.resample(np.array([1.0, 1.0]), np.array([2.0, 2.0]))[0]) == 2


def test_lane_offset():
    none = np.array([])
    assert len(routes.lane_offset(none, none)[0]) == 0
    assert routes.lane_offset(np.array([40.0]), np.array([-74.0]))[0].tolist() == [40.0]
    y, x = routes.lane_offset(np.array([40.0, 40.01]), np.array([-74.0, -74.0]))
    assert np.allclose(y, [40.0, 40.01], atol=1e-6) and (x > -74).all() and (x < -73.999).all()


def corridor(spark, *lines, direction="north"):
    return spark.createDataFrame([(7, "I-95", direction, list(lines))], "corridor_id int, highway string, canonical_direction string, lines array<array<struct<lat:double,lon:double>>>")


def test_routes_are_measured_ranked_and_named(spark):
    line = [(40.0 + 0.01 * i, -75.0) for i in range(80)]
    tiny = [(45.0, -75.0), (45.001, -75.0)]
    row = routes.reference_routes(corridor(spark, line[::-1], tiny)).first()
    assert (row.direction_code, row.display_name, row.variant_rank) == ("NB", "I-95 Northbound", 1)
    assert row.start_lat < row.end_lat and row.distance_m == pytest.approx(79 * 1111.949, rel=1e-3)
    assert row.point_count == len(row.lines[0]) and row.duration_s == row.point_count * 5 and len(row.lines) == 1
    assert row.id == routes.route_id("I-95", "NB", 7, row.waypoints_json) == routes.reference_routes(corridor(spark, line[::-1], tiny)).first().id
    anchors = routes.route_anchors(routes.reference_routes(corridor(spark, line))).orderBy("anchor_index").collect()
    assert [a.anchor_index for a in anchors] == sorted({*range(0, row.point_count, 40), row.point_count - 1})
    assert routes.reference_routes(corridor(spark, line[:30])).count() == 0
    assert routes.waypoints_json([[[40.0, -75.5]]]) == "[[40.0,-75.5]]"


def test_geojson_round_trip_and_gaps(spark):
    df = corridor(spark, [(40.0, -75.0), (40.5, -75.25)], [(1.0, 2.0), (3.0, 4.0)])
    text = df.select(routes.lines_geojson(F.col("lines")).alias("t"))
    assert text.first().t == '{"type":"MultiLineString","coordinates":[[[-75.0,40.0],[-75.25,40.5]],[[2.0,1.0],[4.0,3.0]]]}'
    assert text.select(routes.parse_lines(F.col("t")).alias("l")).first().l == df.first().lines
    odd = spark.createDataFrame([('{"type":"LineString","coordinates":[[1,2],[3,4]]}',), ("nonsense",), ('{"type":"Point","coordinates":[1,2]}',)], "t string")
    assert [len(r.l or []) for r in odd.select(routes.parse_lines(F.col("t")).alias("l")).collect()] == [1, 0, 0]
    gap = corridor(spark, [(40.0, -75.0), (40.01, -75.0), (41.0, -75.0), (41.01, -75.0)]).select(routes.split_gaps(F.get("lines", F.lit(0))).alias("s")).first().s
    assert [len(p) for p in gap] == [2, 2]
    east = corridor(spark, [(40.0, -75.0), (40.0, -75.0)]).select(routes.oriented(F.get("lines", F.lit(0)), F.lit("EB")).alias("o")).first().o
    assert len(east) == 2


# ---------------------------------------------------------------- projection


def test_rest_areas_conflict_with_the_other_direction_only(spark):
    candidates = spark.createDataFrame([("e", p, "restArea") for p in ("a", "b", "c", "d")] + [("e", "a2", "gas")], "exit_id string, poi_id string, category string")
    labels = spark.createDataFrame([("a", "i-80 eastbound rest"), ("b", "westbound"), ("c", "eb and wb plaza"), ("d", "northbound"), ("a2", "eastbound gas")], "poi_id string, label string")
    going = spark.createDataFrame([("e", "W")], "exit_id string, direction string")
    got = sorted(r.poi_id for r in projection.prune_directional_conflicts(candidates, labels, going).collect())
    assert got == ["a2", "b", "c", "d"]


def test_ranks_keep_their_gaps(spark):
    exits_ = spark.createDataFrame([("e", 40.0, -75.0)], "exit_id string, lat double, lon double")
    places = spark.createDataFrame([(f"p{k:02}", "gas" if k < 15 else "park", 40.0 + 0.0006 * (k % 15), -75.0) for k in range(30)] + [("none", None, 40.0, -75.0)], "poi_id string, category string, plat double, plon double")
    got = projection.exit_place_candidates(exits_, places).collect()
    gas = sorted((r.rank, r.distance_m) for r in got if r.category == "gas")
    assert [r for r, _ in gas] == list(range(1, 13)) and all(m <= 800 for _, m in gas)
    assert len([r for r in got if r.category == "park"]) == 12


def test_exploded_sides_are_not_broadcast(spark):
    points = spark.createDataFrame([(1, 40.0, -75.0)], "node_id long, lat double, lon double")
    legs = spark.createDataFrame([(1, 40.0, -75.0, 40.001, -75.0)], "way_id long, alat double, alon double, blat double, blon double")
    other = points.toDF("b", "y", "x")
    for joined in (spatial.segment_join(points, legs, 0.001, ("lat", "lon")), spatial.range_join(points, other, 0.01, ("lat", "lon"), ("y", "x"))):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert joined.count() == 1


def test_exits_and_places_at_one_place_are_paired_once(spark):
    rng = np.random.default_rng(4)
    grid = lambda: (40.0 + int(rng.integers(8)) * 0.002, -75.0 + int(rng.integers(8)) * 0.002)
    stops = [(k, *grid()) for k in range(90)]
    spots = [(k, [None, "food", "gas"][k % 3], *grid()) for k in range(300)] + [(7, "food", 40.0, -75.0)] * 2
    a, b = spark.createDataFrame(stops, "exit_id long, lat double, lon double"), spark.createDataFrame(spots, "poi_id long, category string, plat double, plon double")
    found = projection.exit_place_candidates(a, b, open_categories=("gas",), most=5)
    a.createOrReplaceTempView("stops"), b.createOrReplaceTempView("spots")
    pairs = a.crossJoin(b).where("abs(lat - plat) <= 0.024 and abs(lon - plon) <= 0.024").withColumn("m", projection.geo.spheroid_m(*map(F.col, ("lat", "lon", "plat", "plon")))).where("m <= 1600")
    ranked = pairs.selectExpr("*", "row_number() over (partition by exit_id, category order by sqrt((plat - lat) * (plat - lat) + (plon - lon) * (plon - lon)), poi_id) as rank").where("rank <= 5 and (category = 'gas' or rint(m) <= 800)")
    plain = ranked.selectExpr("exit_id", "poi_id", "category", "cast(rint(m) as int) as distance_m", "rank")
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, found.collect())) == sorted(map(key, plain.collect()))

    def window_input(df):
        return "Window [row_number" in df._jdf.queryExecution().optimizedPlan().toString() and "Aggregate [lat" in df._jdf.queryExecution().optimizedPlan().toString()

    assert window_input(found), "ranks are made by place, not by exit"


@pytest.mark.parametrize("lat", [0.0, 40.0, 75.0, -89.99])
def test_closed_categories_are_ranked_the_same_when_far_places_go_first(spark, lat):
    """Against all pairs, with places so dense that both the rank and near_m cut, and far ones nearer in degrees."""
    rng = np.random.default_rng(9)
    across = 0.024 / max(np.cos(np.radians(lat)), 0.5)
    spot = lambda: (float(lat + rng.uniform(-0.012, 0.012)), float(-75 + rng.uniform(-across, across)))
    a = spark.createDataFrame([(k, *spot()) for k in range(12)], "exit_id long, lat double, lon double")
    b = spark.createDataFrame([(k, [None, "food", "gas", "park"][k % 4], *spot()) for k in range(600)], "poi_id long, category string, plat double, plon double")
    pairs = a.crossJoin(b).where("abs(lat - plat) <= 0.024 and abs(lon - plon) <= 0.024").withColumn("m", projection.geo.spheroid_m(*map(F.col, ("lat", "lon", "plat", "plon")))).where("m <= 1600")
    ranked = pairs.selectExpr("*", "row_number() over (partition by exit_id, category order by sqrt((plat - lat) * (plat - lat) + (plon - lon) * (plon - lon)), poi_id) as rank").where("rank <= 12 and (category = 'park' or rint(m) <= 800)")
    plain = ranked.selectExpr("exit_id", "poi_id", "category", "cast(rint(m) as int) as distance_m", "rank")
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, projection.exit_place_candidates(a, b).collect())) == sorted(map(key, plain.collect())) != []


def test_links_stay_lists_until_their_exits_are_sorted(spark, sf_dir):
    rng = np.random.default_rng(3)
    spot = lambda: (40.0 + int(rng.integers(6)) * 0.003, -75.0 + int(rng.integers(6)) * 0.003)
    stops = spark.createDataFrame([(f"node/{k}", *spot()) for k in range(40)], "exit_id string, lat double, lon double")
    places = spark.createDataFrame([(f"p{k}", ["food", "gas", "park"][k % 3], *spot()) for k in range(120)], "poi_id string, category string, plat double, plon double")
    held = spark.createDataFrame([(1, "I-5"), (2, "I-10"), (3, "US-1")], "corridor_id int, highway string")
    on = spark.createDataFrame([(c, f"node/{k}") for k in range(40) for c in (1, 2, 3) if k % 5 and ((k + c) % 3 or k % 4 == 0)], "corridor_id int, exit_id string")
    links = projection.exit_place_candidates(stops, places)
    times = {}
    for r in on.where("corridor_id < 3").collect():
        times[r.exit_id] = times.get(r.exit_id, 0) + 1
    once = sorted(tuple(r) for r in links.collect() if r.exit_id in times)
    plain = [r for r in once for _ in range(times[r[0]])]
    assert set(times.values()) == {1, 2} and len(times) < 40
    flat = export.exit_place_links(held, on, links)
    lists = export.place_links(projection.exit_place_lists(stops.join(export.linked_exits(held, on), "exit_id"), places))
    assert [tuple(r) for r in flat.collect()] == [tuple(r) for r in lists.collect()] == plain
    assert [tuple(r) for r in export.exit_place_links(held, on, links, dedupe=True).collect()] == once
    for df in (flat, lists, queries.queries()["exit_place_links"](spark, sf_dir)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Generate explode") < plan.index("Sort [exit_id"), "exits are sorted, then their links exploded"


def test_expansion_does_not_pair_all_ways_of_a_ref_with_all_its_corridors(spark):
    rows = [way(k, [k, k + 1], ["I-95"]) for k in range(200)]
    ways = ways_df(spark, *rows)
    assigned = spark.createDataFrame([(c, c) for c in range(100)], "corridor_id int, node long")
    names = spark.createDataFrame([(c, "I-95") for c in range(100)], "corridor_id int, highway string")
    found = exits.expand_nodes(assigned, ways, names)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line and "highway#" in line]
    assert joins and all("node#" in line for line in joins), "refs are joined by node as well"
    assert {r.node for r in found.where("corridor_id = 50").collect()} == {49, 50, 51}
