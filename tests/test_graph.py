"""Graph metrics against plain-Python brute force on small random graphs."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from harborline.operators import graph


def frames(spark, nodes, edges):
    v = spark.createDataFrame([(n, "x") for n in nodes], "id string, type string")
    e = spark.createDataFrame(edges, "src string, dst string, weight double")
    return v, e


@pytest.fixture(scope="module")
def random_graph():
    rng = random.Random(7)
    nodes = [f"n{i:02d}" for i in range(40)]
    edges = [(a, b, float(rng.randint(0, 9))) for a in nodes for b in nodes if a != b and rng.random() < 0.04]
    # A hub with a third of all edges, and a parallel edge.
    edges += [("n00", b, 5.0) for b in nodes[1:20]] + [("n00", "n01", 2.0)]
    return nodes, edges


def test_hops(spark, random_graph):
    nodes, edges = random_graph
    v, e = frames(spark, nodes, edges)
    for direction in ("from", "to"):
        step = {}
        for a, b, _ in edges:
            a, b = (a, b) if direction == "from" else (b, a)
            step.setdefault(a, set()).add(b)
        dist, queue = {"n03": 0}, deque(["n03"])
        while queue:
            n = queue.popleft()
            for m in step.get(n, ()):
                if m not in dist:
                    dist[m] = dist[n] + 1
                    queue.append(m)
        got = {r.node_id: r.hops for r in graph.hops(e, v, "n03", direction, spread=12).collect()}
        assert got == {n: dist.get(n) for n in nodes}


def test_landmark_maps(spark, random_graph):
    nodes, edges = random_graph
    v, e = frames(spark, nodes, edges)
    rows = {r.node_id: r.distances for r in graph.landmark_hops(e, v, ["n00", "n03"]).collect()}
    for mark in ("n00", "n03"):
        single = {r.node_id: r.hops for r in graph.hops(e, v, mark, "to").collect()}
        assert {n: d.get(mark) for n, d in rows.items()} == single


def test_cheapest_paths(spark, random_graph):
    nodes, edges = random_graph
    _, e = frames(spark, nodes, edges)
    best = {"n00": (0.0, 0)}
    for _ in nodes:
        for a, b, w in edges:
            if a in best:
                offer = (best[a][0] + w, best[a][1] + 1)
                if b not in best or offer < best[b]:
                    best[b] = offer
    rows = {r.node_id: r for r in graph.cheapest_paths(e, "n00", spread=20).collect()}
    assert {n: (r.cost, r.hops) for n, r in rows.items()} == best
    weights = {}
    for a, b, w in edges:
        weights[a, b] = min(w, weights.get((a, b), w))
    for n, r in rows.items():
        steps = 0
        while n != "n00":
            n, steps = rows[n].previous, steps + 1
        assert steps == r.hops


def test_hops_never_exceed_path_edges(spark, random_graph):
    nodes, edges = random_graph
    v, e = frames(spark, nodes, edges)
    fewest = {r.node_id: r.hops for r in graph.hops(e, v, "n00").collect()}
    for r in graph.cheapest_paths(e, "n00").collect():
        assert fewest[r.node_id] <= r.hops


def test_pagerank(spark, random_graph):
    nodes, edges = random_graph
    v, e = frames(spark, nodes, edges)
    rank = {n: 1 / len(nodes) for n in nodes}
    out = {}
    for a, b, _ in edges:
        out.setdefault(a, []).append(b)
    change = 1.0
    while change > 1e-15:
        idle = sum(r for n, r in rank.items() if n not in out)
        new = {n: 0.15 / len(nodes) + 0.85 * idle / len(nodes) for n in nodes}
        for a, targets in out.items():
            for b in targets:
                new[b] += 0.85 * rank[a] / len(targets)
        change = sum(abs(new[n] - rank[n]) for n in nodes)
        rank = new
    got = {r.node_id: r.pagerank for r in graph.pagerank(e, v, 1e-13, spread=20).collect()}
    assert got == pytest.approx(rank, abs=1e-12)
    assert sum(got.values()) == pytest.approx(1.0)


def plain_components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_sparse_graphs(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{i:03d}" for i in range(120)]
    pairs = [tuple(rng.sample(nodes, 2)) for _ in range(70)] + [("n005", "n005")]
    v, e = frames(spark, nodes, [(a, b, 1.0) for a, b in pairs])
    got = {r.node_id: r.component for r in graph.components(e, v).collect()}
    expected = plain_components(nodes, pairs)
    assert got == expected and len(set(got.values())) > 5


def test_components_of_a_chain_and_a_star(spark):
    chain = [(f"c{i:02d}", f"c{i + 1:02d}") for i in range(16)]
    star = [("s99", f"s{i:02d}") for i in range(60)]
    nodes = sorted({n for p in chain + star for n in p}) + ["alone"]
    v, e = frames(spark, nodes, [(a, b, 1.0) for a, b in chain + star])
    got = {r.node_id: r.component for r in graph.components(e, v).collect()}
    assert got == plain_components(nodes, chain + star)
    assert set(got.values()) == {"c00", "s00", "alone"}


def test_components_with_a_hub(spark):
    star = [("n50", f"n{i:02d}") for i in range(100) if i != 50]
    v, e = frames(spark, [f"n{i:02d}" for i in range(100)], [(a, b, 1.0) for a, b in star])
    assert {r.component for r in graph.components(e, v).collect()} == {"n00"}


def test_edges_are_not_shuffled_again_in_a_round(spark, random_graph):
    nodes, edges = random_graph
    _, e = frames(spark, nodes, edges)
    links = e.select(F.col("src").alias("node_id"), F.col("dst").alias("next"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for spread in (20, 1):
            with graph._placed(links, spread) as placed:
                assert placed.hubs.isEmpty() == (spread == 1)
                joined = placed.expand(links.select("node_id").distinct())
                assert joined.count() == len(edges)
                joined.collect()
                final = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
                before_links = final[:final.index("InMemoryTableScan")]
                links_side = before_links[before_links.rindex("SortMergeJoin"):].splitlines()[-4:]
                assert not any("Exchange" in line for line in links_side)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_routes_of_a_long_chain_and_of_a_random_graph(spark, random_graph):
    chain = [(f"c{i:02d}", f"c{i + 1:02d}", 1.0) for i in range(40)]
    _, e = frames(spark, [], chain)
    routes = {r.node_id: r.route for r in graph.route_nodes(graph.cheapest_paths(e, "c00")).collect()}
    assert routes["c40"] == [f"c{i:02d}" for i in range(41)] and routes["c00"] == ["c00"]
    _, e = frames(spark, *random_graph)
    paths = graph.cheapest_paths(e, "n00")
    before, cost = ({r.node_id: r[c] for r in paths.collect()} for c in ("previous", "cost"))
    least = {}
    for a, b, w in random_graph[1]:
        least[a, b] = min(w, least.get((a, b), w))
    for r in graph.route_nodes(paths).collect():
        assert r.route[-1] == r.node_id and r.route[0] == "n00"
        assert [before[n] for n in r.route[1:]] == r.route[:-1]
        assert sum(least[p] for p in zip(r.route, r.route[1:])) == pytest.approx(cost[r.node_id])


def test_pareto_fronts_equal_brute_force(spark):
    rng = random.Random(3)
    nodes = [f"n{i}" for i in range(7)]
    times = [rng.randint(1, 9) for _ in range(18)]  # what is fast has more risk
    edges = [(*rng.sample(nodes, 2), float(t), float(10 - t + t % 2)) for t in times] + [("n0", "n1", 2.0, 2.0)] * 2
    sums = {n: set() for n in nodes}

    def walk(at, seen, first, second):
        sums[at].add((first, second))
        for a, b, w, r in edges:
            if a == at and b not in seen:
                walk(b, seen | {b}, first + w, second + r)

    walk("n0", {"n0"}, 0.0, 0.0)
    want = {(n, *x) for n, all_ in sums.items() for x in all_ if not any(y != x and y[0] <= x[0] and y[1] <= x[1] for y in all_)}
    e = spark.createDataFrame(edges, "src string, dst string, weight double, risk double")
    got = graph.pareto_paths(e, "n0", spread=20).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) > len({r.node_id for r in got})


def test_unknown_direction(spark, random_graph):
    v, e = frames(spark, *random_graph)
    with pytest.raises(ValueError):
        graph.hops(e, v, "n00", "sideways")


def test_safety_cost(spark):
    df = spark.createDataFrame([(10.0, 0.5)], "t double, r double")
    row = graph.with_risk_path_cost(df, F.col("t"), F.col("r"), risk_weight=0.5).first()
    assert row.safety_cost == 5.25
