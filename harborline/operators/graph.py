"""Graph metrics by repeated joins over an edge table ``src, dst, weight``.

Every round is checkpointed to the shared folder, so plans stay short and a lost executor costs one
round at most. Rounds go on until nothing changes; there is no cap that could cut results short.

The edges are by far the largest input. They are shuffled once, by source node, and stay where they are;
each round moves only node rows to them. A node with more edges than an even share of the shuffle partitions
is split into parts of that size, so a hub that holds a third of all edges still spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from harborline.functions.skew import lookup
from harborline.session import cut_lineage, written

_COMPACT_EVERY = 8
_HISTORY = 6


def _width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


@dataclass(frozen=True)
class _Placed:
    """Links ``node_id, part, ...`` partitioned by node and part, and the number of parts of the nodes that are split."""

    links: DataFrame
    hubs: DataFrame

    def expand(self, nodes: DataFrame) -> DataFrame:
        """Node rows joined with all their links. Only the node rows are shuffled."""
        last = F.coalesce("parts", F.lit(1)) - 1
        # Fewer nodes than parts can each hold more than an even share of the links.
        copies = nodes.join(F.broadcast(self.hubs), "node_id", "left").withColumn("part", F.explode(F.sequence(F.lit(0), last)))
        return copies.drop("parts").join(self.links, ["node_id", "part"]).drop("part")


@contextmanager
def _placed(links: DataFrame, spread: int | None = None) -> Iterator[_Placed]:
    """Keep links partitioned by node, and by part for nodes with more than one ``spread``-th of them (default: shuffle partitions).

    The copy is held on executor disks while the rounds run. It is derived from a checkpoint, so blocks
    lost with an executor are rebuilt from there.
    """
    links = cut_lineage(links)
    width = _width(links)
    share = links.agg(F.count("*") / F.lit(spread or width)).scalar()
    counts = links.groupBy("node_id").agg(F.count("*").alias("rows")).withColumn("share", share)
    hubs = cut_lineage(counts.filter(F.col("rows") > F.col("share")).select("node_id", F.ceil(F.col("rows") / F.col("share")).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64(*[c for c in links.columns if c != "node_id"]), F.coalesce("parts", F.lit(1)))
    placed = (
        links.join(F.broadcast(hubs), "node_id", "left").withColumn("part", part.cast("int")).drop("parts")
        .repartition(width, "node_id", "part").persist(StorageLevel.DISK_ONLY)
    )
    try:
        yield _Placed(placed, hubs)
    finally:
        placed.unpersist()


def degrees(edges: DataFrame) -> DataFrame:
    """In plus out degree per connected node."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node_id"))
    return ends.groupBy("node_id").agg(F.count("*").alias("degree"))


def centrality(edges: DataFrame, vertices: DataFrame, critical_from: int = 2) -> DataFrame:
    """Degree with node type and criticality; isolated nodes do not appear."""
    types = vertices.select(F.col("id").alias("node_id"), F.col("type").alias("node_type"))
    level = F.when(F.col("degree") >= critical_from, "NODO_CRITICO").otherwise("NODO_NORMAL")
    return degrees(edges).join(types, "node_id", "left").select(
        "node_id", "node_type", "degree", level.alias("criticality_level")
    )


def top_nodes(ranked: DataFrame, limit: int = 20) -> DataFrame:
    """Nodes with the most links first."""
    return ranked.orderBy(F.col("degree").desc(), "node_id").limit(limit)


def hops(edges: DataFrame, vertices: DataFrame, landmark: str, direction: str = "from", spread: int | None = None) -> DataFrame:
    """Fewest edges between the landmark and every vertex; null when there is no path.

    ``from`` counts along the edges away from the landmark, ``to`` towards it.
    """
    reached = _breadth_first(edges, vertices, [landmark], direction, spread).drop("landmark")
    return vertices.select(F.col("id").alias("node_id"), F.col("type").alias("node_type")).join(reached, "node_id", "left")


def landmark_hops(edges: DataFrame, vertices: DataFrame, landmarks: Sequence[str], direction: str = "to",
                  spread: int | None = None) -> DataFrame:
    """``distances`` map per vertex, from landmark to fewest edges; landmarks without a path are absent.

    All landmarks share the same rounds. A map holds one entry per landmark at most.
    """
    reached = _breadth_first(edges, vertices, landmarks, direction, spread)
    maps = reached.groupBy("node_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("landmark", "hops")))).alias("distances")
    )
    empty = F.create_map().cast("map<string,int>")
    return (
        vertices.select(F.col("id").alias("node_id"), F.col("type").alias("node_type"))
        .join(maps, "node_id", "left")
        .withColumn("distances", F.coalesce("distances", empty))
    )


def _breadth_first(edges: DataFrame, vertices: DataFrame, landmarks: Sequence[str], direction: str, spread: int | None) -> DataFrame:
    """``node_id, landmark, hops`` for every vertex that has a path."""
    if direction not in ("from", "to"):
        raise ValueError(f"unknown direction {direction!r}")
    here, there = ("src", "dst") if direction == "from" else ("dst", "src")
    links = edges.select(F.col(here).alias("node_id"), F.col(there).alias("next")).distinct()
    key = ["node_id", "landmark"]
    with _placed(links, spread) as placed:
        start = vertices.filter(F.col("id").isin(*landmarks))
        seen = cut_lineage(start.select(F.col("id").alias("node_id"), F.col("id").alias("landmark"), F.lit(0).alias("hops")))
        frontier, step = seen, 0
        while True:
            step += 1
            reached = placed.expand(frontier.select(*key)).select(F.col("next").alias("node_id"), "landmark").distinct()
            frontier = cut_lineage(reached.join(seen, key, "left_anti").withColumn("hops", F.lit(step)))
            if frontier.isEmpty():
                return seen
            seen = seen.unionByName(frontier)
            if step % _COMPACT_EVERY == 0:
                seen = cut_lineage(seen)


def cheapest_paths(edges: DataFrame, source: str, cost: str = "weight", spread: int | None = None) -> DataFrame:
    """Lowest total cost from ``source`` to every reachable node: ``node_id, cost, hops, previous``.

    Of equally cheap paths the one with fewest edges counts, then the smallest previous node, so the
    result does not depend on the order of rounds. Only nodes that improved in the last round are
    expanded. Costs must not be negative.
    """
    # Of parallel edges only the cheapest can matter.
    links = (
        edges.filter(F.col(cost).isNotNull())
        .groupBy(F.col("src").alias("node_id"), F.col("dst").alias("next")).agg(F.min(cost).alias("cost"))
    )

    def label(total: Column, hops: Column, previous: Column) -> Column:
        return F.struct(total.alias("cost"), hops.alias("hops"), previous.alias("previous")).alias("label")

    with _placed(links, spread) as placed:
        start = label(F.lit(0.0), F.lit(0), F.lit(None).cast("string"))
        best = cut_lineage(edges.sparkSession.range(1).select(F.lit(source).alias("node_id"), start))
        frontier = best
        while True:
            # The smallest label of a node is picked before the shuffle, so a hub sends few rows.
            offers = (
                placed.expand(frontier)
                .select("next", label(F.col("label.cost") + F.col("cost"), F.col("label.hops") + 1, F.col("node_id")))
                .groupBy(F.col("next").alias("node_id"))
                .agg(F.min("label").alias("label"))
            )
            improved = cut_lineage(
                offers.join(best.select("node_id", F.col("label").alias("known")), "node_id", "left")
                .filter(F.col("known").isNull() | (F.col("label") < F.col("known")))
                .drop("known")
            )
            if improved.isEmpty():
                return best.select("node_id", "label.cost", "label.hops", "label.previous")
            best = cut_lineage(best.join(improved, "node_id", "left_anti").unionByName(improved))
            frontier = improved


def _mixture(products: list[list[float]]) -> list[float]:
    """Weights that sum to one and make the weighted sum of the residuals shortest, from the products of the residuals."""
    gram = np.array(products)
    n = len(gram)
    scale = max(gram.diagonal().max(), 1e-300)
    system = np.block([[gram / scale, np.ones((n, 1))], [np.ones((1, n)), np.zeros((1, 1))]])
    return np.linalg.lstsq(system, np.append(np.zeros(n), 1.0), rcond=1e-14)[0][:n].tolist()


def pagerank(edges: DataFrame, vertices: DataFrame, tolerance: float = 1e-10, damping: float = 0.85,
             spread: int | None = None) -> DataFrame:
    """PageRank that sums to one; rank of nodes without out-edges is spread over all nodes.

    Every round applies the step to a mixture of the last rounds' results, the one whose residual is shortest (Anderson
    acceleration). It goes on until a step changes the ranks of all nodes together by no more than ``tolerance``. A round is
    one job: what the mixture needs, some twenty sums, is observed while the ranks are written.
    """
    # One row per distinct pair keeps parallel edges as a factor instead of as repeated rows.
    pairs = edges.groupBy(F.col("src").alias("node_id"), F.col("dst").alias("next")).agg(F.count("*").alias("times"))
    nodes = vertices.select(F.col("id").alias("node_id")).distinct()
    # The number of links travels with the node, so the edges never meet a table of degrees.
    out = edges.groupBy(F.col("src").alias("node_id")).agg(F.count("*").alias("links"))
    with _placed(pairs, spread) as placed:
        state = cut_lineage(nodes.join(out, "node_id", "left"))
        total, idle_nodes = state.agg(F.count("*"), F.count("*") - F.count("links")).first()
        if not total:
            return state.select("node_id", F.lit(None).cast("double").alias("pagerank"))
        start = F.array(F.lit(1.0 / total))
        state = state.withColumns({"made": start, "residual": F.array(F.lit(0.0))})
        weights, idle, change = [1.0], [idle_nodes / total], None
        least, since = float("inf"), 0
        # What rounding allows is reached when many rounds bring nothing more.
        while change is None or (change > tolerance and since < 2 * _HISTORY):
            rank = sum((F.col("made")[i] * F.lit(w) for i, w in enumerate(weights)), F.lit(0.0))
            state = state.withColumn("rank", rank)
            received = (
                placed.expand(state.filter(F.col("links") > 0).select("node_id", "rank", "links"))
                .groupBy(F.col("next").alias("node_id"))
                .agg(F.sum(F.col("rank") * (F.col("times") / F.col("links"))).alias("received"))
            )
            base = (1.0 - damping) / total + damping * sum(w * x for w, x in zip(weights, idle)) / total
            step = F.lit(base) + F.lit(damping) * F.coalesce("received", F.lit(0.0))
            kept = len(weights) if change is not None else 0
            state = state.join(received, "node_id", "left").withColumn("step", step).select(
                "node_id", "links", F.concat(F.array("step"), F.slice("made", 1, min(kept, _HISTORY - 1))).alias("made"),
                F.concat(F.array(F.col("step") - F.col("rank")), F.slice("residual", 1, min(kept, _HISTORY - 1))).alias("residual"),
            )
            n = min(kept, _HISTORY - 1) + 1
            seen = Observation()
            state = written(state.observe(
                seen, F.sum(F.abs(F.col("residual")[0])).alias("change"),
                *[F.sum(F.col("residual")[i] * F.col("residual")[k]).alias(f"p{i}_{k}") for i in range(n) for k in range(i + 1)],
                *[F.sum(F.when(F.col("links").isNull(), F.col("made")[i])).alias(f"idle{i}") for i in range(n)],
            ))
            sums = seen.get
            change = sums["change"]
            least, since = (change, 0) if change < least else (least, since + 1)
            weights = _mixture([[sums[f"p{max(i, k)}_{min(i, k)}"] for k in range(n)] for i in range(n)])
            idle = [sums[f"idle{i}"] or 0.0 for i in range(n)]
    return state.select("node_id", F.col("made")[0].alias("pagerank"))


def _with_root(links: DataFrame, roots: DataFrame) -> DataFrame:
    """Links ``high, low`` with the root of ``high``, however many links a node has."""
    return lookup(links, roots, "high", "rows", ["high", "low"])


def components(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Connected components, labelled with the smallest node id, ignoring edge direction.

    Alternating large-star and small-star rounds: the number of rounds grows with the logarithm of
    the graph size. A node with very many neighbours is handled by the skew-safe lookup.
    """
    links = cut_lineage(
        edges.filter(F.col("src") != F.col("dst"))
        .select(F.greatest("src", "dst").alias("high"), F.least("src", "dst").alias("low"))
        .distinct()
    )
    while True:
        both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
        smallest = cut_lineage(
            both.groupBy("high").agg(F.min(F.least("high", "low")).alias("root"), F.count("*").alias("rows"))
        )
        large = cut_lineage(
            _with_root(both, smallest)
            .filter(F.col("low") > F.col("high"))
            .select(F.col("low").alias("high"), F.col("root").alias("low"))
            .distinct()
        )
        roots = cut_lineage(large.groupBy("high").agg(F.min("low").alias("root"), F.count("*").alias("rows")))
        # Neighbours other than the root hang under it, and the node itself as well.
        hung = _with_root(large, roots).filter(F.col("low") != F.col("root")).select(
            F.col("low").alias("high"), F.col("root").alias("low")
        )
        new = cut_lineage(
            hung.unionByName(roots.select("high", F.col("root").alias("low"))).distinct()
        )
        stable = new.join(links, ["high", "low"], "left_anti").isEmpty() and links.join(
            new, ["high", "low"], "left_anti"
        ).isEmpty()
        links = new
        if stable:
            break
    labels = links.groupBy(F.col("high").alias("node_id")).agg(F.min("low").alias("component"))
    return (
        vertices.select(F.col("id").alias("node_id"))
        .join(labels, "node_id", "left")
        .select("node_id", F.coalesce("component", "node_id").alias("component"))
    )


def with_risk_path_cost(edges: DataFrame, time: Column, risk: Column, risk_weight: float = 1.0) -> DataFrame:
    """Edges with a ``safety_cost`` that trades time for risk, for use as a path cost."""
    return edges.withColumn("safety_cost", risk * F.lit(risk_weight) + time * F.lit(1.0 - risk_weight))


def route_nodes(paths: DataFrame) -> DataFrame:
    """``node_id, route``: the nodes of the cheapest route to every node, in order, from :func:`cheapest_paths`.

    Every round doubles the stretch of the route that a node knows, so a route of n nodes takes log n rounds.
    """
    known = cut_lineage(paths.select("node_id", F.col("previous").alias("up"), F.array("node_id").alias("route")))
    while not known.filter("up is not null").isEmpty():
        ahead = known.select(F.col("node_id").alias("up"), F.col("up").alias("_up"), F.col("route").alias("_route"))
        # Both sides are shuffled for this join, so adaptive execution splits the rows of a frequent predecessor.
        known = cut_lineage(
            known.join(ahead, "up", "left").select(
                "node_id", F.col("_up").alias("up"), F.concat(F.coalesce("_route", F.array().cast("array<string>")), "route").alias("route"),
            )
        )
    return known.select("node_id", "route")


def pareto_paths(edges: DataFrame, source: str, first: str = "weight", second: str = "risk", spread: int | None = None) -> DataFrame:
    """``node_id, first, second``: for every node all sums of two costs that no other route from ``source`` beats in both.

    Rounds extend the labels that are new; of a node's labels only those stay that no other one dominates. Costs must
    not be negative. Sums are compared at nine digits.
    """
    links = edges.filter(F.col(first).isNotNull() & F.col(second).isNotNull()).select(
        F.col("src").alias("node_id"), F.col("dst").alias("next"), F.col(first).alias("_first"), F.col(second).alias("_second"),
    )
    labels = ["node_id", "first", "second"]

    def undominated(rows: DataFrame) -> DataFrame:
        """In order of the first cost, a label stays if it has less of the second than all before it."""
        before = Window.partitionBy("node_id").orderBy("first", "second").rowsBetween(Window.unboundedPreceding, -1)
        least = rows.withColumn("_least", F.min("second").over(before))
        return least.filter(F.col("_least").isNull() | (F.col("second") < F.col("_least"))).drop("_least")

    with _placed(links, spread) as placed:
        zero = F.lit(0.0)
        front = cut_lineage(edges.sparkSession.range(1).select(F.lit(source).alias("node_id"), zero.alias("first"), zero.alias("second")))
        new = front
        while True:
            sums = [F.round(F.col("first") + F.col("_first"), 9).alias("first"), F.round(F.col("second") + F.col("_second"), 9).alias("second")]
            offers = placed.expand(new).select(F.col("next").alias("node_id"), *sums).groupBy(*labels).agg(F.lit(1).alias("offered"))
            both = front.withColumn("offered", F.lit(0)).unionByName(offers).groupBy(*labels).agg(F.min("offered").alias("offered"))
            both = cut_lineage(undominated(both))
            front, new = both.select(*labels), both.filter("offered = 1").select(*labels)
            if new.isEmpty():
                return front
