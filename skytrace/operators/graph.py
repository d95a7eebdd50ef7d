"""Components and reachability over edge tables ``(src, dst)`` of long ids.

Every round is a few joins and partial aggregations and ends in a reliable checkpoint. No vertex
needs its neighbours in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytrace.operators.lineage import sized as cut


def _is_star_forest(edges: DataFrame) -> bool:
    """Does every node either point to exactly one root or be pointed to, but not both?"""
    roles = edges.select(F.col("src").alias("node"), F.lit(1).alias("out")).unionByName(
        edges.select(F.col("dst").alias("node"), F.lit(0).alias("out"))
    )
    mixed = (
        roles.groupBy("node")
        .agg(F.sum("out").alias("out"), F.min("out").alias("least"))
        .filter((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("least") == 0)))
    )
    return mixed.isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node with an edge; a component is named by its least node.

    Large-star / small-star (Kiveris et al., "Connected Components in MapReduce and Beyond",
    2014): the number of rounds grows with the logarithm of the longest path, not with its length.
    """
    current = cut(
        edges.filter(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("dst"), F.greatest("src", "dst").alias("src"))
        .distinct()
    )
    while not _is_star_forest(current):
        current = cut(_small_star(_large_star(current)))
    members = current.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    roots = current.select(F.col("dst").alias("node"), F.col("dst").alias("component"))
    return members.union(roots.distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    flipped = edges.select(F.col("src").alias("dst"), F.col("dst").alias("src"))
    both = edges.unionByName(flipped)
    least = both.groupBy("src").agg(F.min("dst").alias("least"))
    return (
        both.filter(F.col("dst") > F.col("src"))
        .join(least, "src")
        .select(F.col("dst").alias("src"), F.least("least", "src").alias("dst"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of those neighbours."""
    least = edges.groupBy("src").agg(F.min("dst").alias("least"))
    siblings = (
        edges.join(least, "src")
        .filter(F.col("dst") != F.col("least"))
        .select(F.col("least").alias("dst"), F.col("dst").alias("src"))
    )
    return siblings.union(least.select(F.col("least").alias("dst"), "src")).distinct()


def mutual_pairs(edges: DataFrame) -> DataFrame:
    """Pairs linked in both directions, each once."""
    return (
        edges.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
        .agg(
            F.bool_or(F.col("src") < F.col("dst")).alias("up"),
            F.bool_or(F.col("src") > F.col("dst")).alias("down"),
        )
        .filter("up AND down")
        .select(F.col("a").alias("src"), F.col("b").alias("dst"))
    )


def relabel_edges(edges: DataFrame, components: DataFrame) -> DataFrame:
    """Edges between components; nodes without a component stand for themselves."""
    for end in ("src", "dst"):
        names = components.select(F.col("node").alias(end), F.col("component").alias("_to"))
        edges = edges.join(names, end, "left").withColumn(end, F.coalesce("_to", end)).drop("_to")
    return edges.filter(F.col("src") != F.col("dst")).select("src", "dst").distinct()


def last_seed(edges: DataFrame) -> DataFrame:
    """``(node, seed)`` for the nodes of a directed graph.

    A node is a seed when no smaller node reaches it; its group is the largest seed that does.
    """
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    reach = _propagate(edges, nodes.withColumn("value", F.col("node")), F.min, F.least)
    seeds = reach.select(
        "node", F.when(F.col("value") == F.col("node"), F.col("node")).alias("value")
    )
    return _propagate(edges, seeds, F.max, F.greatest).withColumnRenamed("value", "seed")


def _propagate(edges: DataFrame, values: DataFrame, aggregate, pick) -> DataFrame:
    """Carry values along edges until nothing changes; ``pick`` ignores NULLs.

    Nodes with one predecessor hang below each other in trees. Their way up to the root is gathered
    by pointer doubling, in rounds that grow with the logarithm of its length; only the roots, nodes
    where ways meet, then exchange values. A ring of such nodes has no root: there doubling goes on
    until every node has the value of the whole ring.
    """
    edges = cut(edges.select("src", "dst").distinct())
    above = edges.groupBy("dst").agg(F.count(F.lit(1)).alias("n"), F.min("src").alias("up"))
    parents = above.filter("n = 1").select(F.col("dst").alias("node"), "up")
    # ``value`` covers the way from a node up to, but without, ``up``.
    ways = _gathered(values.join(parents, "node", "left"), pick)
    return _between_roots(edges, ways, aggregate, pick)


def _gathered(ways: DataFrame, pick) -> DataFrame:
    """Pointer doubling over ``(node, value, up)``: ``(node, up, value, open)``.

    In the end ``up`` is the root above a node, or NULL for a root itself, and ``value`` covers the
    way without the root. Open nodes hang on rings: theirs covers all of the way and the ring.
    """
    ways = ways.select("node", "up", "value")
    waiting = None
    while True:
        higher = ways.select(
            F.col("node").alias("up"), F.col("up").alias("next"), F.col("value").alias("rest")
        )
        goes_on = F.col("next").isNotNull()  # else ``up`` is a root, or there is none
        gathered = F.when(goes_on, pick("value", "rest")).otherwise(F.col("value"))
        ways = cut(
            ways.join(higher, "up", "left").select(
                "node",
                F.coalesce("next", "up").alias("up"),
                gathered.alias("value"),
                goes_on.alias("open"),
                (~gathered.eqNullSafe(F.col("value"))).alias("changed"),
            )
        )
        state = ways.agg(F.count_if("open").alias("open"), F.bool_or("changed").alias("changed"))
        found = state.first()
        # Trees have fewer open nodes after each round; what does not shrink hangs on a ring.
        if not found["open"] or (found["open"] == waiting and not found["changed"]):
            return ways.drop("changed")
        waiting = found["open"]
        ways = ways.drop("open", "changed")


def _between_roots(edges: DataFrame, ways: DataFrame, aggregate, pick) -> DataFrame:
    """Finish ``(node, up, value, open)``: what reaches the roots, and from there the trees.

    Open nodes hang on rings and are complete.
    """
    roots = ways.filter("NOT open AND up IS NULL").select("node", "value")
    source = ways.select(
        F.col("node").alias("src"),
        F.when(~F.col("open"), F.coalesce("up", "node")).alias("root"),
        F.when(F.col("open") | F.col("up").isNotNull(), F.col("value")).alias("carried"),
    )
    feeds = cut(
        edges.join(roots.select(F.col("node").alias("dst")), "dst")
        .join(source, "src")
        .groupBy("dst", "root")
        .agg(aggregate("carried").alias("carried"))
    )
    # What trees and rings bring to a root reaches it whatever else does.
    brought = feeds.groupBy(F.col("dst").alias("node")).agg(aggregate("carried").alias("carried"))
    start = roots.join(brought, "node", "left").select("node", pick("value", "carried").alias("value"))
    links = feeds.filter("root IS NOT NULL AND root != dst").select(F.col("root").alias("src"), "dst")
    current = _spread(links, start, aggregate, pick)
    tops = current.withColumnsRenamed({"node": "up", "value": "top"})
    trees = (
        ways.filter("NOT open AND up IS NOT NULL")
        .join(tops, "up")
        .select("node", pick("value", "top").alias("value"))
    )
    rings = ways.filter("open").select("node", "value")
    return current.unionByName(trees).unionByName(rings)


def _spread(links: DataFrame, values: DataFrame, aggregate, pick) -> DataFrame:
    """``(node, value)``: the pick over a node and all that reach it over ``links``.

    Every round all links hand on their values; then each node follows the predecessor with the best
    value, of equal ones the first, up a forest whose ways are gathered by pointer doubling. So a value
    runs the length of a way in one round where the best predecessors lead along it, and one link
    further at least. Rings need no care: going round one twice changes nothing.
    """
    current = values
    while not links.isEmpty():
        arriving = (
            links.join(current.withColumnsRenamed({"node": "src"}), "src")
            .groupBy(F.col("dst").alias("node"))
            .agg(
                aggregate("value").alias("arrived"),
                aggregate(F.struct(F.col("value"), F.col("src"))).alias("best"),
            )
        )
        together = pick("value", "arrived")
        handed = cut(
            current.join(arriving, "node", "left").select(
                "node",
                together.alias("value"),
                F.col("best.src").alias("up"),
                (~together.eqNullSafe(F.col("value"))).alias("changed"),
            )
        )
        current = handed.select("node", "value")
        if handed.filter("changed").isEmpty():
            return current
        ways = _gathered(handed.drop("changed"), pick)
        tops = ways.filter("NOT open AND up IS NULL").select(
            F.col("node").alias("up"), F.col("value").alias("top")
        )
        best = F.when(F.col("open"), F.col("value")).otherwise(pick("value", "top"))
        current = ways.join(tops, "up", "left").select("node", best.alias("value"))
    return cut(current)
