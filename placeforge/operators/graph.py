"""Graph operators over edge tables (child, parent).

Each is a driver loop of joins: only what changed in the last round (the frontier) meets the edges again, and
each round's rows are written to the shared folder, so the lineage stays flat. Loops stop with an error after
`max_rounds`, as a longer chain means bad data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.constants import ANCESTOR_HOPS, MAX_ROUNDS
from placeforge.tables import durable


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


def closures(edges: DataFrame, roots: DataFrame, blocked: tuple[int, ...] = (), max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """tag, qid: for each tag, its roots and all that reach them over child -> parent edges.

    A blocked node becomes a member but nothing is reached through it. Several tags share one loop.
    """
    up = edges.select("child", F.col("parent").alias("qid")).distinct()
    frontier = durable(roots.select("tag", F.col("qid").cast("long").alias("qid")).distinct(), "closure")
    found = [frontier]
    for _ in range(max_rounds + 1):
        if frontier.isEmpty():
            return _union(found)
        through = frontier.filter(~F.col("qid").isin(*blocked)) if blocked else frontier
        step = through.join(up, "qid").select("tag", F.col("child").alias("qid")).distinct()
        frontier = durable(step.join(_union(found), ["tag", "qid"], "left_anti"), "closure")
        found.append(frontier)
    raise RuntimeError(f"closure did not settle in {max_rounds} rounds")


def closure(edges: DataFrame, roots, blocked: tuple[int, ...] = (), max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """qid: the closure of one set of roots."""
    seeds = edges.sparkSession.createDataFrame([("", int(r)) for r in roots], "tag string, qid long")
    return closures(edges, seeds, blocked, max_rounds).select("qid")


def reach_up(edges: DataFrame, start: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """qid: the nodes of start and all their ancestors."""
    turned = edges.select(F.col("parent").alias("child"), F.col("child").alias("parent"))
    return closures(turned, start.select(F.lit("").alias("tag"), "qid"), (), max_rounds).select("qid")


def ancestors(edges: DataFrame, start: DataFrame, hops: int = ANCESTOR_HOPS) -> DataFrame:
    """qid, ancestor, hop: nodes within so many steps up, each at its least hop; a node is its own ancestor
    only on a cycle."""
    up = edges.select(F.col("child").alias("ancestor"), "parent").distinct()
    frontier = durable(start.select("qid", F.col("qid").alias("ancestor")).distinct(), "ancestors")
    found: list[DataFrame] = []
    for hop in range(1, hops + 1):
        step = frontier.join(up, "ancestor").select("qid", F.col("parent").alias("ancestor")).distinct()
        if found:
            step = step.join(_union(found), ["qid", "ancestor"], "left_anti")
        frontier = durable(step, "ancestors")
        if frontier.isEmpty():
            break
        found.append(frontier.withColumn("hop", F.lit(hop)))
        found[-1] = found[-1].select("qid", "ancestor", "hop")
    if not found:
        return frontier.withColumn("hop", F.lit(0)).filter(F.lit(False))
    return _union(found)


def root_most(edges: DataFrame, selected: DataFrame, hops: int = ANCESTOR_HOPS) -> DataFrame:
    """selected without those that have another selected node above them."""
    above = ancestors(edges, selected.select("qid").distinct(), hops).filter("qid <> ancestor")
    inner = above.join(selected.select(F.col("qid").alias("ancestor")).distinct(), "ancestor", "left_semi")
    return selected.join(inner.select("qid").distinct(), "qid", "left_anti")


def nearest_seed(edges: DataFrame, seeds: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """qid, depth, division: for each node that a seed reaches downward, the least (depth, division).

    seeds: qid, depth (its offset), division. A seed may itself get a nearer one. Depths only grow along
    edges, so cycles end.
    """
    down = edges.select(F.col("parent").alias("qid"), "child").distinct()
    best = lambda: F.min(F.struct("depth", "division")).alias("b")
    first = seeds.select(F.col("qid").cast("long"), F.col("depth").cast("int"), F.col("division").cast("long"))
    state = durable(first.groupBy("qid").agg(best()).select("qid", "b.depth", "b.division"), "nearest")
    frontier = state
    for _ in range(max_rounds + 1):
        if frontier.isEmpty():
            return state
        step = frontier.join(down, "qid").select(F.col("child").alias("qid"), (F.col("depth") + 1).alias("depth"), "division")
        cand = step.groupBy("qid").agg(best()).select("qid", F.col("b").alias("new"))
        old = state.select("qid", F.struct("depth", "division").alias("old"))
        better = cand.join(old, "qid", "left").filter(F.col("old").isNull() | (F.col("new") < F.col("old")))
        frontier = durable(better.select("qid", "new.depth", "new.division"), "nearest")
        state = durable(state.union(frontier).groupBy("qid").agg(best()).select("qid", "b.depth", "b.division"), "nearest")
    raise RuntimeError(f"propagation did not settle in {max_rounds} rounds")


def rescue_walk(located_in: DataFrame, contains: DataFrame, divisions: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """nearest_seed over both statements of containment, from divisions alone; nothing without the second."""
    if contains.isEmpty():
        return nearest_seed(contains, divisions.filter(F.lit(False)).select("qid", F.lit(0).alias("depth"), F.col("qid").alias("division")), max_rounds)
    both = located_in.select("child", "parent").union(contains.select("child", "parent"))
    return nearest_seed(both, divisions.select("qid", F.lit(0).alias("depth"), F.col("qid").alias("division")), max_rounds)


def linked_groups(pairs: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """node, root: single-link components of pairs (a, b), named by their least node."""
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = both.select(F.col("a").alias("child"), F.col("b").alias("parent"))
    state = durable(both.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node")), "groups")
    for _ in range(max_rounds):
        near = edges.join(state.select(F.col("node").alias("parent"), "root"), "parent").groupBy("child").agg(F.min("root").alias("low"))
        step = state.join(near.withColumnRenamed("child", "node"), "node").select("node", F.col("root").alias("was"), F.least("root", "low").alias("root"))
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        new = durable(step.join(jump, "root").select("node", "was", F.least("root", "next").alias("root")), "groups")
        state = new.select("node", "root")
        if new.filter("root <> was").isEmpty():
            return state
    raise RuntimeError(f"groups did not settle in {max_rounds} rounds")


def ids(column: Column | str) -> Column:
    """Entity references ('Q12') of a list as numbers; others are left out."""
    c = F.col(column) if isinstance(column, str) else column
    refs = F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda x: x.rlike(r"^Q[0-9]+$"))
    return F.transform(refs, lambda x: F.substring(x, 2, 20).cast("long"))
