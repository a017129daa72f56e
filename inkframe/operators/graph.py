"""Directed graphs: bounded reachability and cycles, by rounds of joins over written tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkframe.scratch import Scratch


def reachable(edges: DataFrame, starts: DataFrame, scratch: Scratch) -> DataFrame:
    """(scope, node): nodes reachable from the starts (scope, node) over edges (scope, a, b), the starts
    themselves only if they come round. Rounds go on until none is new."""
    e = edges.where("a is not null and b is not null").select("scope", "a", "b").distinct()
    at = starts.select("scope", F.col("node").alias("a"))
    front = scratch.save(at.join(e, ["scope", "a"]).select("scope", F.col("b").alias("node")).distinct())
    seen = front
    while front.limit(1).count():
        nxt = front.withColumnRenamed("node", "a").join(e, ["scope", "a"]).select("scope", F.col("b").alias("node")).distinct()
        front = scratch.save(nxt.join(seen, ["scope", "node"], "left_anti"))
        seen = scratch.save(seen.unionByName(front))
    return seen


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(scope, node, root) of the undirected edges (scope, a, b): star contraction. Each round every
    node whose first neighbour, in an order hashed anew, is a local minimum joins it; the links are
    followed to their ends at last. Loops make a node of its own component."""
    e = edges.where("a is not null and b is not null").select("scope", "a", "b")
    nodes = e.select("scope", F.col("a").alias("node")).union(e.select("scope", "b")).distinct()
    e = scratch.save(e.where("a <> b").distinct())
    ups, rounds = [], 0
    while e.limit(1).count():
        rank = lambda c: F.struct(F.xxhash64("scope", c, F.lit(rounds)).alias("h"), F.col(c).alias("x"))  # noqa: B023, E731
        arcs = e.union(e.select("scope", "b", "a"))
        first = scratch.save(arcs.groupBy("scope", "a").agg(F.min(rank("b")).alias("m")).select("scope", "a", F.col("m.x").alias("m"), (rank("a") < F.col("m")).alias("centre")))
        centres = first.where("centre").select("scope", F.col("a").alias("m"))
        up = scratch.save(first.where("not centre").join(centres, ["scope", "m"]).select("scope", F.col("a").alias("n"), F.col("m").alias("p")))
        ups.append(up)
        e = e.join(up.select("scope", F.col("n").alias("a"), F.col("p").alias("pa")), ["scope", "a"], "left").join(up.select("scope", F.col("n").alias("b"), F.col("p").alias("pb")), ["scope", "b"], "left")
        e = scratch.save(e.select("scope", F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b")).where("a <> b").distinct())
        rounds += 1
    if not ups:
        return nodes.select("scope", "node", F.col("node").alias("root"))
    up, hops = scratch.save(reduce(DataFrame.unionByName, ups)), 1
    while hops < rounds:
        far = up.select("scope", F.col("n").alias("p"), F.col("p").alias("q"))
        up = scratch.save(up.join(far, ["scope", "p"], "left").select("scope", "n", F.coalesce("q", "p").alias("p")))
        hops *= 2
    return nodes.join(up.withColumnRenamed("n", "node"), ["scope", "node"], "left").select("scope", "node", F.coalesce("p", "node").alias("root"))


def on_cycles(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(scope, node): nodes on a directed cycle, by colouring.

    Nodes without a way in or out are taken away round after round. In what is left, the greatest
    node that reaches each node is its colour; those that also reach the node that gave the colour,
    inside the colour, are on a cycle with it. Then these are taken away too, until nothing is left.
    A loop is a cycle of one.
    """
    e = scratch.save(edges.where("a is not null and b is not null").select("scope", "a", "b").distinct())
    found = [e.where("a = b").select("scope", F.col("a").alias("node"))]
    e = scratch.save(e.where("a <> b"))
    n = e.count()
    while n:
        while True:
            ins, outs = e.select("scope", F.col("b").alias("a")).distinct(), e.select("scope", F.col("a").alias("b")).distinct()
            e = scratch.save(e.join(ins, ["scope", "a"], "left_semi").join(outs, ["scope", "b"], "left_semi").select("scope", "a", "b"))
            n, old = e.count(), n
            if n == old:
                break
        if not n:
            break
        colour = scratch.save(e.select("scope", F.col("a").alias("node")).union(e.select("scope", "b")).distinct().withColumn("c", F.col("node")))
        moved = 1
        while moved:
            come = e.join(colour.withColumnRenamed("node", "a"), ["scope", "a"]).select("scope", F.col("b").alias("node"), F.col("c").alias("d"))
            best = come.groupBy("scope", "node").agg(F.max("d").alias("d"))
            new = scratch.save(colour.join(best, ["scope", "node"], "left").select("scope", "node", F.greatest("c", F.coalesce("d", "c")).alias("c"), (F.col("d") > F.col("c")).alias("up")))
            moved = new.where("up").count()
            colour = new.drop("up")
        ca, cb = colour.select("scope", F.col("node").alias("a"), F.col("c").alias("k")), colour.select("scope", F.col("node").alias("b"), F.col("c").alias("k"))
        inner = scratch.save(e.join(ca, ["scope", "a"]).join(cb, ["scope", "b", "k"]).select("scope", F.col("b").alias("a"), F.col("a").alias("b")))
        heads = colour.where("node = c").select("scope", "node")
        back = scratch.save(reachable(inner, heads, scratch))
        found.append(back)
        gone = back.unionByName(heads).distinct()
        e = scratch.save(e.join(gone.withColumnRenamed("node", "a"), ["scope", "a"], "left_anti").join(gone.withColumnRenamed("node", "b"), ["scope", "b"], "left_anti").select("scope", "a", "b"))
        n = e.count()
    return reduce(DataFrame.unionByName, found).distinct()
