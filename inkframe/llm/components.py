"""Connected components by stripping leaves, compressing chains and solving what is left.

Each round looks at the degrees of what is left of the graph:

* while leaves make up a fair share of the vertices, they are stripped: each hangs on its neighbour;
* then vertices of degree one or two form paths. List ranking (pointer doubling over directed chain
  elements) finds for each of them the end of its path in either direction; the whole path is then
  removed, and a path between two branching vertices leaves one edge behind;
* a core of at most `CORE` edges, as counted, is solved by a disjoint-set forest in one task; a larger one
  is contracted: every vertex whose first neighbour (in an order hashed anew each round) is a local
  minimum moves into it, and the rounds go on.

Each removed vertex keeps the vertex it hangs on; pointer doubling over these links restores the labels in
the end. All state is held in written tables, counts come with the writing, nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from inkframe.scratch import Scratch

#: Edges of a core that one task solves: 1 MB of them.
CORE = 1 << 16
#: Leaves are stripped alone while they are at least this share of the vertices.
LEAVES = 0.25
#: Members from which a group's name is sent to all tasks instead of its members to one: of n members there
#: are at most n / HOT such groups.
HOT = 100_000


def _save(scratch: Scratch, df: DataFrame, **counts) -> tuple[DataFrame, dict]:
    """The table as written, and counts over its rows that were taken with the writing."""
    seen = Observation()
    out = scratch.save(df.observe(seen, *(F.coalesce(c, F.lit(0)).alias(k) for k, c in counts.items())))
    return out, seen.get


def numbered(df: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """Distinct rows of `keys` with a long `id` each."""
    return scratch.save(df.select(*keys).distinct().withColumn("id", F.monotonically_increasing_id()))


def _degrees(edges: DataFrame) -> DataFrame:
    arcs = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select("b", "a"))
    return arcs.groupBy("v").agg(F.count("*").alias("d"), F.min("w").alias("n1"), F.max("w").alias("n2"))


def _distinct_edges(edges: DataFrame) -> DataFrame:
    return (
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _without(edges: DataFrame, gone: DataFrame) -> DataFrame:
    gone = gone.select(F.col("v").alias("g"))
    return edges.join(gone, F.col("a") == F.col("g"), "left_anti").join(gone, F.col("b") == F.col("g"), "left_anti")


def _strip_leaves(deg: DataFrame, edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """Remove every leaf; (links of the removed, edges left and their number)."""
    leaves = deg.where("d = 1").select("v", F.col("n1").alias("p"))
    other = leaves.select(F.col("v").alias("o"))
    # of two leaves that have only each other the lesser stays
    links = leaves.join(other, F.col("p") == F.col("o"), "left").where("o is null or v > p").select("v", "p")
    left, n = _save(scratch, _without(edges, leaves), n=F.count("*"))
    return links, left, n["n"]


def _rank_chains(low: DataFrame, scratch: Scratch) -> DataFrame:
    """End `t` of the walk that leaves `v` towards `w`, for each vertex of degree one or two.

    A walk on a closed ring ends at the ring's least vertex. Column `ring` tells these.
    """
    arcs = low.select("v", "d", F.col("n1").alias("w"), F.col("n2").alias("back")).union(
        low.where("d = 2").select("v", "d", "n2", "n1")
    )
    to = low.where("d = 2").select(F.col("v").alias("u"), "n1", "n2")
    # element (v, w) -> element (w, x), x the other neighbour of w; an element is named by both ends
    walk = arcs.join(to, F.col("w") == F.col("u"), "left").select(
        "v",
        "w",
        F.when(F.col("u").isNull(), F.col("w")).alias("t"),
        F.when(F.col("u").isNotNull(), F.col("w")).alias("pv"),
        F.when(F.col("u").isNotNull(), F.when(F.col("n1") == F.col("v"), F.col("n2")).otherwise(F.col("n1"))).alias("pw"),
        F.col("w").alias("least"),
        F.lit(False).alias("ring"),
    )
    tally = {"open": F.count_if(F.col("t").isNull()), "rings": F.count_if(F.expr("ring and t = v"))}
    step, left = _save(scratch, walk, **tally)
    ended = step.where("t is not null")
    while left["open"]:
        # every walk that has not ended goes on as far again as it has come; only these are written anew
        going, round_met = step.where("t is null"), None
        nxt = ended.unionByName(going).select(
            F.col("v").alias("pv"), F.col("w").alias("pw"), F.col("t").alias("jt"), F.col("pv").alias("jpv"),
            F.col("pw").alias("jpw"), F.col("least").alias("jl"), F.col("ring").alias("jr"),
        )
        if left["rings"]:
            # the rest of a ring whose least vertex has just come back to itself
            seen = step.where("ring and t = v").select(F.col("v").alias("m")).distinct()
            met = going.join(seen, F.col("least") == F.col("m"), "left")
            round_met = met.where("m is not null").select("v", "w", F.col("m").alias("t"), "pv", "pw", "least", F.lit(True).alias("ring"))
            going = met.where("m is null").drop("m")
        still = going.join(nxt, ["pv", "pw"]).withColumn("least", F.least("least", "jl"))
        round_ = F.col("least") == F.col("v")
        moved = still.select(
            "v", "w", F.when(round_, F.col("v")).otherwise(F.col("jt")).alias("t"), F.col("jpv").alias("pv"), F.col("jpw").alias("pw"), "least",
            (round_ | F.col("jr")).alias("ring"),
        )
        step, left = _save(scratch, moved if round_met is None else moved.unionByName(round_met), **tally)
        ended = ended.unionByName(step.where("t is not null"))
    return ended


def _strip_chains(deg: DataFrame, edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """Remove every path of vertices of degree one or two; (links of the removed, edges left and their number)."""
    low = deg.where("d <= 2")
    walk = _rank_chains(low, scratch)
    ends = walk.groupBy("v").agg(F.min("t").alias("t1"), F.max("t").alias("t2"), F.count("*").alias("d"), F.max("ring").alias("ring"))
    lows = low.select(F.col("v").alias("lv"))
    # which ends branch: an end that is itself of degree one is no place to hang on, unless both are
    e = (
        ends.join(lows.withColumnRenamed("lv", "l1"), F.col("t1") == F.col("l1"), "left")
        .join(lows.withColumnRenamed("lv", "l2"), F.col("t2") == F.col("l2"), "left")
        .select("v", "d", "ring", "t1", "t2", F.col("l1").isNull().alias("b1"), F.col("l2").isNull().alias("b2"))
    )
    anchor = (
        F.when(F.col("ring"), F.col("t1"))
        .when(F.col("b1"), F.col("t1"))
        .when(F.col("b2"), F.col("t2"))
        .when(F.col("d") == 1, F.least("v", "t1"))
        .otherwise(F.least("t1", "t2"))
    )
    e = scratch.save(e)
    links = e.select("v", anchor.alias("p")).where("v <> p")
    # one edge for each chain between two branching ends; edges between vertices that stay
    joined = e.where("d = 2 and not ring and b1 and b2 and t1 <> t2").select(F.col("t1").alias("a"), F.col("t2").alias("b"))
    left, n = _save(scratch, _distinct_edges(_without(edges, low).union(joined)), n=F.count("*"))
    return links, left, n["n"]


def _solve(edges: DataFrame) -> DataFrame:
    """Links of a core of a known small size to the least vertices of its parts, by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while (up := root.setdefault(top, top)) != top:
                top = up
            while root[x] != top:
                root[x], x = top, root[x]
            return top

        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
        gone = [(v, find(v)) for v in root if root[v] != v]
        yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in gone], pa.int64()), pa.array([p for _, p in gone], pa.int64())], ["v", "p"])

    return edges.select("a", "b").coalesce(1).mapInArrow(run, "v bigint, p bigint")


def _contract(edges: DataFrame, round_no: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """One star contraction of the core; (links of the removed, edges left and their number)."""
    rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(round_no)).alias("h"), F.col(c).alias("x"))
    arcs = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select("b", "a"))
    first = scratch.save(arcs.groupBy("v").agg(F.min(rank("w")).alias("m")).select("v", F.col("m.x").alias("m"), (rank("v") < F.col("m")).alias("centre")))
    centres = first.where("centre").select(F.col("v").alias("c"))
    links = scratch.save(first.where("not centre").join(centres, F.col("m") == F.col("c")).select("v", F.col("c").alias("p")))
    l1, l2 = links.select(F.col("v").alias("v1"), F.col("p").alias("p1")), links.select(F.col("v").alias("v2"), F.col("p").alias("p2"))
    moved = (
        edges.join(l1, F.col("a") == F.col("v1"), "left")
        .join(l2, F.col("b") == F.col("v2"), "left")
        .select(F.coalesce("p1", "a").alias("a"), F.coalesce("p2", "b").alias("b"))
    )
    left, n = _save(scratch, _distinct_edges(moved), n=F.count("*"))
    scratch.drop(first)
    return links, left, n["n"]


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, root) for each vertex of the edges (a, b) of longs.

    Null ends are dropped, loops and repeated edges count once. A vertex of which only loops are
    known is its own root. Every vertex of a component has the same root, which is one of them.
    No edges: no rows.
    """
    edges = edges.where("a is not null and b is not null")
    loops = edges.where("a = b").select(F.col("a").alias("v"), F.col("a").alias("p"))
    edges, n = _save(scratch, _distinct_edges(edges), n=F.count("*"))
    everything = edges.select(F.col("a").alias("v")).union(edges.select("b")).union(loops.select("v")).distinct()
    first_edges, parts, ranked, n = edges, [], False, n["n"]
    while n:
        if ranked and n <= CORE:
            parts.append(_solve(edges))
            break
        deg, tally = _save(scratch, _degrees(edges), n=F.count("*"), leaves=F.count_if(F.col("d") == 1), low=F.count_if(F.col("d") <= 2))
        if tally["leaves"] >= LEAVES * tally["n"]:
            links, left, n = _strip_leaves(deg, edges, scratch)
        elif tally["low"]:
            (links, left, n), ranked = _strip_chains(deg, edges, scratch), True
        elif n <= CORE:
            ranked = True
            continue
        else:
            links, left, n = _contract(edges, len(parts), scratch)
        parts.append(links)
        if edges is not first_edges and n:
            scratch.drop(edges)
        edges = left
    if not parts:
        return everything.select("v", F.col("v").alias("root"))
    up = parts[0]
    for p in parts[1:]:
        up = up.unionByName(p)
    hops = 1
    # a link leads to a vertex removed in a later round: after as many hops as rounds every walk is at its root
    up = scratch.save(up)
    while hops < len(parts):
        old = up
        nxt = up.select(F.col("v").alias("jv"), F.col("p").alias("jp"))
        up = scratch.save(up.join(nxt, F.col("p") == F.col("jv"), "left").select("v", F.coalesce("jp", "p").alias("p")))
        scratch.drop(old)
        hops *= 2
    return everything.join(up, "v", "left").select("v", F.coalesce("p", "v").alias("root"))


def identity_groups(links: DataFrame, scope: str, left: str, right: str) -> DataFrame:
    """(scope, group_ref, candidate_ref): one group for each set of records linked at any distance.

    `group_ref` is the least reference of its group, whose own row is included; groups have two or
    more members. Rows with a null scope or end, and links of a record with itself, link nothing.
    Repeated and swapped links count once. References compare by code point. No links: no rows.
    """
    spark = links.sparkSession
    scratch = Scratch(spark, "groups")
    pairs = (
        links.where(F.col(scope).isNotNull() & F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
        .select(F.col(scope).alias("s"), F.least(left, right).alias("l"), F.greatest(left, right).alias("r"))
        .distinct()
    )
    pairs = scratch.save(pairs)
    nodes = numbered(pairs.select("s", F.col("l").alias("ref")).union(pairs.select("s", "r")), ["s", "ref"], scratch)
    n1 = nodes.select("s", F.col("ref").alias("l"), F.col("id").alias("a"))
    n2 = nodes.select("s", F.col("ref").alias("r"), F.col("id").alias("b"))
    labels = connected_components(pairs.join(n1, ["s", "l"]).join(n2, ["s", "r"]).select("a", "b"), scratch)
    named = scratch.save(labels.join(nodes.withColumnRenamed("id", "v"), "v").select("root", "s", "ref"))
    heads = scratch.save(named.groupBy("root").agg(F.min("ref").alias("head"), F.count("*").alias("n")))
    # a group of many members does not go to one task: its name goes to the members
    hot = F.broadcast(heads.where(F.col("n") >= HOT))
    few = named.join(heads.where(F.col("n") < HOT), "root")
    return few.unionByName(named.join(hot, "root")).select(F.col("s").alias(scope), F.col("head").alias("group_ref"), F.col("ref").alias("candidate_ref"))
