"""Queries of problem 5: the revisions of the pointers as a forest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkframe.operators.hierarchy import dense_ids, hierarchy
from inkframe.plans.registry import Registry
from inkframe.scratch import Scratch, table

R = Registry()

KEY = ["pointer_id", "revision"]

_PARENTS = """
WITH RECURSIVE node AS (
  SELECT pointer_id AS p, revision AS r, any_value(previous_pointer_ref) AS prev, any_value(target_ref) AS tgt
  FROM current_pointers WHERE pointer_id IS NOT NULL AND revision IS NOT NULL GROUP BY pointer_id, revision
), sup AS (
  SELECT superseding_pointer_ref.artifact_id AS p, superseding_pointer_ref.revision AS r,
    any_value(superseded_pointer_ref) AS s
  FROM supersession_records GROUP BY 1, 2
), cand AS (
  SELECT p, r, 1 AS rank, prev.artifact_id AS cp, prev.revision AS cr FROM node WHERE prev IS NOT NULL
  UNION ALL SELECT node.p, node.r, 2, s.artifact_id, s.revision FROM node JOIN sup ON node.p = sup.p AND node.r = sup.r
  UNION ALL SELECT p, r, 3, tgt.artifact_id, tgt.revision FROM node WHERE tgt.artifact_type = 'current_pointer'
), par AS (
  SELECT c.p, c.r, min_by(c.cp, c.rank) AS pp, min_by(c.cr, c.rank) AS pr
  FROM cand c JOIN node n ON n.p = c.cp AND n.r = c.cr GROUP BY c.p, c.r
), up AS (
  SELECT p, r, pp AS ap, pr AS ar FROM par
  UNION SELECT u.p, u.r, x.pp, x.pr FROM up u JOIN par x ON x.p = u.ap AND x.r = u.ar
), ring AS (SELECT DISTINCT p, r FROM up WHERE p = ap AND r = ar),
fate AS (
  SELECT u.p, u.r,
    min(CASE WHEN g.p IS NOT NULL THEN struct_pack(a := u.ap, b := u.ar) END) AS least_ring,
    min(CASE WHEN x.p IS NULL THEN struct_pack(a := u.ap, b := u.ar) END) AS top,
    count(*) AS above
  FROM up u LEFT JOIN ring g ON g.p = u.ap AND g.r = u.ar LEFT JOIN par x ON x.p = u.ap AND x.r = u.ar
  GROUP BY u.p, u.r
)
"""


def pointer_nodes(spark: SparkSession, sf_dir: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(names with ids, (id, parent)); of repeated rows and records the least reference counts."""
    ref = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.artifact_id").alias("k"), F.col(f"{c}.revision").alias("n")))
    own = (
        table(spark, sf_dir, "current_pointers")
        .where("pointer_id is not null and revision is not null")
        .select(
            *KEY,
            ref("previous_pointer_ref").alias("prev"),
            F.when(F.col("target_ref.artifact_type") == "current_pointer", ref("target_ref")).alias("target"),
        )
        .groupBy(*KEY)
        .agg(F.min("prev").alias("prev"), F.min("target").alias("target"))
    )
    records = (
        table(spark, sf_dir, "supersession_records")
        .select(ref("superseding_pointer_ref").alias("s"), ref("superseded_pointer_ref").alias("record"))
        .where("s.k is not null and s.n is not null")
        .groupBy(F.col("s.k").alias("pointer_id"), F.col("s.n").alias("revision"))
        .agg(F.min("record").alias("record"))
    )
    nodes = dense_ids(own.join(records, KEY, "left"), KEY, scratch)
    names = nodes.select(*KEY, "id")
    offers = nodes.select("id", F.posexplode(F.array("prev", "record", "target"))).where("col.k is not null and col.n is not null")
    known = names.select(F.col("pointer_id").alias("k"), F.col("revision").alias("n"), F.col("id").alias("pid"))
    found = (
        offers.select("id", "pos", "col.k", "col.n")
        .join(known, ["k", "n"])
        .groupBy("id")
        .agg(F.min(F.struct("pos", "pid")).alias("m"))
        .select("id", F.col("m.pid").alias("parent"))
    )
    return names, scratch.save(names.select("id").join(found, "id", "left"))


@R.query(
    "p5_found",
    _PARENTS
    + """SELECT p AS pointer_id, r AS revision, CASE WHEN top IS NULL THEN least_ring.a ELSE top.a END AS root_pointer_id,
  CASE WHEN top IS NULL THEN least_ring.b ELSE top.b END AS root_revision FROM fate""",
)
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pointers")
    names, nodes = pointer_nodes(spark, sf_dir, scratch)
    tree = hierarchy(nodes, scratch).where("parent is not null").select("id", "root")
    roots = names.select(F.col("id").alias("root"), F.col("pointer_id").alias("root_pointer_id"), F.col("revision").alias("root_revision"))
    return tree.join(names, "id").join(roots, "root").select(*KEY, "root_pointer_id", "root_revision")


# from every root and every member of a cycle downwards; upwards until a node comes round
_TREE = (
    _PARENTS
    + """, tree AS (
  SELECT n.p, n.r, 0 AS depth, n.p || '@' || n.r AS path FROM node n WHERE NOT EXISTS (SELECT 1 FROM par x WHERE x.p = n.p AND x.r = n.r)
    OR EXISTS (SELECT 1 FROM ring g WHERE g.p = n.p AND g.r = n.r)
  UNION ALL
  SELECT x.p, x.r, t.depth + 1, t.path || '/' || x.p || '@' || x.r FROM tree t JOIN par x ON x.pp = t.p AND x.pr = t.r
  WHERE NOT EXISTS (SELECT 1 FROM ring g WHERE g.p = x.p AND g.r = x.r)
), way AS (
  SELECT p, r, pp AS ap, pr AS ar, 1 AS distance, [p || '@' || r, pp || '@' || pr] AS seen FROM par WHERE NOT (pp = p AND pr = r)
  UNION ALL
  SELECT w.p, w.r, x.pp, x.pr, w.distance + 1, list_append(w.seen, x.pp || '@' || x.pr) FROM way w JOIN par x ON x.p = w.ap AND x.r = w.ar
  WHERE NOT list_contains(w.seen, x.pp || '@' || x.pr)
)
"""
)


def _named(names: DataFrame, id_: str, prefix: str) -> DataFrame:
    return names.select(F.col("id").alias(id_), F.col("pointer_id").alias(f"{prefix}pointer_id"), F.col("revision").alias(f"{prefix}revision"))


@R.query(
    "p5_hierarchy",
    _TREE
    + """SELECT t.p AS pointer_id, t.r AS revision, par.pp AS parent_pointer_id, par.pr AS parent_revision, t.depth::BIGINT AS depth, t.path,
  CASE WHEN f.p IS NULL THEN t.p WHEN f.top IS NULL THEN f.least_ring.a ELSE f.top.a END AS root_pointer_id,
  CASE WHEN f.p IS NULL THEN t.r WHEN f.top IS NULL THEN f.least_ring.b ELSE f.top.b END AS root_revision, coalesce(f.p IS NOT NULL AND f.top IS NULL, false) AS on_or_below_cycle
FROM tree t LEFT JOIN par ON par.p = t.p AND par.r = t.r LEFT JOIN fate f ON f.p = t.p AND f.r = t.r""",
)
def p5_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every revision with its parent, root, depth, path, and whether it is on or below a cycle.

    Below a cycle path and depth start at the member of the cycle that the way up enters; a member is
    at depth 0 with itself as its path. The root stays the cycle's least member. The path names its
    revisions from the top as pointer@revision, with slashes between them.
    """
    scratch = Scratch(spark, "pointers")
    names, nodes = pointer_nodes(spark, sf_dir, scratch)
    tree, _, _ = _opened(nodes, scratch)
    tree = scratch.save(tree)
    step = names.select(F.col("id").alias("at"), F.concat_ws("@", "pointer_id", F.col("revision").cast("string")).alias("step"))
    steps = tree.select("id", F.posexplode("path").alias("pos", "at")).join(step, "at")
    # a path has as many steps as its own row has elements
    paths = steps.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "step"))), lambda x: x["step"]), "/").alias("path"))
    full = tree.drop("path").join(paths, "id").join(_named(names, "id", ""), "id").join(_named(names, "root", "root_"), "root").join(_named(names, "parent", "parent_"), "parent", "left")
    return full.select(*KEY, "parent_pointer_id", "parent_revision", "depth", "path", "root_pointer_id", "root_revision", F.col("is_ring").alias("on_or_below_cycle"))


def _opened(nodes: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(hierarchy with paths, each cycle cut open so that its members are the roots of what hangs
    below them; members (id, parent, ring); whole hierarchy)."""
    whole = scratch.save(hierarchy(nodes, scratch))
    ring = _on_cycles(whole, scratch).withColumnRenamed("root", "ring")
    cut = nodes.join(ring.select("id", F.lit(True).alias("on")), "id", "left").select("id", F.when(F.col("on").isNull(), F.col("parent")).alias("parent"))
    below = scratch.save(hierarchy(scratch.save(cut), scratch, with_path=True))
    tree = below.select("id", "depth", "path").join(whole.select("id", "parent", "root", "is_ring"), "id")
    return tree.select("id", "parent", "root", "depth", "is_ring", "path"), ring, below


@R.query(
    "p5_descendants",
    _TREE + "SELECT ap AS pointer_id, ar AS revision, p AS descendant_pointer_id, r AS descendant_revision, distance::BIGINT AS distance FROM way",
)
def p5_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All descendants of every revision, each once, with their distance.

    On a cycle every other member is a descendant, and what hangs below any of them; the distance is
    that of the first time round, and no revision is its own descendant.
    """
    scratch = Scratch(spark, "pointers")
    names, nodes = pointer_nodes(spark, sf_dir, scratch)
    _, ring, below = _opened(nodes, scratch)
    straight = below.where("depth > 0").select("id", "depth", F.posexplode("path")).where("pos < depth").select(
        F.col("col").alias("ancestor"), F.col("id").alias("descendant"), (F.col("depth") - F.col("pos")).alias("distance")
    )
    # places on each cycle: steps up to its least member, which cuts it open
    line = ring.select("id", F.when(F.col("id") != F.col("ring"), F.col("parent")).alias("parent"))
    place = hierarchy(scratch.save(line), scratch).select("id", F.col("root").alias("ring"), F.col("depth").alias("at"))
    place = scratch.save(place)
    size = place.groupBy("ring").agg(F.count("*").alias("size"))
    lower = below.select("id", "root", "depth").join(place.withColumnRenamed("id", "root"), "root")
    upper = place.select("ring", F.col("id").alias("ancestor"), F.col("at").alias("above")).join(size, "ring")
    # the member that the way enters by has its own way already
    around = lower.join(upper, "ring").where("ancestor != root").select(
        "ancestor", F.col("id").alias("descendant"), (F.col("depth") + F.pmod(F.col("at") - F.col("above"), F.col("size"))).alias("distance")
    )
    pairs = straight.unionByName(around).join(_named(names, "ancestor", ""), "ancestor").join(_named(names, "descendant", "descendant_"), "descendant")
    return pairs.select(*KEY, "descendant_pointer_id", "descendant_revision", "distance")


def _on_cycles(tree: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, parent, root) of the members of cycles among the rows of a hierarchy.

    From the least member of each cycle, its first 2, 4, 8, ... members are gathered, with links
    that reach as far, until no more come.
    """
    rings = scratch.save(tree.where("is_ring").select("id", "parent", "root"))
    links, on, n = rings.select("id", "parent"), rings.select(F.col("root").alias("m")).distinct(), 0
    while True:
        on = scratch.save(on.union(on.join(links, F.col("m") == F.col("id")).select("parent")).distinct())
        if (now := on.count()) == n:
            break
        n, far = now, links.select(F.col("id").alias("j"), F.col("parent").alias("to"))
        links = scratch.save(links.join(far, F.col("parent") == F.col("j")).select("id", F.col("to").alias("parent")))
    return scratch.save(rings.join(on, F.col("id") == F.col("m")).select("id", "parent", "root"))


@R.query(
    "p5_cycles",
    _PARENTS
    + """SELECT DISTINCT x.p AS pointer_id, x.r AS revision, x.pp AS parent_pointer_id, x.pr AS parent_revision
FROM ring JOIN par x ON x.p = ring.p AND x.r = ring.r""",
)
def p5_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The circular links themselves: revisions on a cycle, with the link each of them has."""
    scratch = Scratch(spark, "pointers")
    names, nodes = pointer_nodes(spark, sf_dir, scratch)
    left = _on_cycles(hierarchy(nodes, scratch), scratch).select("id", "parent")
    parents = names.select(F.col("id").alias("parent"), F.col("pointer_id").alias("parent_pointer_id"), F.col("revision").alias("parent_revision"))
    return left.join(names, "id").join(parents, "parent").select(*KEY, "parent_pointer_id", "parent_revision")
