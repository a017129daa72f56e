"""Identity from decisions: what is settled, what remains open, and what a decision says of two records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkframe.operators import graph
from inkframe.operators.consolidate import number_within
from inkframe.operators.ranking import rank_within
from inkframe.scratch import Scratch


def entity_map(entities: DataFrame, decisions: DataFrame, kinds: dict[str, str], scratch: Scratch) -> DataFrame:
    """(scope, ref, kind, status, entity_id): where each candidate belongs, once each.

    `entities` has (scope, ref, kind, order_key), `decisions` (scope, a, b, decision). `kinds` are those that
    decisions may join, with the prefix of their ids. Candidates of one kind joined by same_entity, at any
    distance, are one entity. An entity that any uncertain decision touches, even inside it, is unresolved,
    together with all that uncertain decisions reach from it. Candidates of other kinds are unresolved each
    for itself. Decisions across kinds, about unknown candidates or about nothing join nothing. Ids count
    from 1 inside a scope in the order of the first members.
    """
    e = entities.where("scope is not null and ref is not null").groupBy("scope", "ref").agg(F.min("kind").alias("kind"), F.min("order_key").alias("order_key"))
    e = scratch.save(e)
    able = e.where(F.col("kind").isin(*kinds)).select("scope", "ref", "kind")
    d = decisions.where("a is not null and b is not null and decision in ('same_entity', 'uncertain')").select("scope", "a", "b", "decision").distinct()
    d = d.join(able.select("scope", F.col("ref").alias("a"), "kind"), ["scope", "a"]).join(able.select("scope", F.col("ref").alias("b"), "kind"), ["scope", "b", "kind"])
    d = scratch.save(d.select("scope", "a", "b", "decision"))
    joined = graph.components(d.where("decision = 'same_entity'").select("scope", "a", "b"), scratch)
    comp = scratch.save(e.join(joined.withColumnRenamed("node", "ref"), ["scope", "ref"], "left").withColumn("root", F.coalesce("root", "ref")))
    of = lambda end: comp.select("scope", F.col("ref").alias(end), F.col("root").alias(f"c{end}"))
    open_ = d.where("decision = 'uncertain'").join(of("a"), ["scope", "a"]).join(of("b"), ["scope", "b"])
    groups = graph.components(open_.select("scope", F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), scratch)
    groups = scratch.save(groups.select("scope", F.col("node").alias("root"), F.col("root").alias("g")))
    placed = comp.join(groups, ["scope", "root"], "left")
    resolved = F.col("kind").isin(*kinds) & F.col("g").isNull()
    placed = scratch.save(placed.select("scope", "ref", "kind", "order_key", F.when(resolved, "resolved").otherwise("unresolved").alias("status"), F.coalesce("g", "root").alias("name")))
    of_kind = F.when(F.col("status") == "resolved", F.col("kind")).otherwise("")
    heads = placed.groupBy("scope", "status", of_kind.alias("series"), "name").agg(F.min(F.struct("order_key", "ref")).alias("first"))
    prefix = F.lit("unres")
    for kind, short in kinds.items():
        prefix = F.when(F.col("series") == kind, short).otherwise(prefix)
    heads = heads.select("scope", "status", "series", "name", "first.order_key", "first.ref")
    ids = number_within(heads, ["scope", "series"], ["order_key", "ref"], prefix, scratch).select("scope", "status", "series", "name", "entity_id")
    return placed.withColumn("series", of_kind).join(ids, ["scope", "status", "series", "name"]).select("scope", "ref", "kind", "status", "entity_id")


def oriented(decisions: DataFrame, members: DataFrame, what: str, scratch: Scratch) -> DataFrame:
    """(scope, number, from_id, to_id, decision_id): the decisions `what` between two records, from the earlier
    to the later one, numbered by (later, earlier, decision id) inside a scope.

    `decisions` has (scope, decision_id, left_ref, right_ref, decision), `members` (scope, ref, id, ordinal).
    A decision whose ends are one record fails; one with an unknown end is left out.
    """
    d = decisions.where(F.col("decision") == what)
    end = lambda c: members.select("scope", F.col("ref").alias(f"{c}_ref"), F.struct("ordinal", "id").alias(c))
    both = d.join(end("left"), ["scope", "left_ref"]).join(end("right"), ["scope", "right_ref"])
    same = F.when(F.col("left.id") == F.col("right.id"), F.raise_error(F.concat(F.lit(f"{what} between one record and itself: "), "decision_id")).cast("string"))
    both = both.withColumn("checked", F.coalesce(same, "decision_id"))
    both = both.select("scope", F.col("checked").alias("decision_id"), F.least("left", "right").alias("first"), F.greatest("left", "right").alias("last"))
    rows = both.select("scope", "decision_id", F.col("first.id").alias("from_id"), F.col("last.id").alias("to_id"), F.col("first.ordinal").alias("_f"), F.col("last.ordinal").alias("_l"))
    ranked = rank_within(rows, ["scope"], ["_l", "_f", "decision_id"], scratch, "number")
    return ranked.select("scope", (F.col("number") + 1).alias("number"), "from_id", "to_id", "decision_id")
