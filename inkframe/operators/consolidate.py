"""Canonical records from groups of candidates, and what changes over their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkframe.operators.ranking import rank_within
from inkframe.scratch import Scratch


def ordered_union(order: Column, items: Column) -> Column:
    """Distinct elements of arrays over rows, in the order in which they first come (an aggregate)."""
    return F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), items.alias("i")))), lambda x: x["i"])))


def settled_mode(c: str, unknown: str = "unknown") -> Column:
    """The one known value of a group, else unknown (an aggregate)."""
    known = F.when(F.col(c) != unknown, F.col(c))
    return F.when(F.countDistinct(known) == 1, F.min(known)).otherwise(unknown)


def number_within(df: DataFrame, scope: list[str], order: list[str], prefix: Column, scratch: Scratch, width: int = 4) -> DataFrame:
    """`df` with `entity_id`: dense ids like char_0001 in order inside a scope, of any size."""
    ranked = rank_within(df, scope, order, scratch, "_rank")
    no = (F.col("_rank") + 1).cast("string")
    return ranked.withColumn("entity_id", F.concat(prefix, F.lit("_"), F.lpad(no, width, "0"))).drop("_rank")


def state_runs(df: DataFrame, scope: list[str], order: list[str], state: str) -> DataFrame:
    """(scope, run_no, state, first order, n): runs of equal states; null states are skipped first and
    do not break a run."""
    w = Window.partitionBy(*scope).orderBy(*order)
    known = df.where(F.col(state).isNotNull())
    marked = known.withColumn("_new", F.when(F.lag(state).over(w) == F.col(state), 0).otherwise(1)).withColumn("run_no", F.sum("_new").over(w))
    return marked.groupBy(*scope, "run_no").agg(F.min(state).alias("state"), *[F.min_by(o, F.struct(*order)).alias(f"first_{o}") for o in order[:1]], F.count("*").alias("n"))


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest `order` of each key; aggregation, not a window, so that it combines
    before the shuffle. Ties keep the greatest row."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("_m"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_m.{c}").alias(c) for c in df.columns])
