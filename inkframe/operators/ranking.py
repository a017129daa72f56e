"""Ranks inside scopes that may be far larger than a task.

The rows are sorted over all scopes by range partitions and written; a row's rank is its place among
the rows of its scope in its partition, plus how many rows of the scope lie in partitions before.
Only those counts, one for each scope and partition, go through a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkframe.scratch import Scratch


def rank_within(df: DataFrame, scope: list[str], order: list[str], scratch: Scratch, name: str = "place") -> DataFrame:
    """`df` with `name`: the rank from 0 of each row inside its scope. Null scopes are scopes too. Ties
    in `order` are ranked in any order: give a total one."""
    rows = df.orderBy(*scope, *order).withColumn("_id", F.monotonically_increasing_id())
    rows = scratch.save(rows.withColumn("_part", F.shiftright("_id", 33)))
    n = rows.groupBy(*scope, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*scope).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = n.select(*[F.col(c).alias(f"_s_{c}") for c in scope], F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    on = F.col("_part") == F.col("_p")
    for c in scope:
        on = on & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    # a range partition is as large as a task, whatever its scopes
    inside = F.row_number().over(Window.partitionBy("_part", *scope).orderBy("_id")) - 1
    ranked = rows.withColumn("_in", inside).join(base, on)
    return ranked.select(*df.columns, (F.col("_base") + F.col("_in")).alias(name))
