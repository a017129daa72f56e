"""Windows of so many owned rows with context on both sides, over an ordered stream per scope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkframe.operators.ranking import rank_within
from inkframe.scratch import Scratch


def plan_windows(df: DataFrame, scope: str, order: list[str], owned: int, context: int, scratch: Scratch) -> DataFrame:
    """`df` with place (from 0), window_no and role, one row for each window that holds the row: as
    owned in exactly one, as context in those whose owned rows lie within `context` places.

    Rows with a null scope are left out. Ties in `order` are broken by nothing: give a total order.
    """
    if owned < 1 or context < 0:
        raise ValueError("owned must be at least 1 and context at least 0")
    p = scratch.save(rank_within(df.where(F.col(scope).isNotNull()), [scope], order, scratch))
    p = p.join(p.groupBy(scope).agg(F.max("place").alias("_last")), scope)
    # the windows that reach this row: an arithmetic band, no join
    lo = F.greatest(F.lit(0), F.floor((F.col("place") - F.lit(context)) / owned)).cast("int")
    hi = F.least(F.floor(F.col("_last") / owned), F.floor((F.col("place") + F.lit(context)) / owned)).cast("int")
    x = p.withColumn("window_no", F.explode(F.sequence(lo, hi)))
    start, end = F.col("window_no") * owned, (F.col("window_no") + 1) * owned
    mine = (F.col("place") >= start) & (F.col("place") < end)
    near = (F.col("place") >= start - context) & (F.col("place") < end + context)
    return x.where(near).withColumn("role", F.when(mine, "owned").when(F.col("place") < start, "before").otherwise("after")).drop("_last")


def sweep_policies(n: int) -> tuple[range, range]:
    """Every window size and context that an audit of n rows tries."""
    return range(1, n + 1), range(0, max(1, n // 10) + 1)
