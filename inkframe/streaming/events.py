"""Streaming counterparts: windowed counts with a watermark, and the latest record of each key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_events(spark: SparkSession, directory: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(directory)


def windowed_counts(events: DataFrame, time: str, key: str, value: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(start, key, n, total) per tumbling window; rows later than the watermark are dropped by Spark."""
    e = events.withWatermark(time, late)
    return e.groupBy(F.window(time, size), key).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), key, "n", "total")


def latest_by_key(events: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """(key, order, value): after each batch, the greatest record so far of each key that it touched.
    Rows with a null key or order are left out; of equal orders the first one seen stays."""
    kinds = dict(events.dtypes)

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = state.get if state.exists else None
        for f in frames:
            top = f.loc[f[order].idxmax()]
            if best is None or top[order] > best[0]:
                best = (int(top[order]), None if pd.isna(top[value]) else top[value])
        state.update(best)
        yield pd.DataFrame({key: [k[0]], order: [best[0]], value: [best[1]]})

    rows = events.where(F.col(key).isNotNull() & F.col(order).isNotNull()).select(key, F.col(order).cast("long").alias(order), value)
    return rows.groupBy(key).applyInPandasWithState(
        step, f"`{key}` {kinds[key]}, `{order}` bigint, `{value}` {kinds[value]}", f"o bigint, v {kinds[value]}", "update", GroupStateTimeout.NoTimeout
    )
