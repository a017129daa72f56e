"""Queries over the event table: batch twins of the streaming operators, and the streams themselves."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkframe.operators.consolidate import latest, state_runs
from inkframe.plans.registry import Registry
from inkframe.scratch import checkpoint_root, table
from inkframe.streaming.events import windowed_counts

R = Registry()

_HOURLY = "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2"


@R.query("hourly_counts", _HOURLY)
def hourly_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.date_trunc("hour", "ts").alias("start"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@R.query("stream_hourly_counts", _HOURLY)
def stream_hourly_counts(spark: SparkSession, d: str) -> DataFrame:
    """The same by Structured Streaming: every file so far as one trigger, into a table of totals."""
    root = f"{checkpoint_root(spark).rstrip('/')}/inkframe/stream-{uuid.uuid4().hex}"
    events = table(spark, d, "events")
    src = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet" if os.path.isfile(f"{d}/events.parquet") else "*.parquet")
    stream = src.parquet(d if os.path.isfile(f"{d}/events.parquet") else f"{d}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = windowed_counts(stream, "ts", "event_type", "value")

    def write(batch: DataFrame, number: int) -> None:
        # complete mode: each batch holds all totals so far, so a repeated batch replaces itself
        batch.write.mode("overwrite").parquet(f"{root}/out")

    q = counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out").withColumn("start", F.col("start").cast("timestamp_ntz"))


@R.query("latest_event_of_user", "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1")
def latest_event_of_user(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "events").select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"])


@R.query(
    "event_type_runs",
    """WITH m AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS n FROM events WHERE event_type IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run_no FROM m)
SELECT user_id, run_no::BIGINT AS run_no, min(event_type) AS state, min(ts) AS first_ts, count(*) AS n FROM r GROUP BY 1, 2""",
)
def event_type_runs(spark: SparkSession, d: str) -> DataFrame:
    return state_runs(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type")
