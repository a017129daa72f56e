"""Queries of problem 8: a mix of the sources at their target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkframe.llm.mixing import mix
from inkframe.plans.registry import Registry
from inkframe.scratch import Scratch, table

R = Registry()


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, targets = table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets")
    return mix(spark, docs.select("doc_id", "text", "source"), "doc_id", "text", "source", targets, Scratch(spark, "mix"))


@R.query("p8_mix")
def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)


@R.query("p8_shares")
def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: target share, share reached, documents, tokens and most repeats used."""
    got = _mixed(spark, sf_dir).groupBy("source").agg(
        F.count("*").alias("rows"), F.countDistinct("doc_id").alias("docs"), F.sum("tokens").alias("tokens"), F.max("repeat").alias("most_repeats")
    )
    total = got.agg(F.sum("tokens").alias("all_tokens"))
    targets = table(spark, sf_dir, "mix_targets")
    # the total is one row
    return targets.join(got, "source", "left").join(F.broadcast(total)).select(
        "source", "target_weight", "max_repeats", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("docs", F.lit(0)).alias("docs"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)).alias("share"), "most_repeats",
    )
