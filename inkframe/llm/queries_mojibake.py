"""Queries of problem 3: paragraphs decoded with the wrong encoding, and what they said."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkframe.llm.mojibake import MAYBE, repair_texts
from inkframe.plans.registry import Registry
from inkframe.scratch import table

R = Registry()


def garbled(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "paragraphs").where(F.col("text_original").rlike(MAYBE))
    return repair_texts(spark, texts, "para_key", "text_original").where("garbled")


@R.query("p3_found")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled(spark, sf_dir).select("para_key").distinct()


@R.query("p3_restored")
def p3_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The affected paragraphs with the original text, as far as it can be had."""
    return garbled(spark, sf_dir).select("para_key", "restored", (~F.col("restored").rlike("[�\u0080-\u0084\u0086-\u009F]")).alias("whole")).distinct()
