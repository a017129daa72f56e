"""Queries of problem 7: documents that hold passages of evaluation items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkframe.llm.leakage import find_leaks
from inkframe.plans.registry import Registry
from inkframe.scratch import table

R = Registry()


def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(spark, table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "text")


@R.query("p7_found")
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one row for each document and item: doc_id and item_id are unique
    return leaks(spark, sf_dir).select("doc_id", "item_id")


@R.query("p7_by_suite")
def p7_by_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per suite and item language: leaked items, documents that hold them, longest passage."""
    items = table(spark, sf_dir, "eval_items").select("item_id", "suite", "lang")
    return leaks(spark, sf_dir).join(items, "item_id").groupBy("suite", "lang").agg(
        F.countDistinct("item_id").alias("items"), F.countDistinct("doc_id").alias("docs"), F.max("matched").alias("longest")
    )
