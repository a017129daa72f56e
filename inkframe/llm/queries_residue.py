"""Queries of problem 9: documents that are template residue or error pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkframe.llm.residue import judge_residue
from inkframe.plans.registry import Registry
from inkframe.scratch import table

R = Registry()


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_residue(table(spark, sf_dir, "documents"), "doc_id", "text")


@R.query("p9_found")
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    # doc_id is unique, so the rows are distinct
    return judged(spark, sf_dir).where("residue").select("doc_id")


@R.query("p9_clean")
def p9_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus without residue; the texts do not pass through the judging stage."""
    docs = table(spark, sf_dir, "documents")
    return docs.join(judged(spark, sf_dir).where("residue").select("doc_id"), "doc_id", "left_anti")


@R.query("p9_report")
def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per source and reason."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return docs.join(judged(spark, sf_dir), "doc_id").groupBy("source", "reason").agg(F.count("*").alias("docs"))
