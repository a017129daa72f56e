"""Queries of problem 4: texts of one chapter that look the same but differ in their characters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkframe.llm.lookalikes import normalize_texts
from inkframe.plans.registry import Registry
from inkframe.scratch import Scratch, table

R = Registry()


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    par = table(spark, sf_dir, "paragraphs").select(F.lit("text_original").alias("field_name"), "document_id", "chapter_id", F.col("para_key").alias("key"), F.col("text_original").alias("body"))
    ev = table(spark, sf_dir, "event_candidates").select(F.lit("summary_zh").alias("field_name"), "document_id", "chapter_id", F.col("event_key").alias("key"), F.col("summary_zh").alias("body"))
    return par.unionByName(ev).where("body is not null and document_id is not null and chapter_id is not null")


@R.query("p4_found")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "lookalikes")
    forms = normalize_texts(spark, _texts(spark, sf_dir), "body", digest_only=True)
    group = ["field_name", "document_id", "chapter_id", "canonical"]
    # from here on texts are digests; repeated rows of a record count once
    rows = scratch.save(forms.select(*group, "key", F.unhex(F.md5("body")).alias("raw")))
    raws = rows.groupBy(*group).agg(F.min("raw").alias("a"), F.max("raw").alias("b")).where("a <> b").select(*group)
    hot = scratch.save(rows.join(raws, group, "left_semi").distinct())
    # first the pairs of different texts, then the records that have them: equal texts never meet
    kinds = hot.select(*group, "raw").distinct()
    pairs = kinds.withColumnRenamed("raw", "raw1").join(kinds.withColumnRenamed("raw", "raw2"), group).where("raw1 < raw2")
    one = hot.select(*group, F.col("raw").alias("raw1"), F.col("key").alias("k1"))
    two = hot.select(*group, F.col("raw").alias("raw2"), F.col("key").alias("k2"))
    met = pairs.join(one, [*group, "raw1"]).join(two, [*group, "raw2"]).where("k1 <> k2")
    return met.select("field_name", F.least("k1", "k2").alias("left_key"), F.greatest("k1", "k2").alias("right_key")).distinct()


@R.query("p4_canonical")
def p4_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consistent form of every text with its document and chapter, and whether it differs from what is
    stored: texts of one chapter and form look the same."""
    forms = normalize_texts(spark, _texts(spark, sf_dir), "body")
    return forms.select("field_name", "document_id", "chapter_id", "key", "canonical", (F.col("canonical") != F.col("body")).alias("changed"))
