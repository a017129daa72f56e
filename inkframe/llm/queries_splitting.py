"""Queries of problem 1: paragraphs and packets beyond the budget of their profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkframe.llm.splitting import split_texts
from inkframe.plans.registry import Registry
from inkframe.scratch import table

R = Registry()

_OVER = """
SELECT DISTINCT 'paragraph' AS item_kind, para_key AS item_key FROM paragraphs JOIN chunk_profile USING (profile_id)
WHERE greatest(1, ceil(strlen(text_original) / 3.0)) > ownership_budget
UNION SELECT DISTINCT 'packet', packet_key FROM skeleton_measurements JOIN chunk_profile USING (profile_id)
WHERE greatest(1, ceil(strlen(payload) / 3.0)) > ownership_budget
"""


def split_items(spark: SparkSession, sf_dir: str, once: bool = False) -> DataFrame:
    """(item_kind, item_key, pieces, budget) of every text with a profile, one row for each stored row, or with
    `once` for each key: repeated rows go before they are split."""
    # a profile is a row of configuration: the plan broadcasts the table only while it is small
    profile = table(spark, sf_dir, "chunk_profile").select("profile_id", "ownership_budget", "overlap_budget")
    kinds = [("paragraphs", "paragraph", "para_key", "text_original"), ("skeleton_measurements", "packet", "packet_key", "payload")]
    parts = []
    for name, kind, key, text in kinds:
        rows = table(spark, sf_dir, name).select(F.lit(kind).alias("item_kind"), F.col(key).alias("item_key"), F.col(text).alias("body"), "profile_id")
        if once:
            rows = rows.where("body is not null").dropDuplicates(["item_kind", "item_key"])
        parts.append(split_texts(rows.join(profile, "profile_id"), "body", "ownership_budget", "overlap_budget"))
    return parts[0].unionByName(parts[1]).select("item_kind", "item_key", "pieces", F.col("ownership_budget").alias("budget"))


@R.query("p1_found", _OVER)
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_items(spark, sf_dir).where(F.size("pieces") > 1).select("item_kind", "item_key").distinct()


@R.query("p1_pieces")
def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as ordered pieces within its budget; texts that fit are one piece."""
    items = split_items(spark, sf_dir, once=True).where("pieces is not null")
    return items.select("item_kind", "item_key", F.explode("pieces").alias("p")).select("item_kind", "item_key", "p.*")


@R.query(
    "p1_rejoined",
    """SELECT DISTINCT 'paragraph' AS item_kind, para_key AS item_key, md5(text_original) AS text_md5, true AS fits FROM paragraphs JOIN chunk_profile USING (profile_id) WHERE text_original IS NOT NULL
UNION SELECT DISTINCT 'packet', packet_key, md5(payload), true FROM skeleton_measurements JOIN chunk_profile USING (profile_id) WHERE payload IS NOT NULL""",
)
def p1_rejoined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The own parts of the pieces put together again, as a digest, and whether every piece fits its budget."""
    items = split_items(spark, sf_dir, once=True).where("pieces is not null")
    parts = F.expr("transform(pieces, x -> decode(substring(encode(x.text, 'UTF-8'), x.own_byte - x.start_byte + 1), 'UTF-8'))")
    fits = F.forall("pieces", lambda p: F.greatest(F.lit(1), F.ceil(F.octet_length(p["text"]) / 3)) <= F.col("budget"))
    return items.select("item_kind", "item_key", F.md5(F.array_join(parts, "")).alias("text_md5"), fits.alias("fits"))
