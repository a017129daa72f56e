"""Queries of problem 2: groups of linked candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkframe.llm.components import identity_groups
from inkframe.plans.registry import Registry
from inkframe.scratch import table

R = Registry()

#: Every pair of references that are linked at some distance; UNION keeps the closure finite.
_REACH = """
WITH RECURSIVE link AS (
  SELECT DISTINCT document_id AS d, left_candidate_ref AS a, right_candidate_ref AS b
  FROM reconciliation_decisions
  WHERE decision = 'same_entity' AND left_candidate_ref <> right_candidate_ref AND document_id IS NOT NULL
), arc AS (SELECT d, a, b FROM link UNION SELECT d, b, a FROM link),
reach AS (
  SELECT d, a, b FROM arc
  UNION
  SELECT r.d, r.a, x.b FROM reach r JOIN arc x ON x.d = r.d AND x.a = r.b
)
"""


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, "reconciliation_decisions").where("decision = 'same_entity'")
    return identity_groups(links, "document_id", "left_candidate_ref", "right_candidate_ref")


@R.query("p2_found", _REACH + "SELECT d AS document_id, min(b) AS group_ref, a AS candidate_ref FROM reach GROUP BY d, a")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _groups(spark, sf_dir)


@R.query(
    "p2_group_sizes",
    _REACH
    + """, grp AS (SELECT d, min(b) AS g, a FROM reach GROUP BY d, a), size AS (SELECT d, g, count(*) AS n FROM grp GROUP BY d, g)
SELECT d AS document_id, count(*) AS groups, sum(n)::BIGINT AS members, max(n) AS largest FROM size GROUP BY d""",
)
def p2_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = _groups(spark, sf_dir).groupBy("document_id", "group_ref").agg(F.count("*").alias("n"))
    return sizes.groupBy("document_id").agg(
        F.count("*").alias("groups"), F.sum("n").alias("members"), F.max("n").alias("largest")
    )
