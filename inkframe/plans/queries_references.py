"""Queries of problem 6: references of events and relationships that no candidate answered."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkframe.operators.references import orphan_references
from inkframe.plans.registry import Registry
from inkframe.scratch import Scratch, table

R = Registry()

_ORPHANS = """
WITH refs AS (
  SELECT 'event_candidates' AS table_name, 'participant_refs' AS field_name, document_id, candidate_ref AS referring_ref,
    unnest(participant_refs) AS missing_ref, recorded_at FROM event_candidates
  UNION ALL SELECT 'event_candidates', 'location_refs', document_id, candidate_ref, unnest(location_refs), recorded_at FROM event_candidates
  UNION ALL SELECT 'relationship_candidates', 'source_ref', document_id, candidate_ref, source_ref, recorded_at FROM relationship_candidates
  UNION ALL SELECT 'relationship_candidates', 'target_ref', document_id, candidate_ref, target_ref, recorded_at FROM relationship_candidates
), orphan AS (
  SELECT DISTINCT table_name, field_name, document_id, referring_ref, missing_ref, recorded_at FROM refs r
  WHERE missing_ref IS NOT NULL AND NOT EXISTS (
    SELECT 1 FROM entity_candidates e WHERE e.document_id = r.document_id AND e.candidate_ref = r.missing_ref
      AND e.recorded_at <= r.recorded_at AND (e.deleted_at IS NULL OR e.deleted_at > r.recorded_at))
)
"""


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev, rel = table(spark, sf_dir, "event_candidates"), table(spark, sf_dir, "relationship_candidates")

    def of(df: DataFrame, name: str, field: str) -> DataFrame:
        many = dict(df.dtypes)[field].startswith("array")
        return df.select(
            F.lit(name).alias("table_name"), F.lit(field).alias("field_name"), F.col("document_id").alias("scope"),
            F.col("candidate_ref").alias("referring_ref"), F.col("recorded_at").alias("at"),
            (F.explode(F.array_distinct(field)) if many else F.col(field)).alias("ref"),
        )

    refs = reduce(
        DataFrame.unionByName,
        [of(ev, "event_candidates", "participant_refs"), of(ev, "event_candidates", "location_refs"),
         of(rel, "relationship_candidates", "source_ref"), of(rel, "relationship_candidates", "target_ref")],
    )
    parents = table(spark, sf_dir, "entity_candidates").select(
        F.col("document_id").alias("scope"), F.col("candidate_ref").alias("ref"), F.col("recorded_at").alias("valid_from"), F.col("deleted_at").alias("valid_to")
    )
    return orphan_references(refs, parents, Scratch(spark, "references")).select(
        "table_name", "field_name", F.col("scope").alias("document_id"), "referring_ref", F.col("ref").alias("missing_ref"), "at"
    ).distinct()


@R.query("p6_found", _ORPHANS + "SELECT DISTINCT table_name, field_name, document_id, referring_ref, missing_ref FROM orphan")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir).drop("at").distinct()


@R.query(
    "p6_report",
    _ORPHANS + "SELECT table_name, year(recorded_at)::INT AS year, month(recorded_at)::INT AS month, count(*) AS orphans FROM orphan GROUP BY 1, 2, 3",
)
def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references per table and month."""
    return _orphans(spark, sf_dir).groupBy("table_name", F.year("at").alias("year"), F.month("at").alias("month")).agg(F.count("*").alias("orphans"))
