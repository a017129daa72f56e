"""Fail-closed checks: findings as rows, and one verdict over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finding(df: DataFrame, code: str, severity: str, ref: Column) -> DataFrame:
    """(finding_id, code, severity, ref) for the rows of `df`; ids are hashes of the content."""
    return df.select(F.lit(code).alias("code"), F.lit(severity).alias("severity"), ref.cast("string").alias("ref")).distinct().select(
        F.concat(F.lit("fnd_"), F.substring(F.sha2(F.concat_ws("|", "code", "ref"), 256), 1, 20)).alias("finding_id"), "code", "severity", "ref"
    )


def verdict(findings: DataFrame) -> DataFrame:
    """One row: counts by severity and PASS, PASS_WITH_REVIEW_ITEMS or FAIL."""
    of = lambda s: F.count_if(F.col("severity") == s)
    return findings.agg(of("blocking").alias("blocking"), of("review").alias("review"), of("warning").alias("warning")).withColumn(
        "verdict", F.when(F.col("blocking") > 0, "FAIL").when(F.col("review") > 0, "PASS_WITH_REVIEW_ITEMS").otherwise("PASS")
    )


def require_empty(df: DataFrame, what: str) -> None:
    """Raise if there is a row; nothing is repaired or dropped."""
    row = df.head(1)
    if row:
        raise ValueError(f"{what}: {row[0].asDict()}")


def coverage(owners: DataFrame, members: DataFrame, key: list[str]) -> DataFrame:
    """(owned_once, unowned, owned_often) of the members, by how often they are owned."""
    n = owners.groupBy(*key).agg(F.count("*").alias("_n"))
    c = members.select(*key).distinct().join(n, key, "left")
    return c.agg(F.count_if(F.col("_n") == 1).alias("owned_once"), F.count_if(F.col("_n").isNull()).alias("unowned"), F.count_if(F.col("_n") > 1).alias("owned_often"))
