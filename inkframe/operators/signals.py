"""Pairs of facts, events and relationships with every signal that speaks for them.

Pairs come from equi-joins over small natural groups: an evidence paragraph, a chunk and its neighbour,
an entity as one chunk knows it. Records with equal texts may be many; they meet the least of their group
only, which leads to the others. Signals are then told by the two records themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkframe.functions.text import normalize_name
from inkframe.operators.blocking import relationship_key



def strings(c: str) -> Column:
    """An array of strings without nulls and repeats; null as empty."""
    return F.array_distinct(F.filter(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: x.isNotNull()))


def folded(c: str) -> Column:
    """Folded text; null as empty."""
    return F.coalesce(normalize_name(F.col(c)), F.lit(""))


def _meet(df: DataFrame, on: list[str]) -> DataFrame:
    d = df.select(*on, "ref").where(" and ".join(f"{c} is not null" for c in on)).distinct()
    return d.withColumnRenamed("ref", "left_ref").join(d.withColumnRenamed("ref", "right_ref"), on).where("left_ref < right_ref").select("scope", "left_ref", "right_ref")


def _neighbours(df: DataFrame, on: list[str]) -> DataFrame:
    """Pairs with equal `on` in one chunk and the next: a band join of width one as an equi-join."""
    d = df.select(*on, "chunk", "ref").where(" and ".join(f"{c} is not null" for c in [*on, "chunk"])).distinct()
    nxt = d.select(*on, (F.col("chunk") - 1).alias("chunk"), F.col("ref").alias("other"))
    return d.join(nxt, [*on, "chunk"]).where("ref <> other").select("scope", F.least("ref", "other").alias("left_ref"), F.greatest("ref", "other").alias("right_ref"))


def _with_least(df: DataFrame, on: list[str]) -> DataFrame:
    """Each record with the least of its group, however large that is."""
    least = df.groupBy(*on).agg(F.min("ref").alias("left_ref"), F.count("*").alias("n")).where("n > 1").drop("n")
    return df.select(*on, F.col("ref").alias("right_ref")).join(least, on).where("left_ref < right_ref").select("scope", "left_ref", "right_ref")


def _told(parts: list[DataFrame], records: DataFrame, rules: dict[str, object]) -> DataFrame:
    """(scope, left_ref, right_ref, signals): sorted names of the rules that hold for each pair."""
    pairs = reduce(DataFrame.unionByName, parts).distinct()
    whole = F.struct(*[c for c in records.columns if c not in ("scope", "ref")])
    l = records.select("scope", F.col("ref").alias("left_ref"), whole.alias("l"))  # noqa: E741
    r = records.select("scope", F.col("ref").alias("right_ref"), whole.alias("r"))
    both = pairs.join(l, ["scope", "left_ref"]).join(r, ["scope", "right_ref"])
    names = F.array(*[F.when(rule(F.col("l"), F.col("r")), F.lit(name)) for name, rule in rules.items()])
    return both.select("scope", "left_ref", "right_ref", F.array_sort(F.filter(names, lambda x: x.isNotNull())).alias("signals"))


def _equal(c: str):
    return lambda l, r: (l[c] != "") & (l[c] == r[c])


def _overlap(c: str):
    return lambda l, r: F.arrays_overlap(l[c], r[c])


_CHUNKS = {
    "same_chunk": lambda l, r: (l["chapter"] == r["chapter"]) & (l["chunk"] == r["chunk"]),
    "adjacent_chunk": lambda l, r: (l["chapter"] == r["chapter"]) & (F.abs(l["chunk"] - r["chunk"]) == 1),
}
_EVIDENCE = {"evidence_paragraph_overlap": _overlap("paragraphs")}


def fact_records(facts: DataFrame) -> DataFrame:
    """(scope, ref, chapter, chunk, kind, text, subjects, objects, bound, paragraphs, exact) of facts
    (document_id, chapter_id, chunk_ordinal, candidate_ref, fact_type, statement_zh, subject_refs,
    object_refs, evidence). Rows without a document or reference are left out, repeated ones count once."""
    f = facts.where("document_id is not null and candidate_ref is not null").select(
        F.col("document_id").alias("scope"), F.col("candidate_ref").alias("ref"), F.col("chapter_id").alias("chapter"), F.col("chunk_ordinal").alias("chunk"),
        folded("fact_type").alias("kind"), folded("statement_zh").alias("text"), strings("subject_refs").alias("subjects"), strings("object_refs").alias("objects"),
        F.array_distinct(F.coalesce(F.col("evidence.paragraph_id"), F.array().cast("array<string>"))).alias("paragraphs"),
    )
    f = f.dropDuplicates(["scope", "ref"]).withColumn("bound", F.array_union("subjects", "objects"))
    return f.withColumn("exact", F.sha2(F.to_json(F.struct("kind", "text", F.array_sort("subjects").alias("s"), F.array_sort("objects").alias("o"))), 256))


def fact_pairs(facts: DataFrame) -> DataFrame:
    """(scope, left_ref, right_ref, signals) of facts with equal statements, a common evidence paragraph, or
    one type and a common entity or the same or neighbouring chunks."""
    f = fact_records(facts)
    typed = f.where("kind <> ''")
    parts = [
        _with_least(f.where("text <> ''"), ["scope", "text"]),
        _meet(f.select("scope", "ref", F.explode("paragraphs").alias("p")), ["scope", "p"]),
        _meet(typed.select("scope", "kind", "ref", F.explode("bound").alias("e")), ["scope", "kind", "e"]),
        _meet(typed, ["scope", "kind", "chapter", "chunk"]),
        _neighbours(typed, ["scope", "kind", "chapter"]),
    ]
    rules = {
        "same_fact_type": _equal("kind"), "exact_normalized_statement": _equal("text"), "subject_overlap": _overlap("subjects"), "object_overlap": _overlap("objects"),
        "bound_entity_overlap": _overlap("bound"), **_EVIDENCE, **_CHUNKS, "exact_safe_key": _equal("exact"),
    }
    return _told(parts, f, rules)


def event_records(events: DataFrame) -> DataFrame:
    """(scope, ref, chapter, chunk, text, participants, locations, bound, paragraphs, exact) of events. The
    exact key is the folded summary with participants, locations and mode."""
    e = events.where("document_id is not null and candidate_ref is not null").select(
        F.col("document_id").alias("scope"), F.col("candidate_ref").alias("ref"), F.col("chapter_id").alias("chapter"), F.col("chunk_ordinal").alias("chunk"),
        folded("summary_zh").alias("text"), strings("participant_refs").alias("participants"), strings("location_refs").alias("locations"), F.col("temporal_mode").alias("mode"),
        F.array_distinct(F.coalesce(F.col("evidence.paragraph_id"), F.array().cast("array<string>"))).alias("paragraphs"), "order_key",
    )
    e = e.dropDuplicates(["scope", "ref"]).withColumn("bound", F.array_union("participants", "locations"))
    return e.withColumn("exact", F.sha2(F.to_json(F.struct("text", F.array_sort("participants").alias("p"), F.array_sort("locations").alias("l"), "mode")), 256))


def event_signals(events: DataFrame) -> DataFrame:
    """(scope, left_ref, right_ref, signals) of events with equal summaries, a common evidence paragraph, one
    chunk, neighbouring chunks and a common entity, or a common participant and location."""
    e = event_records(events)
    places = e.select("scope", "ref", "locations", F.explode("participants").alias("p")).select("scope", "ref", "p", F.explode("locations").alias("l"))
    parts = [
        _with_least(e.where("text <> ''"), ["scope", "text"]),
        _meet(e.select("scope", "ref", F.explode("paragraphs").alias("p")), ["scope", "p"]),
        _meet(e, ["scope", "chapter", "chunk"]),
        _neighbours(e.select("scope", "chapter", "chunk", "ref", F.explode("bound").alias("x")), ["scope", "chapter", "x"]),
        _meet(places, ["scope", "p", "l"]),
    ]
    rules = {
        "exact_normalized_summary": _equal("text"), "participant_overlap": _overlap("participants"), "location_overlap": _overlap("locations"),
        "bound_entity_overlap": _overlap("bound"), **_EVIDENCE, **_CHUNKS, "exact_safe_key": _equal("exact"),
    }
    return _told(parts, e, rules)


def relationship_signals(relationships: DataFrame) -> DataFrame:
    """(scope, left_ref, right_ref, signals) of relationships between the same ends, which an unordered pair
    names where they are symmetric. Null states equal null states only."""
    r = relationships.where("document_id is not null and candidate_ref is not null and source_ref is not null and target_ref is not null").select(
        F.col("document_id").alias("scope"), F.col("candidate_ref").alias("ref"), F.col("chapter_id").alias("chapter"), F.col("chunk_ordinal").alias("chunk"),
        relationship_key(F.col("source_ref"), F.col("target_ref"), F.col("direction")).alias("ends"), folded("relationship_type_zh").alias("kind"),
        normalize_name(F.col("state_zh")).alias("state"), F.array_distinct(F.coalesce(F.col("evidence.paragraph_id"), F.array().cast("array<string>"))).alias("paragraphs"),
    )
    r = r.dropDuplicates(["scope", "ref"])
    rules = {
        "same_endpoint_group": _equal("ends"), "exact_normalized_relationship_type": _equal("kind"), "state_equal": lambda l, r: l["state"].eqNullSafe(r["state"]), **_EVIDENCE, **_CHUNKS,
        "exact_safe_key": lambda l, r: (l["ends"] == r["ends"]) & (l["kind"] != "") & (l["kind"] == r["kind"]),
    }
    return _told([_meet(r, ["scope", "ends"])], r, rules)
