"""Candidate pairs by blocking: equal keys, shared tokens, shared evidence, neighbouring chunks.

Copies meet once: records whose blocking material is equal form a class, pairs are made between
classes, and a membership table leads back to the records. Within small natural groups (a chunk, an
evidence paragraph) records pair directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkframe.functions.text import blocking_tokens, is_strong_key, normalize_name


def entity_keys(entities: DataFrame) -> DataFrame:
    """(document_id, kind, candidate_ref, chunk_ordinal, keys, tokens): normalized names and aliases of
    each candidate, sorted, and their blocking tokens. Null names and aliases count for nothing, and
    repeated rows of a candidate once; of a candidate recorded twice all names count."""
    names = entities.where("document_id is not null and candidate_ref is not null").select(
        "document_id", "kind", "candidate_ref", "chunk_ordinal",
        F.explode(F.array_union(F.array("display_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"),
    )
    keys = names.where("name is not null").withColumn("key", normalize_name(F.col("name"))).where("key <> ''")
    g = keys.groupBy("document_id", "kind", "candidate_ref").agg(F.min("chunk_ordinal").alias("chunk_ordinal"), F.array_sort(F.collect_set("key")).alias("keys"))
    return g.withColumn("tokens", blocking_tokens(F.col("keys")))


def key_classes(keyed: DataFrame) -> DataFrame:
    """(document_id, kind, class_ref, keys, tokens, members): candidates with equal key sets; the least
    reference stands for its class."""
    return keyed.groupBy("document_id", "kind", "keys", "tokens").agg(F.min("candidate_ref").alias("class_ref"), F.count("*").alias("members"))


def class_pairs(classes: DataFrame) -> DataFrame:
    """(document_id, kind, left_ref, right_ref, shared_keys, shared_tokens, state) of different classes
    of one document and kind that share a key or a blocking token.

    `state` is auto_same where a shared key is strong, else needs_decision.
    """
    material = classes.select(
        "document_id", "kind", "class_ref",
        F.explode(F.concat(F.transform("keys", lambda k: F.struct(F.lit(True).alias("is_key"), k.alias("m"))), F.transform("tokens", lambda t: F.struct(F.lit(False).alias("is_key"), t.alias("m"))))).alias("x"),
    ).select("document_id", "kind", "class_ref", "x.is_key", "x.m")
    on = ["document_id", "kind", "is_key", "m"]
    met = material.withColumnRenamed("class_ref", "left_ref").join(material.withColumnRenamed("class_ref", "right_ref"), on).where("left_ref < right_ref")
    pairs = met.groupBy("document_id", "kind", "left_ref", "right_ref").agg(
        F.array_sort(F.collect_set(F.when(F.col("is_key"), F.col("m")))).alias("shared_keys"),
        F.array_sort(F.collect_set(F.when(~F.col("is_key"), F.col("m")))).alias("shared_tokens"),
    )
    return pairs.withColumn("state", F.when(F.exists("shared_keys", is_strong_key), "auto_same").otherwise("needs_decision"))


def chunk_pairs(keyed: DataFrame) -> DataFrame:
    """(document_id, kind, left_ref, right_ref) of candidates of one kind in one chunk."""
    a = keyed.select("document_id", "kind", "chunk_ordinal", F.regexp_extract("candidate_ref", "^([^:]*)", 1).alias("chunk"), F.col("candidate_ref").alias("left_ref"))
    b = a.withColumnRenamed("left_ref", "right_ref")
    return a.join(b, ["document_id", "kind", "chunk_ordinal", "chunk"]).where("left_ref < right_ref").select("document_id", "kind", "left_ref", "right_ref")


def _within(df: DataFrame, on: list[str]) -> DataFrame:
    d = df.select(*on, "candidate_ref").where(" and ".join(f"{c} is not null" for c in on)).distinct()
    return d.withColumnRenamed("candidate_ref", "left_ref").join(d.withColumnRenamed("candidate_ref", "right_ref"), on).where("left_ref < right_ref").select("document_id", "left_ref", "right_ref")


def event_pairs(events: DataFrame) -> DataFrame:
    """(document_id, left_ref, right_ref, signals) of events of one document that have an evidence
    paragraph in common, or are in one chunk, or in neighbouring chunks with an entity in common.
    Signals are sorted: same_paragraph, same_chunk, adjacent_chunk_entity."""
    chunk = F.regexp_extract("candidate_ref", "^([^:]*)", 1)
    e = events.where("document_id is not null and candidate_ref is not null").select(
        "document_id", "chapter_id", "candidate_ref", "chunk_ordinal", chunk.alias("chunk"), F.coalesce(F.col("evidence"), F.array()).alias("evidence"),
        F.array_distinct(F.concat(F.coalesce("participant_refs", F.array().cast("array<string>")), F.coalesce("location_refs", F.array().cast("array<string>")))).alias("ents"),
    )
    e = e.dropDuplicates(["document_id", "candidate_ref"])
    par = _within(e.select("document_id", "candidate_ref", F.explode("evidence.paragraph_id").alias("p")), ["document_id", "p"]).withColumn("s", F.lit("same_paragraph"))
    same = _within(e, ["document_id", "chunk"]).withColumn("s", F.lit("same_chunk"))
    ent = e.select("document_id", "chapter_id", "candidate_ref", "chunk_ordinal", F.explode("ents").alias("ent")).where("ent is not null and chapter_id is not null and chunk_ordinal is not null")
    # a band join of width one as an equi-join on the shifted ordinal
    nxt = ent.select("document_id", "chapter_id", (F.col("chunk_ordinal") - 1).alias("chunk_ordinal"), "ent", F.col("candidate_ref").alias("other"))
    adj = ent.join(nxt, ["document_id", "chapter_id", "chunk_ordinal", "ent"]).where("candidate_ref <> other").select(
        "document_id", F.least("candidate_ref", "other").alias("left_ref"), F.greatest("candidate_ref", "other").alias("right_ref"), F.lit("adjacent_chunk_entity").alias("s")
    )
    return par.unionByName(same).unionByName(adj).groupBy("document_id", "left_ref", "right_ref").agg(F.array_sort(F.collect_set("s")).alias("signals"))


def relationship_key(source: Column, target: Column, direction: Column) -> Column:
    """Ends in order, but sorted where the relationship is symmetric."""
    sym = direction == "symmetric"
    return F.concat_ws("→", F.when(sym, F.least(source, target)).otherwise(source), F.when(sym, F.greatest(source, target)).otherwise(target))
