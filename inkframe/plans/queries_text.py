"""Queries over texts: token estimates, headings, paragraphs, chunks, hashes and seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkframe.functions import hashing, numeric, text
from inkframe.operators.checks import coverage
from inkframe.operators.chunking import plan_chunks
from inkframe.operators.ingest import paragraphs
from inkframe.plans.registry import Registry
from inkframe.scratch import table

R = Registry()


@R.query("token_estimate", "SELECT DISTINCT para_key, greatest(1, ceil(strlen(text_original) / 3.0))::BIGINT AS tokens FROM paragraphs WHERE text_original IS NOT NULL")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "paragraphs").where("text_original is not null")
    return p.select("para_key", text.estimate_tokens(F.col("text_original")).alias("tokens")).distinct()


_LINES = "SELECT doc_id, unnest(string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))) AS line FROM documents"
_KIND = f"""CASE WHEN regexp_matches(trim(line), '{text.HEADING_SPECIAL}') THEN lower(regexp_extract(trim(line), '{text.HEADING_SPECIAL}', 1))
  WHEN regexp_matches(trim(line), '{text.HEADING_ENGLISH}') THEN lower(regexp_extract(trim(line), '{text.HEADING_ENGLISH}', 1))
  WHEN regexp_matches(trim(line), '{text.HEADING_CHINESE}') THEN CASE WHEN regexp_matches(trim(line), '^第[^章节卷部]*[卷部]') THEN 'part'
    WHEN regexp_matches(trim(line), '^(序章|序言|楔子)') THEN 'prologue' WHEN regexp_matches(trim(line), '^(尾声|后记)') THEN 'epilogue' ELSE 'chapter' END END"""


@R.query("heading_lines", f"WITH l AS ({_LINES}), k AS (SELECT doc_id, {_KIND} AS kind FROM l) SELECT doc_id, kind, count(*) AS n FROM k WHERE kind IS NOT NULL GROUP BY ALL")
def heading_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split(text.normalize_newlines(F.col("text")), "\n", -1)).alias("line"))
    return lines.select("doc_id", text.heading_kind(F.col("line")).alias("kind")).where("kind is not null").groupBy("doc_id", "kind").agg(F.count("*").alias("n"))


@R.query(
    "document_paragraphs",
    f"""WITH a AS (SELECT doc_id, string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM a),
k AS (SELECT doc_id, i, regexp_replace(line, '\\s+$', '') AS t, NOT regexp_matches(line, '\\S') AS b, {_KIND} AS h FROM l),
s AS (SELECT *, sum(CASE WHEN h IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS sec FROM k),
m AS (SELECT *, bool_or(b) OVER (PARTITION BY doc_id, sec) AS split, sum(b::INT) OVER (PARTITION BY doc_id, sec ORDER BY i) AS blanks FROM s WHERE h IS NULL),
p AS (SELECT doc_id, sec, CASE WHEN split THEN blanks ELSE i END AS g, min(i) AS i, string_agg(t, chr(10) ORDER BY i) AS text FROM m WHERE NOT b GROUP BY 1, 2, 3)
SELECT p.doc_id, dense_rank() OVER (PARTITION BY p.doc_id ORDER BY p.sec)::INT AS chapter_no, coalesce(s.h, 'synthetic') AS chapter_kind, trim(s.t) AS heading,
  row_number() OVER (PARTITION BY p.doc_id, p.sec ORDER BY p.i)::INT AS paragraph_no, text
FROM p LEFT JOIN (SELECT * FROM s WHERE h IS NOT NULL) s ON s.doc_id = p.doc_id AND s.sec = p.sec""",
)
def document_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return paragraphs(table(spark, d, "documents"), "doc_id", "text")


def _chunks(spark: SparkSession, d: str, with_owned: bool = False) -> DataFrame:
    prof = table(spark, d, "chunk_profile")
    p = table(spark, d, "paragraphs").join(prof, "profile_id")
    return plan_chunks(p, ["document_id", "chapter_id"], "ord", "paragraph_id", "text_original", "ownership_budget", "overlap_budget", "context_budget", with_owned)


@R.query("chunk_plan")
def chunk_plan(spark: SparkSession, d: str) -> DataFrame:
    """Greedy chunks of every chapter, with ownership and context; a fold, checked by brute force in the tests."""
    return _chunks(spark, d)


@R.query(
    "chunk_coverage",
    """WITH k AS (SELECT DISTINCT document_id, chapter_id, paragraph_id FROM paragraphs JOIN chunk_profile USING (profile_id) WHERE ord IS NOT NULL AND paragraph_id IS NOT NULL)
SELECT count(*) AS owned_once, (SELECT count(*) FROM (SELECT DISTINCT document_id, chapter_id, paragraph_id FROM paragraphs EXCEPT SELECT * FROM k)) AS unowned, 0::BIGINT AS owned_often FROM k""",
)
def chunk_coverage(spark: SparkSession, d: str) -> DataFrame:
    """How many paragraphs one chunk owns, none, and several, by the paragraphs that the chunks hold."""
    owned = _chunks(spark, d, with_owned=True).select("document_id", "chapter_id", F.explode("owned").alias("paragraph_id"))
    known = table(spark, d, "paragraphs").select("document_id", "chapter_id", "paragraph_id")
    return coverage(owned, known, ["document_id", "chapter_id", "paragraph_id"])


@R.query(
    "chunk_sizes",
    """WITH p AS (SELECT DISTINCT document_id, chapter_id, profile_id, ord, paragraph_id, strlen(coalesce(text_original, '')) AS b FROM paragraphs WHERE ord IS NOT NULL AND paragraph_id IS NOT NULL)
SELECT document_id, chapter_id, count(*) AS paragraphs, sum(b)::BIGINT AS bytes FROM p JOIN chunk_profile USING (profile_id) GROUP BY 1, 2""",
)
def chunk_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Per chapter the paragraphs and bytes that its chunks own together."""
    c = _chunks(spark, d, with_owned=True)
    p = table(spark, d, "paragraphs").where("ord is not null").select("document_id", "chapter_id", "paragraph_id", F.octet_length(F.coalesce("text_original", F.lit(""))).cast("long").alias("b")).distinct()
    ids = c.select("document_id", "chapter_id", F.explode("owned").alias("paragraph_id")).join(p, ["document_id", "chapter_id", "paragraph_id"])
    return ids.groupBy("document_id", "chapter_id").agg(F.count("*").alias("paragraphs"), F.sum("b").alias("bytes"))


@R.query("base_language", "SELECT lower(regexp_split_to_array(trim(lang), '[-_]')[1]) AS language, count(*) AS docs, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1")
def base_language(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy(text.base_language(F.col("lang")).alias("language")).agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"))


@R.query(
    "template_fields",
    r"SELECT doc_id, f AS field, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\{\{\s*([A-Za-z_][A-Za-z0-9_]*)\s*\}\}', 1)) AS f FROM documents) GROUP BY ALL",
)
def template_fields(spark: SparkSession, d: str) -> DataFrame:
    f = F.explode(F.regexp_extract_all("text", F.lit(r"\{\{\s*([A-Za-z_][A-Za-z0-9_]*)\s*\}\}"), F.lit(1)))
    return table(spark, d, "documents").select("doc_id", f.alias("field")).groupBy("doc_id", "field").agg(F.count("*").alias("n"))


@R.query("content_hashes", "SELECT doc_id, sha256(text) AS content_hash, 'doc_' || substr(sha256(coalesce(source, '') || '|' || doc_id), 1, 20) AS short_id FROM documents")
def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").withColumn("source", F.coalesce("source", F.lit("")))
    return t.select("doc_id", hashing.content_hash(F.col("text")).alias("content_hash"), hashing.short_id("doc_", F.concat_ws("|", "source", F.col("doc_id").cast("string"))).alias("short_id"))


@R.query(
    "duplicate_texts",
    "SELECT sha256(text) AS content_hash, min(doc_id) AS first_doc, count(*) AS copies, count(DISTINCT source) AS sources FROM documents GROUP BY 1 HAVING count(*) > 1",
)
def duplicate_texts(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "documents").groupBy(F.sha2("text", 256).alias("content_hash"))
    return g.agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), F.countDistinct("source").alias("sources")).where("copies > 1")


@R.query(
    "generation_seeds",
    """WITH k AS (SELECT DISTINCT project_id, document_id, chunk_ordinal FROM event_candidates WHERE chunk_ordinal >= 1),
h AS (SELECT *, sha256(project_id || '|' || document_id || '|' || chunk_ordinal) AS x FROM k)
SELECT project_id, document_id, chunk_ordinal, ((instr('0123456789abcdef', substr(x, 1, 1)) - 1) % 8)::HUGEINT * 1152921504606846976 + ('0x' || substr(x, 2, 15))::BIGINT AS seed FROM h""",
)
def generation_seeds(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "event_candidates").where("chunk_ordinal >= 1").select("project_id", "document_id", "chunk_ordinal").distinct()
    return k.withColumn("seed", hashing.deterministic_seed(F.col("project_id"), F.col("document_id"), F.col("chunk_ordinal")))


@R.query(
    "shot_frames",
    """WITH s AS (SELECT doc_id, json_extract_string(text, '$.shot_id') AS shot_id, json_extract_string(text, '$.framing') AS framing,
  json_extract_string(text, '$.duration_seconds')::DOUBLE AS seconds FROM documents WHERE source = 'shot_prompts' AND text LIKE '{"shot_id"%' AND json_valid(text)),
n AS (SELECT *, greatest(5, round_even(seconds * 24, 0))::BIGINT AS f FROM s WHERE seconds IS NOT NULL)
SELECT doc_id, shot_id, framing, seconds, f + (((5 - f) % 17) + 17) % 17 AS frames FROM n""",
)
def shot_frames(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").where("source = 'shot_prompts' and startswith(text, '{\"shot_id\"')")
    s = t.where(hashing.canonicalize_json(F.col("text")).isNotNull()).select("doc_id", F.from_json("text", "shot_id string, framing string, duration_seconds double").alias("j")).where("j.duration_seconds is not null")
    return s.select("doc_id", "j.shot_id", "j.framing", F.col("j.duration_seconds").alias("seconds"), numeric.frames_for_seconds(F.col("j.duration_seconds")).alias("frames"))


@R.query(
    "packet_distribution",
    """SELECT profile_id, count(*) AS packets, min(rendered_prompt_estimated_tokens) AS least, quantile_disc(rendered_prompt_estimated_tokens, 0.5) AS median,
  quantile_disc(rendered_prompt_estimated_tokens, 0.95) AS p95, max(rendered_prompt_estimated_tokens) AS greatest FROM skeleton_measurements GROUP BY 1""",
)
def packet_distribution(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "skeleton_measurements")
    return m.groupBy("profile_id").agg(F.count("*").alias("packets"), *numeric.distribution("rendered_prompt_estimated_tokens"))


@R.query(
    "measurement_audit",
    """SELECT packet_key, greatest(1, ceil(strlen(payload) / 3.0))::BIGINT AS tokens, strlen(payload)::BIGINT AS bytes, packet_estimated_tokens AS stored_tokens, packet_bytes AS stored_bytes
FROM (SELECT DISTINCT packet_key, payload, packet_estimated_tokens, packet_bytes FROM skeleton_measurements)
WHERE packet_estimated_tokens IS DISTINCT FROM greatest(1, ceil(strlen(payload) / 3.0))::BIGINT OR packet_bytes IS DISTINCT FROM strlen(payload)""",
)
def measurement_audit(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "skeleton_measurements").select("packet_key", "payload", F.col("packet_estimated_tokens").alias("stored_tokens"), F.col("packet_bytes").alias("stored_bytes")).distinct()
    m = m.withColumn("tokens", text.estimate_tokens(F.col("payload"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    return m.where(~F.col("tokens").eqNullSafe(F.col("stored_tokens")) | ~F.col("bytes").eqNullSafe(F.col("stored_bytes"))).drop("payload")


@R.query(
    "budget_preflight",
    """SELECT profile_id, count(*) FILTER (rendered_prompt_estimated_tokens + reserved_output_tokens <= 8192) AS fits, count(*) AS packets, max(rendered_prompt_estimated_tokens + reserved_output_tokens) AS largest
FROM skeleton_measurements GROUP BY 1""",
)
def budget_preflight(spark: SparkSession, d: str) -> DataFrame:
    need = F.col("rendered_prompt_estimated_tokens") + F.col("reserved_output_tokens")
    return table(spark, d, "skeleton_measurements").groupBy("profile_id").agg(F.count_if(need <= 8192).alias("fits"), F.count("*").alias("packets"), F.max(need).alias("largest"))
