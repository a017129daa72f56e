"""Queries over indexes, keys, coverage and lineage of the candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkframe.functions.numeric import distribution
from inkframe.functions.text import normalize_name
from inkframe.operators import blocking
from inkframe.plans.queries_story import _CLASS_PAIRS, _DECIDED, _KEYS, pair_packing
from inkframe.plans.registry import Registry
from inkframe.scratch import table

R = Registry()


@R.query(
    "source_order_keys",
    r"""WITH e AS (SELECT DISTINCT document_id, candidate_ref, chunk_ordinal, x.paragraph_id AS p FROM (SELECT document_id, candidate_ref, chunk_ordinal, unnest(evidence) AS x FROM event_candidates WHERE chunk_ordinal IS NOT NULL)),
k AS (SELECT document_id, candidate_ref, chunk_ordinal, min(regexp_extract(p, '_P(\d+)$', 1)::INT) AS para, regexp_extract(candidate_ref, '(\d+)$', 1)::INT AS suffix FROM e WHERE regexp_matches(p, '_P\d+$') GROUP BY 1, 2, 3)
SELECT document_id, candidate_ref, printf('%06d:%09d:%02d:%09d:%s', chunk_ordinal, para, 2, suffix, candidate_ref) AS source_order_key FROM k""",
)
def source_order_keys(spark: SparkSession, d: str) -> DataFrame:
    """Sortable keys of fixed width, anchored at the earliest evidence paragraph."""
    e = table(spark, d, "event_candidates").where("chunk_ordinal is not null").select("document_id", "candidate_ref", "chunk_ordinal", F.explode("evidence.paragraph_id").alias("p")).where(F.col("p").rlike(r"_P\d+$"))
    k = e.groupBy("document_id", "candidate_ref", "chunk_ordinal").agg(F.min(F.regexp_extract("p", r"_P(\d+)$", 1).cast("int")).alias("para"))
    suffix = F.regexp_extract("candidate_ref", r"(\d+)$", 1).cast("int")
    return k.select("document_id", "candidate_ref", F.format_string("%06d:%09d:%02d:%09d:%s", "chunk_ordinal", "para", F.lit(2), suffix, "candidate_ref").alias("source_order_key"))


@R.query(
    "primary_anchors",
    r"""WITH e AS (SELECT document_id, candidate_ref, x.role AS role, regexp_extract(x.paragraph_id, '_P(\d+)$', 1) AS o FROM (SELECT document_id, candidate_ref, unnest(evidence) AS x FROM relationship_candidates))
SELECT document_id, candidate_ref, coalesce(min(o::INT) FILTER (role = 'primary'), min(o::INT)) AS anchor FROM e WHERE o <> '' GROUP BY 1, 2""",
)
def primary_anchors(spark: SparkSession, d: str) -> DataFrame:
    """Earliest primary evidence paragraph, else earliest of any."""
    e = table(spark, d, "relationship_candidates").select("document_id", "candidate_ref", F.explode("evidence").alias("x"))
    o = F.regexp_extract("x.paragraph_id", r"_P(\d+)$", 1)
    e = e.select("document_id", "candidate_ref", "x.role", o.alias("o")).where("o <> ''").withColumn("o", F.col("o").cast("int"))
    return e.groupBy("document_id", "candidate_ref").agg(F.coalesce(F.min(F.when(F.col("role") == "primary", F.col("o"))), F.min("o")).alias("anchor"))


@R.query(
    "alias_lookup",
    f"""WITH {_KEYS}, a AS (SELECT document_id, kind, candidate_ref, unnest(keys) AS alias FROM full_keys)
SELECT document_id, alias, count(*) AS entries, CASE WHEN count(*) = 1 THEN min(candidate_ref) END AS resolved_ref FROM a GROUP BY 1, 2""",
)
def alias_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A normalized alias resolves only if exactly one entry has it."""
    a = blocking.entity_keys(table(spark, d, "entity_candidates")).select("document_id", "candidate_ref", F.explode("keys").alias("alias"))
    g = a.groupBy("document_id", "alias").agg(F.count("*").alias("entries"), F.min("candidate_ref").alias("first"))
    return g.select("document_id", "alias", "entries", F.when(F.col("entries") == 1, F.col("first")).alias("resolved_ref"))


_CLASS_OF = ", cls AS (SELECT f.document_id, f.candidate_ref, min(c.class_ref) AS class_ref FROM full_keys f JOIN classes c USING (document_id, kind, keys, tokens) GROUP BY 1, 2)"


@R.query(
    "decision_coverage",
    _CLASS_PAIRS
    + _CLASS_OF
    + f""", {_DECIDED}, dc AS (SELECT DISTINCT d.document_id, least(a.class_ref, b.class_ref) AS l, greatest(a.class_ref, b.class_ref) AS r FROM dec d
  JOIN cls a ON a.document_id = d.document_id AND a.candidate_ref = d.l JOIN cls b ON b.document_id = d.document_id AND b.candidate_ref = d.r WHERE a.class_ref <> b.class_ref),
pl AS (SELECT DISTINCT document_id, l, r FROM pairs)
SELECT CASE WHEN dc.l IS NULL THEN 'undecided' WHEN pl.l IS NULL THEN 'not_planned' ELSE 'decided' END AS outcome, count(*) AS pairs FROM pl FULL JOIN dc ON pl.document_id = dc.document_id AND pl.l = dc.l AND pl.r = dc.r GROUP BY 1""",
)
def decision_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Planned class pairs against decided ones, in both directions."""
    keyed = blocking.entity_keys(table(spark, d, "entity_candidates"))
    classes = blocking.key_classes(keyed)
    of = keyed.join(classes, ["document_id", "kind", "keys", "tokens"]).groupBy("document_id", "candidate_ref").agg(F.min("class_ref").alias("class_ref"))
    t = table(spark, d, "reconciliation_decisions").where("document_id is not null and left_candidate_ref <> right_candidate_ref and decision is not null")
    t = t.select("document_id", "left_candidate_ref", "right_candidate_ref").distinct()
    m = t.join(of.select("document_id", F.col("candidate_ref").alias("left_candidate_ref"), F.col("class_ref").alias("a")), ["document_id", "left_candidate_ref"]).join(
        of.select("document_id", F.col("candidate_ref").alias("right_candidate_ref"), F.col("class_ref").alias("b")), ["document_id", "right_candidate_ref"]
    )
    decided = m.where("a <> b").select("document_id", F.least("a", "b").alias("left_ref"), F.greatest("a", "b").alias("right_ref"), F.lit(1).alias("in_d")).distinct()
    planned = blocking.class_pairs(classes).select("document_id", "left_ref", "right_ref", F.lit(1).alias("in_p")).distinct()
    o = F.when(F.col("in_d").isNull(), "undecided").when(F.col("in_p").isNull(), "not_planned").otherwise("decided")
    return planned.join(decided, ["document_id", "left_ref", "right_ref"], "full_outer").groupBy(o.alias("outcome")).agg(F.count("*").alias("pairs"))


@R.query("packing_distribution")
def packing_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Pairs and ends of the packed blocks: least, median, 95th percentile, greatest."""
    b = pair_packing(spark, d)
    x = b.select(F.explode(F.array(F.struct(F.lit("pairs").alias("measure"), F.col("pairs").cast("long").alias("v")), F.struct(F.lit("ends").alias("measure"), F.col("ends").cast("long").alias("v")))).alias("x")).select("x.*")
    return x.groupBy("measure").agg(F.count("*").alias("blocks"), *distribution("v"))


@R.query(
    "window_policies",
    """WITH n AS (SELECT document_id, count(DISTINCT event_key) AS n FROM event_candidates WHERE document_id IS NOT NULL GROUP BY 1),
p AS (SELECT unnest([6, 12, 24]) AS owned), c AS (SELECT unnest([0, 2, 4]) AS context)
SELECT owned, context, sum(ceil(n / owned))::BIGINT AS windows, max(least(n, owned + 2 * context))::BIGINT AS largest FROM n, p, c GROUP BY 1, 2""",
)
def window_policies(spark: SparkSession, d: str) -> DataFrame:
    """What window sizes and contexts would cost: windows in all, rows in the largest."""
    n = table(spark, d, "event_candidates").where("document_id is not null").select("document_id", "event_key").distinct().groupBy("document_id").count()
    policies = [F.struct(F.lit(o).alias("owned"), F.lit(c).alias("context")) for o in (6, 12, 24) for c in (0, 2, 4)]
    x = n.select("count", F.explode(F.array(*policies)).alias("p")).select("count", "p.owned", "p.context")
    return x.groupBy("owned", "context").agg(
        F.sum(F.ceil(F.col("count") / F.col("owned"))).alias("windows"), F.max(F.least(F.col("count"), F.col("owned") + 2 * F.col("context")).cast("long")).alias("largest")
    )


@R.query(
    "global_index",
    """WITH k AS (SELECT document_id, 'entities' AS part, count(DISTINCT candidate_ref) AS n FROM entity_candidates GROUP BY 1
UNION ALL SELECT document_id, 'events', count(DISTINCT candidate_ref) FROM event_candidates GROUP BY 1 UNION ALL SELECT document_id, 'relationships', count(DISTINCT candidate_ref) FROM relationship_candidates GROUP BY 1
UNION ALL SELECT document_id, 'paragraphs', count(DISTINCT paragraph_id) FROM paragraphs GROUP BY 1)
SELECT document_id, coalesce(sum(n) FILTER (part = 'entities'), 0)::BIGINT AS entities, coalesce(sum(n) FILTER (part = 'events'), 0)::BIGINT AS events,
  coalesce(sum(n) FILTER (part = 'relationships'), 0)::BIGINT AS relationships, coalesce(sum(n) FILTER (part = 'paragraphs'), 0)::BIGINT AS paragraphs FROM k GROUP BY 1""",
)
def global_index(spark: SparkSession, d: str) -> DataFrame:
    """Size of every part of a document's index, also where a part is missing."""
    parts = [("entity_candidates", "candidate_ref", "entities"), ("event_candidates", "candidate_ref", "events"), ("relationship_candidates", "candidate_ref", "relationships"), ("paragraphs", "paragraph_id", "paragraphs")]
    rows = None
    for name, key, part in parts:
        x = table(spark, d, name).where(F.col(key).isNotNull()).select("document_id", F.col(key).alias("k"), F.lit(part).alias("part")).distinct()
        rows = x if rows is None else rows.unionByName(x)
    g = rows.groupBy("document_id", "part").count()
    return g.groupBy("document_id").agg(*[F.coalesce(F.sum(F.when(F.col("part") == p, F.col("count"))), F.lit(0)).alias(p) for _, _, p in parts])


@R.query(
    "id_gaps",
    r"""WITH i AS (SELECT DISTINCT document_id, regexp_extract(candidate_ref, '^(.*)_\d+$', 1) AS stem, regexp_extract(candidate_ref, '_(\d+)$', 1)::INT AS n FROM event_candidates WHERE regexp_matches(candidate_ref, '_\d+$'))
SELECT document_id, stem, max(n) AS last, (max(n) - count(*))::BIGINT AS missing FROM i GROUP BY 1, 2 HAVING max(n) > count(*)""",
)
def id_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Local ids that are not 1, 2, ..., n."""
    i = table(spark, d, "event_candidates").where(F.col("candidate_ref").rlike(r"_\d+$"))
    i = i.select("document_id", F.regexp_extract("candidate_ref", r"^(.*)_\d+$", 1).alias("stem"), F.regexp_extract("candidate_ref", r"_(\d+)$", 1).cast("int").alias("n")).distinct()
    return i.groupBy("document_id", "stem").agg(F.max("n").alias("last"), (F.max("n") - F.count("*")).alias("missing")).where("missing > 0")


@R.query(
    "plan_hashes",
    "WITH p AS (SELECT DISTINCT document_id, chapter_id, order_key || '|' || candidate_ref AS k FROM event_candidates WHERE order_key IS NOT NULL AND candidate_ref IS NOT NULL) SELECT document_id, chapter_id, sha256(string_agg(k, ';' ORDER BY k)) AS plan_hash, count(*) AS n FROM p GROUP BY 1, 2",
)
def plan_hashes(spark: SparkSession, d: str) -> DataFrame:
    """One hash of a chapter's ordered index: equal exactly if the index is."""
    p = table(spark, d, "event_candidates").where("order_key is not null and candidate_ref is not null").select("document_id", "chapter_id", F.concat_ws("|", "order_key", "candidate_ref").alias("k")).distinct()
    return p.groupBy("document_id", "chapter_id").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("k")), ";"), 256).alias("plan_hash"), F.count("*").alias("n"))


@R.query(
    "lineage_steps",
    """WITH p AS (SELECT DISTINCT pointer_id, revision, previous_pointer_ref.artifact_id AS a, previous_pointer_ref.revision AS r FROM current_pointers),
l AS (SELECT *, lag(revision) OVER (PARTITION BY pointer_id ORDER BY revision) AS before FROM p)
SELECT CASE WHEN r IS NULL THEN 'none' WHEN a <> pointer_id THEN 'other_pointer' WHEN r = before THEN 'before' WHEN r < revision THEN 'older' ELSE 'not_older' END AS step, count(*) AS n FROM l GROUP BY 1""",
)
def lineage_steps(spark: SparkSession, d: str) -> DataFrame:
    """Where previous references lead, against the revision that really is before."""
    p = table(spark, d, "current_pointers").select("pointer_id", "revision", F.col("previous_pointer_ref.artifact_id").alias("a"), F.col("previous_pointer_ref.revision").alias("r")).distinct()
    l = p.withColumn("before", F.lag("revision").over(Window.partitionBy("pointer_id").orderBy("revision")))  # noqa: E741
    step = F.when(F.col("r").isNull(), "none").when(F.col("a") != F.col("pointer_id"), "other_pointer").when(F.col("r") == F.col("before"), "before").when(F.col("r") < F.col("revision"), "older").otherwise("not_older")
    return l.groupBy(step.alias("step")).agg(F.count("*").alias("n"))


@R.query(
    "evidence_labels",
    "SELECT DISTINCT document_id, candidate_ref, array_to_string(list_transform(evidence, lambda e, i: 'L' || (i - 1) || ':' || e.paragraph_id), '|') AS labels FROM relationship_candidates WHERE evidence IS NOT NULL",
)
def evidence_labels(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "relationship_candidates").where("evidence is not null")
    labels = F.transform("evidence", lambda e, i: F.concat(F.lit("L"), i.cast("string"), F.lit(":"), e["paragraph_id"]))
    return r.select("document_id", "candidate_ref", F.array_join(labels, "|").alias("labels")).distinct()


@R.query(
    "relationship_pairs",
    """WITH r AS (SELECT DISTINCT document_id, candidate_ref, chunk_ordinal, state_zh, relationship_type_zh, split_part(candidate_ref, ':', 1) AS chunk,
  CASE WHEN direction = 'symmetric' THEN least(source_ref, target_ref) || '→' || greatest(source_ref, target_ref) ELSE source_ref || '→' || target_ref END AS ends
  FROM relationship_candidates WHERE source_ref IS NOT NULL AND target_ref IS NOT NULL)
SELECT a.document_id, a.candidate_ref AS left_ref, b.candidate_ref AS right_ref, a.relationship_type_zh IS NOT DISTINCT FROM b.relationship_type_zh AS same_type,
  a.state_zh IS NOT DISTINCT FROM b.state_zh AS same_state, a.chunk = b.chunk AS same_chunk FROM r a JOIN r b ON a.document_id = b.document_id AND a.ends = b.ends AND a.candidate_ref < b.candidate_ref""",
)
def relationship_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Relationships of one document between the same ends; null states equal null states."""
    r = table(spark, d, "relationship_candidates").where("source_ref is not null and target_ref is not null")
    k = blocking.relationship_key(F.col("source_ref"), F.col("target_ref"), F.col("direction"))
    r = r.select("document_id", k.alias("ends"), F.struct("candidate_ref", "relationship_type_zh", "state_zh", F.regexp_extract("candidate_ref", "^([^:]*)", 1).alias("chunk")).alias("a")).distinct()
    p = r.join(r.withColumnRenamed("a", "b"), ["document_id", "ends"]).where("a.candidate_ref < b.candidate_ref")
    same = lambda f: F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}"))
    return p.select(
        "document_id", F.col("a.candidate_ref").alias("left_ref"), F.col("b.candidate_ref").alias("right_ref"),
        same("relationship_type_zh").alias("same_type"), same("state_zh").alias("same_state"), same("chunk").alias("same_chunk"),
    )


@R.query(
    "name_variants",
    """WITH n AS (SELECT DISTINCT document_id, display_name, lower(nfc_normalize(regexp_replace(trim(display_name), '\\s+', ' ', 'g'))) AS k FROM entity_candidates WHERE display_name IS NOT NULL)
SELECT document_id, k AS name_key, count(*) AS variants, min(display_name) AS first_variant FROM n GROUP BY 1, 2 HAVING count(*) > 1""",
)
def name_variants(spark: SparkSession, d: str) -> DataFrame:
    """Display names that differ only in width, case or white space."""
    n = table(spark, d, "entity_candidates").where("display_name is not null").select("document_id", "display_name").distinct()
    g = n.groupBy("document_id", normalize_name(F.col("display_name")).alias("name_key"))
    return g.agg(F.count("*").alias("variants"), F.min("display_name").alias("first_variant")).where("variants > 1")
