"""Queries over candidates, decisions and pointers: blocking, resolution, consolidation, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkframe.functions.text import is_strong_key
from inkframe.operators import blocking, checks, consolidate, graph
from inkframe.operators.chunking import pack_pairs
from inkframe.operators.ranking import rank_within
from inkframe.operators.windows import plan_windows
from inkframe.plans.folding import folded
from inkframe.plans.registry import Registry
from inkframe.scratch import Scratch, table
from inkframe.sources.store import missing

R = Registry()

_KEYS = f"""
names AS (SELECT document_id, kind, candidate_ref, chunk_ordinal, unnest(list_prepend(display_name, coalesce(aliases, []))) AS name FROM entity_candidates
  WHERE document_id IS NOT NULL AND candidate_ref IS NOT NULL),
norm AS (SELECT *, {folded('name')} AS key FROM names WHERE name IS NOT NULL),
keyed AS (SELECT document_id, kind, candidate_ref, min(chunk_ordinal) AS chunk_ordinal, list_sort(list_distinct(list(key))) AS keys FROM norm WHERE key <> '' GROUP BY 1, 2, 3),
tok AS (SELECT document_id, kind, candidate_ref, t FROM (SELECT document_id, kind, candidate_ref, unnest(regexp_extract_all(key, '[\\p{{L}}\\p{{N}}]+')) AS t FROM norm)
  WHERE length(t) >= 2 AND NOT regexp_matches(t, '^\\p{{N}}+$') AND t NOT IN ('the', 'of')),
toks AS (SELECT document_id, kind, candidate_ref, list_sort(list_distinct(list(t))) AS tokens FROM tok GROUP BY 1, 2, 3),
full_keys AS (SELECT k.*, coalesce(t.tokens, []) AS tokens FROM keyed k LEFT JOIN toks t USING (document_id, kind, candidate_ref)),
classes AS (SELECT document_id, kind, keys, tokens, min(candidate_ref) AS class_ref, count(*) AS members FROM full_keys GROUP BY 1, 2, 3, 4)
"""
_WEAK = ", ".join(f"'{w}'" for w in __import__("inkframe.functions.text", fromlist=["WEAK_KEYS"]).WEAK_KEYS)
_STRONG = f"""(regexp_matches(k, '\\p{{L}}') AND k NOT IN ({_WEAK}) AND (len(list_distinct(list_filter(regexp_extract_all(k, '[\\p{{L}}\\p{{N}}]+'), lambda x: length(x) >= 2 AND NOT regexp_matches(x, '^\\p{{N}}+$')))) >= 2
  OR len(regexp_extract_all(k, '[一-鿿]')) >= 3))"""


def _keyed(spark: SparkSession, d: str) -> DataFrame:
    return blocking.entity_keys(table(spark, d, "entity_candidates"))


@R.query("identity_keys", f"WITH {_KEYS} SELECT document_id, kind, candidate_ref, array_to_string(keys, '|') AS keys, array_to_string(tokens, '|') AS tokens FROM full_keys")
def identity_keys(spark: SparkSession, d: str) -> DataFrame:
    return _keyed(spark, d).select("document_id", "kind", "candidate_ref", F.array_join("keys", "|").alias("keys"), F.array_join("tokens", "|").alias("tokens"))


@R.query("strong_keys", f"WITH {_KEYS}, k1 AS (SELECT DISTINCT unnest(keys) AS k FROM full_keys) SELECT k AS identity_key, {_STRONG} AS strong FROM k1")
def strong_keys(spark: SparkSession, d: str) -> DataFrame:
    k = _keyed(spark, d).select(F.explode("keys").alias("identity_key")).distinct()
    return k.withColumn("strong", is_strong_key(F.col("identity_key")))


@R.query("entity_classes", f"WITH {_KEYS} SELECT document_id, kind, class_ref, array_to_string(keys, '|') AS keys, members FROM classes")
def entity_classes(spark: SparkSession, d: str) -> DataFrame:
    return blocking.key_classes(_keyed(spark, d)).select("document_id", "kind", "class_ref", F.array_join("keys", "|").alias("keys"), "members")


_CLASS_PAIRS = f"""WITH {_KEYS},
mk AS (SELECT document_id, kind, class_ref, unnest(keys) AS m FROM classes), mt AS (SELECT document_id, kind, class_ref, unnest(tokens) AS m FROM classes),
pk AS (SELECT a.document_id, a.kind, a.class_ref AS l, b.class_ref AS r, list_sort(list(DISTINCT a.m)) AS ks FROM mk a JOIN mk b ON a.document_id = b.document_id AND a.kind = b.kind AND a.m = b.m AND a.class_ref < b.class_ref GROUP BY 1, 2, 3, 4),
pt AS (SELECT a.document_id, a.kind, a.class_ref AS l, b.class_ref AS r, list_sort(list(DISTINCT a.m)) AS ts FROM mt a JOIN mt b ON a.document_id = b.document_id AND a.kind = b.kind AND a.m = b.m AND a.class_ref < b.class_ref GROUP BY 1, 2, 3, 4),
pairs AS (SELECT document_id, kind, l, r, coalesce(ks, []) AS ks, coalesce(ts, []) AS ts,
  CASE WHEN len(list_filter(coalesce(ks, []), lambda k: {_STRONG})) > 0 THEN 'auto_same' ELSE 'needs_decision' END AS state FROM pk FULL JOIN pt USING (document_id, kind, l, r))
"""


@R.query("class_pairs", _CLASS_PAIRS + "SELECT document_id, kind, l AS left_ref, r AS right_ref, array_to_string(ks, '|') AS shared_keys, array_to_string(ts, '|') AS shared_tokens, state FROM pairs")
def class_pairs(spark: SparkSession, d: str) -> DataFrame:
    p = blocking.class_pairs(blocking.key_classes(_keyed(spark, d)))
    return p.withColumns({c: F.array_join(c, "|") for c in ("shared_keys", "shared_tokens")})


@R.query("pair_states", _CLASS_PAIRS + "SELECT kind, state, count(*) AS pairs FROM pairs GROUP BY 1, 2")
def pair_states(spark: SparkSession, d: str) -> DataFrame:
    return blocking.class_pairs(blocking.key_classes(_keyed(spark, d))).groupBy("kind", "state").agg(F.count("*").alias("pairs"))


@R.query(
    "chunk_pairs",
    f"""WITH {_KEYS} SELECT a.document_id, a.kind, a.candidate_ref AS left_ref, b.candidate_ref AS right_ref FROM full_keys a JOIN full_keys b
ON a.document_id = b.document_id AND a.kind = b.kind AND a.chunk_ordinal = b.chunk_ordinal AND split_part(a.candidate_ref, ':', 1) = split_part(b.candidate_ref, ':', 1) AND a.candidate_ref < b.candidate_ref""",
)
def chunk_pairs(spark: SparkSession, d: str) -> DataFrame:
    return blocking.chunk_pairs(_keyed(spark, d))


@R.query(
    "entity_components",
    _CLASS_PAIRS
    + """SELECT document_id, kind, class_ref, min(root) AS root FROM (
  WITH RECURSIVE same AS (SELECT document_id, kind, l, r FROM pairs WHERE state = 'auto_same' UNION SELECT document_id, kind, r, l FROM pairs WHERE state = 'auto_same'),
  reach AS (SELECT document_id, kind, class_ref, class_ref AS root FROM classes UNION SELECT x.document_id, x.kind, x.class_ref, s.r FROM reach x JOIN same s ON s.document_id = x.document_id AND s.kind = x.kind AND s.l = x.root)
  SELECT * FROM reach) GROUP BY 1, 2, 3""",
)
def entity_components(spark: SparkSession, d: str) -> DataFrame:
    """Classes joined by a strong key, at any distance; the least reference names the component."""
    scratch = Scratch(spark, "entities")
    classes = scratch.save(blocking.key_classes(_keyed(spark, d)).withColumn("scope", F.struct("document_id", "kind")))
    same = blocking.class_pairs(classes).where("state = 'auto_same'").select(F.struct("document_id", "kind").alias("scope"), F.col("left_ref").alias("a"), F.col("right_ref").alias("b"))
    c = graph.components(same, scratch)
    least = c.groupBy("scope", "root").agg(F.min("node").alias("least"))
    named = c.join(least, ["scope", "root"]).select("scope", F.col("node").alias("class_ref"), "least")
    return classes.join(named, ["scope", "class_ref"], "left").select("document_id", "kind", "class_ref", F.coalesce("least", "class_ref").alias("root"))


@R.query(
    "canonical_entities",
    f"""WITH {_KEYS}, e AS (SELECT document_id, kind, keys, min(candidate_ref) AS first_ref, count(*) AS members FROM full_keys WHERE kind IN ('character', 'location') GROUP BY 1, 2, 3)
SELECT document_id, kind, CASE kind WHEN 'character' THEN 'char_' ELSE 'loc_' END || lpad(row_number() OVER (PARTITION BY document_id, kind ORDER BY first_ref)::VARCHAR, 6, '0') AS entity_id, first_ref, members FROM e""",
)
def canonical_entities(spark: SparkSession, d: str) -> DataFrame:
    c = blocking.key_classes(_keyed(spark, d)).where("kind in ('character', 'location')").withColumnRenamed("class_ref", "first_ref")
    prefix = F.when(F.col("kind") == "character", "char").otherwise("loc")
    c = c.select("document_id", "kind", "first_ref", "members")
    return consolidate.number_within(c, ["document_id", "kind"], ["first_ref"], prefix, Scratch(spark, "entities"), 6)


_EVENTS = """ev AS (SELECT DISTINCT ON (document_id, candidate_ref) * FROM event_candidates WHERE document_id IS NOT NULL AND candidate_ref IS NOT NULL ORDER BY document_id, candidate_ref, ingested_at),
ents AS (SELECT DISTINCT document_id, chapter_id, candidate_ref, chunk_ordinal, e FROM (SELECT *, unnest(list_concat(coalesce(participant_refs, []), coalesce(location_refs, []))) AS e FROM ev) WHERE e IS NOT NULL)"""


_EVENT_PAIRS = f"""WITH {_EVENTS}, p AS (SELECT DISTINCT document_id, candidate_ref, x.paragraph_id AS p FROM (SELECT document_id, candidate_ref, unnest(evidence) AS x FROM ev) WHERE x.paragraph_id IS NOT NULL),
s AS (SELECT a.document_id, a.candidate_ref AS l, b.candidate_ref AS r, 'same_paragraph' AS s FROM p a JOIN p b USING (document_id, p) WHERE a.candidate_ref < b.candidate_ref
 UNION SELECT a.document_id, a.candidate_ref, b.candidate_ref, 'same_chunk' FROM ev a JOIN ev b ON a.document_id = b.document_id AND split_part(a.candidate_ref, ':', 1) = split_part(b.candidate_ref, ':', 1) WHERE a.candidate_ref < b.candidate_ref
 UNION SELECT a.document_id, least(a.candidate_ref, b.candidate_ref), greatest(a.candidate_ref, b.candidate_ref), 'adjacent_chunk_entity' FROM ents a JOIN ents b
  ON a.document_id = b.document_id AND a.chapter_id = b.chapter_id AND a.chunk_ordinal + 1 = b.chunk_ordinal AND a.e = b.e WHERE a.candidate_ref <> b.candidate_ref)
SELECT document_id, l AS left_ref, r AS right_ref, string_agg(s, '|' ORDER BY s) AS signals FROM s GROUP BY 1, 2, 3"""


@R.query("event_pairs", _EVENT_PAIRS)
def event_pairs(spark: SparkSession, d: str) -> DataFrame:
    return blocking.event_pairs(table(spark, d, "event_candidates")).withColumn("signals", F.array_join("signals", "|"))


@R.query("signal_combinations", _EVENT_PAIRS.replace("SELECT document_id, l AS left_ref", "SELECT signals, count(*) AS pairs FROM (SELECT document_id, l AS left_ref", 1) + ") GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25")
def signal_combinations(spark: SparkSession, d: str) -> DataFrame:
    """The 25 most frequent sets of signals of event pairs; ties by name."""
    p = blocking.event_pairs(table(spark, d, "event_candidates"))
    return p.groupBy(F.array_join("signals", "|").alias("signals")).agg(F.count("*").alias("pairs")).orderBy(F.desc("pairs"), "signals").limit(25)


@R.query("pair_packing")
def pair_packing(spark: SparkSession, d: str) -> DataFrame:
    """Pairs that need a decision, packed greedily per chapter of their left end, which bounds the fold;
    (document_id, chapter, block_no, pairs, ends)."""
    p = blocking.class_pairs(blocking.key_classes(_keyed(spark, d))).where("state = 'needs_decision'")
    p = p.withColumn("chapter", F.regexp_extract("left_ref", "^([^_:]*)", 1))
    b = pack_pairs(p, ["document_id", "chapter"], [], "left_ref", "right_ref")
    ends = F.size(F.array_distinct(F.concat(F.collect_list("left_ref"), F.collect_list("right_ref"))))
    return b.groupBy("document_id", "chapter", "block_no").agg(F.count("*").alias("pairs"), ends.alias("ends"))


@R.query(
    "relationship_keys",
    """WITH r AS (SELECT DISTINCT document_id, candidate_ref, source_ref, target_ref, direction, relationship_type_zh FROM relationship_candidates WHERE source_ref IS NOT NULL AND target_ref IS NOT NULL)
SELECT document_id, CASE WHEN direction = 'symmetric' THEN least(source_ref, target_ref) || '→' || greatest(source_ref, target_ref) ELSE source_ref || '→' || target_ref END AS ends,
  relationship_type_zh, count(*) AS candidates, min(candidate_ref) AS first_ref FROM r GROUP BY 1, 2, 3""",
)
def relationship_keys(spark: SparkSession, d: str) -> DataFrame:
    cols = ["document_id", "candidate_ref", "source_ref", "target_ref", "direction", "relationship_type_zh"]
    r = table(spark, d, "relationship_candidates").select(*cols).where("source_ref is not null and target_ref is not null").distinct()
    k = blocking.relationship_key(F.col("source_ref"), F.col("target_ref"), F.col("direction"))
    return r.groupBy("document_id", k.alias("ends"), "relationship_type_zh").agg(F.count("*").alias("candidates"), F.min("candidate_ref").alias("first_ref"))


_STATES = """st AS (SELECT DISTINCT document_id, candidate_ref, order_key, state_zh, relationship_type_zh,
  CASE WHEN direction = 'symmetric' THEN least(source_ref, target_ref) || '→' || greatest(source_ref, target_ref) ELSE source_ref || '→' || target_ref END AS ends
  FROM relationship_candidates WHERE source_ref IS NOT NULL AND target_ref IS NOT NULL)"""


def _states(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "relationship_candidates").where("source_ref is not null and target_ref is not null")
    k = blocking.relationship_key(F.col("source_ref"), F.col("target_ref"), F.col("direction"))
    return r.select("document_id", "candidate_ref", "order_key", "state_zh", "relationship_type_zh", k.alias("ends")).distinct()


@R.query(
    "state_runs",
    f"""WITH {_STATES}, m AS (SELECT *, CASE WHEN lag(state_zh) OVER w = state_zh THEN 0 ELSE 1 END AS n FROM st WHERE state_zh IS NOT NULL WINDOW w AS (PARTITION BY document_id, ends, relationship_type_zh ORDER BY order_key, candidate_ref)),
r AS (SELECT *, sum(n) OVER (PARTITION BY document_id, ends, relationship_type_zh ORDER BY order_key, candidate_ref) AS run_no FROM m)
SELECT document_id, ends, relationship_type_zh, run_no::BIGINT AS run_no, min(state_zh) AS state, min(order_key) AS first_order_key, count(*) AS n FROM r GROUP BY 1, 2, 3, 4""",
)
def state_runs(spark: SparkSession, d: str) -> DataFrame:
    return consolidate.state_runs(_states(spark, d), ["document_id", "ends", "relationship_type_zh"], ["order_key", "candidate_ref"], "state_zh")


@R.query(
    "state_transitions",
    f"""WITH {_STATES}, t AS (SELECT document_id, lag(state_zh) OVER w AS from_state, state_zh AS to_state FROM st WHERE state_zh IS NOT NULL WINDOW w AS (PARTITION BY document_id, ends, relationship_type_zh ORDER BY order_key, candidate_ref))
SELECT from_state, to_state, count(*) AS n FROM t WHERE from_state <> to_state GROUP BY 1, 2""",
)
def state_transitions(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("document_id", "ends", "relationship_type_zh").orderBy("order_key", "candidate_ref")
    t = _states(spark, d).where("state_zh is not null").select(F.lag("state_zh").over(w).alias("from_state"), F.col("state_zh").alias("to_state"))
    return t.where("from_state <> to_state").groupBy("from_state", "to_state").agg(F.count("*").alias("n"))


@R.query(
    "event_modes",
    """WITH e AS (SELECT DISTINCT document_id, candidate_ref, order_key, summary_zh, temporal_mode FROM event_candidates WHERE summary_zh IS NOT NULL),
g AS (SELECT document_id, regexp_replace(trim(summary_zh), '\\s+', ' ', 'g') AS summary, min(order_key) AS first_order, count(*) AS candidates,
  CASE WHEN count(DISTINCT temporal_mode) FILTER (temporal_mode <> 'unknown') = 1 THEN min(temporal_mode) FILTER (temporal_mode <> 'unknown') ELSE 'unknown' END AS temporal_mode FROM e GROUP BY 1, 2)
SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY first_order, summary)::INT AS narrative_order FROM g""",
)
def event_modes(spark: SparkSession, d: str) -> DataFrame:
    """The one known mode of the events of each summary, or unknown."""
    e = table(spark, d, "event_candidates").where("summary_zh is not null").select("document_id", "candidate_ref", "order_key", "summary_zh", "temporal_mode").distinct()
    g = e.groupBy("document_id", F.regexp_replace(F.trim("summary_zh"), r"\s+", " ").alias("summary")).agg(
        F.min("order_key").alias("first_order"), F.count("*").alias("candidates"), consolidate.settled_mode("temporal_mode").alias("temporal_mode")
    )
    ranked = rank_within(g, ["document_id"], ["first_order", "summary"], Scratch(spark, "events"), "narrative_order")
    return ranked.withColumn("narrative_order", (F.col("narrative_order") + 1).cast("int"))


@R.query(
    "evidence_union",
    """WITH e AS (SELECT DISTINCT document_id, candidate_ref, order_key, evidence, chunk_ordinal, chapter_id FROM event_candidates),
x AS (SELECT document_id, chapter_id, order_key, candidate_ref, unnest(list_transform(evidence, lambda v: v.paragraph_id)) AS p, generate_subscripts(evidence, 1) AS i FROM e),
f AS (SELECT document_id, chapter_id, p, min((order_key, candidate_ref, i)) AS k FROM x GROUP BY 1, 2, 3)
SELECT document_id, chapter_id, string_agg(p, '|' ORDER BY k) AS paragraphs FROM f GROUP BY 1, 2""",
)
def evidence_union(spark: SparkSession, d: str) -> DataFrame:
    """Evidence paragraphs of a chapter's events, each once, in the order in which they first come."""
    e = table(spark, d, "event_candidates").select("document_id", "chapter_id", "candidate_ref", "order_key", F.col("evidence.paragraph_id").alias("ps")).distinct()
    u = e.where("ps is not null").groupBy("document_id", "chapter_id").agg(consolidate.ordered_union(F.struct("order_key", "candidate_ref"), F.col("ps")).alias("ps"))
    return u.where("size(ps) > 0").select("document_id", "chapter_id", F.array_join("ps", "|").alias("paragraphs"))


def _stream(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "event_candidates").select("document_id", "event_key", "order_key", "participant_refs", "location_refs").groupBy("document_id", "event_key").agg(
        F.min("order_key").alias("order_key"), F.min("participant_refs").alias("participant_refs"), F.min("location_refs").alias("location_refs")
    )


_WINDOWS = """pl AS (SELECT document_id, event_key, row_number() OVER (PARTITION BY document_id ORDER BY min(order_key), event_key) - 1 AS place FROM event_candidates WHERE document_id IS NOT NULL GROUP BY 1, 2),
lst AS (SELECT document_id, max(place) AS last FROM pl GROUP BY 1),
win AS (SELECT document_id, unnest(range(0, last // 12 + 1)) AS window_no FROM lst),
pw AS (SELECT p.document_id, w.window_no::INT AS window_no, p.event_key, p.place, CASE WHEN p.place // 12 = w.window_no THEN 'owned' WHEN p.place < w.window_no * 12 THEN 'before' ELSE 'after' END AS role
  FROM win w JOIN pl p ON p.document_id = w.document_id AND p.place >= w.window_no * 12 - 4 AND p.place < (w.window_no + 1) * 12 + 4)"""


@R.query("plot_windows", f"WITH {_WINDOWS} SELECT document_id, window_no, event_key, place::INT AS place, role FROM pw")
def plot_windows(spark: SparkSession, d: str) -> DataFrame:
    return plan_windows(_stream(spark, d), "document_id", ["order_key", "event_key"], 12, 4, Scratch(spark, "windows")).select("document_id", "window_no", "event_key", "place", "role")


@R.query(
    "window_entities",
    f"""WITH {_WINDOWS}, r AS (SELECT DISTINCT document_id, event_key, e FROM (SELECT document_id, event_key, unnest(list_concat(coalesce(participant_refs, []), coalesce(location_refs, []))) AS e FROM event_candidates) WHERE e IS NOT NULL)
SELECT pw.document_id, window_no, e AS entity_ref, count(*) AS events FROM pw JOIN r USING (document_id, event_key) GROUP BY 1, 2, 3""",
)
def window_entities(spark: SparkSession, d: str) -> DataFrame:
    """Entities of the owned and context events of every window."""
    w = plan_windows(_stream(spark, d), "document_id", ["order_key", "event_key"], 12, 4, Scratch(spark, "windows"))
    none = F.array().cast("array<string>")
    refs = F.array_distinct(F.concat(F.coalesce("participant_refs", none), F.coalesce("location_refs", none)))
    return w.select("document_id", "window_no", F.explode(refs).alias("entity_ref")).where("entity_ref is not null").groupBy("document_id", "window_no", "entity_ref").agg(F.count("*").alias("events"))


@R.query(
    "character_packages",
    """WITH c AS (SELECT DISTINCT document_id, candidate_ref FROM entity_candidates WHERE kind = 'character'),
e AS (SELECT DISTINCT document_id, event_key, p FROM (SELECT document_id, event_key, unnest(participant_refs) AS p FROM event_candidates)),
r AS (SELECT DISTINCT document_id, candidate_ref, x FROM (SELECT document_id, candidate_ref, unnest([source_ref, target_ref]) AS x FROM relationship_candidates)),
ec AS (SELECT document_id, p, count(*) AS n FROM e GROUP BY 1, 2), rc AS (SELECT document_id, x, count(*) AS n FROM r GROUP BY 1, 2)
SELECT c.document_id, c.candidate_ref, coalesce(ec.n, 0) AS events, coalesce(rc.n, 0) AS relationships FROM c
LEFT JOIN ec ON ec.document_id = c.document_id AND ec.p = c.candidate_ref LEFT JOIN rc ON rc.document_id = c.document_id AND rc.x = c.candidate_ref""",
)
def character_packages(spark: SparkSession, d: str) -> DataFrame:
    """Evidence of every character, also of those without any: counted per key before the joins."""
    c = table(spark, d, "entity_candidates").where("kind = 'character'").select("document_id", "candidate_ref").distinct()
    e = table(spark, d, "event_candidates").select("document_id", "event_key", F.explode("participant_refs").alias("candidate_ref")).distinct()
    r = table(spark, d, "relationship_candidates").select("document_id", F.col("candidate_ref").alias("rel"), F.explode(F.array("source_ref", "target_ref")).alias("candidate_ref")).distinct()
    key = ["document_id", "candidate_ref"]
    ec, rc = e.groupBy(*key).agg(F.count("*").alias("events")), r.groupBy(*key).agg(F.count("*").alias("relationships"))
    return c.join(ec, key, "left").join(rc, key, "left").fillna(0, ["events", "relationships"])


@R.query(
    "latest_revisions",
    "SELECT pointer_id, max(revision) AS revision, arg_max(target_ref.artifact_type, revision) AS artifact_type, arg_max(target_ref.artifact_id, revision) AS artifact_id FROM current_pointers GROUP BY 1",
)
def latest_revisions(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "current_pointers").select("pointer_id", "revision", F.col("target_ref.artifact_type").alias("artifact_type"), F.col("target_ref.artifact_id").alias("artifact_id"))
    return consolidate.latest(p, ["pointer_id"], ["revision"])


@R.query(
    "revision_gaps",
    "SELECT pointer_id, min(revision) AS first, max(revision) AS last, (max(revision) - min(revision) + 1 - count(DISTINCT revision))::BIGINT AS missing FROM current_pointers GROUP BY 1 HAVING max(revision) - min(revision) + 1 > count(DISTINCT revision)",
)
def revision_gaps(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "current_pointers").select("pointer_id", "revision").distinct().groupBy("pointer_id")
    return g.agg(F.min("revision").alias("first"), F.max("revision").alias("last"), (F.max("revision") - F.min("revision") + 1 - F.count("*")).alias("missing")).where("missing > 0")


@R.query(
    "supersession_audit",
    """WITH p AS (SELECT DISTINCT pointer_id, revision, previous_pointer_ref.artifact_id AS a, previous_pointer_ref.revision AS r FROM current_pointers),
s AS (SELECT DISTINCT superseding_pointer_ref.artifact_id AS pointer_id, superseding_pointer_ref.revision AS revision, superseded_pointer_ref.artifact_id AS sa, superseded_pointer_ref.revision AS sr FROM supersession_records)
SELECT CASE WHEN s.pointer_id IS NULL THEN 'no_record' WHEN p.pointer_id IS NULL THEN 'no_pointer' WHEN p.a IS NOT DISTINCT FROM s.sa AND p.r IS NOT DISTINCT FROM s.sr THEN 'agrees' ELSE 'differs' END AS outcome, count(*) AS n
FROM p FULL JOIN s USING (pointer_id, revision) GROUP BY 1""",
)
def supersession_audit(spark: SparkSession, d: str) -> DataFrame:
    """The pointer log against the supersession records, in both directions."""
    p = table(spark, d, "current_pointers").select("pointer_id", "revision", F.col("previous_pointer_ref.artifact_id").alias("a"), F.col("previous_pointer_ref.revision").alias("r"), F.lit(1).alias("in_p")).distinct()
    s = table(spark, d, "supersession_records").select(
        F.col("superseding_pointer_ref.artifact_id").alias("pointer_id"), F.col("superseding_pointer_ref.revision").alias("revision"),
        F.col("superseded_pointer_ref.artifact_id").alias("sa"), F.col("superseded_pointer_ref.revision").alias("sr"), F.lit(1).alias("in_s"),
    ).distinct()
    o = F.when(F.col("in_s").isNull(), "no_record").when(F.col("in_p").isNull(), "no_pointer").when(F.col("a").eqNullSafe(F.col("sa")) & F.col("r").eqNullSafe(F.col("sr")), "agrees").otherwise("differs")
    return p.join(s, ["pointer_id", "revision"], "full_outer").groupBy(o.alias("outcome")).agg(F.count("*").alias("n"))


_DECIDED = """dec AS (SELECT DISTINCT document_id, least(left_candidate_ref, right_candidate_ref) AS l, greatest(left_candidate_ref, right_candidate_ref) AS r, decision FROM reconciliation_decisions
  WHERE document_id IS NOT NULL AND left_candidate_ref <> right_candidate_ref AND decision IS NOT NULL)"""


@R.query("decision_conflicts", f"WITH {_DECIDED} SELECT document_id, l AS left_ref, r AS right_ref, string_agg(decision, '|' ORDER BY decision) AS decisions FROM dec GROUP BY 1, 2, 3 HAVING count(*) > 1")
def decision_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Pairs, in either order, that were decided differently."""
    t = table(spark, d, "reconciliation_decisions").where("document_id is not null and left_candidate_ref <> right_candidate_ref and decision is not null")
    g = t.groupBy("document_id", F.least("left_candidate_ref", "right_candidate_ref").alias("left_ref"), F.greatest("left_candidate_ref", "right_candidate_ref").alias("right_ref"))
    return g.agg(F.array_sort(F.collect_set("decision")).alias("ds")).where("size(ds) > 1").select("document_id", "left_ref", "right_ref", F.array_join("ds", "|").alias("decisions"))


@R.query(
    "decision_distance",
    r"""WITH d AS (SELECT DISTINCT decision_id, decision, regexp_extract(left_candidate_ref, '^CH(\d+)', 1) AS a, regexp_extract(right_candidate_ref, '^CH(\d+)', 1) AS b FROM reconciliation_decisions)
SELECT decision, CASE WHEN abs(a::INT - b::INT) = 0 THEN 'same' WHEN abs(a::INT - b::INT) = 1 THEN 'adjacent' WHEN abs(a::INT - b::INT) <= 5 THEN 'near' ELSE 'far' END AS distance, count(*) AS n FROM d WHERE a <> '' AND b <> '' GROUP BY 1, 2""",
)
def decision_distance(spark: SparkSession, d: str) -> DataFrame:
    """Decisions by how many chapters apart their ends are."""
    ch = lambda c: F.regexp_extract(c, r"^CH(\d+)", 1).try_cast("int")
    t = table(spark, d, "reconciliation_decisions").select("decision_id", "decision", F.abs(ch(F.col("left_candidate_ref")) - ch(F.col("right_candidate_ref"))).alias("x")).distinct().where("x is not null")
    label = F.when(F.col("x") == 0, "same").when(F.col("x") == 1, "adjacent").when(F.col("x") <= 5, "near").otherwise("far")
    return t.groupBy("decision", label.alias("distance")).agg(F.count("*").alias("n"))


@R.query(
    "identity_conflicts",
    f"""WITH RECURSIVE {_DECIDED}, arc AS (SELECT document_id, l, r FROM dec WHERE decision = 'same_entity' UNION SELECT document_id, r, l FROM dec WHERE decision = 'same_entity'),
reach AS (SELECT document_id, l, r FROM arc UNION SELECT x.document_id, x.l, a.r FROM reach x JOIN arc a ON a.document_id = x.document_id AND a.l = x.r)
SELECT DISTINCT d.document_id, d.l AS left_ref, d.r AS right_ref FROM dec d JOIN reach ON reach.document_id = d.document_id AND reach.l = d.l AND reach.r = d.r WHERE d.decision = 'different_entity'""",
)
def identity_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Pairs told apart that chains of same_entity decisions nevertheless join."""
    scratch = Scratch(spark, "conflicts")
    t = table(spark, d, "reconciliation_decisions").where("document_id is not null and left_candidate_ref <> right_candidate_ref and decision is not null")
    t = scratch.save(t.select(F.col("document_id").alias("scope"), F.least("left_candidate_ref", "right_candidate_ref").alias("a"), F.greatest("left_candidate_ref", "right_candidate_ref").alias("b"), "decision").distinct())
    c = scratch.save(graph.components(t.where("decision = 'same_entity'").select("scope", "a", "b"), scratch))
    apart = t.where("decision = 'different_entity'")
    return apart.join(c.select("scope", F.col("node").alias("a"), "root"), ["scope", "a"]).join(c.select("scope", F.col("node").alias("b"), "root"), ["scope", "b", "root"]).select(
        F.col("scope").alias("document_id"), F.col("a").alias("left_ref"), F.col("b").alias("right_ref")
    )


_DIRECTED = "g AS (SELECT DISTINCT document_id, source_ref AS a, target_ref AS b FROM relationship_candidates WHERE document_id IS NOT NULL AND direction = 'directed' AND source_ref IS NOT NULL AND target_ref IS NOT NULL)"


@R.query(
    "relationship_cycles",
    f"WITH RECURSIVE {_DIRECTED}, reach AS (SELECT document_id, a, b FROM g UNION SELECT r.document_id, r.a, g.b FROM reach r JOIN g ON g.document_id = r.document_id AND g.a = r.b) SELECT document_id, a AS node FROM reach WHERE a = b",
)
def relationship_cycles(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "relationship_candidates").where("document_id is not null and direction = 'directed'")
    return graph.on_cycles(r.select(F.col("document_id").alias("scope"), F.col("source_ref").alias("a"), F.col("target_ref").alias("b")), Scratch(spark, "cycles")).withColumnRenamed("scope", "document_id")


@R.query(
    "relationship_reach",
    f"""WITH RECURSIVE {_DIRECTED}, s AS (SELECT document_id, min(a) AS a FROM g GROUP BY 1),
reach AS (SELECT g.document_id, g.b FROM g JOIN s USING (document_id, a) UNION SELECT r.document_id, g.b FROM reach r JOIN g ON g.document_id = r.document_id AND g.a = r.b) SELECT document_id, b AS node FROM reach""",
)
def relationship_reach(spark: SparkSession, d: str) -> DataFrame:
    """What each document's first source reaches over directed relationships."""
    scratch = Scratch(spark, "reach")
    g = scratch.save(table(spark, d, "relationship_candidates").where("document_id is not null and direction = 'directed' and source_ref is not null and target_ref is not null").select(F.col("document_id").alias("scope"), F.col("source_ref").alias("a"), F.col("target_ref").alias("b")).distinct())
    return graph.reachable(g, g.groupBy("scope").agg(F.min("a").alias("node")), scratch).withColumnRenamed("scope", "document_id")


_FINDINGS = """f AS (
  SELECT 'self_relationship' AS code, 'blocking' AS severity, document_id || '/' || candidate_ref AS ref FROM relationship_candidates WHERE source_ref = target_ref
  UNION SELECT 'no_evidence', 'review', document_id || '/' || candidate_ref FROM entity_candidates WHERE evidence IS NULL OR len(evidence) = 0
  UNION SELECT 'no_summary', 'warning', document_id || '/' || candidate_ref FROM event_candidates WHERE summary_zh IS NULL
  UNION SELECT 'no_primary', 'review', document_id || '/' || candidate_ref FROM event_candidates WHERE len(evidence) > 0 AND len(list_filter(evidence, lambda v: v.role = 'primary')) = 0)"""


def _findings(spark: SparkSession, d: str) -> DataFrame:
    ref = F.concat_ws("/", "document_id", "candidate_ref")
    rel, ent, ev = (table(spark, d, f"{n}_candidates").where("document_id is not null and candidate_ref is not null") for n in ("relationship", "entity", "event"))
    parts = [
        checks.finding(rel.where("source_ref = target_ref"), "self_relationship", "blocking", ref),
        checks.finding(ent.where("evidence is null or size(evidence) = 0"), "no_evidence", "review", ref),
        checks.finding(ev.where("summary_zh is null"), "no_summary", "warning", ref),
        checks.finding(ev.where("size(evidence) > 0 and not exists(evidence, v -> v.role = 'primary')"), "no_primary", "review", ref),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@R.query("findings", f"WITH {_FINDINGS} SELECT 'fnd_' || substr(sha256(code || '|' || ref), 1, 20) AS finding_id, code, severity, ref FROM f")
def findings(spark: SparkSession, d: str) -> DataFrame:
    return _findings(spark, d)


@R.query(
    "findings_verdict",
    f"""WITH {_FINDINGS}, c AS (SELECT count(*) FILTER (severity = 'blocking') AS blocking, count(*) FILTER (severity = 'review') AS review, count(*) FILTER (severity = 'warning') AS warning FROM f)
SELECT *, CASE WHEN blocking > 0 THEN 'FAIL' WHEN review > 0 THEN 'PASS_WITH_REVIEW_ITEMS' ELSE 'PASS' END AS verdict FROM c""",
)
def findings_verdict(spark: SparkSession, d: str) -> DataFrame:
    return checks.verdict(_findings(spark, d))


@R.query(
    "excerpt_check",
    """WITH e AS (SELECT DISTINCT document_id, candidate_ref, x.paragraph_id AS p, x.excerpt AS excerpt FROM (SELECT document_id, candidate_ref, unnest(evidence) AS x FROM entity_candidates) WHERE x.excerpt IS NOT NULL),
t AS (SELECT DISTINCT document_id, paragraph_id AS p, text_original FROM paragraphs)
SELECT e.document_id, e.candidate_ref, e.p AS paragraph_id, CASE WHEN t.p IS NULL THEN 'no_paragraph' WHEN t.text_original IS NULL THEN 'no_text' WHEN contains(t.text_original, e.excerpt) THEN 'exact' ELSE 'not_in_text' END AS outcome
FROM e LEFT JOIN t ON t.document_id = e.document_id AND t.p = e.p""",
)
def excerpt_check(spark: SparkSession, d: str) -> DataFrame:
    """Whether each excerpt stands in its paragraph as it is."""
    e = table(spark, d, "entity_candidates").select("document_id", "candidate_ref", F.explode("evidence").alias("x")).select("document_id", "candidate_ref", "x.paragraph_id", "x.excerpt").where("excerpt is not null").distinct()
    t = table(spark, d, "paragraphs").select("document_id", "paragraph_id", "text_original", F.lit(1).alias("there")).distinct()
    o = F.when(F.col("there").isNull(), "no_paragraph").when(F.col("text_original").isNull(), "no_text").when(F.contains("text_original", "excerpt"), "exact").otherwise("not_in_text")
    return e.join(t, ["document_id", "paragraph_id"], "left").select("document_id", "candidate_ref", "paragraph_id", o.alias("outcome"))


@R.query(
    "reference_kinds",
    r"""WITH x AS (SELECT 'participant_refs' AS field_name, unnest(participant_refs) AS r FROM event_candidates UNION ALL SELECT 'location_refs', unnest(location_refs) FROM event_candidates)
SELECT field_name, regexp_extract(r, ':(cand_[a-z]+)_', 1) AS namespace, count(*) AS n FROM x WHERE r IS NOT NULL GROUP BY 1, 2""",
)
def reference_kinds(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "event_candidates")
    x = e.select(F.lit("participant_refs").alias("field_name"), F.explode("participant_refs").alias("r")).unionByName(e.select(F.lit("location_refs").alias("field_name"), F.explode("location_refs").alias("r")))
    return x.where("r is not null").groupBy("field_name", F.regexp_extract("r", ":(cand_[a-z]+)_", 1).alias("namespace")).agg(F.count("*").alias("n"))


@R.query(
    "resume_missing",
    "SELECT DISTINCT packet_key, profile_id FROM skeleton_measurements m WHERE NOT EXISTS (SELECT 1 FROM skeleton_measurements x WHERE x.packet_key = m.packet_key AND x.packet_estimated_tokens IS NOT NULL)",
)
def resume_missing(spark: SparkSession, d: str) -> DataFrame:
    """Packets that a resumed measuring run still has to do."""
    m = table(spark, d, "skeleton_measurements")
    return missing(m.select("packet_key", "profile_id").distinct(), m.where("packet_estimated_tokens is not null"), ["packet_key"])
