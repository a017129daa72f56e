"""Queries over pairs with signals, canonical facts, events and entities, and the uncertain graph.

Facts are derived from relationships that state something: the type is the relationship's, the statement
its state, subject and object its ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkframe.operators import resolve, signals
from inkframe.operators.ranking import rank_within
from inkframe.plans.folding import folded
from inkframe.plans.registry import Registry
from inkframe.scratch import Scratch, table

R = Registry()

def _folded(c: str) -> str:
    return f"coalesce({folded(c)}, '')"


_PS = "list_distinct(list_transform(coalesce(evidence, []), lambda v: v.paragraph_id))"
_LIST = "list_sort(list_distinct(list_filter(coalesce({0}, []), lambda x: x IS NOT NULL)))"
_FACTS = f"""f AS (SELECT DISTINCT ON (document_id, candidate_ref) document_id AS d, candidate_ref AS c, split_part(candidate_ref, '_', 1) AS ch, chunk_ordinal AS o, order_key,
  {_folded("relationship_type_zh")} AS k, {_folded("state_zh")} AS t, list_filter([source_ref], lambda x: x IS NOT NULL) AS su, list_filter([target_ref], lambda x: x IS NOT NULL) AS ob,
  {_PS} AS ps, relationship_type_zh, state_zh, source_ref, target_ref FROM relationship_candidates WHERE document_id IS NOT NULL AND candidate_ref IS NOT NULL ORDER BY document_id, candidate_ref, ingested_at)"""


def _facts(spark: SparkSession, d: str) -> DataFrame:
    one = lambda c: F.filter(F.array(c), lambda x: x.isNotNull())
    return table(spark, d, "relationship_candidates").select(
        "document_id", F.regexp_extract("candidate_ref", "^([^_]*)", 1).alias("chapter_id"), "chunk_ordinal", "candidate_ref", "order_key", F.col("relationship_type_zh").alias("fact_type"),
        F.col("state_zh").alias("statement_zh"), one("source_ref").alias("subject_refs"), one("target_ref").alias("object_refs"), "evidence",
    )


def _shown(df: DataFrame) -> DataFrame:
    return df.select(F.col("scope").alias("document_id"), "left_ref", "right_ref", F.array_join("signals", "|").alias("signals"))


_SIGNALS = "array_to_string(list_sort(list_filter([{0}], lambda x: x IS NOT NULL)), '|') AS signals"
_NEAR = "CASE WHEN a.ch = b.ch AND a.o = b.o THEN 'same_chunk' END, CASE WHEN a.ch = b.ch AND abs(a.o - b.o) = 1 THEN 'adjacent_chunk' END, CASE WHEN list_has_any(a.ps, b.ps) THEN 'evidence_paragraph_overlap' END"


@R.query(
    "fact_pairs",
    f"""WITH {_FACTS}, p AS (
  SELECT d, min(c) OVER (PARTITION BY d, t) AS l, c AS r FROM f WHERE t <> ''
  UNION SELECT a.d, a.c, b.c FROM (SELECT d, c, unnest(ps) AS x FROM f) a JOIN (SELECT d, c, unnest(ps) AS x FROM f) b ON a.d = b.d AND a.x = b.x
  UNION SELECT a.d, a.c, b.c FROM (SELECT d, c, k, unnest(su || ob) AS x FROM f WHERE k <> '') a JOIN (SELECT d, c, k, unnest(su || ob) AS x FROM f) b ON a.d = b.d AND a.k = b.k AND a.x = b.x
  UNION SELECT a.d, least(a.c, b.c), greatest(a.c, b.c) FROM f a JOIN f b ON a.d = b.d AND a.k = b.k AND a.k <> '' AND a.ch = b.ch AND b.o - a.o BETWEEN 0 AND 1)
SELECT p.d AS document_id, p.l AS left_ref, p.r AS right_ref, {_SIGNALS.format(
    "CASE WHEN a.k <> '' AND a.k = b.k THEN 'same_fact_type' END, CASE WHEN a.t <> '' AND a.t = b.t THEN 'exact_normalized_statement' END, CASE WHEN list_has_any(a.su, b.su) THEN 'subject_overlap' END, "
    "CASE WHEN list_has_any(a.ob, b.ob) THEN 'object_overlap' END, CASE WHEN list_has_any(a.su || a.ob, b.su || b.ob) THEN 'bound_entity_overlap' END, " + _NEAR
    + ", CASE WHEN a.k = b.k AND a.t = b.t AND a.su = b.su AND a.ob = b.ob THEN 'exact_safe_key' END")}
FROM p JOIN f a ON a.d = p.d AND a.c = p.l JOIN f b ON b.d = p.d AND b.c = p.r WHERE p.l < p.r""",
)
def fact_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _shown(signals.fact_pairs(_facts(spark, d)))


_EVENTS = f"""e AS (SELECT DISTINCT ON (document_id, candidate_ref) document_id AS d, candidate_ref AS c, chapter_id AS ch, chunk_ordinal AS o, order_key, {_folded("summary_zh")} AS t,
  {_LIST.format("participant_refs")} AS pa, {_LIST.format("location_refs")} AS lo, temporal_mode AS m, {_PS} AS ps FROM event_candidates WHERE document_id IS NOT NULL AND candidate_ref IS NOT NULL ORDER BY document_id, candidate_ref, ingested_at)"""
_EVENT_SIGNALS = f"""WITH {_EVENTS}, x AS (SELECT d, ch, o, c, unnest(list_distinct(pa || lo)) AS x FROM e), pl AS (SELECT d, c, p, unnest(lo) AS l FROM (SELECT d, c, lo, unnest(pa) AS p FROM e)),
p AS (
  SELECT d, min(c) OVER (PARTITION BY d, t) AS l, c AS r FROM e WHERE t <> ''
  UNION SELECT a.d, a.c, b.c FROM (SELECT d, c, unnest(ps) AS x FROM e) a JOIN (SELECT d, c, unnest(ps) AS x FROM e) b ON a.d = b.d AND a.x = b.x
  UNION SELECT a.d, a.c, b.c FROM e a JOIN e b ON a.d = b.d AND a.ch = b.ch AND a.o = b.o
  UNION SELECT a.d, least(a.c, b.c), greatest(a.c, b.c) FROM x a JOIN x b ON a.d = b.d AND a.ch = b.ch AND a.x = b.x AND b.o = a.o + 1
  UNION SELECT a.d, a.c, b.c FROM pl a JOIN pl b ON a.d = b.d AND a.p = b.p AND a.l = b.l),
s AS (SELECT p.d AS document_id, p.l AS left_ref, p.r AS right_ref, {_SIGNALS.format(
    "CASE WHEN a.t <> '' AND a.t = b.t THEN 'exact_normalized_summary' END, CASE WHEN list_has_any(a.pa, b.pa) THEN 'participant_overlap' END, CASE WHEN list_has_any(a.lo, b.lo) THEN 'location_overlap' END, "
    "CASE WHEN list_has_any(a.pa || a.lo, b.pa || b.lo) THEN 'bound_entity_overlap' END, " + _NEAR + ", CASE WHEN a.t = b.t AND a.pa = b.pa AND a.lo = b.lo AND a.m IS NOT DISTINCT FROM b.m THEN 'exact_safe_key' END")}
FROM p JOIN e a ON a.d = p.d AND a.c = p.l JOIN e b ON b.d = p.d AND b.c = p.r WHERE p.l < p.r)
"""


@R.query("event_signals", _EVENT_SIGNALS + "SELECT * FROM s")
def event_signals(spark: SparkSession, d: str) -> DataFrame:
    return _shown(signals.event_signals(table(spark, d, "event_candidates")))


@R.query("event_signal_sets", _EVENT_SIGNALS + "SELECT signals, count(*) AS pairs FROM s GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25")
def event_signal_sets(spark: SparkSession, d: str) -> DataFrame:
    """The 25 most frequent sets of signals; ties by name."""
    return event_signals(spark, d).groupBy("signals").agg(F.count("*").alias("pairs")).orderBy(F.desc("pairs"), "signals").limit(25)


@R.query(
    "relationship_signals",
    f"""WITH r AS (SELECT DISTINCT ON (document_id, candidate_ref) document_id AS d, candidate_ref AS c, split_part(candidate_ref, '_', 1) AS ch, chunk_ordinal AS o, {_folded("relationship_type_zh")} AS k, state_zh AS s,
  CASE WHEN direction = 'symmetric' THEN least(source_ref, target_ref) || '→' || greatest(source_ref, target_ref) ELSE source_ref || '→' || target_ref END AS e, {_PS} AS ps
  FROM relationship_candidates WHERE document_id IS NOT NULL AND candidate_ref IS NOT NULL AND source_ref IS NOT NULL AND target_ref IS NOT NULL ORDER BY document_id, candidate_ref, ingested_at)
SELECT a.d AS document_id, a.c AS left_ref, b.c AS right_ref, {_SIGNALS.format(
    "'same_endpoint_group', CASE WHEN a.k <> '' AND a.k = b.k THEN 'exact_normalized_relationship_type' END, CASE WHEN a.k <> '' AND a.k = b.k THEN 'exact_safe_key' END, CASE WHEN a.s IS NOT DISTINCT FROM b.s THEN 'state_equal' END, " + _NEAR)}
FROM r a JOIN r b ON a.d = b.d AND a.e = b.e AND a.c < b.c""",
)
def relationship_signals(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "relationship_candidates").withColumn("chapter_id", F.regexp_extract("candidate_ref", "^([^_]*)", 1))
    return _shown(signals.relationship_signals(r))


@R.query(
    "canonical_facts",
    f"""WITH {_FACTS}, g AS (SELECT d, k, t, su, ob, min_by(c, (order_key, c)) AS first_ref, min(order_key) AS first_order, count(*) AS candidates FROM f WHERE t <> '' GROUP BY ALL)
SELECT d AS document_id, 'fact_' || lpad(row_number() OVER (PARTITION BY d ORDER BY first_order, first_ref)::VARCHAR, 6, '0') AS fact_id, k AS fact_type, t AS statement, first_ref, first_order, candidates FROM g""",
)
def canonical_facts(spark: SparkSession, d: str) -> DataFrame:
    """Facts of one type, statement, subjects and objects as one; the first candidate stands for it."""
    return _canonical_facts(spark, d, Scratch(spark, "facts"))[0]


def _canonical_facts(spark: SparkSession, d: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(canonical facts, (scope, ref, id, ordinal) of their members)."""
    f = signals.fact_records(_facts(spark, d)).where("text <> ''")
    f = scratch.save(f.join(_facts(spark, d).groupBy(F.col("document_id").alias("scope"), F.col("candidate_ref").alias("ref")).agg(F.min("order_key").alias("order_key")), ["scope", "ref"]))
    g = f.groupBy("scope", "exact").agg(
        F.min("kind").alias("fact_type"), F.min("text").alias("statement"), F.min(F.struct("order_key", "ref")).alias("first"), F.count("*").alias("candidates"),
    ).select("scope", "exact", "fact_type", "statement", F.col("first.ref").alias("first_ref"), F.col("first.order_key").alias("first_order"), "candidates")
    ranked = scratch.save(rank_within(g, ["scope"], ["first_order", "first_ref"], scratch, "ordinal"))
    named = ranked.withColumn("fact_id", F.concat(F.lit("fact_"), F.lpad((F.col("ordinal") + 1).cast("string"), 6, "0")))
    members = f.select("scope", "ref", "exact").join(named.select("scope", "exact", F.col("fact_id").alias("id"), "ordinal"), ["scope", "exact"]).drop("exact")
    return named.select(F.col("scope").alias("document_id"), "fact_id", "fact_type", "statement", "first_ref", "first_order", "candidates"), members


_CHANGES = f"""{_FACTS}, g AS (SELECT d, k, t, su, ob, min_by(c, (order_key, c)) AS c, min(order_key) AS o FROM f WHERE t <> '' GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY o, c) AS i FROM g), id AS (SELECT *, 'fact_' || lpad(i::VARCHAR, 6, '0') AS fid FROM n),
ch AS (SELECT d, i AS i1, fid AS f1, c AS c1, o AS o1, lead(i) OVER w AS i2, lead(fid) OVER w AS f2, lead(c) OVER w AS c2, lead(o) OVER w AS o2 FROM id WINDOW w AS (PARTITION BY d, k, su, ob ORDER BY i)),
dec AS (SELECT *, c1 || '>' || c2 AS did, CASE WHEN split_part(o1, '.', 1) = split_part(o2, '.', 1) AND split_part(o1, '.', 2) = split_part(o2, '.', 2) THEN 'conflict' ELSE 'state_change' END AS decision FROM ch WHERE c2 IS NOT NULL)
"""


def _fact_decisions(spark: SparkSession, d: str, what: str) -> DataFrame:
    """What a reader would decide by rule: another statement of the same type and ends conflicts within one
    chunk and is a change later on."""
    scratch = Scratch(spark, "facts")
    facts, members = _canonical_facts(spark, d, scratch)
    members = scratch.save(members)
    f = signals.fact_records(_facts(spark, d)).where("text <> ''").select(F.col("scope").alias("document_id"), F.col("ref").alias("first_ref"), "kind", F.array_sort("subjects").alias("su"), F.array_sort("objects").alias("ob"))
    w = Window.partitionBy("document_id", "kind", "su", "ob").orderBy("first_order", "first_ref")
    both = facts.select("document_id", "first_ref", "first_order").join(f, ["document_id", "first_ref"]).withColumns({"right_ref": F.lead("first_ref").over(w), "next": F.lead("first_order").over(w)})
    chunk = lambda c: F.substring_index(c, ".", 2)
    dec = both.where("right_ref is not null").select(
        F.col("document_id").alias("scope"), F.concat_ws(">", "first_ref", "right_ref").alias("decision_id"), F.col("first_ref").alias("left_ref"), "right_ref",
        F.when(chunk("first_order") == chunk("next"), "conflict").otherwise("state_change").alias("decision"),
    )
    out = resolve.oriented(dec, members, what, scratch)
    return out.select(F.col("scope").alias("document_id"), F.col("number").cast("long").alias("number"), F.col("from_id").alias("earlier_id"), F.col("to_id").alias("later_id"), "decision_id")


@R.query("fact_transitions", f"WITH {_CHANGES} SELECT d AS document_id, row_number() OVER (PARTITION BY d ORDER BY i2, i1, did) AS number, f1 AS earlier_id, f2 AS later_id, did AS decision_id FROM dec WHERE decision = 'state_change'")
def fact_transitions(spark: SparkSession, d: str) -> DataFrame:
    return _fact_decisions(spark, d, "state_change")


@R.query("fact_conflicts", f"WITH {_CHANGES} SELECT d AS document_id, row_number() OVER (PARTITION BY d ORDER BY i2, i1, did) AS number, f1 AS earlier_id, f2 AS later_id, did AS decision_id FROM dec WHERE decision = 'conflict'")
def fact_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return _fact_decisions(spark, d, "conflict")


@R.query(
    "canonical_events",
    f"""WITH {_EVENTS}, g AS (SELECT d, t, pa, lo, m, min_by(c, (order_key, c)) AS first_ref, min(order_key) AS first_order, count(*) AS candidates FROM e WHERE t <> '' GROUP BY ALL)
SELECT d AS document_id, t AS summary, m AS temporal_mode, array_to_string(pa, '|') AS participants, array_to_string(lo, '|') AS locations, first_ref, first_order, candidates,
  row_number() OVER (PARTITION BY d ORDER BY first_order, first_ref)::INT AS narrative_order FROM g""",
)
def canonical_events(spark: SparkSession, d: str) -> DataFrame:
    """Events of one folded summary, participants, locations and mode as one, in narrative order."""
    scratch = Scratch(spark, "events")
    e = signals.event_records(table(spark, d, "event_candidates")).where("text <> ''")
    g = e.groupBy("scope", "exact").agg(
        F.min("text").alias("summary"), F.min("mode").alias("temporal_mode"), F.min(F.array_join(F.array_sort("participants"), "|")).alias("participants"), F.min(F.array_join(F.array_sort("locations"), "|")).alias("locations"),
        F.min(F.struct("order_key", "ref")).alias("first"), F.count("*").alias("candidates"),
    ).select(F.col("scope").alias("document_id"), "summary", "temporal_mode", "participants", "locations", F.col("first.ref").alias("first_ref"), F.col("first.order_key").alias("first_order"), "candidates")
    ranked = rank_within(g, ["document_id"], ["first_order", "first_ref"], scratch, "narrative_order")
    return ranked.withColumn("narrative_order", (F.col("narrative_order") + 1).cast("int"))


_MAP = """WITH RECURSIVE en AS (SELECT document_id AS d, candidate_ref AS c, min(kind) AS k, min(order_key) AS o FROM entity_candidates WHERE document_id IS NOT NULL AND candidate_ref IS NOT NULL GROUP BY 1, 2),
dc AS (SELECT DISTINCT document_id AS d, left_candidate_ref AS a, right_candidate_ref AS b, decision FROM reconciliation_decisions JOIN en x ON x.d = document_id AND x.c = left_candidate_ref
  JOIN en y ON y.d = document_id AND y.c = right_candidate_ref WHERE x.k = y.k AND x.k IN ('character', 'location')),
arc AS (SELECT d, a, b FROM dc WHERE decision = 'same_entity' UNION SELECT d, b, a FROM dc WHERE decision = 'same_entity'),
reach AS (SELECT d, c AS a, c AS b FROM en UNION SELECT r.d, r.a, x.b FROM reach r JOIN arc x ON x.d = r.d AND x.a = r.b),
comp AS (SELECT d, a AS c, min(b) AS root FROM reach GROUP BY 1, 2),
un AS (SELECT DISTINCT u.d, p.root AS a, q.root AS b FROM dc u JOIN comp p ON p.d = u.d AND p.c = u.a JOIN comp q ON q.d = u.d AND q.c = u.b WHERE u.decision = 'uncertain'),
uarc AS (SELECT d, a, b FROM un UNION SELECT d, b, a FROM un),
far AS (SELECT d, a, b FROM uarc UNION SELECT r.d, r.a, x.b FROM far r JOIN uarc x ON x.d = r.d AND x.a = r.b),
grp AS (SELECT d, a AS root, min(b) AS g FROM far GROUP BY 1, 2),
pl AS (SELECT en.d, en.c, en.k, en.o, CASE WHEN en.k IN ('character', 'location') AND g IS NULL THEN 'resolved' ELSE 'unresolved' END AS status, coalesce(g, comp.root) AS name
  FROM en JOIN comp ON comp.d = en.d AND comp.c = en.c LEFT JOIN grp ON grp.d = en.d AND grp.root = comp.root),
hd AS (SELECT d, status, CASE status WHEN 'resolved' THEN k ELSE '' END AS series, name, min((o, c)) AS f FROM pl GROUP BY 1, 2, 3, 4),
ids AS (SELECT *, CASE series WHEN 'character' THEN 'char_' WHEN 'location' THEN 'loc_' ELSE 'unres_' END || lpad(row_number() OVER (PARTITION BY d, series ORDER BY f)::VARCHAR, 4, '0') AS entity_id FROM hd),
res AS (SELECT pl.d AS document_id, pl.c AS candidate_ref, pl.k AS kind, pl.status, ids.entity_id FROM pl JOIN ids ON ids.d = pl.d AND ids.status = pl.status AND ids.name = pl.name AND ids.series = CASE pl.status WHEN 'resolved' THEN pl.k ELSE '' END)
"""


def _map(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "entity_candidates").select(F.col("document_id").alias("scope"), F.col("candidate_ref").alias("ref"), "kind", "order_key")
    x = table(spark, d, "reconciliation_decisions").select(F.col("document_id").alias("scope"), F.col("left_candidate_ref").alias("a"), F.col("right_candidate_ref").alias("b"), "decision")
    m = resolve.entity_map(e, x, {"character": "char", "location": "loc"}, Scratch(spark, "map"))
    return m.select(F.col("scope").alias("document_id"), F.col("ref").alias("candidate_ref"), "kind", "status", "entity_id")


@R.query("entity_map", _MAP + "SELECT * FROM res")
def entity_map(spark: SparkSession, d: str) -> DataFrame:
    """Every candidate with the entity it is resolved to, or the unresolved group it belongs to."""
    return _map(spark, d)


@R.query("unresolved_groups", _MAP + "SELECT document_id, entity_id, count(*) AS members, min(candidate_ref) AS first_ref FROM res WHERE status = 'unresolved' GROUP BY 1, 2")
def unresolved_groups(spark: SparkSession, d: str) -> DataFrame:
    return _map(spark, d).where("status = 'unresolved'").groupBy("document_id", "entity_id").agg(F.count("*").alias("members"), F.min("candidate_ref").alias("first_ref"))


_RECORDS = """, m AS (SELECT DISTINCT r.document_id, r.entity_id, r.kind, e.candidate_ref, e.order_key, e.display_name, coalesce(e.aliases, []) AS aliases, coalesce(e.evidence, []) AS evidence FROM res r
  JOIN (SELECT document_id, candidate_ref, min(order_key) AS order_key, min_by(display_name, (recorded_at, display_name)) AS display_name, min_by(aliases, (recorded_at, display_name)) AS aliases, min_by(evidence, (recorded_at, display_name)) AS evidence
    FROM entity_candidates GROUP BY 1, 2) e ON e.document_id = r.document_id AND e.candidate_ref = r.candidate_ref WHERE r.status = 'resolved'),
nm AS (SELECT document_id, entity_id, x, min(p) AS p FROM (SELECT document_id, entity_id, unnest(list_prepend(display_name, aliases)) AS x, (order_key, candidate_ref, generate_subscripts(list_prepend(display_name, aliases), 1)) AS p FROM m) WHERE x IS NOT NULL GROUP BY 1, 2, 3),
nl AS (SELECT document_id, entity_id, string_agg(x, '|' ORDER BY p) AS names FROM nm GROUP BY 1, 2),
ev AS (SELECT document_id, entity_id, x, min(p) AS p FROM (SELECT document_id, entity_id, unnest(list_transform(evidence, lambda v: v.paragraph_id)) AS x, (order_key, candidate_ref, generate_subscripts(evidence, 1)) AS p FROM m) WHERE x IS NOT NULL GROUP BY 1, 2, 3),
el AS (SELECT document_id, entity_id, string_agg(x, '|' ORDER BY p) AS paragraphs FROM ev GROUP BY 1, 2)
SELECT m.document_id, m.entity_id, min(m.kind) AS kind, min_by(m.candidate_ref, (m.order_key, m.candidate_ref)) AS representative, count(*) AS members, coalesce(any_value(nl.names), '') AS names, coalesce(any_value(el.paragraphs), '') AS paragraphs
FROM m LEFT JOIN nl ON nl.document_id = m.document_id AND nl.entity_id = m.entity_id LEFT JOIN el ON el.document_id = m.document_id AND el.entity_id = m.entity_id GROUP BY 1, 2"""


@R.query("entity_records", _MAP + _RECORDS)
def entity_records(spark: SparkSession, d: str) -> DataFrame:
    """Resolved entities: first member, names and evidence paragraphs, each once, in the order of the members.

    Names and evidence are first made distinct with the place where they first come, so that an entity of
    any number of members gathers only its different names.
    """
    res = _map(spark, d).where("status = 'resolved'")
    e = table(spark, d, "entity_candidates").groupBy("document_id", "candidate_ref").agg(
        F.min("order_key").alias("order_key"), F.min_by(F.struct("display_name", "aliases", "evidence"), F.struct("recorded_at", "display_name")).alias("x")
    )
    none = F.array().cast("array<string>")
    names = F.concat(F.array("x.display_name"), F.coalesce("x.aliases", none))
    m = Scratch(spark, "records").save(
        res.join(e, ["document_id", "candidate_ref"]).select("document_id", "entity_id", "kind", "candidate_ref", "order_key", names.alias("names"), F.coalesce(F.col("x.evidence.paragraph_id"), none).alias("paragraphs"))
    )

    def each(c: str) -> DataFrame:
        x = m.select("document_id", "entity_id", "order_key", "candidate_ref", F.posexplode(c).alias("pos", "v")).where("v is not null")
        first = x.groupBy("document_id", "entity_id", "v").agg(F.min(F.struct("order_key", "candidate_ref", "pos")).alias("p"))
        lists = first.groupBy("document_id", "entity_id").agg(F.array_sort(F.collect_list(F.struct("p", "v"))).alias("l"))
        return lists.select("document_id", "entity_id", F.array_join(F.transform("l", lambda y: y["v"]), "|").alias(c))

    base = m.groupBy("document_id", "entity_id").agg(F.min("kind").alias("kind"), F.min_by("candidate_ref", F.struct("order_key", "candidate_ref")).alias("representative"), F.count("*").alias("members"))
    out = base.join(each("names"), ["document_id", "entity_id"], "left").join(each("paragraphs"), ["document_id", "entity_id"], "left")
    return out.fillna("", ["names", "paragraphs"])
