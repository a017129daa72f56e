import itertools
import random

import pytest

from inkframe.operators import resolve, signals
from inkframe.scratch import Scratch

EV = "array<struct<paragraph_id string, role string>>"
FACT = f"document_id string, chapter_id string, chunk_ordinal int, candidate_ref string, fact_type string, statement_zh string, subject_refs array<string>, object_refs array<string>, evidence {EV}, left_ref string, scope string, l int"
EVENT = f"document_id string, chapter_id string, chunk_ordinal int, candidate_ref string, summary_zh string, participant_refs array<string>, location_refs array<string>, temporal_mode string, order_key string, evidence {EV}, signals string"


def fold(t):
    import unicodedata

    return " ".join(unicodedata.normalize("NFKC", t or "").casefold().split())


def overlap(a, b):
    return bool(set(a or []) & set(b or []) - {None})


def _facts(n=60):
    rng = random.Random(4)
    some = lambda names: rng.choice([None, [], rng.sample(names, 1), rng.sample(names, 2) + [None]])
    rows = []
    for i in range(n):
        ps = rng.choice([None, [], [f"P{rng.randrange(8)}", f"P{rng.randrange(8)}"]])
        rows.append(("d", f"CH{rng.randrange(3)}", rng.choice([None, 1, 2, 3]), f"c{i:02}", rng.choice(["rank", "ＲＡＮＫ", "", None, "mood"]), rng.choice([None, "", "is  Old", "IS old", "is new"]), some("abcd"), some("efgh"), None if ps is None else [(p, "primary") for p in ps], "x", "y", 1))
    return rows


def test_fact_pairs_against_all_pairs(spark):
    rows = _facts()
    df = spark.createDataFrame(rows + rows[:5] + [(None, "CH1", 1, "z", *[None] * 5, "x", "y", 1), ("d", "CH1", 1, None, *[None] * 5, "x", "y", 1)], FACT)
    got = {(r.left_ref, r.right_ref): r.signals for r in signals.fact_pairs(df).collect()}
    least, want = {}, {}
    for r in rows:
        if fold(r[5]):
            least.setdefault(fold(r[5]), r[3])
    for a, b in itertools.combinations(rows, 2):
        ta, tb, ka, kb = fold(a[5]), fold(b[5]), fold(a[4]), fold(b[4])
        pa, pb = ({p for p, _ in x[8] or []} for x in (a, b))
        ba, bb = ((x[6] or []) + (x[7] or []) for x in (a, b))
        known = a[2] is not None and b[2] is not None and a[1] == b[1]
        near = abs(a[2] - b[2]) if known else 9
        typed = ka != "" and ka == kb
        if (ta and ta == tb and least[ta] == a[3]) or pa & pb or (typed and (overlap(ba, bb) or near <= 1)):
            s = {"same_fact_type": typed, "exact_normalized_statement": ta != "" and ta == tb, "subject_overlap": overlap(a[6], b[6]), "object_overlap": overlap(a[7], b[7]), "bound_entity_overlap": overlap(ba, bb),
                 "evidence_paragraph_overlap": bool(pa & pb), "same_chunk": near == 0, "adjacent_chunk": near == 1}
            clean = lambda x: set(x or []) - {None}
            s["exact_safe_key"] = ka == kb and ta == tb and clean(a[6]) == clean(b[6]) and clean(a[7]) == clean(b[7])
            want[a[3], b[3]] = sorted(k for k, v in s.items() if v)
    assert got == want
    assert signals.fact_pairs(df.limit(0)).count() == 0


def test_many_equal_summaries_meet_their_least_only(spark):
    rows = [("d", f"CH{i}", 1, f"e{i:03}", "the same", [f"p{i}"], None, "normal", "1", None, "x") for i in range(200)]
    got = signals.event_signals(spark.createDataFrame(rows, EVENT)).collect()
    assert {(r.left_ref, r.right_ref) for r in got} == {("e000", f"e{i:03}") for i in range(1, 200)}
    assert {tuple(r.signals) for r in got} == {("exact_normalized_summary",)}


def test_relationship_signals(spark):
    schema = f"document_id string, chapter_id string, chunk_ordinal int, candidate_ref string, source_ref string, target_ref string, direction string, relationship_type_zh string, state_zh string, evidence {EV}"
    rows = [("d", "C", 1, "a", "x", "y", "symmetric", "友", None, [("p", "primary")]), ("d", "C", 2, "b", "y", "x", "symmetric", "友", None, [("p", "primary")]), ("d", "C", 2, "c", "y", "x", "directed", "友", "好", None), ("d", "C", 2, "n", None, "x", "directed", "友", "好", None)]
    got = {(r.left_ref, r.right_ref): r.signals for r in signals.relationship_signals(spark.createDataFrame(rows, schema)).collect()}
    assert got == {("a", "b"): ["adjacent_chunk", "evidence_paragraph_overlap", "exact_normalized_relationship_type", "exact_safe_key", "same_endpoint_group", "state_equal"]}


def _brute_map(ents, decs, kinds):
    kind = {r: k for r, k, _ in ents}
    order = {r: (o, r) for r, _, o in ents}

    def parts(nodes, edges):
        up = {n: n for n in nodes}

        def find(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in edges:
            up[find(a)] = find(b)
        return {n: find(n) for n in nodes}

    able = lambda a, b: a in kind and b in kind and kind[a] == kind[b] and kind[a] in kinds
    comp = parts(kind, [(a, b) for a, b, d in decs if d == "same_entity" and able(a, b)])
    open_ = [(comp[a], comp[b]) for a, b, d in decs if d == "uncertain" and able(a, b)]
    touched = {x for e in open_ for x in e}
    group = parts(set(comp.values()), open_)
    place = {r: ("unresolved", "", group[c]) if c in touched or kind[r] not in kinds else ("resolved", kind[r], c) for r, c in comp.items()}
    firsts = {}
    for r, p in place.items():
        firsts[p] = min(firsts.get(p, order[r]), order[r])
    out = {}
    for r, p in place.items():
        no = 1 + sum(f < firsts[p] for q, f in firsts.items() if q[:2] == p[:2])
        out[r] = (p[0], f"{kinds.get(p[1], 'unres')}_{no:04}")
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_entity_map_against_brute_force(spark, seed):
    rng = random.Random(seed)
    ents = [(f"r{i:02}", rng.choice(["character", "location", "unresolved_mention"]), f"{rng.randrange(30):03}") for i in range(40)]
    decs = [(f"r{rng.randrange(44):02}", f"r{rng.randrange(44):02}", rng.choice(["same_entity", "same_entity", "uncertain", "different_entity", None])) for _ in range(45)]
    kinds = {"character": "char", "location": "loc"}
    e = spark.createDataFrame([("d", *x) for x in ents + ents[:3]] + [(None, "q", "character", "1")], "scope string, ref string, kind string, order_key string")
    d = spark.createDataFrame([("d", *x) for x in decs] + [("d", None, "r01", "uncertain"), (None, "r01", "r02", "same_entity")], "scope string, a string, b string, decision string")
    rows = resolve.entity_map(e, d, kinds, Scratch(spark, "t")).collect()
    assert len(rows) == 40 and {r.ref: (r.status, r.entity_id) for r in rows} == _brute_map(ents, decs, kinds)
    assert resolve.entity_map(e.limit(0), d, kinds, Scratch(spark, "t")).count() == 0


def test_oriented_decisions(spark):
    members = spark.createDataFrame([("d", r, i, n) for r, i, n in (("a", "f1", 0), ("b", "f2", 1), ("c", "f3", 2), ("a2", "f1", 0))], "scope string, ref string, id string, ordinal long")
    decs = [("d", "k1", "c", "a", "change"), ("d", "k0", "b", "a2", "change"), ("d", "k2", "b", "c", "other"), ("d", "k3", "b", "zz", "change")]
    df = spark.createDataFrame(decs, "scope string, decision_id string, left_ref string, right_ref string, decision string")
    got = sorted(tuple(r) for r in resolve.oriented(df, members, "change", Scratch(spark, "t")).collect())
    assert got == [("d", 1, "f1", "f2", "k0"), ("d", 2, "f1", "f3", "k1")]
    bad = df.union(spark.createDataFrame([("d", "k9", "a", "a2", "change")], df.schema))
    with pytest.raises(Exception, match="k9"):
        resolve.oriented(bad, members, "change", Scratch(spark, "t")).collect()
