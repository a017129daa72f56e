import random

import pytest

from inkframe.llm.components import connected_components, identity_groups
from inkframe.scratch import Scratch


def brute(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def run(spark, edges):
    rows = connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), Scratch(spark, "test")).collect()
    assert len(rows) == len({r.v for r in rows})
    groups = {}
    for r in rows:
        groups.setdefault(r.root, []).append(r.v)
    assert all(root in members for root, members in groups.items())
    return {v: min(m) for m in groups.values() for v in m}


GRAPHS = {
    "path": [(i, i + 1) for i in range(90)],
    "ring": [(i, (i + 1) % 37) for i in range(37)],
    "two rings on a bridge": [(i, (i + 1) % 9) for i in range(9)] + [(20 + i, 20 + (i + 1) % 8) for i in range(8)] + [(3, 100), (100, 101), (101, 22)],
    "star": [(0, i) for i in range(1, 60)],
    "lollipop": [(i, j) for i in range(6) for j in range(i)] + [(5, 10), (10, 11), (11, 12)],
    "tree": [(i, i // 2) for i in range(2, 100)],
    "triangle, pair, loop, nulls": [(1, 2), (2, 3), (3, 1), (8, 9), (9, 8), (5, 5), (None, 4), (4, None)],
    "figure eight": [(0, 1), (1, 2), (2, 0), (0, 3), (3, 4), (4, 0)],
    "two triangles joined twice": [(0, 1), (1, 2), (2, 0), (3, 4), (4, 5), (5, 3), (0, 9), (9, 3), (1, 4)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_shapes(spark, name):
    assert run(spark, GRAPHS[name]) == brute(GRAPHS[name])


@pytest.mark.parametrize("n,m", [(50, 45), (40, 90)])
def test_random(spark, n, m):
    rng = random.Random(n)
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
    assert run(spark, edges) == brute(edges)


def test_groups_by_scope(spark):
    rows = [("d", "b", "a", 1), ("d", "a", "b", 2), ("e", "a", "c", 3), ("d", "x", "x", 4), (None, "a", "b", 5), ("d", None, "q", 6), ("d", "b", "Z", 7)]
    df = spark.createDataFrame(rows, "document_id string, l string, r string, id int")
    got = sorted(map(tuple, identity_groups(df, "document_id", "l", "r").collect()))
    assert got == [("d", "Z", "Z"), ("d", "Z", "a"), ("d", "Z", "b"), ("e", "a", "a"), ("e", "a", "c")]
    assert identity_groups(df.limit(0), "document_id", "l", "r").count() == 0


@pytest.mark.parametrize("name", ["two rings on a bridge", "lollipop", "triangle, pair, loop, nulls", "figure eight", "two triangles joined twice", "ring"])
def test_cores_that_no_single_task_solves(spark, name, monkeypatch):
    from inkframe.llm import components

    monkeypatch.setattr(components, "CORE", 0)
    monkeypatch.setattr(components, "LEAVES", 2.0)
    assert run(spark, GRAPHS[name]) == brute(GRAPHS[name])


def test_one_group_of_most_records(spark, monkeypatch):
    """Names of large groups are sent to their members; the result is the same."""
    from inkframe.llm import components

    rng = random.Random(9)
    edges = [("d", f"r{i:05}", f"r{rng.randrange(i):05}", 0) for i in range(1, 3000)] + [("d", f"s{i}", f"s{i + 1}", 0) for i in range(0, 400, 2)]
    df = spark.createDataFrame(edges, "document_id string, l string, r string, s int").select("document_id", "l", "r")
    monkeypatch.setattr(components, "HOT", 500)
    got = {(r.candidate_ref, r.group_ref) for r in identity_groups(df, "document_id", "l", "r").collect()}
    assert got == {(f"r{i:05}", "r00000") for i in range(3000)} | {(f"s{i}", f"s{i - i % 2}") for i in range(401) if i < 400}
