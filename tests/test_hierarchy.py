import random

import numpy as np
import pytest

from inkframe.operators import hierarchy as H
from inkframe.scratch import Scratch


def brute(parent):
    out = {}
    for n in parent:
        way, seen, x = [n], {n}, n
        while parent[x] is not None and parent[x] not in seen:
            x = parent[x]
            way.append(x)
            seen.add(x)
        if parent[x] is None:
            out[n] = (x, len(way) - 1, False, way[::-1])
        else:
            ring, y = [parent[x]], parent[parent[x]]
            while y != parent[x]:
                ring.append(y)
                y = parent[y]
            out[n] = (min(ring), None, True, None)
    return out


def run(spark, parent):
    nodes = spark.createDataFrame([(k, v) for k, v in parent.items()], "id bigint, parent bigint")
    rows = H.hierarchy(nodes, Scratch(spark, "test"), with_path=True).collect()
    return {r.id: (r.root, r.depth, r.is_ring, r.path) for r in rows}


@pytest.mark.parametrize("bits", [2, 18])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_forests_with_cycles_across_blocks(spark, monkeypatch, seed, bits):
    """Small blocks force most links to be merged; workers get the constant by the pickled module."""
    rng = random.Random(seed)
    ids = [i + (i % 5) * (1 << 33) for i in range(60)]
    parent = {i: (None if rng.random() < 0.15 else rng.choice(ids)) for i in ids}
    monkeypatch.setattr(H, "BLOCK_BITS", bits)
    assert run(spark, parent) == brute(parent)


def test_long_chain_and_long_ring(spark):
    chain = {i: i - 1 if i else None for i in range(700)}
    ring = {1000 + i: 1000 + (i + 1) % 300 for i in range(300)}
    tail = {2000: 1150, 2001: 2000}
    assert run(spark, {**chain, **ring, **tail}) == brute({**chain, **ring, **tail})


def test_self_parent_and_empty(spark):
    assert run(spark, {7: 7, 8: 7}) == {7: (7, None, True, None), 8: (7, None, True, None)}
    assert H.hierarchy(spark.createDataFrame([], "id bigint, parent bigint"), Scratch(spark, "test")).count() == 0


def test_forest_of_one_block():
    ids = np.array([3, 5, 9])
    up, off, least, ring, *_ = H._forest(ids, np.array([-1, 3, 5]), np.array([False, True, True]))
    assert list(up) == [0, 0, 0] and list(off) == [0, 1, 2] and not ring.any()


def test_below_and_on_cycles(spark, monkeypatch):
    """Every node has a path from the cycle it hangs on, and all its descendants, each once."""
    from inkframe.plans import queries_hierarchy as Q

    rng = random.Random(7)
    ids = [i + (i % 3) * (1 << 33) for i in range(50)]
    parent = {i: (None if rng.random() < 0.1 else rng.choice(ids)) for i in ids}
    parent |= {100 + i: 100 + (i + 1) % 5 for i in range(5)} | {200: 103, 201: 200, 202: 201, 300: 300, 301: 300}
    nodes = spark.createDataFrame(list(parent.items()), "id bigint, parent bigint")
    names = nodes.selectExpr("cast(id as string) as pointer_id", "1L as revision", "id")
    monkeypatch.setattr(Q, "pointer_nodes", lambda *_: (names, nodes))
    want, ring = {}, set()
    for n in parent:
        x, k = parent[n], 1
        while x is not None and x != n and (x, n) not in want:
            want[x, n] = k
            x, k = parent[x], k + 1
        if x == n:
            ring.add(n)
    got = Q.p5_descendants(spark, "").collect()
    assert len(got) == len(want) and {(int(r.pointer_id), int(r.descendant_pointer_id)): r.distance for r in got} == want
    for r in Q.p5_hierarchy(spark, "").collect():
        node = int(r.pointer_id)
        way = [node]
        while way[0] not in ring and parent[way[0]] is not None:
            way.insert(0, parent[way[0]])
        old = brute(parent)[node]
        named = "/".join(f"{x}@1" for x in way)
        up = None if r.parent_pointer_id is None else int(r.parent_pointer_id)
        assert (r.path, r.depth, int(r.root_pointer_id), r.on_or_below_cycle, up) == (named, len(way) - 1, old[0], old[2], parent[node])
