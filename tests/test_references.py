import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from inkframe.operators.references import orphan_references
from inkframe.scratch import Scratch

REFS = "scope string, ref string, at timestamp_ntz, id int, extra string"
PARENTS = "scope string, ref string, valid_from timestamp_ntz, valid_to timestamp_ntz"


def run(spark, refs, parents):
    r, p = spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS)
    return sorted(x.id for x in orphan_references(r, p, Scratch(spark, "test")).collect())


def brute(refs, parents):
    return sorted(
        i for s, r, t, i, _ in refs
        if r is not None and not any(s == a and r == b and s is not None and t is not None and f is not None and f <= t and (u is None or u > t) for a, b, f, u in parents)
    )


def test_random_times(spark):
    rng = random.Random(5)
    t0 = datetime(2024, 11, 20)
    when = lambda: t0 + timedelta(hours=rng.randrange(0, 24 * 120))
    parents = []
    for _ in range(80):
        a = when()
        parents.append((f"d{rng.randrange(4)}", f"c{rng.randrange(8)}", a, rng.choice([None, a, a + timedelta(days=rng.randrange(70))])))
    refs = [(f"d{rng.randrange(4)}", f"c{rng.randrange(10)}", when(), i, "x") for i in range(400)]
    assert run(spark, refs, parents) == brute(refs, parents)


def test_month_edges_nulls_and_repeats(spark):
    d = datetime
    parents = [("d", "a", d(2025, 1, 1), d(2025, 2, 1)), ("d", "b", None, None), (None, "a", d(2024, 1, 1), None), ("d", "a", d(2025, 1, 1), d(2025, 2, 1))]
    refs = [
        ("d", "a", d(2025, 1, 1), 1, None), ("d", "a", d(2025, 2, 1), 2, None), ("d", "a", d(2025, 1, 31, 23), 3, None), ("d", "b", d(2025, 1, 5), 4, None),
        (None, "a", d(2025, 1, 5), 5, None), ("d", None, d(2025, 1, 5), 6, None), ("d", "a", None, 7, None), ("d", "a", d(2025, 2, 1), 8, None), ("d", "a", d(2024, 12, 31), 9, None),
    ]
    assert run(spark, refs, parents) == [2, 4, 5, 7, 8, 9] == brute(refs, parents)


def test_empty_tables(spark):
    t = datetime(2025, 1, 1)
    assert run(spark, [], []) == []
    assert run(spark, [("d", "a", t, 1, "x")], []) == [1]


def test_hot_key(spark):
    """A third of the references name one key."""
    t = datetime(2025, 3, 3)
    refs = spark.range(3000).select(F.lit("d").alias("scope"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("ref"), F.lit(t).cast("timestamp_ntz").alias("at"), F.col("id").cast("int").alias("id"))
    parents = spark.createDataFrame([("d", "hot", t, None)], PARENTS)
    assert orphan_references(refs, parents, Scratch(spark, "test")).count() == 2000


def test_clashing_columns_pass_through(spark):
    t = datetime(2025, 1, 1)
    names = ["_id", "_month", "_sure", "month", "range", "valid_from", "valid_to", "p_id", "_row", "bit"]
    refs = spark.createDataFrame([("d", "a", t), ("d", "b", t)], "scope string, ref string, at timestamp_ntz").select("*", *[F.lit(7).alias(n) for n in names])
    parents = spark.createDataFrame([("d", "a", t, None, 1)], PARENTS + ", _id int")
    got = orphan_references(refs, parents, Scratch(spark, "test")).collect()
    assert [(r.ref, *[r[n] for n in names]) for r in got] == [("b", *[7] * len(names))]


def test_packed_bitmaps():
    import numpy as np

    from inkframe.operators.references import RANGE, pack, unpack

    rng = np.random.default_rng(3)
    kinds = set()
    for bits in ([], [0], [RANGE - 1], range(RANGE), range(100, 9000), rng.choice(RANGE, 50, replace=False), rng.choice(RANGE, 20_000, replace=False), [*range(5), *range(7, 900)]):
        b = np.sort(np.array(list(bits), dtype=np.int64))
        packed = pack(b)
        kinds.add(packed[:1])
        assert list(np.flatnonzero(unpack(packed))) == list(b) and len(packed) <= RANGE // 8 + 1
    assert kinds == {b"R", b"L", b"P"} and not unpack(None).any() and len(pack(np.array([7]))) < 8
