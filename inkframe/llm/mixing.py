"""Mixing sources to target weights.

Sizes are tokens of a public tokenizer. The largest total that every source can serve within its
repeats fixes each source's token budget, its target share of that total.

A source's documents are taken in a fixed random order: its stock is that order gone through as often
as repeats are allowed, and its budget a length of that stock. Positions in the order come from the
sizes of hash buckets, split further where a bucket is large, so that no source, however large, is
sorted in one place. Stock is cut into blocks of documents, and a multivariate hypergeometric
splitting tree deals the blocks to the output shards: at each node the blocks of every source are
divided between the two halves as if drawn from an urn, so every shard has its exact number of blocks
and the whole is a random shuffle. Blocks are permuted over the drawn places, and rows shuffled inside
a shard by a hash.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkframe.scratch import Scratch

#: Where the vocabulary files of public tokenizers lie, and which of them measures sizes.
TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
# Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(2)
def _encoding(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(df: DataFrame, text: str, keep: list[str], vocabulary: str = os.path.join(TOKENIZERS, VOCABULARY)) -> DataFrame:
    """`keep` and `tokens` of each row; a null text has 0 tokens. Texts are tokenized whole."""
    kinds = dict(df.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(vocabulary)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(n, pa.int64())], [*keep, "tokens"])

    return df.select(*keep, text).mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", tokens bigint")


def budgets(stock: pd.DataFrame) -> pd.DataFrame:
    """Token budget of each source: columns source, target_weight, max_repeats, tokens -> also budget.

    The total is the least, over sources with a weight, of tokens * max_repeats / weight.
    """
    s = stock.copy()
    s["tokens"] = s["tokens"].fillna(0).astype("int64")
    asked = s[s["target_weight"] > 0]
    total = 0.0 if asked.empty else float((asked["tokens"] * asked["max_repeats"] / asked["target_weight"]).min())
    s["budget"] = np.floor(s["target_weight"] * total + 1e-6).astype("int64")
    return s


def split_tree(counts: dict[str, int], shards: int, seed: int) -> list[dict[str, int]]:
    """Blocks of each source for each shard: urn draws down a binary tree, exact in total.

    Every shard gets the same number of blocks, but for one.
    """
    rng = np.random.default_rng(seed)
    names = sorted(counts)
    out: list[dict[str, int]] = []

    def node(have: np.ndarray, lo: int, hi: int) -> None:
        if hi - lo == 1:
            out.append(dict(zip(names, map(int, have))))
            return
        mid, total = (lo + hi) // 2, int(have.sum())
        # as many blocks as the left shards' even share of this node
        want = total * (mid - lo) // (hi - lo)
        left = rng.multivariate_hypergeometric(have, want, method="marginals") if total else have * 0
        node(left, lo, mid)
        node(have - left, mid, hi)

    if names:
        node(np.array([counts[n] for n in names], dtype=np.int64), 0, shards)
    return out


def mix(spark: SparkSession, docs: DataFrame, key: str, text: str, source: str, targets: DataFrame, scratch: Scratch, shards: int = 32, block: int = 64, seed: int = 7) -> DataFrame:
    """(key, source, repeat, tokens, shard, place): the selection, dealt to shards.

    Each source named in `targets` (source, target_weight, max_repeats) contributes its weight of the
    selected tokens, as near as whole documents permit: within one document. No document is used more
    than `max_repeats` times (`repeat` counts from 1); sources of weight 0, or without documents or
    tokens, contribute nothing; if a source with a weight has no tokens, no mix has the target shares,
    and there are no rows. Documents without a source or with one that has no target are left out.
    Documents of equal text are different documents. Null weights and repeats count as 0.
    """
    # the table of targets has one row for each source of the mix: configuration, not data
    goal = targets.where("source is not null").groupBy("source").agg(
        F.max(F.coalesce("target_weight", F.lit(0.0))).alias("target_weight"), F.max(F.coalesce("max_repeats", F.lit(0))).alias("max_repeats")
    )
    sized = count_tokens(docs.where(F.col(source).isNotNull()).select(key, text, F.col(source).alias("source")), text, [key, "source"])
    # hash order within a source; buckets of that order keep running sums apart from single sorts
    sized = scratch.save(sized.where("tokens > 0").withColumn("_h", F.xxhash64(F.lit(seed), F.col(key))))
    stock = goal.join(sized.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")), "source", "left").toPandas()
    plan = budgets(stock)
    plan["buckets"] = np.maximum(1, plan["n"].fillna(0).astype("int64") // 4096)
    plan = plan[plan["budget"] > 0]
    empty = f"`{key}` {dict(docs.dtypes)[key]}, source string, repeat int, tokens bigint, shard int, place bigint"
    if plan.empty:
        return spark.createDataFrame([], empty)
    goals = F.broadcast(spark.createDataFrame(plan[["source", "max_repeats", "budget", "buckets", "tokens"]].rename(columns={"tokens": "all_tokens"})))
    rows = sized.join(goals, "source")
    # bucket of the hash order: the top of the unsigned hash, cut evenly
    rows = rows.withColumn("_b", F.floor(F.shiftrightunsigned("_h", 33) * F.col("buckets") / F.lit(2.0**31)).cast("long"))
    per = rows.groupBy("source", "_b").agg(F.sum("tokens").alias("bt"), F.count("*").alias("bn"))
    over = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each 4096 documents
    before = per.select("source", "_b", F.coalesce(F.sum("bt").over(over), F.lit(0)).alias("t0"), F.coalesce(F.sum("bn").over(over), F.lit(0)).alias("n0"))
    inside = Window.partitionBy("source", "_b").orderBy("_h", key).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(before, ["source", "_b"]).select(
        key, "source", "tokens", "budget", "max_repeats", "all_tokens",
        (F.col("t0") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).alias("at"),
        (F.col("n0") + F.coalesce(F.count("*").over(inside), F.lit(0))).alias("pos"),
    )
    # the k-th time through the order starts k * all_tokens tokens further on; a document is in if
    # most of it lies within the budget
    rows = rows.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.col("max_repeats"))))
    taken = rows.where(F.col("at") + (F.col("repeat") - 1) * F.col("all_tokens") + F.col("tokens") / 2 <= F.col("budget"))
    taken = scratch.save(taken.select(key, "source", "tokens", "repeat", "pos"))
    # blocks: the same number of documents each, in the fixed order
    sizes = {r.source: (r.n, r.m) for r in taken.where("repeat = 1").groupBy("source").agg(F.count("*").alias("n"), F.max("pos").alias("m")).collect()}
    total = {r.source: r.n for r in taken.groupBy("source").agg(F.count("*").alias("n")).collect()}
    counts = {s: -(-n // block) for s, n in total.items()}
    dealt = split_tree(counts, shards, seed)
    # a shard's blocks of a source are consecutive numbers of a permuted numbering; where they begin
    first: dict[str, int] = {s: 0 for s in counts}
    quota = []
    for shard, have in enumerate(dealt):
        for s, n in have.items():
            if n:
                quota.append((s, shard, first[s], first[s] + n))
                first[s] += n
    # shards times sources rows
    quotas = F.broadcast(spark.createDataFrame(quota, "source string, shard int, lo long, hi long"))
    meta = F.broadcast(spark.createDataFrame([(s, int(sizes[s][0]), counts[s], *_affine(counts[s], seed)) for s in counts], "source string, per_pass long, blocks long, mul long, add long"))
    numbered = taken.join(meta, "source").withColumn("_block", F.floor(((F.col("repeat") - 1) * F.col("per_pass") + F.col("pos")) / block).cast("long"))
    numbered = numbered.withColumn("_slot", F.pmod(F.col("_block") * F.col("mul") + F.col("add"), F.col("blocks")))
    out = numbered.join(quotas, (numbered["source"] == quotas["source"]) & (F.col("_slot") >= F.col("lo")) & (F.col("_slot") < F.col("hi"))).drop(quotas["source"])
    return out.select(key, "source", F.col("repeat").cast("int").alias("repeat"), "tokens", "shard", F.xxhash64(F.lit(seed + 1), F.col(key), F.col("repeat")).alias("place"))


def _affine(n: int, seed: int) -> tuple[int, int]:
    """A permutation x -> (mul * x + add) mod n of block numbers, below 2^31 so that products fit."""
    rng = np.random.default_rng(seed + n)
    while True:
        mul = int(rng.integers(1, max(2, min(n, 2**31))))
        if np.gcd(mul, n) == 1:
            return mul, int(rng.integers(0, n))
