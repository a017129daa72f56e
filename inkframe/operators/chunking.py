"""Greedy packing of paragraphs to chunks with context, and of pairs to blocks, by array folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _tokens(size: Column, n: Column) -> Column:
    """Estimated tokens of n paragraphs of so many bytes, joined by blank lines."""
    return F.when(n <= 0, F.lit(0)).otherwise(F.greatest(F.lit(1), F.ceil((size + 2 * (n - 1)) / 3))).cast("long")


def plan_chunks(par: DataFrame, keys: list[str], order: str, pid: str, text: str, ownership: str, overlap: str, context: str, with_owned: bool = False) -> DataFrame:
    """(keys, chunk_no, first_owned, last_owned, first_context, last_context, owned_tokens, context_tokens).

    Paragraphs of a chapter are taken in order into chunks of at most `ownership` estimated tokens; a
    paragraph that alone exceeds it is a chunk of its own. The context then grows to the left, and
    after that to the right, while the grown side has at most `overlap` tokens and the whole at most
    `context`. Repeated rows of a paragraph count once, null texts as empty; rows without an order or
    id are left out. Folds run inside a chapter. With `with_owned` the ids of the owned paragraphs come too.
    """
    p = par.where(f"{order} is not null and {pid} is not null").select(*keys, F.struct(F.col(order).alias("o"), F.col(pid).alias("id"), F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("b")).alias("p"), F.col(ownership).alias("_own"), F.col(overlap).alias("_ov"), F.col(context).alias("_ctx"))
    g = p.groupBy(*keys).agg(F.array_sort(F.collect_set("p")).alias("ps"), F.min("_own").alias("_own"), F.min("_ov").alias("_ov"), F.min("_ctx").alias("_ctx"))
    start = F.struct(F.lit(0).cast("long").alias("b"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("sizes"))

    def take(acc: Column, x: Column) -> Column:
        fits = (acc["n"] > 0) & (_tokens(acc["b"] + x["b"], acc["n"] + 1) <= F.col("_own"))
        return F.struct(
            F.when(fits, acc["b"] + x["b"]).otherwise(x["b"]).alias("b"),
            F.when(fits, acc["n"] + 1).otherwise(F.lit(1)).alias("n"),
            F.when(fits | (acc["n"] == 0), acc["sizes"]).otherwise(F.concat(acc["sizes"], F.array(acc["n"]))).alias("sizes"),
        )

    g = g.withColumn("sizes", F.aggregate("ps", start, take, lambda a: F.concat(a["sizes"], F.array(a["n"]))))
    ends = F.aggregate("sizes", F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
    # bytes before each paragraph
    sums = F.aggregate("ps", F.array(F.lit(0).cast("long")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x["b"])))
    g = g.withColumn("ends", ends).withColumn("sums", sums).withColumn("n", F.size("ps"))
    c = g.select(*keys, "ps", "sums", "n", "_ov", "_ctx", "ends", F.posexplode("sizes").alias("k", "size"))
    c = c.withColumn("lo", F.element_at("ends", F.col("k") + 1)).withColumn("hi", F.col("lo") + F.col("size"))

    def span(a: Column, b: Column) -> Column:
        return _tokens(F.element_at("sums", b + 1) - F.element_at("sums", a + 1), b - a)

    # growth stops at the first side that does not fit: count how many in a row do
    left = F.aggregate(
        F.when(F.col("lo") > 0, F.sequence(F.col("lo") - 1, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>")),
        F.struct(F.col("lo").alias("at"), F.lit(True).alias("go")),
        lambda a, i: F.struct(
            F.when(a["go"] & (span(i, F.col("lo")) <= F.col("_ov")) & (span(i, F.col("hi")) <= F.col("_ctx")), i).otherwise(a["at"]).alias("at"),
            (a["go"] & (span(i, F.col("lo")) <= F.col("_ov")) & (span(i, F.col("hi")) <= F.col("_ctx"))).alias("go"),
        ),
        lambda a: a["at"],
    )
    c = c.withColumn("cl", left)
    right = F.aggregate(
        F.when(F.col("hi") < F.col("n"), F.sequence(F.col("hi") + 1, F.col("n"))).otherwise(F.array().cast("array<int>")),
        F.struct(F.col("hi").alias("at"), F.lit(True).alias("go")),
        lambda a, i: F.struct(
            F.when(a["go"] & (span(F.col("hi"), i) <= F.col("_ov")) & (span(F.col("cl"), i) <= F.col("_ctx")), i).otherwise(a["at"]).alias("at"),
            (a["go"] & (span(F.col("hi"), i) <= F.col("_ov")) & (span(F.col("cl"), i) <= F.col("_ctx"))).alias("go"),
        ),
        lambda a: a["at"],
    )
    c = c.withColumn("cr", right)
    at = lambda i: F.element_at("ps", i)["id"]
    return c.select(
        *keys, (F.col("k") + 1).alias("chunk_no"), at(F.col("lo") + 1).alias("first_owned"), at(F.col("hi")).alias("last_owned"),
        at(F.col("cl") + 1).alias("first_context"), at(F.col("cr")).alias("last_context"), F.col("size").alias("n_owned"), (F.col("cr") - F.col("cl")).alias("n_context"),
        span(F.col("lo"), F.col("hi")).alias("owned_tokens"), span(F.col("cl"), F.col("cr")).alias("context_tokens"),
        *([F.transform(F.slice("ps", F.col("lo") + 1, F.col("size")), lambda x: x["id"]).alias("owned")] if with_owned else []),
    )


def pack_pairs(pairs: DataFrame, scope: list[str], order: list[str], left: str, right: str, max_pairs: int = 6, max_ends: int = 12) -> DataFrame:
    """(scope, block_no, pair_no, left, right): pairs in order, packed greedily into blocks of at most
    `max_pairs` pairs with at most `max_ends` different ends. The fold runs inside a scope."""
    g = pairs.groupBy(*scope).agg(F.array_sort(F.collect_list(F.struct(*order, left, right))).alias("ps"))
    zero = F.struct(F.lit(0).alias("block"), F.lit(0).alias("n"), F.array().cast("array<string>").alias("ends"), F.array().cast("array<int>").alias("blocks"))

    def put(a: Column, p: Column) -> Column:
        ends = F.array_union(a["ends"], F.array(p[left], p[right]))
        full = (a["n"] >= max_pairs) | (F.size(ends) > max_ends)
        block = a["block"] + F.when(full, 1).otherwise(0)
        return F.struct(
            block.alias("block"),
            F.when(full, 1).otherwise(a["n"] + 1).alias("n"),
            F.when(full, F.array_distinct(F.array(p[left], p[right]))).otherwise(ends).alias("ends"),
            F.concat(a["blocks"], F.array(block)).alias("blocks"),
        )

    g = g.withColumn("blocks", F.aggregate("ps", zero, put, lambda a: a["blocks"]))
    return g.select(*scope, F.posexplode(F.arrays_zip("ps", "blocks")).alias("pair_no", "z")).select(
        *scope, (F.col("z.blocks") + 1).alias("block_no"), (F.col("pair_no") + 1).alias("pair_no"), F.col(f"z.ps.{left}").alias(left), F.col(f"z.ps.{right}").alias(right)
    )
