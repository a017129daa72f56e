import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from inkframe.llm.mixing import budgets, mix, split_tree
from inkframe.scratch import Scratch


def test_tree_keeps_totals():
    counts = {"a": 101, "b": 7, "c": 0, "d": 1}
    got = split_tree(counts, 8, 1)
    assert len(got) == 8 and {s: sum(x[s] for x in got) for s in counts} == counts
    sizes = [sum(x.values()) for x in got]
    assert max(sizes) - min(sizes) <= 1 and split_tree({}, 4, 1) == []


def test_budgets():
    b = budgets(pd.DataFrame({"source": list("abc"), "target_weight": [0.5, 0.5, 0.0], "max_repeats": [1, 3, 9], "tokens": [100, 10, np.nan]}))
    assert list(b["budget"]) == [30, 30, 0]


@pytest.fixture(scope="module")
def docs(spark):
    n = spark.range(3000)
    src = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "small").when(F.col("id") % 50 == 2, F.lit(None)).otherwise("mid")
    return n.select(F.col("id").alias("doc"), F.concat(F.lit("some words of text "), F.repeat(F.lit("and more "), (F.col("id") % 7).cast("int"))).alias("text"), src.alias("src"), F.lit("x").alias("tokens"), F.lit("x").alias("source"), F.lit(1).alias("_h"))


def test_shares_repeats_and_shards(spark, docs):
    targets = spark.createDataFrame([("hot", 0.6, 1), ("small", 0.2, 4), ("mid", 0.2, 1), ("none", 0.0, 1)], "source string, target_weight double, max_repeats int")
    got = mix(spark, docs, "doc", "text", "src", targets, Scratch(spark, "test"), shards=8, block=8).toPandas()
    share = got.groupby("source")["tokens"].sum() / got["tokens"].sum()
    assert abs(share["hot"] - 0.6) < 0.01 and abs(share["small"] - 0.2) < 0.01 and set(share.index) == {"hot", "small", "mid"}
    assert not got.duplicated(["doc", "repeat"]).any() and got[got.source == "small"]["repeat"].max() <= 4
    assert got["shard"].nunique() == 8 and got["shard"].notna().all()
    again = mix(spark, docs.repartition(7), "doc", "text", "src", targets, Scratch(spark, "test"), shards=8, block=8).toPandas()
    key = ["doc", "repeat", "shard", "place"]
    assert got[key].sort_values(key).reset_index(drop=True).equals(again[key].sort_values(key).reset_index(drop=True))


def test_edges(spark, docs):
    t = "source string, target_weight double, max_repeats int"
    none = spark.createDataFrame([], t)
    assert mix(spark, docs, "doc", "text", "src", none, Scratch(spark, "test")).count() == 0
    missing = spark.createDataFrame([("nowhere", 0.5, 1), ("mid", 0.5, 1)], t)
    assert mix(spark, docs, "doc", "text", "src", missing, Scratch(spark, "test")).count() == 0
    nulls = docs.withColumn("text", F.lit(None).cast("string"))
    assert mix(spark, nulls, "doc", "text", "src", spark.createDataFrame([("mid", 1.0, None)], t), Scratch(spark, "test")).count() == 0
