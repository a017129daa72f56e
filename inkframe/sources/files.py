"""Reading and writing files: texts of any encoding, JSON, configuration directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkframe.operators.ingest import sniff


def read_texts(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """(path, encoding, text, sha256, n_bytes) of text files; a file that is not in its encoding has a
    null text. With `encoding` no mark is looked for."""
    raw = spark.read.format("binaryFile").load(path)
    enc, text = sniff(F.col("content"))
    if encoding:
        enc, text = F.lit(encoding), F.regexp_replace(F.decode("content", encoding), "\r\n?", "\n")
    return raw.select("path", enc.alias("encoding"), text.alias("text"), F.sha2("content", 256).alias("sha256"), F.length("content").alias("n_bytes"))


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents of a fixed schema, one a file or several; a malformed one fails the read."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path, ignoreNullFields=False)


def last_of_each(df: DataFrame, key: str, path: str = "path") -> DataFrame:
    """Of rows with one key the one whose file comes last by name."""
    from inkframe.operators.consolidate import latest

    return latest(df, [key], [path])


def concat_plan(clips: DataFrame, scope: str, order: str, file: str) -> DataFrame:
    """(scope, text): the list that a concatenating tool reads, one line a clip in order."""
    line = F.concat(F.lit("file '"), F.replace(F.col(file), F.lit("'"), F.lit("'''")), F.lit("'"))
    return clips.groupBy(scope).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))), lambda x: x["l"]), "\n").alias("text"))
