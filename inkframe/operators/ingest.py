"""Texts to sections and paragraphs, and bytes to texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkframe.functions.text import heading_kind, normalize_newlines

# Byte order marks in the order they are looked for, and what they name.
MARKS = [("FFFE0000", 0, "UTF-32"), ("0000FEFF", 0, "UTF-32"), ("FFFE", 2, "UTF-16LE"), ("FEFF", 2, "UTF-16BE"), ("EFBBBF", 3, "UTF-8")]


def sniff(content: Column) -> tuple[Column, Column]:
    """(encoding, text) of bytes by their byte order mark, else strict UTF-8, with a null text where they
    are not; bytes that are not in the encoding that their mark names fail the read."""
    head, name, text = F.hex(F.substring(content, 1, 4)), None, None
    for mark, n, enc in MARKS:
        hit, body = head.startswith(mark), F.substring(content, n + 1, 2**31 - 1)
        body = F.try_validate_utf8(body.cast("string")) if enc == "UTF-8" else F.decode(body, enc)
        name = F.when(hit, enc) if name is None else name.when(hit, enc)
        text = F.when(hit, body) if text is None else text.when(hit, body)
    return name.otherwise("UTF-8"), normalize_newlines(text.otherwise(F.try_validate_utf8(content.cast("string"))))


def to_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, line): lines from 0. A null text has none, an empty one has one empty line."""
    return df.select(key, F.posexplode(F.split(normalize_newlines(F.col(text)), "\n", -1)).alias("line_no", "line"))


def paragraphs(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, chapter_no, chapter_kind, heading, paragraph_no, text): sections and their paragraphs.

    A heading line begins a section; lines before the first heading make a section of kind
    `synthetic`; sections without text are left out and numbered densely. In a section with a blank
    line, blank lines separate paragraphs, whose lines stay together; else every line that is not
    blank is a paragraph. Lines are trimmed at their ends.

    Everything happens inside the row of a document, in time proportional to its length: nothing is
    shuffled, and no line leaves its document before the paragraphs are made.
    """
    lines = df.where(F.col(text).isNotNull()).select(key, F.split(normalize_newlines(F.col(text)), "\n", -1).alias("ls"))
    tagged = lines.select(key, F.transform("ls", lambda x: F.struct(F.regexp_replace(x, r"\s+$", "").alias("t"), heading_kind(x).alias("h"))).alias("ls"))
    heads = F.filter(F.sequence(F.lit(1), F.size("ls")), lambda i: F.element_at("ls", i)["h"].isNotNull())
    # a section is a heading's place (0 for none) and the lines up to the next one
    bounds = tagged.withColumn("heads", heads).withColumn("from", F.concat(F.array(F.lit(0)), "heads")).withColumn("to", F.concat("heads", F.array(F.size("ls") + 1)))
    cut = F.transform(
        F.arrays_zip("from", "to"),
        lambda x: F.struct(
            F.when(x["from"] > 0, F.element_at("ls", F.greatest(x["from"], F.lit(1)))).alias("head"),
            F.transform(F.slice(F.col("ls"), x["from"] + 1, x["to"] - x["from"] - 1), lambda y: y["t"]).alias("body"),
        ),
    )
    apart = lambda body: F.transform(F.split(F.array_join(body, "\n"), "\n{2,}", -1), lambda t: F.regexp_replace(t, r"^\n+|\n+$", ""))
    made = F.transform(
        "cut",
        lambda x: F.struct(x["head"].alias("head"), F.filter(F.when(F.exists(x["body"], lambda t: t == ""), apart(x["body"])).otherwise(x["body"]), lambda t: t != "").alias("ps")),
    )
    full = bounds.select(key, cut.alias("cut")).select(key, F.filter(made, lambda x: F.size(x["ps"]) > 0).alias("sections"))
    # outer, or the optimizer would ask for the size of the arrays first and make them twice
    out = full.select(key, F.posexplode_outer("sections").alias("c", "s")).select(key, "c", "s.head", F.posexplode_outer("s.ps").alias("p", "text")).where("p is not null")
    return out.select(
        key, (F.col("c") + 1).alias("chapter_no"), F.coalesce("head.h", F.lit("synthetic")).alias("chapter_kind"), F.trim("head.t").alias("heading"), (F.col("p") + 1).alias("paragraph_no"), "text",
    )
