"""Scalar text functions as column expressions; Python only for Unicode folding."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words that number a chapter, and names of unnumbered ones.
_NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand"
).split()
_CHINESE_NUMERALS = "零〇一二三四五六七八九十百千万两"
_CHINESE_SPECIAL = "序章 序言 楔子 尾声 后记".split()
_DASH = r":.\-–—"

_WORD = "(?:" + "|".join(_NUMBER_WORDS) + ")"
_TAIL = rf"(?:\s*[{_DASH}](?:\s*\S.*)?)?"
HEADING_SPECIAL = rf"(?i)^(prologue|epilogue){_TAIL}$"
HEADING_ENGLISH = rf"(?i)^(chapter|part)\s+(?:\d+|[ivxlcdm]+|{_WORD}(?:[- ]{_WORD})*){_TAIL}$"
HEADING_CHINESE = rf"^(?:第[{_CHINESE_NUMERALS}\d]+[章节卷部]|{'|'.join(_CHINESE_SPECIAL)})(?:\s*[：{_DASH}]\s*\S.*|\s+\S.*)?$"

# Identity keys too general to identify anybody.
WEAK_KEYS = (
    "mr|mrs|ms|miss|sir|madam|captain|doctor|teacher|professor|student|mother|father|mom|mum|dad|boy|girl|man|woman|"
    "the teacher|the doctor|the captain|老师|医生|教授|学生|同学|先生|女士|小姐|队长|父亲|母亲|爸爸|妈妈|男孩|女孩|男人|女人|班主任"
).split("|")
#: Tokens that block nothing.
STOP_TOKENS = ["the", "of"]


def normalize_newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def heading_kind(c: Column) -> Column:
    """chapter, part, prologue, epilogue or null; text of several lines is never a heading."""
    line = F.trim(c)
    marker = F.regexp_extract(line, r"^(?:第[^章节卷部]*([章节卷部])|)", 1)
    return (
        F.when(line.contains("\n"), None)
        .when(line.rlike(HEADING_SPECIAL), F.lower(F.regexp_extract(line, HEADING_SPECIAL, 1)))
        .when(line.rlike(HEADING_ENGLISH), F.lower(F.regexp_extract(line, HEADING_ENGLISH, 1)))
        .when(line.rlike(HEADING_CHINESE), F.when(marker.isin("卷", "部"), "part").when(line.rlike("^(序章|序言|楔子)"), "prologue").when(line.rlike("^(尾声|后记)"), "epilogue").otherwise("chapter"))
    )


def estimate_tokens(c: Column) -> Column:
    """max(1, ceil(UTF-8 bytes / 3)); null for null."""
    return F.when(c.isNotNull(), F.greatest(F.lit(1), F.ceil(F.octet_length(c) / 3))).cast("long")


@F.pandas_udf(StringType())
def _fold(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else re.sub(r"\s+", " ", unicodedata.normalize("NFKC", t).casefold().strip()))


def normalize_name(c: Column) -> Column:
    """Compatibility form, case folded, trimmed, runs of white space as one space."""
    return _fold(c)


def tokens_of(keys: Column) -> Column:
    """Distinct runs of letters and digits of two or more, not all digits, sorted."""
    runs = F.flatten(F.transform(keys, lambda k: F.regexp_extract_all(k, F.lit(r"[\p{L}\p{N}]+"), F.lit(0))))
    return F.array_sort(F.array_distinct(F.filter(runs, lambda t: (F.length(t) >= 2) & ~t.rlike(r"^\p{N}+$"))))


def blocking_tokens(keys: Column) -> Column:
    return F.array_except(tokens_of(keys), F.array(*map(F.lit, STOP_TOKENS)))


def count_cjk(c: Column) -> Column:
    return F.regexp_count(c, F.lit("[一-鿿]"))


def is_strong_key(c: Column) -> Column:
    """A letter, not a general title, and two tokens or three ideographs."""
    return c.rlike(r"\p{L}") & ~c.isin(WEAK_KEYS) & ((F.size(tokens_of(F.array(c))) >= 2) | (count_cjk(c) >= 3))


def base_language(c: Column) -> Column:
    return F.lower(F.split(F.trim(c), "[-_]").getItem(0))


def placeholders(c: Column) -> Column:
    """Sorted distinct names in {{name}}."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"\{\{\s*([A-Za-z_][A-Za-z0-9_]*)\s*\}\}"), F.lit(1))))


def staged_name(asset_id: Column, path: Column) -> Column:
    return F.concat(F.replace(asset_id, F.lit("."), F.lit("__")), F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1)))


def host_path(path: Column) -> Column:
    """A Windows drive path as it is mounted; other paths unchanged."""
    slashed = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.when(path.rlike(r"^[A-Za-z]:[\\/]"), F.concat(F.lit("/mnt/"), F.lower(F.substring(path, 1, 1)), F.substr(slashed, F.lit(3)))).otherwise(path)
