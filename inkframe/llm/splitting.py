"""Splitting of oversized texts at natural boundaries, with an overlap.

Limits are in estimated tokens: a text of n UTF-8 bytes has max(1, ceil(n / 3)). A regular
expression can count that only if each of its characters is one byte, so the text is matched in a
byte view (its UTF-8 bytes read as ISO 8859-1, a lossless round trip). One pattern with bounded
quantifiers then consumes the text from left to right: its alternatives are ordered by the strength
of the boundary (blank line, line, sentence, clause, space), and end with any character; no
alternative can end inside a character. All of it is built-in SQL and stays in the JVM.

A piece is the newly consumed stretch plus a look back of `overlap` tokens into the piece before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ends of a stretch in the byte view, strongest first. The bytes after E3/EF/E2 spell full-width
#: punctuation and closing quotes.
_SENTENCE_MARK = r"(?:[.!?]|\xE3\x80\x82|\xEF\xBC\x81|\xEF\xBC\x9F|\xE2\x80\xA6)"
_CLOSER = r"(?:[\"')\]]|\xC2\xBB|\xE2\x80\x9D|\xE2\x80\x99|\xE3\x80\x8D|\xE3\x80\x8F|\xEF\xBC\x89)"
# each starts with a look at the last byte only, which settles most places at once
_BOUNDARIES = [
    r"(?<=\n)(?<=\n\n|\n\r\n)(?![\r\n])",
    r"(?<=\n)(?!\n)",
    rf"(?:(?<=[\x81\x82\x9F])(?<=\xE3\x80\x82|\xEF\xBC\x81|\xEF\xBC\x9F)(?!{_CLOSER})|(?<=[\"')\]\xBB\x9D\x99\x8D\x8F\x89])(?<=(?:\xE3\x80\x82|\xEF\xBC\x81|\xEF\xBC\x9F){_CLOSER})(?!{_CLOSER})|(?<=[ \t])(?<=[.!?][ \t]|{_SENTENCE_MARK}[ \t]|{_SENTENCE_MARK}{_CLOSER}[ \t]|{_SENTENCE_MARK}{_CLOSER}{_CLOSER}[ \t]))(?![ \t])",
    r"(?:(?<=[ \t])(?<=[,;:][ \t])|(?<=[\x8C\x9B\x9A\x81])(?<=\xEF\xBC\x8C|\xEF\xBC\x9B|\xEF\xBC\x9A|\xE3\x80\x81))(?![ \t])",
    r"(?<=[ \t])(?![ \t])",
]
_WHOLE = r"(?![\x80-\xBF])"
#: A character that is larger than the limit.
_LARGE = r"[\xF0-\xF4][\x80-\xBF]{3}"


def _consume(limit: Column) -> Column:
    """The pattern's alternatives for up to `limit` bytes: ends of blank lines, lines and sentences in
    the better half, then anywhere; clauses and spaces likewise; any whole character."""
    half = F.greatest(F.lit(1), F.floor(limit / 2))

    def upto(least: Column, end: str) -> Column:
        return F.concat(F.lit(r"[\x00-\xFF]{"), least.cast("string"), F.lit(","), limit.cast("string"), F.lit("}" + end))

    strong, weak, one = _BOUNDARIES[:3], _BOUNDARIES[3:], F.lit(1)
    steps = [upto(one, r"\z"), *(upto(half, b) for b in strong), *(upto(one, b) for b in strong), *(upto(half, b) for b in weak), *(upto(one, b) for b in weak), upto(one, _WHOLE), F.lit(_LARGE)]
    return F.concat_ws("|", *steps)


def estimated_tokens(text: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.octet_length(text) / 3)).cast("long")


def split_texts(df: DataFrame, text: str, limit: str, overlap: str) -> DataFrame:
    """`df` with `pieces`: array<struct<piece_no, start_byte, own_byte, text>>, in order.

    Each piece has at most `limit` estimated tokens. `start_byte` is where it starts, `own_byte`
    where its own part starts; between them lies what it shares with the piece before, `overlap`
    tokens as near as characters permit (never more). The own parts, put together, are the text.
    A text within the limit, the empty one too, is one piece. A null text, or a null limit, has null
    pieces. A null or negative overlap is 0; an overlap beyond half of the limit is cut to half of
    it, since pieces must get on, and with a limit under 4 tokens, 12 bytes, there is none. A limit
    under 1 counts as 1; only with that, a character of 4 bytes is a piece beyond it. Columns of any other name pass through; `pieces` is replaced.
    """
    lim = F.greatest(F.lit(1), F.col(limit).cast("int"))
    ov = F.when(lim < 4, 0).otherwise(F.least(F.greatest(F.lit(0), F.coalesce(F.col(overlap).cast("int"), F.lit(0))), F.floor(lim / 2).cast("int")))
    raw = F.decode(F.encode(F.col(text), "UTF-8"), "ISO-8859-1")
    first, more = lim * 3, (lim - ov) * 3
    # the first stretch may use the whole limit, the others leave room for the look back
    pattern = F.concat(F.lit(r"\A(?:"), _consume(first), F.lit(")|(?:"), _consume(more), F.lit(")"))
    own = F.regexp_extract_all(raw, pattern, F.lit(0))
    back = ov * 3
    none = F.array().cast("array<struct<piece_no:int,start_byte:int,own_byte:int,text:string>>")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), none.alias("out"))

    def add(acc: Column, part: Column) -> Column:
        # the tail holds the last bytes so far: what the piece shares with the one before, from the
        # first whole character on
        shared = F.regexp_replace(acc["tail"], r"^[\x80-\xBF]{1,3}", "")
        piece = F.struct(
            F.size(acc["out"]).alias("piece_no"),
            (acc["at"] - F.length(shared)).alias("start_byte"),
            acc["at"].alias("own_byte"),
            F.decode(F.encode(F.concat(shared, part), "ISO-8859-1"), "UTF-8").alias("text"),
        )
        joined = F.concat(acc["tail"], part)
        return F.struct(
            (acc["at"] + F.length(part)).alias("at"),
            F.when(back > 0, joined.substr(F.greatest(F.lit(1), F.length(joined) - back + 1), back)).otherwise("").alias("tail"),
            F.concat(acc["out"], F.array(piece)).alias("out"),
        )

    # one fold over the stretches, so that the pattern runs once whatever the optimizer moves
    cut = F.aggregate(own, zero, add, lambda acc: acc["out"])
    one = F.struct(F.lit(0).alias("piece_no"), F.lit(0).alias("start_byte"), F.lit(0).alias("own_byte"), F.col(text).alias("text"))
    return df.withColumn(
        "pieces",
        F.when(F.col(text).isNull() | F.col(limit).isNull(), F.lit(None))
        .when(F.octet_length(F.col(text)) > lim * 3, cut)
        .otherwise(F.array(one)),
    )
