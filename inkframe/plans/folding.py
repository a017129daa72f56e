"""Unicode folding for the SQL that checks queries, made from the rules of the Unicode tables."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache


@lru_cache(1)
def _maps() -> tuple[str, str, list[tuple[str, str]]]:
    """(characters, what each becomes) for those that fold to one character, and those that fold to several."""
    one, to, many = [], [], []
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        if 0xAC00 <= ord(c) <= 0xD7A3 or 0xD800 <= ord(c) <= 0xDFFF:
            continue
        folded = unicodedata.normalize("NFKC", c).casefold()
        if folded == c or folded == unicodedata.normalize("NFC", c) or not folded:
            continue
        if len(folded) == 1:
            one.append(c)
            to.append(folded)
        elif ord(c) < 0x250 or 0xFB00 <= ord(c) <= 0xFB06 or c in "…‥№℃℉":
            many.append((c, folded))
    return "".join(one), "".join(to), many


def folded(expr: str) -> str:
    """Compatibility form, case folded, of a string in SQL; characters that fold to several others only where
    they are Latin letters, ligatures or common signs. White space is trimmed, runs of it are one blank."""
    one, to, many = _maps()
    out = expr
    for c, t in many:
        out = f"replace({out}, '{c}', '{t}')"
    quote = lambda x: x.replace("'", "''")
    out = f"nfc_normalize(lower(translate({out}, '{quote(one)}', '{quote(to)}')))"
    return f"regexp_replace(trim(regexp_replace({out}, '\\s+', ' ', 'g')), '\\s+', ' ', 'g')"
