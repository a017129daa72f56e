"""Content hashes, ids derived from them, and seeds."""

from __future__ import annotations

import json
import math
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def canonical_json(*fields: tuple[str, Column]) -> Column:
    """JSON of strings, integers, booleans and arrays of them, keys in code-point order, no spaces."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in sorted(fields)]), {"ignoreNullFields": "false"})


def _number(x: int | float) -> str:
    """A number as ECMAScript writes the double it is."""
    x = float(x)
    if not math.isfinite(x):
        raise ValueError(x)
    if x == 0:
        return "0"
    digits, exponent = f"{Decimal(repr(abs(x))):e}".split("e")
    digits = digits.replace(".", "").rstrip("0")
    n, sign = int(exponent) + 1, "-" if x < 0 else ""
    if len(digits) <= n <= 21:
        return sign + digits + "0" * (n - len(digits))
    if 0 < n <= 21:
        return f"{sign}{digits[:n]}.{digits[n:]}"
    if -6 < n <= 0:
        return f"{sign}0.{'0' * -n}{digits}"
    power = f"e{'+' if n > 0 else '-'}{abs(n - 1)}"
    return sign + digits[0] + ("." + digits[1:] if len(digits) > 1 else "") + power


def _write(x) -> str:
    if isinstance(x, dict):
        # keys in the order of their UTF-16 code units
        return "{" + ",".join(f"{_write(k)}:{_write(x[k])}" for k in sorted(x, key=lambda k: k.encode("utf-16-be"))) + "}"
    if isinstance(x, list):
        return "[" + ",".join(map(_write, x)) + "]"
    if isinstance(x, bool) or x is None or isinstance(x, str):
        return json.dumps(x, ensure_ascii=False)
    return _number(x)


@F.pandas_udf(StringType())
def canonicalize_json(s: pd.Series) -> pd.Series:
    """Any JSON text in the canonical form of RFC 8785: no spaces, keys by UTF-16 code units, numbers as
    doubles; null where keys repeat, numbers are not finite, surrogates stand alone or it is no JSON."""

    def pairs(items):
        if len({k for k, _ in items}) < len(items):
            raise ValueError("repeated key")
        return dict(items)

    def bad(x):
        raise ValueError(x)

    def one(t):
        try:
            out = _write(json.loads(t, object_pairs_hook=pairs, parse_constant=bad))
            out.encode()
            return out
        except (ValueError, TypeError, OverflowError, RecursionError):
            return None

    return s.map(one)


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def short_id(prefix: str, c: Column, digits: int = 20) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(c, 256), 1, digits))


def deterministic_seed(project: Column, shot: Column, attempt: Column) -> Column:
    """63 bits of the SHA-256 of project|shot|attempt; null for attempts below 1."""
    digest = F.sha2(F.concat_ws("|", project, shot, attempt.cast("string")), 256)
    top = F.conv(F.substring(digest, 1, 1), 16, 10).cast("long").bitwiseAND(7)
    rest = F.conv(F.substring(digest, 2, 15), 16, 10).cast("long")
    return F.when(attempt >= 1, F.shiftleft(top, 60) + rest)
