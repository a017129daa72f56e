"""Numbers: nearest-rank percentiles, rounding to multiples, intervals, back-off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nearest_rank(c: str, q: float) -> Column:
    """The value at rank ceil(q * n), at least the first; nulls left out."""
    return F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY `{c}`)")


def distribution(c: str) -> list[Column]:
    return [F.min(c).alias("least"), nearest_rank(c, 0.5).alias("median"), nearest_rank(c, 0.95).alias("p95"), F.max(c).alias("greatest")]


def ceil_div(a: Column, b: Column) -> Column:
    return F.ceil(a / b).cast("long")


def frames_for_seconds(seconds: Column, fps: int = 24) -> Column:
    """Frames, rounded half to even, up to the next number that leaves 5 when divided by 17; 5 at least."""
    n = F.greatest(F.lit(5), F.rint(seconds * fps).cast("long"))
    return n + F.pmod(F.lit(5) - n, F.lit(17))


def side_for_megapixels(megapixels: Column, ratio: Column, multiple: int = 32) -> tuple[Column, Column]:
    """(width, height) of a picture of so many megapixels, each a multiple, half to even."""
    width = F.sqrt(megapixels * 1_000_000 * ratio)
    to = lambda x: (F.greatest(F.lit(1), F.rint(x / multiple)) * multiple).cast("int")
    return to(width), to(width / ratio)


def backoff_seconds(attempt: Column) -> Column:
    return F.least(F.lit(2.0), F.lit(0.25) * F.pow(F.lit(2.0), attempt - 1))
