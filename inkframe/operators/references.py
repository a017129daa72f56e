"""References to records that do not exist, by compressed bitmaps over dictionary-encoded keys.

Keys that are referred to get dense ids. For each range of 2^15 ids and each month there is a bitmap
of the keys referred to, one of the keys that had a valid parent during the whole month, and one of
those that had one at some time in it. A bitmap is kept as the shortest of a list of its bits, a list
of its runs, and the plain bits. References and times of validity first become one row for each key and
year with a mask of its months, merged on the map side, so that however often a key is referred to, no
range and year has more rows than the range has keys. AND-NOT of the bitmaps leaves

* references AND NOT ever valid in the month: orphans, whatever their exact time;
* references AND valid at some time AND NOT throughout: only these are compared time by time.

The surviving bits are decoded to ids and find the referring rows again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkframe.scratch import Scratch

#: Ids of one bitmap; a bit's number fits 16 bits.
RANGE = 1 << 15
_MASKS = ["referred", "throughout", "sometime"]


def month_of(c: Column) -> Column:
    return F.year(c) * 12 + F.month(c) - 1


def pack(bits: np.ndarray) -> bytes:
    """Distinct sorted bits as a list, as runs (first and last), or plain, whichever is shortest."""
    bits = bits.astype(np.uint16)
    cut = np.flatnonzero(np.diff(bits.astype(np.int32)) != 1) + 1
    runs = np.stack([bits[np.concatenate([[0], cut])], bits[np.concatenate([cut - 1, [len(bits) - 1]])]], axis=1) if len(bits) else np.zeros((0, 2), np.uint16)
    if 2 * runs.size <= min(2 * len(bits), RANGE // 8):
        return b"R" + runs.tobytes()
    if 2 * len(bits) <= RANGE // 8:
        return b"L" + bits.tobytes()
    plain = np.zeros(RANGE, dtype=np.uint8)
    plain[bits] = 1
    return b"P" + np.packbits(plain).tobytes()


def unpack(packed: bytes | None) -> np.ndarray:
    """Which of the range's bits are set."""
    out = np.zeros(RANGE, dtype=bool)
    if packed:
        kind, rest = packed[:1], packed[1:]
        if kind == b"P":
            return np.unpackbits(np.frombuffer(rest, dtype=np.uint8)).astype(bool)
        x = np.frombuffer(rest, dtype=np.uint16).astype(np.int64)
        if kind == b"L":
            out[x] = True
        else:
            edge = np.zeros(RANGE + 1, dtype=np.int32)
            np.add.at(edge, x[::2], 1)
            np.add.at(edge, x[1::2] + 1, -1)
            out = np.cumsum(edge[:-1]) > 0
    return out


def _build(key: tuple, rows: pa.Table) -> pa.Table:
    """Bitmaps of one range and year, for each month in which there are references."""
    order = np.argsort(rows.column("bit").to_numpy())
    bit, masks = rows.column("bit").to_numpy()[order], [rows.column(c).to_numpy()[order] for c in _MASKS]
    months = [m for m in range(12) if (masks[0] >> m & 1).any()]
    packed = [[pack(bit[(x >> m & 1) > 0]) for m in months] for x in masks]
    first = key[1].as_py() * 12
    return pa.table(
        [pa.array([key[0].as_py()] * len(months), pa.int64()), pa.array([first + m for m in months], pa.int32()), *(pa.array(x, pa.binary()) for x in packed)],
        ["range", "month", *_MASKS],
    )


def _surviving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at, month, *packed in zip(*(c.to_pylist() for c in b.columns)):
            ref, whole, some = map(unpack, packed)
            sure, ask = np.flatnonzero(ref & ~some), np.flatnonzero(ref & some & ~whole)
            n = len(sure) + len(ask)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at * RANGE + np.concatenate([sure, ask]), pa.int64()), pa.array(np.full(n, month, np.int32)), pa.array(np.arange(n) < len(sure))], ["_id", "_month", "_sure"]
            )


def orphan_references(refs: DataFrame, parents: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of `refs` for which no parent was valid at their time.

    refs: scope, ref, at, and any other columns, which pass through whatever their names; rows with a
    null `ref` are no references and are left out. parents: scope, ref, valid_from, valid_to (null: for ever; the end is exclusive), others are ignored. A parent is valid from `valid_from` on while
    `valid_to` is null or later. A null scope has no parents, and a reference without a time (`at`
    is null) none that was valid then: both are orphans. A parent without `valid_from` is never
    valid. Repeated rows of `refs` stay repeated. Empty tables: no parents makes every reference an
    orphan, no references gives no rows.
    """
    refs = refs.where("ref is not null")
    # the rows travel as one column, so that none of theirs can clash with those made here
    rows = refs.select("scope", "ref", "at", F.struct(*[F.col(f"`{c}`") for c in refs.columns]).alias("_row"))
    whole = rows.where("scope is not null and at is not null")
    lost = rows.where("scope is null or at is null").select("_row.*")
    keys = scratch.save(whole.select("scope", "ref").distinct().orderBy("scope", "ref").withColumn("_id", F.monotonically_increasing_id()))
    # ids are dense inside a partition of the sort; the bits above tell the partitions apart
    r = scratch.save(whole.join(keys, ["scope", "ref"]).withColumn("_month", month_of(F.col("at"))))
    p = (
        parents.where("scope is not null and ref is not null and valid_from is not null and (valid_to is null or valid_to > valid_from)")
        .select("scope", "ref", "valid_from", "valid_to")
        .join(keys, ["scope", "ref"])
        .select("_id", "valid_from", "valid_to", month_of(F.col("valid_from")).alias("m0"), month_of(F.col("valid_to")).alias("m1"))
    )
    p = scratch.save(p.distinct())
    span = r.agg(F.min("_month").alias("lo"), F.max("_month").alias("hi")).first()
    if span["lo"] is None:
        return lost
    # months in which the parent is valid at some time, and throughout, of those in which there are references
    s0, s1 = F.greatest("m0", F.lit(span["lo"])), F.least(F.coalesce("m1", F.lit(span["hi"])), F.lit(span["hi"]))
    starts = F.make_timestamp_ntz(F.floor(F.col("m0") / 12).cast("int"), (F.col("m0") % 12 + 1).cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    w0, w1 = F.when(F.col("valid_from") <= starts, F.col("m0")).otherwise(F.col("m0") + 1), F.coalesce(F.col("m1") - 1, F.lit(span["hi"]))
    spans = p.select("_id", s0.alias("s0"), s1.alias("s1"), F.greatest(w0, s0).alias("w0"), F.least(w1, s1).alias("w1")).where("s0 <= s1")
    spans = spans.withColumn("year", F.explode(F.sequence(F.floor(F.col("s0") / 12).cast("int"), F.floor(F.col("s1") / 12).cast("int"))))

    def mask(lo: str, hi: str) -> Column:
        a, b = F.greatest(F.col(lo), F.col("year") * 12), F.least(F.col(hi), F.col("year") * 12 + 11)
        return F.when(a <= b, (F.pow(F.lit(2), b - F.col("year") * 12 + 1) - F.pow(F.lit(2), a - F.col("year") * 12)).cast("int")).otherwise(0)

    none = F.lit(0)
    bits = r.select(F.col("_id").alias("id"), F.floor(F.col("_month") / 12).cast("int").alias("year"), F.pow(F.lit(2), F.col("_month") % 12).cast("int").alias("referred"), none.alias("throughout"), none.alias("sometime"))
    bits = bits.unionByName(spans.select(F.col("_id").alias("id"), "year", none.alias("referred"), mask("w0", "w1").alias("throughout"), mask("s0", "s1").alias("sometime")))
    bits = bits.groupBy("id", "year").agg(*[F.bit_or(c).alias(c) for c in _MASKS]).where("referred <> 0")
    bits = bits.select(F.floor(F.col("id") / RANGE).alias("range"), "year", (F.col("id") % RANGE).cast("int").alias("bit"), *_MASKS)
    maps = bits.groupBy("range", "year").applyInArrow(_build, "range bigint, month int, referred binary, throughout binary, sometime binary")
    left = maps.mapInArrow(_surviving, "_id bigint, _month int, _sure boolean")
    found = scratch.save(r.join(left, ["_id", "_month"]))
    valid = p.select(F.col("_id").alias("p_id"), "valid_from", "valid_to")
    asked = found.where("not _sure").join(
        valid,
        (F.col("_id") == F.col("p_id")) & (F.col("valid_from") <= F.col("at")) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("at"))),
        "left_anti",
    )
    return found.where("_sure").unionByName(asked).select("_row.*").unionByName(lost)
