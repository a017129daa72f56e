"""Full hierarchies from parent-child rows: root, depth, path and descendants, with cycles found.

Nodes get dense ids in key order, so that a chain of revisions lies in one block of ids.

* Within a block, a weighted disjoint-set forest is built over the links that stay in the block:
  each node gets its local root and its offset below it, in a few vectorised compression passes.
* Only local roots with a parent in another block go on. They form a much smaller graph of the same
  kind, whose forests are merged pairwise, twice as high each time, until every walk has ended at a
  root or has come round to its own start, which is a cycle.
* Paths are read off by following the parents' positions inside a block, and joined along the merged
  links.

A block holds at most `BLOCK` nodes, whatever the keys are; nothing else is brought into one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkframe.scratch import Scratch

#: Most nodes of one block, as a power of two.
BLOCK_BITS = 18

_LOCAL = "id bigint, parent bigint, up bigint, off bigint, least bigint, ring boolean"


def _forest(ids: np.ndarray, parent: np.ndarray, has: np.ndarray):
    """Local root, offset, least id on the way, and whether the way ends in a ring, for one block.

    `ids` is sorted; `parent` counts where `has`. Returns positions for the roots.
    """
    n = len(ids)
    pos = np.searchsorted(ids, parent)
    inside = has & (pos < n)
    inside[inside] &= ids[pos[inside]] == parent[inside]
    me = np.arange(n)
    up = np.where(inside, pos, me)
    off = inside.astype(np.int64)
    least = np.minimum(me, up)
    # compression: each pass doubles the length of the ways, and ends those that reached a root
    for _ in range(max(1, int(n).bit_length())):
        nxt = up[up]
        if np.array_equal(nxt, up):
            break
        off = off + off[up]
        least = np.minimum(least, least[up])
        up = nxt
    ring = inside[up]  # a way that still goes on after n steps goes round
    if ring.any():
        # after so many passes every way into a ring has gone round it at least once, but ways from
        # outside also saw the nodes before it: take the least of a node that is on the ring
        on = np.zeros(n, dtype=bool)
        on[up[ring]] = True
        root = np.where(ring, least[up], up)
        up = root
        off = np.where(ring, 0, off)
        least = np.where(ring, root, least)
    return up, off, least, ring, inside, pos


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forests of the blocks in a task; rows are sorted by id, so a block comes in one piece."""
    held: list[pa.RecordBatch] = []
    block = None

    def solve():
        t = pa.Table.from_batches(held)
        ids = t["id"].to_numpy()
        par = t["parent"]
        has = np.asarray(par.is_valid())
        parent = par.fill_null(-1).to_numpy()
        up, off, least, ring, *_ = _forest(ids, parent, has)
        yield from pa.table(
            {"id": ids, "parent": par.combine_chunks(), "up": ids[up], "off": off, "least": ids[least], "ring": ring}
        ).cast(pa.schema([("id", pa.int64()), ("parent", pa.int64()), ("up", pa.int64()), ("off", pa.int64()), ("least", pa.int64()), ("ring", pa.bool_())])).to_batches(max_chunksize=65536)

    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy() >> BLOCK_BITS
        cuts = np.flatnonzero(np.diff(key)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, b.num_rows]):
            if block is not None and key[lo] != block:
                yield from solve()
                held = []
            block = key[lo]
            held.append(b.slice(lo, hi - lo))
    if held:
        yield from solve()


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The way from each node's local root down to the node, following positions of the parents."""
    held: list[pa.RecordBatch] = []
    block = None

    def solve():
        t = pa.Table.from_batches(held)
        ids, off = t["id"].to_numpy(), t["off"].to_numpy()
        ring = t["ring"].to_numpy(zero_copy_only=False)
        has = np.asarray(t["parent"].is_valid())
        parent = t["parent"].fill_null(-1).to_numpy()
        pos = np.searchsorted(ids, parent)
        ok = has & (pos < len(ids)) & ~ring
        ok[ok] &= ids[pos[ok]] == parent[ok]
        size = np.where(ring, 0, off + 1)
        total = np.cumsum(size)
        hi = 0
        while hi < len(ids):
            lo = hi  # as many nodes as have a million entries together, one at least
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + 1_000_000, "right")))
            ends = np.concatenate([[0], np.cumsum(size[lo:hi])])
            flat = np.empty(ends[-1], dtype=np.int64)
            cur = np.arange(lo, hi)
            slot = ends[1:] - 1
            live = size[lo:hi] > 0
            while live.any():
                flat[slot[live]] = ids[cur[live]]
                live = live & ok[cur]
                cur = np.where(live, pos[cur], cur)
                slot = slot - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[lo:hi]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], ["id", "way"]
            )

    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy() >> BLOCK_BITS
        cuts = np.flatnonzero(np.diff(key)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, b.num_rows]):
            if block is not None and key[lo] != block:
                yield from solve()
                held = []
            block = key[lo]
            held.append(b.slice(lo, hi - lo))
    if held:
        yield from solve()


def _by_block(df: DataFrame) -> DataFrame:
    return df.withColumn("_b", F.shiftright("id", BLOCK_BITS)).repartition("_b").sortWithinPartitions("id").drop("_b")


def dense_ids(df: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """`df` (one row for each value of `keys`) with a long `id` that grows with the keys."""
    return scratch.save(df.orderBy(*keys).withColumn("id", F.monotonically_increasing_id()))


def _merge(tops: DataFrame, forest: DataFrame, scratch: Scratch, ways: DataFrame | None) -> DataFrame:
    """(r, root, w, ring[, way]) for each local root `r` whose parent lies in another block."""
    f = forest.select(F.col("id").alias("fid"), F.col("up").alias("nxt"), F.col("off").alias("foff"), "least", "ring")
    links = tops.join(f, F.col("parent") == F.col("fid")).select(
        F.col("id").alias("r"), "nxt", (F.col("foff") + 1).alias("w"), "least", "ring", F.col("parent").alias("p")
    )
    if ways is not None:
        links = links.join(ways.withColumnRenamed("id", "p"), "p", "left")
    open_ids = tops.select(F.col("id").alias("o"))
    links = links.join(open_ids, F.col("nxt") == F.col("o"), "left")
    way = ["way"] if ways is not None else []
    links = links.select(
        "r", "nxt", "w", "least", "ring", F.col("nxt").alias("seen"), (F.col("o").isNull() | F.col("ring")).alias("done"), *way
    )
    links = scratch.save(links)
    while True:
        left = links.where("not done").count()
        if not left:
            return links
        old = links
        n = links.select(
            F.col("r").alias("n_r"), F.col("nxt").alias("n_nxt"), F.col("w").alias("n_w"), F.col("least").alias("n_least"),
            F.col("ring").alias("n_ring"), F.col("seen").alias("n_seen"), F.col("done").alias("n_done"),
            *([F.col("way").alias("n_way")] if way else []),
        )
        seen = F.least("seen", "n_seen")
        least = F.when(F.col("n_ring"), F.col("n_least")).otherwise(F.least("least", "n_least"))
        came = (seen == F.col("r")) & ~F.col("n_done")
        grown = links.where("not done").join(n, F.col("nxt") == F.col("n_r")).select(
            "r",
            F.when(came, F.col("r")).otherwise(F.col("n_nxt")).alias("nxt"),
            (F.col("w") + F.col("n_w")).alias("w"),
            least.alias("least"),
            (F.col("n_ring") | came).alias("ring"),
            seen.alias("seen"),
            (F.col("n_done") | came).alias("done"),
            *([F.concat("n_way", "way").alias("way")] if way else []),
        )
        links = scratch.save(links.where("done").unionByName(grown))
        # the others on a ring whose least member has come round: their walk has passed it as well
        heads = links.where("ring and nxt = r").select(F.col("r").alias("h"), F.col("least").alias("h_least"))
        if links.where("done and ring and nxt = r").limit(1).count():
            before = links
            hit = F.col("h").isNotNull()
            links = scratch.save(
                links.join(heads, (F.col("seen") == F.col("h")) & ~F.col("done"), "left").select(
                    "r",
                    F.when(hit, F.col("h")).otherwise(F.col("nxt")).alias("nxt"),
                    "w",
                    F.when(hit, F.col("h_least")).otherwise(F.col("least")).alias("least"),
                    (F.col("ring") | hit).alias("ring"),
                    "seen",
                    (F.col("done") | hit).alias("done"),
                    *way,
                )
            )
            scratch.drop(before)
        scratch.drop(old)


def hierarchy(nodes: DataFrame, scratch: Scratch, with_path: bool = False) -> DataFrame:
    """(id, parent, root, depth, is_ring[, path]) for nodes (id, parent), ids dense and unique.

    `parent` is null or the id of another node; a node may be its own parent, which is a cycle of
    one. The root of a node on or below a cycle is the cycle's least member, and its depth and path
    are null: a walk up has no end there. A path leads from the root to the node, both included. A
    parent that is no node is an error of the caller. No nodes: no rows.
    """
    forest = scratch.save(_by_block(nodes.select("id", "parent")).mapInArrow(_local, _LOCAL))
    tops = scratch.save(forest.where("up = id and not ring and parent is not null").select("id", "parent"))
    ways = None
    if with_path:
        ways = scratch.save(_by_block(forest.select("id", "parent", "off", "ring")).mapInArrow(_paths, "id bigint, way array<bigint>"))
    merged = _merge(tops, forest, scratch, ways)
    top = merged.select(
        F.col("r"), F.when(F.col("ring"), F.col("least")).otherwise(F.col("nxt")).alias("t_root"), F.col("w").alias("t_w"),
        F.col("ring").alias("t_ring"), *([F.col("way").alias("t_way")] if with_path else []),
    )
    out = forest.join(top, (F.col("up") == F.col("r")) & ~F.col("ring"), "left")
    ring = F.col("ring") | F.coalesce("t_ring", F.lit(False))
    cols = [
        "id", "parent", F.coalesce("t_root", "up").alias("root"),
        F.when(~ring, F.col("off") + F.coalesce("t_w", F.lit(0))).alias("depth"), ring.alias("is_ring"),
    ]
    if with_path:
        out = out.join(ways, "id")
        cols.append(F.when(~ring, F.concat(F.coalesce("t_way", F.array().cast("array<bigint>")), "way")).alias("path"))
    return out.select(*cols)
