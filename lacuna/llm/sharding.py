"""Shards of near-equal bytes by minimax contiguous partition of ordered atomic groups.

Groups are equal texts (by 64-bit hash: a collision only makes two texts one group), ordered by that hash. The smallest
capacity with which a greedy walk over the groups fills at most `shards` shards is found by binary search, and the order
is cut where that walk cuts. The driver never sees all groups: it gets sums of hash ranges, at most 2**REFINE_BITS at a
time, and bounds the capacity from below (ranges of several groups cut anywhere) and above (cut at their ends only);
only the ranges in which cuts of such capacities may fall are summed again in finer ranges, until these are single
groups. Rows get their slots by salted ranks, so a group with a third of all rows is dealt to many tasks.

Defined results: a null text has size 1 and checksum 0 and is in the group of empty texts; repeated rows each get a slot;
an empty table gives no rows; other columns of the input are ignored. With fewer groups than shards, some stay empty.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import cut, ranked

SHARDS = 8
FIRST_BITS, REFINE_BITS = 12, 17
_SIGN = -(1 << 63)


def walk(blocks: list[tuple], ends: list[int], capacity: int, shards: int, fluid: bool) -> tuple[list[int], bool]:
    """Positions of the greedy cuts with this capacity, and whether all fits. blocks: (first, last, bits, size, single) in
    order; ends: running sums. Blocks of several groups are cut anywhere if fluid, else at their ends only."""
    cuts, at, total = [], 0, ends[-1] if ends else 0
    while at < total and len(cuts) < shards:
        reach = at + capacity
        if reach >= total:
            return [*cuts, total], True
        k = bisect_right(ends, reach)  # the block in which reach lies
        begin = ends[k - 1] if k else 0
        after = reach if fluid and not blocks[k][4] else begin
        if after <= at:
            return cuts + [at] * (shards - len(cuts)), False
        at = after
        cuts.append(at)
    return cuts, at >= total


def least(blocks: list[tuple], ends: list[int], shards: int, fluid: bool) -> int:
    """The smallest feasible capacity, by binary search."""
    low, high = -(-ends[-1] // shards), ends[-1]
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if walk(blocks, ends, middle, shards, fluid)[1] else (middle + 1, high)
    return low


def minimax_cuts(sums, shards: int) -> list[int]:
    """Group keys at which shards 1, 2, ... begin. sums(ranges, bits): (first key, last key, size, range) rows of the
    blocks of 2**(64-bits) keys within the given ranges of block numbers at fewer bits (None: all)."""

    def blocks_of(rows, bits: int) -> list[tuple]:
        return sorted((first, last, bits, int(size), first == last) for first, last, size in rows)

    blocks = blocks_of(sums(None, 0, FIRST_BITS), FIRST_BITS)
    while blocks:
        ends, total = [], 0
        for b in blocks:
            ends.append(total := total + b[3])
        low, high = least(blocks, ends, shards, True), least(blocks, ends, shards, False)
        near, far = walk(blocks, ends, low, shards, False)[0], walk(blocks, ends, high, shards, True)[0]
        far += [total] * (len(near) - len(far))
        near += [near[-1] if near else 0] * (len(far) - len(near))
        doubtful = {k for a, z in zip(near, far, strict=True) for k in range(bisect_right(ends, a), min(bisect_right(ends, z), len(blocks) - 1) + 1) if not blocks[k][4]}
        if low == high and all(blocks[k][4] or (ends[k - 1] if k else 0) in far for k in doubtful) or not doubtful:
            cuts = walk(blocks, ends, high, shards, False)[0]
            return [blocks[bisect_right(ends, at)][0] for at in cuts if at < total]
        coarse = min(blocks[k][2] for k in doubtful)
        now = sorted(k for k in doubtful if blocks[k][2] == coarse)
        bits = min(64, coarse + max(1, min(FIRST_BITS, REFINE_BITS - len(now).bit_length())))
        finer = blocks_of(sums([(blocks[k][0], blocks[k][1]) for k in now], coarse, bits), bits)
        gone = set(now)
        blocks = sorted([b for k, b in enumerate(blocks) if k not in gone] + finer)
    return []


def shard_rows(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, key and shard of docs(doc_id, text), read once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = cut(docs.select(F.col("doc_id").cast("long"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("key")))

    def sums(ranges, coarse: int, bits: int):
        some, block = rows, F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(_SIGN)), 64 - bits)
        if ranges:
            spans = rows.sparkSession.createDataFrame(sorted({((first ^ _SIGN) % (1 << 64)) >> (64 - coarse) for first, _ in ranges}), "long").toDF("coarse")
            # at most 2**REFINE_BITS numbers
            some = rows.withColumn("coarse", F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(_SIGN)), 64 - coarse)).join(F.broadcast(spans), "coarse", "left_semi")
        found = some.groupBy(block.alias("b")).agg(F.min("key").alias("first"), F.max("key").alias("last"), F.sum("size").alias("size"))
        return [(r["first"], r["last"], r["size"]) for r in found.collect()]

    begins = minimax_cuts(sums, shards)
    shard = sum(((F.col("key") >= F.lit(k)).cast("int") for k in begins), F.lit(0))
    return rows.withColumn("shard", shard.cast("int"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law) of docs(doc_id, text)."""
    placed = ranked(shard_rows(docs, shards), ["shard"], ["doc_id", "key"], "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
