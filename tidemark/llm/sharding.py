"""Minimax contiguous partition of equal-text groups into shards, in DataFrame operations only.

Groups of equal texts are atoms, ordered by the hash of their text, so a shard is a range of hashes and a document
finds its shard by comparing its hash with the cuts. The capacity is the smallest with which filling shards in order
needs no more shards than there are; it is searched by bisection, each candidate checked greedily.

The greedy check runs on a bounded outline of the order: sums of hash ranges. Ranges in which a cut can lie for any
capacity still possible are opened into finer ranges until they hold single groups; all others stay sums. The result
is exact, and what reaches the driver is at most ``2 ** OUTLINE_BITS`` sums and a few thousand ranges per round.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.sources.store import settle

OUTLINE_BITS = 12       # of the first outline
OPEN_BITS = 6           # each opened range is split in 2^6
SLOT_BUCKETS = 1024     # parts of a shard that are numbered apart
HASH_BITS = 63          # the text hash without its sign

# An outline is a list of (first hash, bits of the range, bytes, number of groups, largest group), in hash order.


def _outline(groups: DataFrame, bits: int) -> list[tuple[int, int, int, int, int]]:
    """Sums of the 2^bits-wide ranges that hold groups."""
    rows = (groups.groupBy(F.shiftright("h", bits).alias("r"))
            .agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n"), F.max("bytes").alias("m")).collect())
    return sorted((r.r << bits, bits, r.b, r.n, r.m) for r in rows)


def _fill(ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """Positions after which shards end when each takes what fits; None if the shards don't suffice."""
    cuts, base = [], 0
    for _ in range(shards):
        at = bisect_right(ends, base + capacity)
        cuts.append(at)
        if at == len(ends):
            return cuts
        base = ends[at - 1] if at else 0
    return None


def _smallest(ends: list[int], shards: int, least: int, most: int) -> int:
    while least < most:
        middle = (least + most) // 2
        if _fill(ends, middle, shards) is not None:
            most = middle
        else:
            least = middle + 1
    return least


def cut_hashes(groups: DataFrame, shards: int) -> list[int]:
    """The first hash of every shard but the first, of groups (h, bytes)."""
    outline = _outline(groups, HASH_BITS - OUTLINE_BITS)
    if not outline or shards < 2:
        return []
    total, largest = sum(x[2] for x in outline), max(x[4] for x in outline)
    least = max(largest, -(-total // shards))
    while True:
        ends = list(accumulate(x[2] for x in outline))
        most = _smallest(ends, shards, least, total)        # feasible with ranges kept whole, so feasible
        # Where the i-th cut can lie: not before a fill with the least capacity that loses up to one range at each
        # step, not after i times the capacity that is known to suffice.
        low, open_at = 0, set()
        for i in range(1, shards):
            at = bisect_right(ends, low + least)
            low = ends[at - 1] if at else 0
            last = bisect_right(ends, i * most)
            open_at.update(j for j in range(at, min(last + 1, len(outline))) if outline[j][3] > 1 and outline[j][1] > 0)
        if not open_at:
            break
        opened = [(outline[j][0] >> outline[j][1], outline[j][1]) for j in sorted(open_at)]
        by_bits: dict[int, list[int]] = {}
        for key, bits in opened:
            by_bits.setdefault(bits, []).append(key)
        finer = []
        for bits, keys in by_bits.items():
            spark = groups.sparkSession
            wanted = spark.createDataFrame([(k,) for k in keys], "k long")
            inside = groups.join(F.broadcast(wanted), F.shiftright("h", bits) == F.col("k"), "left_semi")
            finer += _outline(inside, max(0, bits - OPEN_BITS))
        outline = sorted([x for j, x in enumerate(outline) if j not in open_at] + finer)
    capacity = _smallest(ends, shards, least, most)
    cuts = [at for at in _fill(ends, capacity, shards) if at < len(outline)]
    return [outline[at][0] for at in cuts]


def _heavy(groups: DataFrame, shards: int) -> list[int]:
    """Hashes of groups above the mean size of the shards left for the rest; each gets a shard of its own."""
    total = groups.agg(F.sum("bytes").alias("t")).first().t or 0
    heavy = []
    for r in groups.orderBy(F.desc("bytes"), "h").limit(shards).collect():
        if len(heavy) < shards - 1 and r.bytes * (shards - len(heavy)) > total:
            heavy.append(r.h)
            total -= r.bytes
    return heavy


def shard(docs: DataFrame, shards: int = 24, overhead: int = 8, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): every row once, rows of equal text in one shard.

    Size is the text's UTF-8 bytes plus ``overhead``. A group larger than the mean shard would empty the shards
    after it, so such groups (fewer than ``shards``) take the first shards alone, largest first; the rest is cut at
    the smallest feasible capacity. Slots count each shard's rows from 0, by bucket of the id's hash and id.

    Null text has no bytes, is a group of its own and has crc 0; a null id is numbered like any other; repeated rows
    get a slot each; an empty table gives no rows; with fewer groups than shards, some shards stay empty. Other
    columns are not read. Texts whose 63-bit hashes agree count as one group, which keeps every promise.
    """
    text = F.col(text_col)
    sized = settle(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(overhead)).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(text).bitwiseAND(F.lit((1 << HASH_BITS) - 1)).alias("h")), "shard-sizes")
    groups = settle(sized.groupBy("h").agg(F.sum("size").alias("bytes")), "shard-groups")
    heavy = _heavy(groups, shards)
    cuts = cut_hashes(groups.where(~F.col("h").isin(heavy)) if heavy else groups, shards - len(heavy))
    number = F.lit(len(heavy))
    for first in cuts:
        number = number + (F.col("h") >= F.lit(first)).cast("int")
    for i, h in reversed(list(enumerate(heavy))):
        number = F.when(F.col("h") == F.lit(h), F.lit(i)).otherwise(number)
    placed = sized.select("doc_id", "size", "text_crc32", number.cast("int").alias("shard"),
                          F.pmod(F.xxhash64("doc_id"), F.lit(SLOT_BUCKETS)).alias("part"))
    parts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    upto = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("shard", "part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    inside = W.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("at", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(parts), ["shard", "part"]).select(       # at most shards x SLOT_BUCKETS rows
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("at")).alias("slot"))
