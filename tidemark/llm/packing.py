"""Best-fit packing of token sequences into sequences of a fixed length, in bulk-synchronous rounds.

Pieces longer than half a sequence open one each, as no two of them fit together. The others go in by classes of
length, from long to short. A round offers the slots of open sequences: with room ``g`` and a longest waiting piece of
``most`` there are ``g // most`` slots that take any piece, and one of the size that is left. Pieces and slots are
range-sorted by size, longest first; from there best fit is a sweep in which a piece takes the slot that came last and
is still free, the smallest one that holds it. Each range is swept by itself. What it leaves over, pieces before slots,
has a height in the stack of free slots that follows from the numbers left over by the ranges before it, one row per
range; a piece and a slot in conflict for a height are told apart by their ranges' ranks. Then rooms are updated, and
the pieces left over go to the next round, for which as many sequences are opened as their total length needs. The
last round of a class opens as many as there are pieces to place, so the number of rounds is fixed.

Everything per piece is shuffled by size or by sequence; sequences have at most ``capacity`` pieces, lengths at most
``capacity`` values, and only sums by length and by range reach the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.encoding import encoded
from tidemark.sources.store import settle

RANGE_ROWS = 1_000_000      # of a range, at most about
ROUNDS = 3                  # per class of lengths
STEP = 2                    # a class reaches from its longest length down to that divided by this
FINEST = 64                 # the class of this length reaches down to 1
NEW = 1 << 62               # numbers of sequences opened without a piece begin here


def cut_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
                  text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, doc_id, piece, start, length, ids_crc32): the token ids of every text and ``end_id``, cut only where they
    are longer than ``capacity``; ``id`` numbers the pieces, and ``with_ids`` adds the ids, little-endian in 32 bits.

    Null and empty texts are the end id alone; null and repeated document ids are rows like any other.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, ids, bounds in encoded(batch.column(1), path):
                rows, pieces, starts, sizes, sums, kept = [], [], [], [], [], []
                for row in range(hi - lo):
                    own = np.empty(bounds[row + 1] - bounds[row] + 1, dtype="<u4")
                    own[:-1], own[-1] = ids[bounds[row]:bounds[row + 1]], end_id
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        part = own[start:start + capacity].tobytes()
                        rows.append(lo + row)
                        pieces.append(piece)
                        starts.append(start)
                        sizes.append(len(part) // 4)
                        sums.append(zlib.crc32(part))
                        kept.append(part)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())] + ([pa.array(kept, pa.binary())] if with_ids else []),
                    ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return source.mapInArrow(cut, fields).withColumn("id", F.monotonically_increasing_id())


def sweep(kinds: np.ndarray, refs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of slots (kind 0) and pieces (kind 1) in order: the place of the slot that each piece takes, the last one that
    is free, or -1; and the places of what is left over, which are pieces first, then slots.
    """
    steps = np.where(kinds == 0, 1, -1)
    height = np.cumsum(steps)
    height -= np.minimum(np.minimum.accumulate(height), 0)       # pieces that find the stack empty don't lower it
    level = np.where(kinds == 0, height, height + 1)
    before = np.concatenate([[0], height[:-1]])
    free = (kinds == 1) & (before == 0)                          # finds nothing
    takes = np.full(len(kinds), -1, dtype=np.int64)
    paired = np.zeros(len(kinds), dtype=bool)
    rest = np.flatnonzero(~free)
    order = rest[np.argsort(level[rest], kind="stable")]         # at one level slots and pieces take turns
    pieces = np.flatnonzero(kinds[order] == 1)
    takes[order[pieces]] = order[pieces - 1]
    paired[order[pieces]] = paired[order[pieces - 1]] = True
    return takes, np.flatnonzero(~paired)


def _matched(pieces: DataFrame, slots: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """(placed (id, length, sequence), left over (id, length)) of pieces (id, length) and slots (sequence, size, room).

    ``rows`` is about how many there are of both.
    """
    spark = pieces.sparkSession
    events = slots.select(F.col("size"), F.lit(0).alias("kind"), F.col("room"), F.col("sequence").alias("ref")).unionByName(
        pieces.select(F.col("length").alias("size"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("room"), F.col("id").alias("ref")))
    keys = [F.col("size").desc(), F.col("kind"), F.col("room").desc(), F.hash("ref"), F.col("ref")]
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // RANGE_ROWS))
    ordered = events.repartitionByRange(width, *keys).sortWithinPartitions(*keys).select(
        F.spark_partition_id().alias("range"), "kind", "ref", "size")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)                                     # one range
        if not held:
            return
        table = pa.Table.from_batches(held)
        kinds, refs, sizes = (table.column(c).to_numpy() for c in ("kind", "ref", "size"))
        takes, over = sweep(kinds, refs, sizes)
        found = np.flatnonzero(takes >= 0)
        at = np.concatenate([found, over])
        sequence = np.concatenate([refs[takes[found]], np.zeros(len(over), dtype=np.int64)])
        is_piece = kinds[over] == 1
        place = np.concatenate([np.zeros(len(found), dtype=np.int64), np.where(is_piece, np.cumsum(is_piece), np.cumsum(~is_piece))])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), table.column("range")[0].as_py()), pa.int32()), pa.array(kinds[at], pa.int32()), pa.array(refs[at]),
             pa.array(sizes[at]), pa.array(sequence, mask=np.arange(len(at)) >= len(found)), pa.array(place)],
            ["range", "kind", "ref", "size", "sequence", "place"])

    swept = settle(ordered.mapInArrow(match, "range int, kind int, ref long, size long, sequence long, place long"), "packing-swept")
    over = swept.where(F.col("sequence").isNull())
    sums = sorted(over.groupBy("range").agg(F.sum(F.col("kind").cast("long")).alias("pieces"), F.count(F.lit(1)).alias("rows")).collect())
    heights, height = [], 0                                      # of the stack before each range; one row per range
    for r in sums:
        heights.append((r.range, height, max(0, height - r.pieces)))
        height = max(0, height - r.pieces) + r.rows - r.pieces
    before = F.broadcast(spark.createDataFrame(heights, "at int, height long, base long"))
    level = F.when(F.col("kind") == 1, F.col("height") - F.col("place") + 1).otherwise(F.col("base") + F.col("place"))
    leveled = over.join(before, F.col("range") == F.col("at")).withColumn("level", level)
    turn = W.partitionBy("level").orderBy("range", F.desc("kind"))       # two rows per range at most
    met = settle(leveled.where("level > 0").withColumn("taken", F.lag("ref").over(turn)).where("kind = 1").select(
        F.col("ref").alias("id"), F.col("size").alias("length"), F.col("taken").alias("sequence")), "packing-met")
    placed = swept.where(F.col("sequence").isNotNull()).select(F.col("ref").alias("id"), F.col("size").alias("length"), "sequence")
    left = leveled.where("level <= 0").select(F.col("ref").alias("id"), F.col("size").alias("length"))
    return placed.unionByName(met), left


def _offered(gaps: DataFrame, most: int, least: int, wanted: int) -> tuple[DataFrame, int, int]:
    """(slots, their number, full slots of all gaps): those of the tightest gaps that together have ``wanted`` full
    ones; all, if that is not enough. Slots below ``least`` take nothing and are left out.
    """
    by_room = sorted(gaps.where(F.col("room") >= least).groupBy("room").count().collect())      # at most ``capacity`` rooms
    total, full, rooms = 0, 0, 0
    for r in by_room:
        if full >= wanted:
            break
        full, rooms = full + r.room // most * r["count"], r.room
        total += (r.room // most + (r.room % most >= least)) * r["count"]
    sizes = F.expr(f"concat(array_repeat({most}L, cast(room div {most} as int)), if(room % {most} >= {least}, array(room % {most}), array()))")
    slots = gaps.where((F.col("room") >= least) & (F.col("room") <= rooms)).select("sequence", "room", F.explode(sizes).alias("size"))
    return slots, total, sum(r.room // most * r["count"] for r in by_room)


def pack(items: DataFrame, capacity: int = 2048, id_col: str = "id", length_col: str = "length") -> DataFrame:
    """(id, length, sequence_id, offset) of items with unique long ids and lengths from 1 to ``capacity``: few sequences
    of at most ``capacity``, each filled from offset 0 without gaps, longest item first.

    An empty table gives no rows; other columns are not read.
    """
    spark = items.sparkSession
    items = settle(items.select(F.col(id_col).alias("id"), F.col(length_col).cast("long").alias("length")), "packing-items")
    by_length = {r.length: r["count"] for r in items.groupBy("length").count().collect()}       # ``capacity`` rows at most
    half = capacity // 2
    alone = items.where(F.col("length") > half)
    placed = [alone.select("id", "length", F.col("id").alias("sequence"))]
    gaps = alone.where(F.col("length") < capacity).select(F.col("id").alias("sequence"), (F.lit(capacity) - F.col("length")).alias("room"))
    opened, most = 0, half
    while most:
        least = 1 if most <= FINEST else most // STEP + 1
        lengths = [n for n in by_length if least <= n <= most]
        waiting = items.where(F.col("length").between(least, most))
        count, total, longest = sum(by_length[n] for n in lengths), sum(n * by_length[n] for n in lengths), max(lengths, default=0)
        for turn in range(ROUNDS if count else 0):
            slots, offered, full = _offered(gaps, longest, min(lengths), count)
            if turn or not offered:
                new = -(-max(0, count - full) // (capacity // longest)) if turn == ROUNDS - 1 else -(-total // capacity)
                fresh = spark.range(NEW + opened, NEW + opened + new).select(F.col("id").alias("sequence"), F.lit(capacity).cast("long").alias("room"))
                gaps, opened = gaps.unionByName(fresh), opened + new
                slots, offered, full = _offered(gaps, longest, min(lengths), count)
            done, left = _matched(waiting, slots, count + offered)
            placed.append(done)
            used = done.groupBy(F.col("sequence").alias("s")).agg(F.sum("length").alias("used"))
            gaps = settle(gaps.join(used, F.col("sequence") == F.col("s"), "left").select(
                "sequence", (F.col("room") - F.coalesce("used", F.lit(0))).alias("room")).where("room > 0"), "packing-gaps")
            waiting = left
            sums = left.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("t"), F.max("length").alias("m")).first()
            count, total, longest = sums.n, sums.t, sums.m
            if not count:
                break
        most = least - 1
    everything = placed[0]
    for more in placed[1:]:
        everything = everything.unionByName(more)
    order = W.partitionBy("sequence").orderBy(F.desc("length"), "id")            # ``capacity`` items at most
    upto = F.sum("length").over(order.rowsBetween(W.unboundedPreceding, -1))
    return everything.select("id", "length", F.col("sequence").alias("sequence_id"), F.coalesce(upto, F.lit(0)).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, **columns: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document.

    See ``cut_documents`` and ``pack``.
    """
    pieces = settle(cut_documents(docs, path, capacity, end_id, **columns), "packing-pieces")
    packed = pack(pieces, capacity).select(F.col("id").alias("packed_id"), "sequence_id", "offset")
    return pieces.join(packed, F.col("id") == F.col("packed_id")).drop("id", "packed_id")


def packed_ids(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, **columns: str) -> DataFrame:
    """(sequence_id, n_ids, ids): every packed sequence, its ids little-endian in 32 bits."""
    pieces = settle(cut_documents(docs, path, capacity, end_id, with_ids=True, **columns), "packing-pieces")
    packed = pack(pieces, capacity).select(F.col("id").alias("packed_id"), "sequence_id", "offset")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))              # ``capacity`` ids in all
    return (pieces.join(packed, F.col("id") == F.col("packed_id")).groupBy("sequence_id")
            .agg(F.sum("length").alias("n_ids"), F.aggregate(
                parts, F.lit(b""), lambda all_ids, part: F.concat(all_ids, part["ids"])).alias("ids")))
