"""Total order and forward fill without pulling the data into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.store import settle

RANGE_ROWS = 2_000_000     # of a range, at most about
_LOCAL_BITS = 33    # monotonically_increasing_id: partition number above, row number below


def dense_ids(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """1, 2, 3, ... in `order` over the whole table.

    Rows are range-partitioned and sorted in parallel; each partition then only needs the number of rows
    before it, one small row per partition. The place in the settled input is the last key: it keeps copies of
    one row from filling a single range, and stays the same when a lost task is run again. The ranges are
    written down too, so a lost executor cannot renumber rows already counted.
    """
    given = settle(df, "unordered")
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = max(least, -(-given.count() // RANGE_ROWS))
    ranged = settle(given.withColumn("_spread", F.hash(F.monotonically_increasing_id()))
                    .repartitionByRange(width, *order, "_spread")
                    .sortWithinPartitions(*order, "_spread")
                    .withColumn("_id", F.monotonically_increasing_id())
                    .drop("_spread"), "ranged")
    slot = F.shiftright("_id", _LOCAL_BITS)
    numbered = ranged.withColumn("_slot", slot).withColumn(
        "_local", F.col("_id") - F.shiftleft(slot, _LOCAL_BITS))
    sizes = numbered.groupBy("_slot").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    offsets = sizes.select("_slot", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (numbered.join(F.broadcast(offsets), "_slot")
            .withColumn(name, F.col("_offset") + F.col("_local") + 1)
            .drop("_id", "_slot", "_local", "_offset"))


def forward_fill(df: DataFrame, group: list[str], chunk: str, order: list[str], fill: list[str]) -> DataFrame:
    """Carry the last non-null value of `fill` forward inside each group, in (chunk, order) order.

    A group may be one huge file: each chunk is filled on its own, and only one row per chunk (its last
    values) is passed on to the chunks after it.
    """
    inside = (Window.partitionBy(*group, chunk).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = df
    for c in fill:
        filled = filled.withColumn(c, F.last(c, ignorenulls=True).over(inside))
    place = F.struct(*order)
    tails = df.groupBy(*group, chunk).agg(
        *[F.max(F.when(F.col(c).isNotNull(), F.struct(place.alias("at"), F.col(c).alias("value"))))["value"].alias(c)
          for c in fill])
    across = Window.partitionBy(*group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(*group, chunk,
                           *[F.last(c, ignorenulls=True).over(across).alias(f"_from_{c}") for c in fill])
    out = filled.join(carried, [*group, chunk], "left")
    for c in fill:
        out = out.withColumn(c, F.coalesce(c, f"_from_{c}")).drop(f"_from_{c}")
    return out
