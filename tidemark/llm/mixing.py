"""Mixing sources to target weights with hash-threshold histograms.

Every document has a fixed hash. A source's budget is a threshold on that hash: documents below it are taken. The
threshold is found without a sort: sizes are summed by source and hash bucket, the bucket in which the budget ends is
split by the next bits of the hash, and only its documents are read again. A larger budget has a higher threshold, so
mixes of growing budgets are nested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.text import word_count
from tidemark.sources.store import settle

HASH_BITS = 60          # fifteen hexadecimal digits of an md5 sum


def id_hash(column: str):
    """A fixed number in [0, 2^60) for an id; a null id counts as the empty string."""
    digits = F.substring(F.md5(F.coalesce(F.col(column).cast("string"), F.lit(""))), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """(source, source_size, target): one row per source, targets water-filled under their caps.

    Sources in code point order, null last, take the weights in turn. All sizes together are shared by weight; a
    target stops at ``max_repeats`` times its source's size and what is above is shared again. The fixed point has
    one level: with the sources ordered by cap per weight, a source is capped exactly when the level that the
    sources from it on would share reaches its cap. The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    wide = "decimal(38,0)"
    per = per.select("source", "source_size", weight.cast("long").alias("weight"),
                     (F.col("source_size") * max_repeats).alias("cap"))
    by_level = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_level.rowsBetween(W.unboundedPreceding, -1), by_level.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    per = per.select(
        "*", F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.sum("weight").over(after).alias("weight_left"))
    reached = (F.col("cap").cast(wide) * F.col("weight_left").cast("decimal(18,0)")
               <= (F.col("total") - F.col("cap_before")).cast(wide) * F.col("weight").cast("decimal(18,0)"))
    per = per.withColumn("capped", reached)
    per = per.select(
        "*", F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything).alias("cap_sum"),
        F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything).alias("free_weight"))
    shared = F.col("weight").cast("double") * (F.col("total") - F.col("cap_sum")).cast("double")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        shared / F.col("free_weight").cast("double"))
    return per.select("source", "source_size", target.alias("target"))


def _level(rows: DataFrame, budgets: DataFrame, shift: int) -> DataFrame:
    """The bucket in which each source's budget ends, and what of the budget is left at its start.

    ``rows`` (source, size, h) lie in the source's current bucket, ``budgets`` has (source, left). Sources whose rows
    all fit are missing from the result.
    """
    buckets = rows.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(W.partitionBy("source").orderBy("bucket"))
    buckets = buckets.withColumn("upto", upto)
    b = budgets.select(F.col("source").alias("b_source"), "left")
    over = buckets.join(b, F.col("source").eqNullSafe(F.col("b_source"))).where(F.col("upto") > F.col("left"))
    first = over.groupBy("source").agg(F.min(F.struct("bucket", "upto", "size", "left")).alias("m"))
    return first.select("source", F.col("m.bucket").alias("bucket"),
                        (F.col("m.left") - (F.col("m.upto") - F.col("m.size"))).alias("left"),
                        F.col("m.size").alias("bucket_size"))


def hash_thresholds(sizes: DataFrame, budgets: DataFrame, bits: int = 12) -> DataFrame:
    """(source, threshold): rows of the source with h < threshold sum to the budget, within half a row's size.

    A source that is missing fits its budget whole. At each level only the documents of the boundary buckets are
    kept, about one in 2^bits. Rows of equal hash go together.
    """
    rows, shift, ends = sizes, HASH_BITS - bits, None
    while True:
        ends = settle(_level(rows, budgets, shift), "mix-ends")
        if shift == 0:
            break
        e = ends.select(F.col("source").alias("e_source"), "bucket")
        inside = (F.col("source").eqNullSafe(F.col("e_source"))) & (F.shiftright("h", shift) == F.col("bucket"))
        rows = settle(rows.join(e, inside).select("source", "size", "h"), "mix-rows")
        budgets, shift = ends.select("source", "left"), max(0, shift - bits)
    # the last bucket is one hash value: take it if that comes nearer to the budget than leaving it
    nearer = F.col("bucket_size") - F.col("left") < F.col("left")
    return ends.select("source", (F.col("bucket") + nearer.cast("long")).alias("threshold"))


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return settle(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                              word_count(F.col(text_col)).alias("size"), id_hash(id_col).alias("h")), "mix-sizes")


def source_plan(sizes: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """(t_source, source_size, target, passes, threshold): whole passes over a source and where the last one ends."""
    targets = source_targets(sizes.select("source", "size"), weights, max_repeats)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = settle(targets.withColumn("passes", passes.cast("long")), "mix-targets")
    left = F.col("target") - F.col("passes") * F.col("source_size")
    budgets = targets.where(F.col("passes") < max_repeats).select("source", left.alias("left"))
    partial = sizes.join(budgets.select(F.col("source").alias("b_source")),
                         F.col("source").eqNullSafe(F.col("b_source")), "left_semi")
    cuts = hash_thresholds(partial.select("source", "size", "h"), budgets)
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target", "passes")
    c = cuts.select(F.col("source").alias("c_source"), "threshold")
    return t.join(c, F.col("t_source").eqNullSafe(F.col("c_source")), "left").drop("c_source")


def _repeats(h, max_repeats: int):
    once_more = (F.col("passes") < max_repeats) & F.coalesce(h < F.col("threshold"), F.lit(True))
    return F.col("passes") + once_more.cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """(doc_id, size, source_size, target, taken): how many words the mix takes of each document.

    ``taken`` is size times the whole passes over the source that its target holds, plus size once more for
    documents under the source's threshold: sources are repeated or cut, never sorted.

    Null or empty text has size 0 and taken 0; null sources form one source, placed last; a null id hashes as the
    empty string; rows with equal ids have equal hashes and are taken together; a source without words has target 0;
    an empty table gives no rows. Other columns are not read.
    """
    sizes = _sizes(docs, id_col, text_col, source_col)
    plan = source_plan(sizes, weights, max_repeats)
    joined = sizes.join(plan, F.col("source").eqNullSafe(F.col("t_source")))
    return joined.select("doc_id", "size", "source_size", "target",
                         (F.col("size") * _repeats(F.col("h"), max_repeats)).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it, with all its columns."""
    sizes = _sizes(docs, id_col, text_col, source_col)
    plan = source_plan(sizes, weights, max_repeats).select("t_source", "passes", "threshold")
    # the columns travel in a struct, so none of them can clash with those of the plan
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("packed"),
                         F.col(source_col).alias("p_source"), id_hash(id_col).alias("p_hash"))
    joined = packed.join(plan, F.col("p_source").eqNullSafe(F.col("t_source")))
    times = F.array_repeat(F.col("packed"), _repeats(F.col("p_hash"), max_repeats).cast("int"))
    return joined.select(F.explode(times).alias("packed")).select("packed.*")
