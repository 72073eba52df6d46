"""The type-2 history of instruments kept up to date snapshot by snapshot, without building it anew."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.plans.reference import TRACKED, stock_versions
from tidemark.sources import store

OPEN = dt.date(9999, 12, 1)         # the partition of open versions; closed ones lie by the month in which they closed
ATTRIBUTES = ["company_name", "isin", "series", "face_value", "listing_date", "industry", "in_nifty500"]


def look() -> Column:
    """A hash of the tracked columns."""
    return F.sha2(F.to_json(F.struct(*TRACKED), {"ignoreNullFields": "false"}), 256)


def _stored(versions: DataFrame) -> DataFrame:
    part = F.coalesce(F.trunc("closed_on", "month"), F.lit(OPEN))
    return versions.select("symbol", *ATTRIBUTES, "opened_on", "closed_on", "version_no", look().alias("look"), part.alias("part"))


def merge_snapshots(snapshots: DataFrame, path: str) -> None:
    """Merge one or more whole snapshots, all later than those merged before, into the versions stored at ``path``.

    Of the stored versions only the hashes of open ones are read for symbols that look the same in every new snapshot.
    The others are played on from their open version; symbols that are new or back go on from their last number, which
    is looked up among the closed versions of those symbols alone. Snapshots merged before are skipped, so a run can be
    repeated, whether it broke off or not. Rows are unique by snapshot and symbol.
    """
    spark = snapshots.sparkSession
    taken = store.read_table(spark, f"{path}_taken")
    last = taken.agg(F.max("snapshot_date")).first()[0] if taken is not None else None
    batch = snapshots if last is None else snapshots.where(F.col("snapshot_date") > F.lit(last))
    batch = store.settle(batch.withColumn("industry", F.coalesce("industry", F.lit(fixed.UNCLASSIFIED))), "snapshots")
    days = batch.select("snapshot_date").distinct()
    count = days.count()
    if not count:
        return
    before = store.read_table(spark, path) if last is not None else None
    if before is None:
        store.upsert(_stored(stock_versions(batch)), path, ["symbol", "version_no"], "part")
    else:
        current = before.where(F.col("part") == F.lit(OPEN))
        seen = batch.withColumn("now", look()).groupBy("symbol").agg(
            F.count(F.lit(1)).alias("n"), F.min("now").alias("least"), F.max("now").alias("most"))
        steady = current.select("symbol", "look").join(seen, "symbol").where(
            (F.col("n") == count) & (F.col("least") == F.col("look")) & (F.col("most") == F.col("look"))).select("symbol")
        moving = store.settle(current.join(steady, "symbol", "left_anti"), "open-versions")
        seeds = moving.select(F.lit(last).alias("snapshot_date"), "symbol", *ATTRIBUTES)
        played = stock_versions(seeds.unionByName(batch.join(steady, "symbol", "left_anti").select(*seeds.columns)),
                                days.unionAll(spark.createDataFrame([(last,)], days.schema)))
        closed = before.where(F.col("part") != F.lit(OPEN)).select("symbol", "version_no")
        fresh = batch.select("symbol").distinct().join(current.select("symbol"), "symbol", "left_anti")
        numbers = closed.join(fresh, "symbol", "left_semi").groupBy("symbol").agg(F.max("version_no").alias("had"))
        going = moving.select("symbol", F.col("opened_on").alias("since"), F.col("version_no").alias("number"))
        first = (F.col("version_no") == 1) & F.col("number").isNotNull()
        result = played.join(going, "symbol", "left").join(numbers, "symbol", "left").select(
            "symbol", *ATTRIBUTES, F.when(first, F.col("since")).otherwise(F.col("opened_on")).alias("opened_on"), "closed_on",
            (F.col("version_no") + F.coalesce(F.col("number") - 1, F.col("had"), F.lit(0))).cast("int").alias("version_no"))
        store.upsert(_stored(result), path, ["symbol", "version_no"], "part")
    store.append(days, f"{path}_taken")


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The stored history, as ``stock_versions`` gives it."""
    return store.read_table(spark, path).select("symbol", *ATTRIBUTES, "opened_on", "closed_on", "version_no")
