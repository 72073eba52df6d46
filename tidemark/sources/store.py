"""Table sinks on plain Parquet, all through Spark's own writers: settle, overwrite, rebuild, upsert, append."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.windows import first_per
from tidemark.session import checkpoint_dir


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several later steps read, and go on from the files.

    The copy lies in the cluster's shared checkpoint folder, so a lost executor costs nothing already
    computed, readers prune its columns, and its size is known when joins are planned.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _newest(spark: SparkSession, path: str) -> int | None:
    """The number of the last rebuild of a table; None for a table that is not kept in versions."""
    files = spark.read.format("binaryFile").load(path).inputFiles()         # names only, nothing is read
    return max((int(found[1]) for f in files if (found := re.search(r"/version=(\d+)/", f))), default=None)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The stored table (of a rebuilt one its newest version), or None when it was never written.

    A table written without rows has no file that tells its schema; with ``schema`` it is read as empty, else as
    never written.
    """
    try:
        version = _newest(spark, path)
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path if version is None else f"{path}/version={version}")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]):
    """Null-safe equality, so rows with a null key part are matched too."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def merged(target: DataFrame, updates: DataFrame, keys: list[str], newest: str | None = None) -> DataFrame:
    """Updates replace target rows of the same keys; all others stay. Applying it twice changes nothing.

    With ``newest`` a row gives way only to one that has at least its value there, so a late batch of old rows
    replaces no newer ones.
    """
    if newest:
        both = target.withColumn("_new", F.lit(False)).unionByName(updates.withColumn("_new", F.lit(True)), allowMissingColumns=True)
        return first_per(both, keys, F.col(newest).desc_nulls_last(), F.col("_new").desc()).drop("_new")
    replaced = updates.select(*[F.col(k) for k in keys]).distinct()
    kept = target.join(replaced, same_keys(target, replaced, keys), "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def _by_partition(df: DataFrame, partition_col: str | None) -> DataFrame:
    """Rows of a partition value together, as few files as their size needs: small values share tasks, large ones are
    split.
    """
    return df.hint("rebalance", F.col(partition_col)) if partition_col else df


def overwrite(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """Write a whole table in place of what lies there."""
    writer = _by_partition(df, partition_col).write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_col:
        writer = writer.partitionBy(partition_col)
    writer.parquet(path)


def rebuild(df: DataFrame, path: str, partition_col: str | None = None) -> None:
    """Write a whole table anew into a folder ``version=n`` of its own, which ``read_table`` takes from then on.

    The version before stays readable until then, so a broken run leaves a whole table; old versions are for the
    folder's retention rule. A table is either always rebuilt or never.
    """
    try:
        version = (_newest(df.sparkSession, path) or 0) + 1
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        version = 1
    overwrite(df, f"{path}/version={version}", partition_col)


def replace_partitions(df: DataFrame, path: str, partition_col: str) -> None:
    """Replace just the partitions present in df: delete-and-insert for one run date."""
    (_by_partition(df, partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


@contextmanager
def unsorted_partitions(spark: SparkSession, most: int) -> Iterator[None]:
    """Within it, writers keep a file open for each of up to ``most`` partition values of a task, instead of sorting all
    its rows by them first: a sort of whole rows spills as soon as they outgrow the task's memory.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def upsert(updates: DataFrame, path: str, keys: list[str], partition_col: str | None = None,
           newest: str | None = None) -> DataFrame:
    """Update matching rows, insert the others. Only the partitions the updates touch are read and rewritten.

    The merge is settled before the table is overwritten: the files being read are never the files being
    written, and a broken run can simply be repeated. The partition values of one batch (its months) are few and are
    listed in the filter, so the scan of the table is pruned when it is planned. Where the partition is no key, a
    row may have moved: the keys of the batch are looked up in the key columns of the table, and the partitions in
    which they lie are rewritten too. Without a partition column the table is rebuilt. ``newest``: see ``merged``.
    """
    spark = updates.sparkSession
    updates = settle(updates, "updates")
    target = read_table(spark, path)
    if target is None:
        (overwrite if partition_col else rebuild)(updates, path, partition_col)
        return read_table(spark, path, updates.schema)
    if partition_col is None:
        rebuild(merged(target, updates, keys, newest), path)
        return read_table(spark, path, updates.schema)
    affected = touched(target, updates, partition_col, keys)
    result = settle(merged(affected, updates, keys, newest), "upsert")
    left = _values(affected, partition_col) - _values(result, partition_col) if partition_col not in keys else ()
    replace_partitions(result, path, partition_col)
    for value in left:                      # partitions all of whose rows have moved
        empty = spark.createDataFrame([], result.drop(partition_col).schema)
        folder = "__HIVE_DEFAULT_PARTITION__" if value is None else value
        empty.coalesce(1).write.mode("overwrite").parquet(f"{path}/{partition_col}={folder}")
    return spark.read.parquet(path)


def _values(df: DataFrame, column: str) -> set:
    """The partition values of one batch: few."""
    return {r[0] for r in df.select(column).distinct().collect()}


def touched(target: DataFrame, updates: DataFrame, partition_col: str, keys: list[str] | None = None) -> DataFrame:
    """The rows of the partitions that the updates have rows in, or had."""
    values = _values(updates, partition_col)
    if keys and partition_col not in keys:
        batch = updates.select(*keys).distinct()
        values |= _values(target.join(batch, same_keys(target, batch, keys), "left_semi"), partition_col)
    column = target[partition_col]
    named = column.isin([v for v in values if v is not None])
    return target.filter(named | column.isNull() if None in values else named)


def save_bucketed(df: DataFrame, table: str, key: str, order: str, buckets: int) -> None:
    """Store pre-hashed and sorted by instrument: per-instrument windows then read without a shuffle."""
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key, order)
     .saveAsTable(table))
