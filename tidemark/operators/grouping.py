"""Aggregates that stay exact and even when one group holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counted(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Rows per (key, value): combined before the shuffle, and spread over the values of a hot key.

    Null values are counted too, so that a key without any value is still there; medians pass over them.
    """
    return df.groupBy(*keys, value.alias("_value")).agg(F.count("*").alias("_n"))


def median_of_counts(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Exact median from (key, value, count): a group weighs as much as it has distinct values."""
    return counts.groupBy(*keys).agg(F.expr("percentile(_value, 0.5, _n)").alias(name))


def median(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    return median_of_counts(counted(df, keys, value), keys, name)


def most_common(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The most frequent value per key, the smaller one on a tie; never a whole group in one buffer."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    best = F.max(F.struct(F.col("_n"), (-F.col(value)).alias("_v")))
    return counts.groupBy(*keys).agg(best.alias("_best")).select(*keys, (-F.col("_best._v")).alias(name))
