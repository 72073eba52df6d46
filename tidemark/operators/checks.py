"""Table tests: each returns the offending rows, so an empty result is a pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def outside(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """Values that are not in the list; null is not judged here."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed)).groupBy(column).agg(
        F.count("*").alias("n"))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def breaking(df: DataFrame, must_hold: Column) -> DataFrame:
    """Rows for which the condition is false; an unknown (null) outcome passes."""
    return df.filter(~must_hold)


def short_days(df: DataFrame, date: str, at_least: int) -> DataFrame:
    return df.groupBy(date).agg(F.count("*").alias("stocks")).filter(F.col("stocks") < at_least)
