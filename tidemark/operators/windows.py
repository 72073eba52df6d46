"""Ordered-row helpers.

A window here is partitioned by an instrument and ordered by its date, and (instrument, date) is
unique by then: the longest partition is one instrument's calendar, whatever the size of the raw data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.cleaning import ratio


def by_date(*keys: str, date: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(date)


def rows(w: WindowSpec, first: int, last: int) -> WindowSpec:
    """Rows `first`..`last` relative to the current one; negative is earlier."""
    return w.rowsBetween(first, last)


def so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def zscore(value: Column, w: WindowSpec) -> Column:
    return ratio(value - F.avg(value).over(w), F.stddev_samp(value).over(w))


def with_streak(df: DataFrame, hit: Column, w: WindowSpec, name: str) -> DataFrame:
    """Consecutive hits up to each row; null counts as a break.

    It is the row's position minus the position of the last miss, so one sort serves both steps.
    """
    missed = ~F.coalesce(hit, F.lit(False))
    return (df.withColumn("_position", F.row_number().over(w))
            .withColumn("_missed_at", F.when(missed, F.col("_position")))
            .withColumn(name, (F.col("_position") - F.coalesce(F.max("_missed_at").over(so_far(w)), F.lit(0)))
                        .cast("long"))
            .drop("_position", "_missed_at"))


def any_before(hit: Column, w: WindowSpec, n: int) -> Column:
    """Was it hit in the n rows before this one? Null on the first row, as there is nothing before it."""
    return F.max(F.when(hit, 1).otherwise(0)).over(rows(w, -n, -1)) == 1


def drawdown(value: Column, w: WindowSpec) -> Column:
    """Distance below the running peak, 0 at a new peak."""
    return value / F.max(value).over(so_far(w)) - 1


def first_per(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The best row per key. Spark limits each group before the shuffle, so copies of one key stay cheap."""
    return top_per(df, keys, 1, *order)


def top_per(df: DataFrame, keys: list[str], n: int, *order: Column, rank: str | None = None) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    name = rank or "_place_in_group"
    ranked = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)
