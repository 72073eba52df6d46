"""As-of, fixed-horizon and interval joins without pair blow-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_date: str, right_date: str,
              take: dict[str, str], how: str = "left", tolerance_days: int | None = None) -> DataFrame:
    """Give each left row the right row of the same key with the latest date on or before its own.

    `take` maps right columns to output names; (on, right_date) is unique on the right. Left rows are
    first reduced to distinct (key, date) probes, so the ordered pass per key is bounded by its calendar
    however many left rows share a key; the match then returns by an equality join that AQE can split.
    The tolerance is tested on the match found: an older one counts as none.
    """
    hit = F.struct(F.col(right_date).alias("_at"), *[F.col(c).alias(c) for c in take])
    known = right.select(*on, F.col(right_date).alias("_day"), hit.alias("_hit"), F.lit(0).alias("_side"))
    probes = (left.select(*on, F.col(left_date).alias("_day")).distinct()
              .withColumn("_hit", F.lit(None).cast(known.schema["_hit"].dataType))
              .withColumn("_side", F.lit(1)))
    w = (Window.partitionBy(*on).orderBy("_day", "_side")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = (known.unionByName(probes)
             .withColumn("_hit", F.last("_hit", ignorenulls=True).over(w))
             .filter((F.col("_side") == 1) & F.col("_hit").isNotNull()))
    if tolerance_days is not None:
        found = found.filter(F.date_diff("_day", "_hit._at") <= tolerance_days)
    found = found.select(*on, F.col("_day").alias(left_date),
                         *[F.col(f"_hit.{c}").alias(name) for c, name in take.items()])
    return left.join(found, [*on, left_date], how)


def forward_product(df: DataFrame, factors: DataFrame, on: list[str], date: str, factor_date: str,
                    factor: str, name: str) -> DataFrame:
    """Product of the factors dated strictly after each row, 1 when there are none.

    The factors, few per key, become intervals with the product of all from their end on; a row lies in one interval
    at most, so it is joined as it is, neither shuffled nor sorted where the factors are small enough to broadcast.
    """
    per_day = factors.groupBy(*on, factor_date).agg(F.sum(F.log(factor)).alias("_log"))
    w = Window.partitionBy(*on).orderBy(F.col(factor_date).desc())
    intervals = per_day.select(
        *[F.col(k).alias(f"_on_{k}") for k in on], F.col(factor_date).alias("_end"),
        F.lead(factor_date).over(w).alias("_start"),
        F.exp(F.sum("_log").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).alias("_product"))
    inside = (df[date] < F.col("_end")) & (F.col("_start").isNull() | (df[date] >= F.col("_start")))
    for k in on:
        inside = (df[k] == F.col(f"_on_{k}")) & inside
    return df.join(intervals, inside, "left").select(*df.columns, F.coalesce("_product", F.lit(1.0)).alias(name))


def spread_days(df: DataFrame, date: str, name: str, days: int) -> DataFrame:
    """Repeat each row for its own day and the `days` after it: an interval join becomes an equality join."""
    return df.withColumn(name, F.explode(F.sequence(F.col(date), F.date_add(date, days), F.expr("interval 1 day"))))


def between_join(left: DataFrame, right: DataFrame, on: list[str], date: str, start: str, end: str,
                 how: str = "left") -> DataFrame:
    """Equality on `on` and start <= date < end; the right intervals of a key do not overlap."""
    same: Column = (left[date] >= right[start]) & (left[date] < right[end])
    for key in on:
        same = (left[key] == right[key]) & same
    return left.join(right, same, how)
