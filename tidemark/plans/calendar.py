"""Trading calendar: weekdays that are not holidays."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import so_far


def expected_days(holidays: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    spine = holidays.sparkSession.range(1).select(F.explode(F.sequence(
        F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("trade_date"))
    closed = holidays.select(F.col("holiday").alias("trade_date")).distinct()
    return spine.filter(F.weekday("trade_date") < 5).join(closed, "trade_date", "left_anti")


def calendar(holidays: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Every day: is it a trading day, why not, which was the trading day before it, and how many so far."""
    spine = holidays.sparkSession.range(1).select(F.explode(F.sequence(
        F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("day"))
    closed = holidays.groupBy(F.col("holiday").alias("day")).agg(F.max("description").alias("description"))
    weekday = F.weekday("day") < 5
    days = spine.join(closed, "day", "left").withColumn("is_trading_day", weekday & F.col("description").isNull())
    w = Window.orderBy("day")    # one row per calendar day
    open_day = F.when(F.col("is_trading_day"), F.col("day"))
    return days.select(
        "day", "is_trading_day",
        F.when(~F.col("is_trading_day"), F.coalesce("description", F.lit("weekend"))).alias("closed_for"),
        F.max(open_day).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("previous_trading_day"),
        F.count(open_day).over(so_far(w)).alias("trading_days_so_far"))


def is_trading_day(holidays: DataFrame, day: dt.date) -> bool:
    return expected_days(holidays, day, day).count() == 1


def previous_trading_day(holidays: DataFrame, day: dt.date) -> dt.date:
    """The last trading day before `day`, however long the market was closed: the span searched grows until it is found."""
    span, last = 16, None
    while last is None:
        span *= 4
        earlier = expected_days(holidays, day - dt.timedelta(days=span), day - dt.timedelta(days=1))
        last = earlier.agg(F.max("trade_date")).first()[0]
    return last
