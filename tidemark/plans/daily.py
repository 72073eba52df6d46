"""Facts and signals of new days, worked out from the last rows of each symbol instead of its whole history."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.windows import by_date, top_per
from tidemark.params import SurveillanceParams
from tidemark.plans import facts, signals
from tidemark.sources import store
from tidemark.sources.store import settle

LONGEST_BASELINE = 24       # rows before a row that its own measures look at
PRICES = ["trade_date", "symbol", "series", "open", "high", "low", "close", "prev_close", "vwap", "volume", "raw_close",
          "raw_volume", "adj_factor", "turnover_lacs", "num_trades", "deliv_qty", "deliv_pct"]


class Day(NamedTuple):
    fact: DataFrame         # facts of the new days
    measures: DataFrame     # what the rules look at on the new days, for ``signals.flagged``
    state: DataFrame        # what the next days need


def state_of(fact: DataFrame, measures: DataFrame, p: SurveillanceParams = SurveillanceParams()) -> DataFrame:
    """The newest rows of every symbol with their circuit streaks: all that later days need of a history.

    A row looks back ``LONGEST_BASELINE`` rows, and at the pumps of the ``p.dump_lookback_days`` rows before it, each of
    which looks back as far. Counts that reach further (days of history, streaks) go on from the oldest row kept.
    """
    newest = top_per(fact, ["symbol"], LONGEST_BASELINE + p.dump_lookback_days, F.col("trade_date").desc())
    return newest.join(measures.select("symbol", "trade_date", "circuit_streak"), ["symbol", "trade_date"], "left")


def advance(state: DataFrame, prices: DataFrame, stocks: DataFrame, p: SurveillanceParams = SurveillanceParams()) -> Day:
    """The days of ``prices`` (staged, whole days) that are newer than all of the state; others are left out.

    Equal to the full build as long as prices of earlier days stay as they were; a new split or bonus changes them,
    after which history is built anew. Reads the state and the new days only: a bounded number of rows per symbol. An
    empty state starts with the first of the new days.
    """
    newest = state.agg(F.max("trade_date").alias("_until"))
    new = settle(prices.select(*PRICES).join(F.broadcast(newest)).where(
        F.col("_until").isNull() | (F.col("trade_date") > F.col("_until"))).drop("_until"), "new-days")
    before = state.groupBy("symbol").agg(F.min("history_days").alias("_first_day"),
                                         F.min_by("circuit_streak", "trade_date").alias("_streak_before"))
    days = F.broadcast(new.select("trade_date").distinct())

    built = facts.stock_daily(state.select(*PRICES).unionByName(new), stocks).join(days, "trade_date", "left_semi")
    earlier = F.coalesce(F.col("_first_day") - 1, F.lit(0))
    columns = built.columns
    fact = settle(built.join(before.select("symbol", "_first_day"), "symbol", "left")
                  .withColumn("history_days", F.col("history_days") + earlier).select(*columns), "new-facts")

    both = state.drop("circuit_streak").unionByName(fact).withColumn(
        "_place", F.row_number().over(by_date("symbol", date="trade_date")))
    judged = signals.measured(both, stocks, p).join(days, "trade_date", "left_semi")
    unbroken = F.col("circuit_streak") == F.col("_place")           # hit on every row kept, so it may have begun before
    carried = F.when(unbroken, F.coalesce(F.col("_streak_before") - 1, F.lit(0))).otherwise(0)
    columns = [c for c in judged.columns if c != "_place"]
    measures = settle(judged.join(before.select("symbol", "_streak_before"), "symbol", "left")
                      .withColumn("circuit_streak", F.col("circuit_streak") + carried).select(*columns), "new-measures")

    streaks = measures.select("symbol", "trade_date", "circuit_streak")
    known = state.unionByName(fact.join(streaks, ["symbol", "trade_date"], "left"))
    kept = top_per(known, ["symbol"], LONGEST_BASELINE + p.dump_lookback_days, F.col("trade_date").desc())
    return Day(fact, measures, kept)


def take(prices: DataFrame, stocks: DataFrame, path: str, p: SurveillanceParams = SurveillanceParams()) -> None:
    """Add the new days of ``prices`` to the facts and signals stored at ``path``, by months.

    Facts and signals are upserted before the state moves on, so a broken run is simply repeated, and days taken before
    change nothing. Where nothing is stored, this is the full build.
    """
    spark = prices.sparkSession
    state = store.read_table(spark, f"{path}/state")
    if state is None:
        fact = settle(facts.stock_daily(prices, stocks), "new-facts")
        measures = settle(signals.measured(fact, stocks, p), "new-measures")
        day = Day(fact, measures, state_of(fact, measures, p))
    else:
        day = advance(state, prices, stocks, p)
    for name, table in (("facts", day.fact), ("signals", signals.flagged(day.measures, p))):
        dated = table.withColumn("month", F.trunc("trade_date", "month"))
        store.upsert(dated, f"{path}/{name}", ["symbol", "trade_date", "month"], "month")
    store.rebuild(day.state, f"{path}/state")


def stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The ``facts`` or ``signals`` stored at ``path``."""
    return store.read_table(spark, f"{path}/{name}").drop("month")
