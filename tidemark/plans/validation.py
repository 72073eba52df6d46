"""Do the alerts catch what the exchange itself acted on? Outcomes, lift, lead time, ablation, event study."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.cleaning import rounded
from tidemark.operators.grouping import median
from tidemark.operators.windows import so_far, top_per
from tidemark.params import BASELINES, SurveillanceParams
from tidemark.plans.facts import forward_returns
from tidemark.plans.signals import risk_band, scored_by_baseline
from tidemark.sources.store import settle


def alert_window(alert: DataFrame) -> DataFrame:
    return alert.agg(F.min("trade_date").alias("start_date"), F.max("trade_date").alias("end_date"))


def _band_rank(band: Column) -> Column:
    return F.when(band == "HIGH", 3).when(band == "MEDIUM", 2).otherwise(1)


def _band_of(rank: Column) -> Column:
    return F.when(rank == 3, "HIGH").when(rank == 2, "MEDIUM").when(rank == 1, "LOW")


def alerts_per_stock(alert: DataFrame) -> DataFrame:
    return alert.groupBy("symbol").agg(
        F.max("risk_score").alias("max_risk_score"), _band_of(F.max(_band_rank(F.col("risk_band")))).alias("best_band"),
        F.min("trade_date").alias("first_alert_date"),
        F.min(F.when(F.col("risk_band") == "HIGH", F.col("trade_date"))).alias("first_high_date"),
        F.count("*").alias("alert_days"))


def list_membership(lists: DataFrame) -> DataFrame:
    """Per symbol: on each list in the newest snapshot, and when it was first seen on any."""
    span = lists.agg(F.max("snapshot_date").alias("_latest"), F.min("snapshot_date").alias("_first"))
    now = F.col("snapshot_date") == F.col("_latest")
    on = {c: F.bool_or((F.col("list_type") == kind) & now).alias(c)
          for c, kind in (("on_stasm", "STASM"), ("on_ltasm", "LTASM"), ("on_gsm", "GSM"))}
    return lists.join(F.broadcast(span)).groupBy("symbol").agg(
        *on.values(), F.min("snapshot_date").alias("first_listed_date"),
        (F.min("snapshot_date") > F.min("_first")).alias("listing_date_known"))


def outcomes(signal: DataFrame, alert: DataFrame, filings: DataFrame, lists: DataFrame) -> DataFrame:
    """One row per stock seen in the alert window: our best alert beside the exchange's own actions."""
    window = F.broadcast(alert_window(alert))    # one row
    inside = F.col("trade_date").between(F.col("start_date"), F.col("end_date"))
    universe = signal.select("symbol", "trade_date").join(window, inside).select("symbol").distinct()
    asked = F.col("announced_date").between(F.date_sub("start_date", 5), F.date_add("end_date", 1))
    queries = (filings.filter(F.col("news_type") == fixed.EXCHANGE_QUERY).select("symbol", "announced_date")
               .join(window, asked).groupBy("symbol")
               .agg(F.min("announced_date").alias("first_query_date"), F.count("*").alias("queries")))
    joined = (universe.join(alerts_per_stock(alert), ["symbol"], "left").join(queries, ["symbol"], "left")
              .join(list_membership(lists), ["symbol"], "left"))

    def flag(c: str) -> Column:
        return F.coalesce(c, F.lit(False)).alias(c)

    return joined.select(
        "symbol", F.coalesce("best_band", F.lit(fixed.NOT_ALERTED)).alias("best_band"), "max_risk_score",
        "first_alert_date", "first_high_date", F.coalesce("alert_days", F.lit(0)).alias("alert_days"),
        "first_query_date", F.coalesce("queries", F.lit(0)).alias("exchange_queries"),
        F.col("first_query_date").isNotNull().alias("exchange_queried"),
        F.date_diff("first_query_date", "first_alert_date").alias("query_lead_days"),
        flag("on_stasm"), flag("on_ltasm"), flag("on_gsm"),
        F.coalesce(F.col("on_stasm") | F.col("on_ltasm") | F.col("on_gsm"), F.lit(False)).alias("on_any_list"),
        "first_listed_date", flag("listing_date_known"))


SEGMENTS = ("HIGH", "MEDIUM", "LOW", "ANY_ALERT", "NOT_ALERTED", "ALL_STOCKS")


def validation(outcome: DataFrame) -> DataFrame:
    """Hit rates per alert band, and their lift over the rate of all stocks."""
    alerted = F.col("best_band") != fixed.NOT_ALERTED
    segments = F.array_compact(F.array(F.col("best_band"), F.when(alerted, "ANY_ALERT"), F.lit("ALL_STOCKS")))
    lead = F.col("query_lead_days")
    counts = outcome.withColumn("segment", F.explode(segments)).groupBy("segment").agg(
        F.count("*").alias("stocks"), F.count_if("exchange_queried").alias("queried"),
        F.count_if("on_stasm").alias("on_stasm"), F.count_if("on_any_list").alias("on_any_list"),
        F.count_if(lead > 0).alias("flagged_before_query"), F.count_if(lead == 0).alias("flagged_same_day"),
        F.count_if(lead < 0).alias("flagged_after_query"), F.median(lead).alias("median_query_lead_days"))
    table = Window.partitionBy()    # at most six rows by now

    def share(c: str) -> Column:
        return rounded(100.0 * F.col(c) / F.col("stocks"), 1)

    def lift(c: str) -> Column:
        base = F.col("segment") == "ALL_STOCKS"
        overall = F.max(F.when(base, F.col(c) / F.col("stocks"))).over(table)
        return rounded(F.col(c) / F.col("stocks") / F.nullif(overall, F.lit(0.0)), 1)

    place = F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("segment")).cast("int")
    return counts.select(
        "segment", place.alias("sort_order"), "stocks", "queried", share("queried").alias("queried_pct"),
        lift("queried").alias("queried_lift"), "on_stasm", share("on_stasm").alias("stasm_pct"),
        lift("on_stasm").alias("stasm_lift"), "on_any_list", share("on_any_list").alias("any_list_pct"),
        lift("on_any_list").alias("any_list_lift"), "flagged_before_query", "flagged_same_day",
        "flagged_after_query", "median_query_lead_days").orderBy("sort_order")


def headline(validated: DataFrame) -> DataFrame:
    """Recall of queried stocks, and how many were flagged on or before the exchange's query."""
    def value(segment: str, c: str) -> Column:
        return F.max(F.when(F.col("segment") == segment, F.col(c)))

    on_time = value("ANY_ALERT", "flagged_before_query") + value("ANY_ALERT", "flagged_same_day")
    late = value("ANY_ALERT", "flagged_after_query")
    return validated.agg(
        value("HIGH", "stasm_pct").alias("high_stasm_pct"), value("HIGH", "queried_pct").alias("high_queried_pct"),
        value("ANY_ALERT", "queried").alias("caught"), value("ALL_STOCKS", "queried").alias("queried"),
        on_time.alias("on_or_before"), (on_time + late).alias("flagged")).select(
        "*", rounded(F.try_divide(100.0 * F.col("caught"), F.col("queried")), 1).alias("recall_pct"),
        rounded(F.try_divide(100.0 * F.col("on_or_before"), F.col("flagged")), 1).alias("on_or_before_pct"))


def lead_histogram(outcome: DataFrame, low: int = -3, high: int = 7, named: int = 8) -> DataFrame:
    """Stocks per clipped lead time, empty buckets included, with the first few names of each."""
    seen = outcome.filter("exchange_queried").filter(F.col("best_band") != fixed.NOT_ALERTED).select(
        "symbol", F.least(F.greatest("query_lead_days", F.lit(low)), F.lit(high)).alias("bucket"))
    counts = seen.groupBy("bucket").agg(F.count("*").alias("n"))
    first = top_per(seen, ["bucket"], named, F.col("symbol")).groupBy("bucket").agg(
        F.array_join(F.sort_array(F.collect_list("symbol")), ", ").alias("_names"))   # at most `named` each
    buckets = outcome.sparkSession.range(low, high + 1).select(F.col("id").cast("int").alias("bucket"))
    more = F.when(F.col("n") > named, " and more").otherwise("")
    return (buckets.join(counts, ["bucket"], "left").join(first, ["bucket"], "left")
            .select("bucket", F.coalesce("n", F.lit(0)).alias("n"),
                    F.coalesce(F.concat("_names", more), F.lit("")).alias("names")))


def acted_on_high(outcome: DataFrame) -> DataFrame:
    """HIGH stocks the exchange also queried, newest alert first."""
    return outcome.filter("exchange_queried AND best_band = 'HIGH'").select(
        "symbol", "max_risk_score", "first_alert_date", "first_query_date", "query_lead_days",
        "on_stasm").orderBy(F.col("first_alert_date").desc(), "symbol")


def ablation(measures: DataFrame, filings: DataFrame, lists: DataFrame,
             p: SurveillanceParams = SurveillanceParams()) -> DataFrame:
    """The same days judged under every baseline, side by side; a baseline without alerts has zeros and nulls.

    The measures are read once, each stock-day with its score under every baseline; from there on the baseline is a
    column, so stocks, days and leaders of all baselines are aggregated together.
    """
    scores = settle(scored_by_baseline(measures, p), "scores")
    each = F.explode(F.array(*[F.struct(F.lit(b).alias("baseline"), F.col(b).alias("risk_score")) for b in BASELINES]))
    long = scores.select("symbol", "trade_date", each.alias("_b")).select("symbol", "trade_date", "_b.*")
    alert = long.filter("risk_score is not null")
    window = settle(alert.groupBy("baseline").agg(
        F.min("trade_date").alias("start_date"), F.max("trade_date").alias("end_date")), "windows")
    window = F.broadcast(window)                  # one row per baseline
    inside = long.join(window, "baseline").filter(F.col("trade_date").between(F.col("start_date"), F.col("end_date")))
    days = inside.select("baseline", "trade_date").distinct().groupBy("baseline").agg(F.count("*").alias("days"))
    stocks = inside.groupBy("baseline", "symbol").agg(
        F.count("risk_score").alias("alert_days"), F.max("risk_score").alias("best_score"))
    asked = F.col("announced_date").between(F.date_sub("start_date", 5), F.date_add("end_date", 1))
    queries = (filings.filter(F.col("news_type") == fixed.EXCHANGE_QUERY).select("symbol", "announced_date")
               .join(window, asked).select("baseline", "symbol", F.lit(True).alias("_queried")).distinct())
    member = list_membership(lists).select("symbol", "on_stasm")
    outcome = settle(stocks.join(queries, ["baseline", "symbol"], "left").join(member, ["symbol"], "left").select(
        "baseline", "symbol", "alert_days", F.coalesce("_queried", F.lit(False)).alias("queried"),
        F.coalesce("on_stasm", F.lit(False)).alias("on_stasm"),
        F.coalesce(risk_band(F.col("best_score"), p) == "HIGH", F.lit(False)).alias("high")), "outcomes")
    leaders = top_per(alert, ["baseline", "trade_date"], 10, F.col("risk_score").desc(), F.col("symbol")).join(
        outcome, ["baseline", "symbol"]).groupBy("baseline").agg(
        rounded(100 * F.avg((F.col("queried") | F.col("on_stasm")).cast("int")), 1).alias("top10_acted_pct"))
    caught, queried, high = F.col("alert_days") > 0, F.col("queried"), F.col("high")
    any_rate = F.try_divide(F.count_if(caught & queried), F.count_if(caught))
    all_rate = F.try_divide(F.count_if(queried), F.count("*"))
    totals = outcome.groupBy("baseline").agg(
        F.sum("alert_days").alias("alerts"), F.count_if(caught).alias("stocks_alerted"),
        rounded(F.try_divide(100.0 * F.count_if(caught & queried), F.count_if(queried)), 1).alias("recall_queried_pct"),
        rounded(F.try_divide(100.0 * F.count_if(caught & F.col("on_stasm")), F.count_if(F.col("on_stasm"))), 1)
        .alias("recall_stasm_pct"),
        rounded(F.try_divide(any_rate, all_rate), 1).alias("any_alert_lift"), F.count_if(high).alias("high_stocks"),
        rounded(F.try_divide(100.0 * F.count_if(high & queried), F.count_if(high)), 1).alias("high_queried_pct"))
    names = measures.sparkSession.createDataFrame([(b,) for b in BASELINES], "baseline string")
    summed = F.broadcast(totals.join(days, "baseline").join(leaders, "baseline"))       # one row per baseline
    return names.join(summed, ["baseline"], "left").select(
        "baseline", rounded(F.col("alerts") / F.col("days"), 1).alias("alerts_per_day"),
        F.coalesce("stocks_alerted", F.lit(0)).alias("stocks_alerted"), "recall_queried_pct", "recall_stasm_pct",
        "any_alert_lift", "top10_acted_pct", F.coalesce("high_stocks", F.lit(0)).alias("high_stocks"), "high_queried_pct")


def event_study(alert: DataFrame, fact: DataFrame, hold_days: int = 5) -> DataFrame:
    """What an alert's stock did after it, beside the median stock bought and sold on the same days."""
    moves = settle(forward_returns(fact, hold_days), "moves")
    market = median(moves, ["trade_date"], F.col("ret"), "market_ret")
    return (alert.join(moves.select("symbol", "trade_date", "ret"), ["symbol", "trade_date"])
            .join(market, ["trade_date"])
            .select("trade_date", "symbol", "company_name", "risk_band", "risk_score", "rules_triggered",
                    "news_types", "ret", "market_ret"))


def event_summary(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count("*").alias("alerts"), F.countDistinct("trade_date").alias("alert_days"),
        rounded(F.avg("ret"), 4).alias("avg_ret"),
        rounded(F.avg("ret") - F.avg("market_ret"), 4).alias("edge"),
        rounded(100 * F.avg((F.col("ret") > 0).cast("int")), 2).alias("pct_up"))


def event_pnl(events: DataFrame, stake: float = 10_000) -> DataFrame:
    """Running profit of a fixed stake per alert, and of the median stock on the same days."""
    daily = events.groupBy("trade_date").agg(
        F.sum(F.col("ret") / 100 * stake).alias("_you"), F.sum(F.col("market_ret") / 100 * stake).alias("_market"))
    days = so_far(Window.orderBy("trade_date"))    # one row per alert day
    return daily.select("trade_date", rounded(F.sum("_you").over(days), 2).alias("you"),
                        rounded(F.sum("_market").over(days), 2).alias("market"))


def outcome_stats(alert: DataFrame, fact: DataFrame, hold_days: int = 5) -> DataFrame:
    """Mean move and share that fell, per band."""
    moves = forward_returns(fact, hold_days)
    return alert.select("symbol", "trade_date", "risk_band").join(moves, ["symbol", "trade_date"]).groupBy(
        "risk_band").agg(F.count("*").alias("n"), rounded(F.avg("ret"), 4).alias("avg_ret"),
                         rounded(100 * F.avg((F.col("exit") < F.col("entry")).cast("int")), 2).alias("pct_down"))
