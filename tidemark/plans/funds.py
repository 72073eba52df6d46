"""Fund returns, risk and drawdown, and daily sector breadth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cleaning import ratio, rounded
from tidemark.operators.asof import asof_join
from tidemark.operators.windows import by_date, drawdown
from tidemark.params import FundParams

# label, days back, annualised
HORIZONS = (("1m", 30, False), ("3m", 91, False), ("6m", 182, False), ("1y", 365, False),
            ("3y", 1095, True), ("5y", 1826, True))
YEAR, THREE_YEARS = 365, 1095


def established(nav: DataFrame, p: FundParams = FundParams()) -> DataFrame:
    """NAVs of funds with enough of them."""
    enough = nav.groupBy("scheme_code").agg(F.count("*").alias("_n")).filter(F.col("_n") >= p.min_nav_count)
    return nav.join(enough, "scheme_code", "left_semi")


def newest(nav: DataFrame) -> DataFrame:
    return nav.groupBy("scheme_code").agg(F.max("nav_date").alias("as_of_date"),
                                          F.max_by("nav", "nav_date").alias("nav_now"))


def horizon_returns(nav: DataFrame) -> DataFrame:
    """Return since the last NAV on or before each horizon's start; compounded per year beyond one year."""
    offsets = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(days).alias("days")) for label, days, _ in HORIZONS])
    targets = newest(nav).withColumn("_h", F.explode(offsets)).select(
        "scheme_code", "as_of_date", "nav_now", "_h.label", F.expr("date_sub(as_of_date, _h.days)").alias("target_date"))
    then = asof_join(targets, nav, ["scheme_code"], "target_date", "nav_date",
                     {"nav": "nav_then", "nav_date": "then_date"}, how="inner")
    growth = F.col("nav_now") / F.col("nav_then")
    yearly = F.pow(growth, 365.0 / F.date_diff("as_of_date", "then_date"))
    gains = [F.max(F.when(F.col("label") == label, (yearly if annual else growth) - 1)).alias(f"ret_{label}")
             for label, _, annual in HORIZONS]
    return then.groupBy("scheme_code").agg(*gains)


def recent(nav: DataFrame, latest: DataFrame, days: int) -> DataFrame:
    return nav.join(latest.select("scheme_code", "as_of_date"), "scheme_code").filter(
        F.col("nav_date") > F.date_sub("as_of_date", days))


def volatility(nav: DataFrame, p: FundParams = FundParams()) -> DataFrame:
    last_year = recent(nav, newest(nav), YEAR)
    return last_year.groupBy("scheme_code").agg(
        (F.stddev_samp(F.col("return_pct") / 100) * F.sqrt(F.lit(p.trading_days_per_year))).alias("vol_1y"))


def max_drawdown(nav: DataFrame) -> DataFrame:
    points = recent(nav, newest(nav), THREE_YEARS).select(
        "scheme_code", drawdown(F.col("nav"), by_date("scheme_code", date="nav_date")).alias("_below"))
    return points.groupBy("scheme_code").agg(F.min("_below").alias("max_drawdown_3y"))


def rolling_year(nav: DataFrame) -> DataFrame:
    """One-year returns sampled at every NAV of the last three years."""
    ends = recent(nav, newest(nav), THREE_YEARS).select(
        "scheme_code", F.col("nav").alias("nav_end"), F.date_sub("nav_date", YEAR).alias("year_before"))
    paired = asof_join(ends, nav, ["scheme_code"], "year_before", "nav_date", {"nav": "nav_start"}, how="inner")
    gain = F.col("nav_end") / F.col("nav_start") - 1
    return paired.groupBy("scheme_code").agg(
        F.avg(gain).alias("roll_avg"), F.min(gain).alias("roll_min"), F.max(gain).alias("roll_max"),
        F.avg((gain > 0).cast("double")).alias("roll_positive"))


def performance(nav: DataFrame, funds: DataFrame, p: FundParams = FundParams()) -> DataFrame:
    known = established(nav, p)
    out = newest(known)
    for part in (horizon_returns(known), volatility(known, p), max_drawdown(known), rolling_year(known)):
        out = out.join(part, "scheme_code", "left")
    out = out.join(funds.select("scheme_code", "scheme_name", "amc", "category", "asset_class", "plan", "option_type"),
                   "scheme_code", "left")

    def pct(c: str, places: int = 2):
        return rounded(F.col(c) * 100, places)

    return out.select(
        "scheme_code", "scheme_name", "amc", "category", "asset_class", "plan", "option_type", "as_of_date",
        F.col("nav_now").alias("latest_nav"),
        *[pct(f"ret_{label}").alias(f"cagr_{label}_pct" if annual else f"return_{label}_pct")
          for label, _, annual in HORIZONS],
        pct("vol_1y").alias("volatility_1y_pct"),
        rounded(ratio(F.col("ret_1y") - p.risk_free_rate, F.col("vol_1y")), 2).alias("sharpe_1y"),
        pct("max_drawdown_3y").alias("max_drawdown_3y_pct"), pct("roll_avg").alias("rolling_1y_avg_pct"),
        pct("roll_min").alias("rolling_1y_min_pct"), pct("roll_max").alias("rolling_1y_max_pct"),
        pct("roll_positive", 1).alias("rolling_1y_positive_pct"))


def sector_performance(fact: DataFrame, stocks: DataFrame) -> DataFrame:
    """Daily breadth per industry.

    Stock-days are first summed per equal return, which the exact median needs as counts; the second step
    then sees one row per distinct return of a sector-day.
    """
    move, turnover = F.col("return_pct"), F.col("turnover_lacs")
    named = fact.filter(move.isNotNull()).join(stocks.select("stock_sk", "industry"), "stock_sk")
    equal = named.groupBy("date_key", "trade_date", "industry", "return_pct").agg(
        F.count("*").alias("_n"), F.sum(turnover).alias("_turnover"), F.sum("deliv_pct").alias("_delivered"),
        F.count("deliv_pct").alias("_reported"))
    n, money = F.col("_n"), F.col("_turnover")
    return equal.groupBy("date_key", "trade_date", "industry").agg(
        F.sum(n).alias("stocks"), rounded(F.sum(move * n) / F.sum(n), 3).alias("avg_return_pct"),
        rounded(F.expr("percentile(return_pct, 0.5, _n)"), 3).alias("median_return_pct"),
        rounded(ratio(F.sum(move * money), F.sum(money)), 3).alias("weighted_return_pct"),
        F.coalesce(F.sum(F.when(move > 0, n)), F.lit(0)).alias("advancers"),
        F.coalesce(F.sum(F.when(move < 0, n)), F.lit(0)).alias("decliners"),
        rounded(F.sum(money) / 100, 2).alias("turnover_cr"),
        rounded(F.try_divide(F.sum("_delivered"), F.sum("_reported")), 2).alias("avg_deliv_pct"))
