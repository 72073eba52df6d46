"""Facts: adjusted prices, daily stock metrics, indices, fund NAVs, portfolio transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.cleaning import code, date_key, pct, ratio, rounded
from tidemark.operators.asof import asof_join, forward_product
from tidemark.operators.ordering import dense_ids
from tidemark.operators.windows import by_date, first_per, rows, so_far

PRICES = ("prev_close", "open", "high", "low", "last", "close", "vwap")


def adjusted_prices(stock_daily: DataFrame, actions: DataFrame) -> DataFrame:
    """Prices before a split or bonus divided, volumes multiplied, by all later factors of the symbol."""
    rated = forward_product(stock_daily, actions, ["symbol"], "trade_date", "ex_date", "factor", "_factor")
    out = rated.withColumn("adj_factor", rounded("_factor", 6)).drop("_factor")
    f = F.col("adj_factor")
    return out.withColumns({
        **{f"adj_{c}": rounded(F.col(c) / f, 4) for c in PRICES},
        "adj_volume": (F.col("volume") * f).cast("long"),
    })


def staged_prices(adjusted: DataFrame) -> DataFrame:
    """One row per symbol and day from its main series; adjusted prices by default, raw ones kept aside."""
    rank = F.when(F.col("series") == "EQ", 0).when(F.col("series") == "BE", 1).otherwise(2)
    equity = adjusted.filter(F.col("series").isin(*fixed.EQUITY_SERIES))
    main = first_per(equity, ["symbol", "trade_date"], rank, F.col("series"))
    return main.select(
        "trade_date", "symbol", "series",
        *[F.col(f"adj_{c}").alias(c) for c in ("open", "high", "low", "close", "prev_close", "vwap", "volume")],
        F.col("close").alias("raw_close"), F.col("volume").alias("raw_volume"), "adj_factor", "turnover_lacs",
        "num_trades", "deliv_qty", "deliv_pct")


def stock_daily(prices: DataFrame, stocks: DataFrame) -> DataFrame:
    """Returns, gaps, ranges, 20-row baselines and the instrument version of every stock-day."""
    w = by_date("symbol", date="trade_date")
    last20 = rows(w, -20, -1)
    close, previous = F.col("close"), F.col("prev_close")
    measured = prices.select(
        "*",
        F.avg("volume").over(last20).alias("avg_volume_20d"),
        F.avg("deliv_pct").over(last20).alias("avg_deliv_pct_20d"),
        (F.stddev_samp(ratio(close, previous) - 1).over(last20) * 100).alias("_volatility"),
        F.lag("close", 5).over(w).alias("_close_5"),
        F.count(F.lit(1)).over(so_far(w)).alias("history_days"))
    versions = stocks.select("stock_sk", F.col("symbol").alias("_symbol"), "valid_from", "valid_to")
    dated = measured.join(
        versions,
        (F.col("symbol") == F.col("_symbol")) & (F.col("trade_date") >= F.col("valid_from"))
        & (F.col("trade_date") < F.col("valid_to")), "left")
    return dated.select(
        date_key("trade_date").alias("date_key"), "trade_date", "symbol",
        F.coalesce("stock_sk", F.lit(fixed.UNKNOWN_KEY)).alias("stock_sk"), "series",
        "open", "high", "low", "close", "prev_close", "vwap", "volume", "raw_close", "raw_volume", "adj_factor",
        "turnover_lacs", "num_trades", "deliv_qty", "deliv_pct",
        pct(close, previous, 4).alias("return_pct"), pct(F.col("open"), previous, 4).alias("gap_pct"),
        rounded(ratio(F.col("high") - F.col("low"), previous) * 100, 4).alias("range_pct"),
        pct(close, F.col("_close_5"), 4).alias("return_5d_pct"), "avg_volume_20d",
        rounded(ratio(F.col("volume"), F.col("avg_volume_20d")), 3).alias("volume_ratio_20d"),
        "avg_deliv_pct_20d", rounded("_volatility", 4).alias("volatility_20d_pct"), "history_days")


def index_daily(indices: DataFrame, dim: DataFrame) -> DataFrame:
    return indices.join(dim.select("index_sk", "index_name"), "index_name").select(
        date_key("trade_date").alias("date_key"), "trade_date", "index_sk", "index_name", "open", "high", "low",
        "close", "points_change", "pct_change", "volume", "turnover_cr", "pe", "pb", "div_yield")


def fund_nav(nav: DataFrame) -> DataFrame:
    before = F.lag("nav").over(by_date("scheme_code", date="nav_date"))
    return nav.select(date_key("nav_date").alias("date_key"), "nav_date", "scheme_code", "nav",
                      pct(F.col("nav"), before, 6).alias("return_pct"))


def staged_transactions(portfolio: DataFrame) -> DataFrame:
    """Typed, normalised transactions, numbered in the order of the raw columns; price breaks the last ties."""
    def last(c: str) -> Column:
        return F.col(c).asc_nulls_last()

    raw = dense_ids(portfolio, [last(c) for c in ("owner", "date", "symbol", "type", "quantity", "amount", "price")],
                    "txn_id")
    return raw.select(
        "txn_id", F.trim("owner").alias("owner"), F.col("date").cast("date").alias("txn_date"), code("type").alias("txn_type"),
        F.upper(F.trim(F.col("symbol").cast("string"))).alias("instrument_id"), code("asset_class").alias("asset_class"),
        *[F.col(c).cast("double").alias(c) for c in ("quantity", "price", "amount")])


def portfolio_transactions(txns: DataFrame, nav: DataFrame, tolerance_days: int = 10) -> DataFrame:
    """Signed units and cash of every transaction; fund units come from the NAV on or just before the day."""
    is_fund = F.col("asset_class") == fixed.MUTUAL_FUND
    keyed = txns.withColumn("scheme_code", F.when(is_fund, F.col("instrument_id").try_cast("bigint")))
    known = nav.select("scheme_code", "nav_date", "nav")
    funds = asof_join(keyed.filter(is_fund), known, ["scheme_code"], "txn_date", "nav_date",
                      {"nav": "_nav", "nav_date": "nav_date_used"}, tolerance_days=tolerance_days)
    others = keyed.filter(~F.coalesce(is_fund, F.lit(False)))
    direction = F.when(F.col("txn_type").isin(*fixed.OUTFLOW_TYPES), -1).otherwise(1)
    unit = F.when(is_fund, F.col("_nav")).otherwise(F.col("price"))
    return (funds.unionByName(others, allowMissingColumns=True)
            .withColumn("unit_price", unit)
            .withColumn("gross_amount", F.coalesce("amount", F.col("quantity") * F.col("unit_price")))
            .withColumn("_units", F.coalesce("quantity", ratio(F.col("amount"), F.col("unit_price"))))
            .select([c for c in ("txn_id",) if "txn_id" in txns.columns] + [
                "owner", date_key("txn_date").alias("date_key"), "txn_date", "txn_type", "asset_class",
                "instrument_id", "unit_price", "nav_date_used", (direction * F.col("_units")).alias("quantity"),
                "gross_amount", (-direction * F.col("gross_amount")).alias("cash_flow")]))


def latest(df: DataFrame, key: str, date: str, columns: dict[str, str]) -> DataFrame:
    """The values of each key's newest row."""
    return df.groupBy(key).agg(F.max(date).alias(date), *[F.max_by(c, date).alias(n) for c, n in columns.items()])


def forward_returns(fact: DataFrame, hold_days: int) -> DataFrame:
    """Buy at the next open, sell at the close `hold_days` rows later; only rows where both exist."""
    w = by_date("symbol", date="trade_date")
    moved = fact.select("symbol", "trade_date", F.lead("open", 1).over(w).alias("entry"),
                        F.lead("close", hold_days).over(w).alias("exit"))
    return moved.filter((F.col("entry") > 0) & F.col("exit").isNotNull()).withColumn(
        "ret", (F.col("exit") / F.col("entry") - 1) * 100)
