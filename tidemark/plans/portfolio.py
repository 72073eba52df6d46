"""Holdings at average cost, money-weighted returns, instalment discipline, paper positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions.cleaning import month_steps, ratio, rounded
from tidemark.functions.xirr import xirr
from tidemark.operators.grouping import most_common
from tidemark.plans.facts import latest
from tidemark.sources.store import settle

KEYS = ["owner", "asset_class", "instrument_id"]
MIN_DAYS_FOR_XIRR = 365


def latest_prices(fact: DataFrame, nav: DataFrame) -> DataFrame:
    """Newest price of every stock and fund under one (asset_class, instrument_id) key."""
    stocks = latest(fact, "symbol", "trade_date", {"close": "current_price"}).select(
        F.lit(fixed.STOCK).alias("asset_class"), F.col("symbol").alias("instrument_id"), "current_price",
        F.col("trade_date").alias("price_date"))
    funds = latest(nav, "scheme_code", "nav_date", {"nav": "current_price"}).select(
        F.lit(fixed.MUTUAL_FUND).alias("asset_class"), F.col("scheme_code").cast("string").alias("instrument_id"),
        "current_price", F.col("nav_date").alias("price_date"))
    return stocks.unionByName(funds)


def instrument_names(stocks: DataFrame, funds: DataFrame) -> DataFrame:
    listed = stocks.filter("is_current").select(
        F.lit(fixed.STOCK).alias("asset_class"), F.col("symbol").alias("instrument_id"),
        F.col("company_name").alias("instrument_name"), F.col("industry").alias("sector_or_category"))
    schemes = funds.select(
        F.lit(fixed.MUTUAL_FUND).alias("asset_class"), F.col("scheme_code").cast("string").alias("instrument_id"),
        F.col("scheme_name").alias("instrument_name"), F.col("category").alias("sector_or_category"))
    return listed.unionByName(schemes)


def holdings(txns: DataFrame, fact: DataFrame, nav: DataFrame, stocks: DataFrame, funds: DataFrame) -> DataFrame:
    bought, sold = F.col("quantity") > 0, F.col("quantity") < 0

    def total(c: str, when: Column) -> Column:
        return F.sum(F.when(when, F.col(c)))

    held = txns.groupBy(*KEYS).agg(
        F.min("txn_date").alias("first_txn_date"), F.count("*").alias("txn_count"), F.sum("quantity").alias("_held"),
        total("quantity", bought).alias("_bought"), total("gross_amount", bought).alias("_paid"),
        F.coalesce(-total("quantity", sold), F.lit(0.0)).alias("_sold"),
        F.coalesce(total("gross_amount", sold), F.lit(0.0)).alias("_received"))
    cost, price, quantity = F.col("_cost"), F.col("current_price"), F.col("_held")
    priced = (held.join(latest_prices(fact, nav), ["asset_class", "instrument_id"], "left")
              .join(instrument_names(stocks, funds), ["asset_class", "instrument_id"], "left")
              .withColumn("_cost", ratio(F.col("_paid"), F.col("_bought"))))
    priced = settle(priced, "priced")
    # a total per owner joined back, not a window: one owner may hold a large share of all rows
    owned = priced.groupBy("owner").agg(F.sum(price * quantity).alias("_owned"))
    return priced.join(owned, "owner").select(
        *KEYS, "instrument_name", "sector_or_category", "first_txn_date", "txn_count",
        rounded(quantity, 4).alias("held_qty"), rounded(cost, 4).alias("avg_cost"), "current_price", "price_date",
        rounded(cost * quantity, 2).alias("invested_value"), rounded(price * quantity, 2).alias("current_value"),
        rounded(price * quantity - cost * quantity, 2).alias("unrealized_pnl"),
        rounded((ratio(price, cost) - 1) * 100, 2).alias("unrealized_pnl_pct"),
        rounded(F.col("_received") - cost * F.col("_sold"), 2).alias("realized_pnl"),
        rounded(ratio(price * quantity, F.col("_owned")) * 100, 2).alias("weight_pct"))


def money_weighted(txns: DataFrame, held: DataFrame) -> DataFrame:
    """XIRR of each holding and of each owner's whole portfolio, today's value being the last flow.

    Flows are first summed per day and sign, which leaves their present value unchanged and bounds the
    array handed to the solver by the calendar, however often somebody trades.
    """
    flow = F.col("cash_flow")
    daily = settle(txns.groupBy(*KEYS, "txn_date", (flow > 0).alias("_in")).agg(F.sum(flow).alias("_amount")),
                   "daily-flows")
    as_of = held.groupBy("owner").agg(F.max("price_date").alias("as_of_date"))
    none = F.lit(None).cast("string")
    levels = {"HOLDING": ["owner", "asset_class", "instrument_id"], "PORTFOLIO": ["owner"]}
    rows = None
    for level, keys in levels.items():
        flows = daily if keys == KEYS else daily.groupBy(*keys, "txn_date", "_in").agg(F.sum("_amount").alias("_amount"))
        listed = flows.groupBy(*keys).agg(
            F.min("txn_date").alias("first_txn_date"),
            F.coalesce(F.sum(F.when(F.col("_amount") < 0, -F.col("_amount"))), F.lit(0.0)).alias("_invested"),
            F.coalesce(F.sum(F.when(F.col("_amount") > 0, F.col("_amount"))), F.lit(0.0)).alias("_received"),
            F.sort_array(F.collect_list(F.struct("txn_date", "_amount"))).alias("_flows"))
        worth = held.groupBy(*keys).agg(F.coalesce(F.sum("current_value"), F.lit(0.0)).alias("_worth"))
        part = listed.join(worth, keys).withColumn("level", F.lit(level))
        for c in ("asset_class", "instrument_id"):
            if c not in keys:
                part = part.withColumn(c, none)
        rows = part if rows is None else rows.unionByName(part)
    dated = rows.join(as_of, "owner")
    all_flows = F.filter(
        F.concat("_flows", F.array(F.struct(F.col("as_of_date").alias("txn_date"), F.col("_worth").alias("_amount")))),
        lambda f: f["_amount"] != 0)
    start = F.col("first_txn_date")
    timed = F.transform(all_flows, lambda f: F.struct(
        F.date_diff(f["txn_date"], start).alias("days"), f["_amount"].alias("amount")))
    invested, received = F.col("_invested"), F.col("_received")
    gain = rounded(ratio(F.col("_worth") + received - invested, invested) * 100, 2)
    solved = dated.withColumn("_rate", xirr(timed)).withColumn("holding_days", F.date_diff("as_of_date", start))
    meaningful = F.col("holding_days") >= MIN_DAYS_FOR_XIRR
    rate = rounded(F.col("_rate") * 100, 2)
    return solved.select(
        "owner", "level", "asset_class", "instrument_id", "as_of_date", "first_txn_date", "holding_days",
        rounded(invested, 2).alias("total_invested"), rounded(received, 2).alias("total_received"),
        rounded("_worth", 2).alias("current_value"), gain.alias("absolute_return_pct"), rate.alias("xirr_pct"),
        meaningful.alias("xirr_is_meaningful"), F.when(meaningful, rate).otherwise(gain).alias("display_return_pct"),
        F.when(meaningful, "XIRR").otherwise("ABSOLUTE").alias("display_return_type"))


def instalments(txns: DataFrame, nav: DataFrame, funds: DataFrame, lapse_days: int = 45) -> DataFrame:
    """Instalments made against months gone by since the first one."""
    sip = txns.filter((F.col("asset_class") == fixed.MUTUAL_FUND) & (F.col("txn_type") == "SIP"))
    keys = ["owner", "instrument_id"]
    totals = sip.groupBy(*keys).agg(
        F.count("*").alias("installments"), F.min("txn_date").alias("first_sip_date"),
        F.max("txn_date").alias("last_sip_date"), F.sum("gross_amount").alias("total_invested"),
        rounded(F.sum("quantity"), 4).alias("units_accumulated"))
    typical = most_common(sip, keys, "gross_amount", "typical_amount")
    names = funds.select(F.col("scheme_code").cast("string").alias("instrument_id"), "scheme_name")
    as_of = nav.agg(F.max("nav_date").alias("_as_of"))
    months = month_steps(F.col("first_sip_date"), F.col("_as_of")) + 1
    return (totals.join(typical, keys, "left").join(names, "instrument_id", "left").join(F.broadcast(as_of))
            .select("owner", F.col("instrument_id").alias("scheme_code"), "scheme_name", "installments",
                    "first_sip_date", "last_sip_date", "typical_amount", "total_invested", "units_accumulated",
                    months.alias("months_since_start"),
                    rounded(F.col("installments") / months * 100, 1).alias("regularity_pct"),
                    F.add_months("last_sip_date", 1).alias("next_expected_date"),
                    (F.date_diff("_as_of", "last_sip_date") > lapse_days).alias("is_lapsed")))


def mark_to_market(positions: DataFrame, fact: DataFrame) -> DataFrame:
    """Virtual positions (symbol, date, qty, price, amount) at the latest close."""
    prices = latest(fact, "symbol", "trade_date", {"close": "last_close"})
    value = F.col("qty") * F.col("last_close")
    return positions.join(prices, "symbol", "left").select(
        "symbol", "date", "qty", "price", "amount", "last_close", F.col("trade_date").alias("as_of"),
        rounded(value, 2).alias("value"), rounded(value - F.col("amount"), 2).alias("pnl"),
        rounded(ratio(value - F.col("amount"), F.col("amount")) * 100, 2).alias("pnl_pct"))


def paper_totals(marked: DataFrame) -> DataFrame:
    return marked.agg(
        F.count("*").alias("positions"), rounded(F.sum("amount"), 2).alias("invested"),
        rounded(F.sum("value"), 2).alias("worth"), rounded(F.sum("pnl"), 2).alias("pnl"),
        rounded(100 * F.try_divide(F.sum("pnl"), F.sum("amount")), 2).alias("pnl_pct"), F.max("as_of").alias("as_of"))


def symbols_held(txns: DataFrame) -> DataFrame:
    return txns.filter(F.col("asset_class") == fixed.STOCK).select(F.col("instrument_id").alias("symbol")).distinct()
