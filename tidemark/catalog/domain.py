"""Market tables derived from the order-processing tables of a test data folder.

Nations act as listed stocks, brands as fund schemes, customers as investors; line items are trades and
orders are filings and portfolio transactions. Every mapping reads its whole source tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.classify import corporate_action
from tidemark.functions.cleaning import ratio, rounded
from tidemark.operators.windows import by_date, first_per
from tidemark.plans import reference
from tidemark.sources import store

TICK = 10_000           # price units of 1/10000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tick() -> Column:
    """Trade price in ticks; the logarithm tames the heavy tail of the unit prices."""
    return F.floor(100 * TICK + 10 * TICK * F.log(F.col("l_extendedprice") / F.col("l_quantity")) + 0.5)


def cents(c: str) -> Column:
    return F.floor(F.col(c) * 100 + 0.5)


def nations(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("symbol"), F.col("r_name").alias("industry"))


def _placed() -> Column:
    """Order, line and price of a trade as one number: of fixed width, so that first and last trade are hash aggregates.

    Whole numbers of 38 digits: 19 of the order, 10 of the line, 9 of the price.
    """
    order, line = F.col("l_orderkey").cast("decimal(19, 0)"), F.col("l_linenumber").cast("decimal(10, 0)")
    seat = (order * F.lit(10 ** 10).cast("decimal(11, 0)") + line).cast("decimal(29, 0)")
    return (seat * F.lit(10 ** 9).cast("decimal(10, 0)") + tick().cast("decimal(9, 0)")).cast("decimal(38, 0)")


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with the stock they sell, settled: a join's size is guessed as the product of its sides, and the trades
    would be shuffled to meet a table that is small enough to broadcast.
    """
    listed = table(spark, folder, "supplier").join(nations(spark, folder), F.col("s_nationkey") == F.col("n_nationkey"))
    return store.settle(listed.select("s_suppkey", "symbol"), "sellers")


def trades(spark: SparkSession, folder: str) -> DataFrame:
    price = tick()
    return table(spark, folder, "lineitem").select(
        "l_suppkey", F.col("l_shipdate").cast("date").alias("trade_date"), price.alias("tick"),
        _placed().alias("placed"), F.col("l_quantity").cast("long").alias("quantity"),
        cents("l_extendedprice").alias("cents"), "l_returnflag", "l_linestatus",
    ).join(sellers(spark, folder), F.col("l_suppkey") == F.col("s_suppkey"))


def _bar_columns() -> list[Column]:
    # sums stay whole numbers until the last step, so they do not depend on the order of the rows
    volume = F.sum("quantity")
    delivered = F.sum(F.when(F.col("l_returnflag") != "R", F.col("quantity")).otherwise(0))
    return [
        (F.min_by("tick", "placed") / TICK).alias("open"), (F.max("tick") / TICK).alias("high"),
        (F.min("tick") / TICK).alias("low"), (F.max_by("tick", "placed") / TICK).alias("close"),
        (F.sum(F.col("tick") * F.col("quantity")) / volume / TICK).alias("vwap"),
        volume.alias("volume"), (F.sum("cents") / 100_000).alias("turnover_lacs"),
        F.count("*").alias("num_trades"), delivered.alias("deliv_qty"),
        (100.0 * delivered / volume).alias("deliv_pct"),
    ]


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """Staged prices: one row per stock and day, the previous close taken from the row before."""
    daily = trades(spark, folder).groupBy("symbol", "trade_date").agg(*_bar_columns())
    return daily.select(
        "trade_date", "symbol", F.lit("EQ").alias("series"), "open", "high", "low", "close",
        F.lag("close").over(by_date("symbol", date="trade_date")).alias("prev_close"), "vwap", "volume",
        F.col("close").alias("raw_close"), F.col("volume").alias("raw_volume"), F.lit(1.0).alias("adj_factor"),
        "turnover_lacs", "num_trades", "deliv_qty", "deliv_pct")


def series_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Unadjusted prices per stock, day and series, before one series is chosen."""
    series = F.when(F.col("l_linestatus") == "O", "EQ").when(F.col("l_returnflag") == "R", "GC").otherwise("BE")
    daily = trades(spark, folder).withColumn("series", series).groupBy("symbol", "trade_date", "series").agg(
        *_bar_columns())
    w = by_date("symbol", "series", date="trade_date")
    return daily.withColumn("last", F.col("close")).withColumn("prev_close", F.lag("close").over(w))


def filed_orders(spark: SparkSession, folder: str) -> DataFrame:
    buyers = table(spark, folder, "customer").join(
        nations(spark, folder), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "c_mktsegment", "n_nationkey", "symbol", "industry")
    return table(spark, folder, "orders").join(buyers, F.col("o_custkey") == F.col("c_custkey"))


def _by_priority(*values: str) -> Column:
    levels = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
    chain = F.when(F.col("o_orderpriority") == levels[0], values[0])
    for level, value in zip(levels[1:], values[1:]):
        chain = chain.when(F.col("o_orderpriority") == level, value)
    return chain.otherwise(values[4])


def announcements(spark: SparkSession, folder: str) -> DataFrame:
    minor = (F.when(F.col("o_orderstatus") == "O", "Acquisition")
             .when(F.col("o_orderstatus") == "F", "Credit Rating").otherwise("General Updates"))
    category = _by_priority("Spurt in Volume", "Financial Result Updates", "Bagging/Receiving of orders/contracts",
                            "Trading Window", "")
    summary = F.when(F.col("o_totalprice") > 300000,
                     F.concat(F.lit("Business update for q"), F.quarter("o_orderdate").cast("string"), F.lit(" FY"),
                              F.date_format("o_orderdate", "yy"))).otherwise(
        F.concat(F.lit("Letter of order "), F.col("o_orderkey").cast("string")))
    return filed_orders(spark, folder).select(
        F.col("o_orderkey").cast("string").alias("seq_id"), "symbol", F.col("o_orderdate").alias("announced_at"),
        F.when(category == "", minor).otherwise(category).alias("category"), summary.alias("summary"),
        F.concat(F.lit("filing-"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("attachment_url"))


def surveillance_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly snapshots of the stocks with a large pending order."""
    large = filed_orders(spark, folder).filter((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000))
    listed = large.select(
        F.trunc("o_orderdate", "month").alias("snapshot_date"), "symbol",
        _by_priority("STASM", "LTASM", "GSM", "STASM", "LTASM").alias("list_type"), "o_totalprice")
    return listed.groupBy("snapshot_date", "symbol", "list_type").agg(
        F.concat(F.lit("Stage "), F.count("*").cast("string")).alias("stage"),
        F.concat(F.lit("Order worth "), F.max(cents("o_totalprice")).cast("string")).alias("description"))


def stock_master(spark: SparkSession, folder: str) -> DataFrame:
    """Quarterly snapshots: a stock looks like its largest order of the quarter, and is absent when that was low."""
    quarter = F.trunc("o_orderdate", "quarter")
    largest = first_per(filed_orders(spark, folder).withColumn("snapshot_date", quarter),
                        ["symbol", "snapshot_date"], F.col("o_totalprice").desc(), F.col("o_orderkey"))
    return largest.filter(F.col("o_orderpriority") != "5-LOW").select(
        "snapshot_date", "symbol", F.concat_ws(" ", "symbol", F.initcap("c_mktsegment"), F.lit("Limited")).alias("company_name"),
        F.when(F.col("o_orderstatus") == "P", "BE").otherwise("EQ").alias("series"),
        F.date_add(F.lit("1990-01-01").cast("date"), F.col("n_nationkey")).alias("listing_date"),
        F.concat(F.lit("INE"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0")).alias("isin"),
        _by_priority("1", "2", "5", "10", "10").cast("double").alias("face_value"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("industry")).alias("industry"),
        (F.col("o_totalprice") > 450000).alias("in_nifty500"))


def action_filings(spark: SparkSession, folder: str) -> DataFrame:
    """One corporate-action subject per order, in the wordings the exchange uses."""
    a = F.pmod(F.col("o_orderkey"), F.lit(3)) + 1
    b = F.pmod(F.col("o_custkey"), F.lit(5)) + 1
    split = F.format_string("Face Value Split (Sub-Division) - From Rs %d/- Per Share To Re %d/- Per Share", a * 2, b)
    subject = (F.when(F.col("o_orderpriority") == "1-URGENT", split)
               .when(F.col("o_orderpriority") == "2-HIGH", F.format_string("Bonus %d:%d", a, b))
               .when(F.col("o_orderpriority") == "3-MEDIUM", F.format_string("Interim Dividend - Rs %d Per Share", b))
               .when(F.col("o_orderpriority") == "4-NOT SPECIFIED",
                     F.format_string("Rights issue from Rs %d to Rs %d", a, b))
               .otherwise("Annual General Meeting"))
    return filed_orders(spark, folder).select(
        "symbol", F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderdate").cast("date").alias("ex_date"),
        subject.alias("subject"))


def corporate_actions(spark: SparkSession, folder: str) -> DataFrame:
    """Each stock's price-changing filing with the largest order of the year."""
    rated = action_filings(spark, folder).withColumn("action", corporate_action(F.col("subject"))).filter(
        F.col("action").isNotNull()).withColumn("_year", F.year("ex_date"))
    return first_per(rated, ["symbol", "_year"], F.col("o_totalprice").desc(), F.col("o_orderkey")).select(
        "symbol", "ex_date", "action.action_type", "action.factor", "subject")


def _scheme_trades(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select(
        "p_partkey", F.regexp_extract("p_brand", r"(\d+)", 1).cast("long").alias("scheme_code"))
    return table(spark, folder, "lineitem").select(
        "l_partkey", F.col("l_shipdate").cast("date").alias("nav_date"), tick().alias("tick"), "l_linestatus",
    ).join(parts, F.col("l_partkey") == F.col("p_partkey"))


def _scheme_names(df: DataFrame) -> DataFrame:
    c = F.col("scheme_code")
    kind = c % 5
    category = (F.when(kind == 0, "Equity Scheme - Large Cap Fund").when(kind == 1, "Debt Scheme - Liquid Fund")
                .when(kind == 2, "Hybrid Scheme - Arbitrage Fund").when(kind == 3, "Solution Oriented Scheme - Children")
                .otherwise("Index Funds"))
    option = F.when(c % 3 == 0, "Growth").when(c % 3 == 1, "IDCW").otherwise("Bonus")
    plan = F.when(c % 2 == 0, "Direct Plan").otherwise("Regular Plan")
    return df.withColumns({
        "scheme_name": F.concat(F.lit("Scheme "), c.cast("string"), F.lit(" - "), plan, F.lit(" - "), option),
        "amc": F.concat(F.lit("House "), (c % 4).cast("string"), F.lit(" Mutual Fund")),
        "category": category,
    })


def fund_nav_daily(spark: SparkSession, folder: str) -> DataFrame:
    daily = _scheme_trades(spark, folder).filter(F.col("l_linestatus") == "O").groupBy("scheme_code", "nav_date").agg(
        (F.max("tick") / TICK).alias("nav"))
    return _scheme_names(daily).withColumn(
        "isin_growth", F.concat(F.lit("INF"), F.lpad(F.col("scheme_code").cast("string"), 5, "0")))


def fund_nav_history(spark: SparkSession, folder: str) -> DataFrame:
    return _scheme_names(_scheme_trades(spark, folder).groupBy("scheme_code", "nav_date").agg(
        (F.min("tick") / TICK).alias("nav")))


def staged_nav(spark: SparkSession, folder: str) -> DataFrame:
    return reference.staged_nav(fund_nav_daily(spark, folder), fund_nav_history(spark, folder))


def index_daily(spark: SparkSession, folder: str) -> DataFrame:
    """One index per part type and size, in names that reach every family."""
    kind, size = F.col("p_type"), F.col("p_size").cast("string")
    name = (F.when(kind == "ECONOMY", F.concat(F.lit("Nifty Midcap "), size))
            .when(kind == "SMALL", F.concat(F.lit("Nifty Smallcap "), size))
            .when(kind == "MEDIUM", F.concat(F.lit("Nifty Bank "), size))
            .when(kind == "LARGE", F.concat(F.lit("India VIX "), size))
            .when(kind == "PROMO", F.concat(F.lit("Nifty G-Sec "), size))
            .otherwise(F.concat(F.lit("Nifty Alpha "), size)))
    parts = table(spark, folder, "part").select("p_partkey", name.alias("index_name"))
    traded = table(spark, folder, "lineitem").select(
        "l_partkey", F.col("l_shipdate").cast("date").alias("trade_date"), tick().alias("tick"),
        F.col("l_quantity").cast("long").alias("quantity"), cents("l_extendedprice").alias("cents"),
    ).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return traded.groupBy("index_name", "trade_date").agg(
        (F.max("tick") / TICK).alias("high"), (F.min("tick") / TICK).alias("low"), F.sum("quantity").alias("volume"),
        (F.sum("cents") / 100_000).alias("turnover_cr"), F.count("*").alias("_n")).select(
        "index_name", "trade_date", F.col("low").alias("open"), "high", "low", F.col("high").alias("close"),
        F.round(F.col("high") - F.col("low"), 4).alias("points_change"),
        rounded(ratio(F.col("high"), F.col("low")) * 100 - 100, 4).alias("pct_change"), "volume", "turnover_cr",
        F.col("_n").cast("double").alias("pe"), F.lit(None).cast("double").alias("pb"),
        F.lit(0.5).alias("div_yield"))


def portfolio(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as an investor's raw transactions, in untidy spelling."""
    is_stock = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    status = F.col("o_orderstatus")
    kind = (F.when(is_stock, F.when(status == "F", " sell ").otherwise("Buy"))
            .when(status == "F", "redeem").when(status == "O", "sip ").otherwise("LUMPSUM"))
    quantity = F.when(is_stock, (F.pmod(F.col("o_orderkey"), F.lit(50)) + 1).cast("double"))
    scheme = F.pmod(F.col("o_orderkey"), F.lit(25)) + 1
    return filed_orders(spark, folder).select(
        F.concat(F.lit(" "), F.col("c_name")).alias("owner"), F.col("o_orderdate").cast("date").alias("date"),
        kind.alias("type"), F.when(is_stock, F.lower("symbol")).otherwise(scheme.cast("string")).alias("symbol"),
        quantity.alias("quantity"),
        F.when(is_stock, (100 + F.pmod(F.col("o_custkey"), F.lit(97))).cast("double")).alias("price"),
        F.when(~is_stock, F.round(F.col("o_totalprice") / 100).cast("double") * 100).alias("amount"),
        F.when(is_stock, "stock").otherwise("mutual_fund").alias("asset_class"))


def holidays(spark: SparkSession, folder: str) -> DataFrame:
    """Days whose largest order was urgent."""
    largest = first_per(
        table(spark, folder, "orders").withColumn("holiday", F.col("o_orderdate").cast("date")), ["holiday"],
        F.col("o_totalprice").desc(), F.col("o_orderkey"))
    return largest.filter(F.col("o_orderpriority") == "1-URGENT").select(
        "holiday", F.concat(F.lit("Closed for order "), F.col("o_orderkey").cast("string")).alias("description"))


def pipeline_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a run log: one run per user and day, the step from the kind of event."""
    kind = F.col("event_type")
    step = (F.when(kind == "click", "extract").when(kind == "view", "silver").when(kind == "purchase", "dbt")
            .when(kind == "signup", "quality").otherwise("alerts"))
    return table(spark, folder, "events").select(
        "event_id", F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("run_id"),
        F.col("ts").cast("date").alias("run_date"), step.alias("step"),
        F.when(F.col("value") > 60, "FAILED").when(F.col("value") < 1, "SKIPPED").otherwise("SUCCESS").alias("status"),
        F.col("ts").alias("started_at"), F.round("value", 1).alias("duration_s"))
