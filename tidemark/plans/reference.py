"""Dimensions: calendar, instruments with history, funds, indices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions import classify
from tidemark.functions.cleaning import date_key
from tidemark.operators.windows import first_per

FIRST_DAY = dt.date(1900, 1, 1)
LAST_DAY = dt.date(9999, 12, 31)
TRACKED = ("company_name", "isin", "face_value", "industry", "series", "in_nifty500")


def latest_master(master: DataFrame) -> DataFrame:
    """Rows of the newest snapshot only; stocks without an industry are 'Unclassified'."""
    newest = master.agg(F.max("snapshot_date").alias("snapshot_date"))
    return (master.join(F.broadcast(newest), "snapshot_date", "left_semi")
            .select("symbol", "company_name", "series", "listing_date", "isin", "face_value",
                    F.coalesce("industry", F.lit(fixed.UNCLASSIFIED)).alias("industry"), "in_nifty500",
                    "snapshot_date"))


def stock_versions(master: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Type-2 history from dated snapshots, taken on ``dates`` (snapshot_date) if some have no row left.

    A version opens when a tracked column changes or the symbol (re)appears, and closes when the next
    version opens or at the first snapshot that no longer has the symbol.
    """
    master = master.withColumn("industry", F.coalesce("industry", F.lit(fixed.UNCLASSIFIED)))
    dates = master.select("snapshot_date").distinct() if dates is None else dates
    # one row per snapshot ever taken: the calendar of snapshots, not of stocks
    following = dates.select(
        "snapshot_date", F.lead("snapshot_date").over(Window.orderBy("snapshot_date")).alias("_next_taken"))
    w = Window.partitionBy("symbol").orderBy("snapshot_date")
    state = F.struct(*TRACKED)
    seen = (master.join(following, "snapshot_date")
            .withColumn("_before", F.lag(state).over(w))
            .withColumn("_expected", F.lag("_next_taken").over(w))
            .withColumn("_opens", F.col("_before").isNull()
                        | ~state.eqNullSafe(F.col("_before"))
                        | (F.col("snapshot_date") != F.col("_expected"))))
    latest_seen = F.lead("snapshot_date").over(w)
    gone = F.when(latest_seen.isNull() | (latest_seen > F.col("_next_taken")), F.col("_next_taken"))
    marked = (seen.withColumn("_gone", gone)
              .withColumn("_version", F.sum(F.col("_opens").cast("int")).over(
                  w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    return marked.groupBy("symbol", "_version").agg(
        *[F.min_by(c, "snapshot_date").alias(c)
          for c in ("company_name", "isin", "series", "face_value", "listing_date", "industry", "in_nifty500")],
        F.min("snapshot_date").alias("opened_on"),
        F.max("_gone").alias("_gone"),
    ).withColumn(
        "closed_on",
        F.coalesce("_gone", F.lead("opened_on").over(Window.partitionBy("symbol").orderBy("_version")))
    ).select("symbol", "company_name", "isin", "series", "face_value", "listing_date", "industry", "in_nifty500",
             "opened_on", "closed_on", F.col("_version").cast("int").alias("version_no"))


def unknown_stock(spark) -> DataFrame:
    return spark.range(1).select(
        F.lit(fixed.UNKNOWN_KEY).alias("stock_sk"), F.lit("UNKNOWN").alias("symbol"),
        F.lit(fixed.UNKNOWN_NAME).alias("company_name"), F.lit(None).cast("string").alias("isin"),
        F.lit(None).cast("string").alias("series"), F.lit(None).cast("double").alias("face_value"),
        F.lit(None).cast("date").alias("listing_date"), F.lit(fixed.UNCLASSIFIED).alias("industry"),
        F.lit(False).alias("in_nifty500"), F.lit(FIRST_DAY).alias("valid_from"), F.lit(LAST_DAY).alias("valid_to"),
        F.lit(True).alias("is_current"), F.lit(1).alias("version_no"))


def dim_stock(master: DataFrame) -> DataFrame:
    """Type-2 dimension of all snapshots."""
    return dim_of_versions(stock_versions(master))


def dim_of_versions(versions: DataFrame) -> DataFrame:
    """First versions reach back to 1900 so that earlier facts find a row; open ones end in 9999."""
    known = versions.select(
        F.md5(F.concat_ws("|", "symbol", F.col("opened_on").cast("string"))).alias("stock_sk"),
        "symbol", "company_name", "isin", "series", "face_value", "listing_date", "industry", "in_nifty500",
        F.when(F.col("version_no") == 1, F.lit(FIRST_DAY)).otherwise(F.col("opened_on")).alias("valid_from"),
        F.coalesce("closed_on", F.lit(LAST_DAY)).alias("valid_to"),
        F.col("closed_on").isNull().alias("is_current"), "version_no")
    return known.unionByName(unknown_stock(versions.sparkSession))


def _fiscal_year(d: Column) -> Column:
    return F.year(d) + F.when(F.month(d) >= 4, 1).otherwise(0)


def dim_date(trading_days: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Calendar from start to max(end, last trade). A weekday inside the loaded range without trades is a holiday."""
    days = trading_days.select("trade_date").distinct()
    span = days.agg(F.min("trade_date").alias("first_trade"), F.max("trade_date").alias("last_trade"))
    d = F.col("date")
    spine = span.select("first_trade", "last_trade", F.explode(F.sequence(
        F.lit(start), F.greatest(F.lit(end), "last_trade"), F.expr("interval 1 day"))).alias("date"))
    traded = F.col("trade_date").isNotNull()
    loaded = d.between(F.col("first_trade"), F.col("last_trade"))
    weekday = F.weekday(d) + 1
    return spine.join(days, spine["date"] == days["trade_date"], "left").select(
        date_key("date").alias("date_key"), d, F.year(d).alias("year"), F.quarter(d).alias("quarter"),
        F.month(d).alias("month"), F.date_format(d, "MMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"), F.weekofyear(d).alias("iso_week"),
        weekday.alias("day_of_week"), F.date_format(d, "EEE").alias("day_name"), (weekday >= 6).alias("is_weekend"),
        F.concat(F.lit("FY"), F.right(_fiscal_year(d).cast("string"), F.lit(2))).alias("fiscal_year"),
        F.quarter(F.add_months(d, -3)).alias("fiscal_quarter"),
        traded.alias("is_trading_day"),
        (~traded & (weekday < 6) & loaded).alias("is_nse_holiday"),
        loaded.alias("in_loaded_range"))


def staged_nav(daily: DataFrame, history: DataFrame) -> DataFrame:
    """Both NAV sources in one table; the daily file wins where both have the day."""
    columns = ["scheme_code", "nav_date", "nav", "scheme_name", "amc", "category"]
    both = (daily.select(*columns, "isin_growth").withColumn("src_priority", F.lit(0))
            .unionByName(history.select(*columns).withColumn("src_priority", F.lit(1)), allowMissingColumns=True))
    return first_per(both, ["scheme_code", "nav_date"], F.col("src_priority"))


def dim_fund(nav: DataFrame) -> DataFrame:
    newest = first_per(nav, ["scheme_code"], F.col("nav_date").desc(), F.col("src_priority"))
    category, name = F.col("category"), F.col("scheme_name")
    return newest.select(
        "scheme_code", "scheme_name", "amc", "category", classify.asset_class(category).alias("asset_class"),
        classify.sub_category(category).alias("sub_category"), classify.plan_type(name).alias("plan"),
        classify.option_type(name).alias("option_type"), "isin_growth", F.col("nav_date").alias("latest_nav_date"),
        F.col("nav").alias("latest_nav"))


def dim_index(index_daily: DataFrame) -> DataFrame:
    name = F.col("index_name")
    return index_daily.select("index_name").distinct().select(
        F.md5(name).alias("index_sk"), "index_name", classify.index_family(name).alias("index_family"))


def staged_announcements(announcements: DataFrame) -> DataFrame:
    return announcements.select(
        "seq_id", "symbol", "announced_at", F.to_date("announced_at").alias("announced_date"), "category", "summary",
        "attachment_url", classify.news_type(F.col("category"), F.col("summary")).alias("news_type"))


def staged_indices(index_rows: DataFrame) -> DataFrame:
    return index_rows.select("trade_date", "index_name", "open", "high", "low", "close", "points_change", "pct_change",
                             "volume", "turnover_cr", "pe", "pb", "div_yield")


def staged_actions(actions: DataFrame) -> DataFrame:
    return actions.select("symbol", "ex_date", "action_type", "factor", "subject")


def staged_lists(lists: DataFrame) -> DataFrame:
    return lists.select("snapshot_date", "symbol", "list_type", "stage", "description")


def symbol_directory(fact: DataFrame, stocks: DataFrame) -> DataFrame:
    """Every traded symbol with its latest known name and mean turnover."""
    names = stocks.select("stock_sk", "company_name")
    per_key = fact.groupBy("symbol", "stock_sk").agg(
        F.sum("turnover_lacs").alias("_turnover"), F.count("turnover_lacs").alias("_days"))
    return (per_key.join(names, "stock_sk").groupBy("symbol")
            .agg(F.max("company_name").alias("company_name"),
                 F.try_divide(F.sum("_turnover"), F.sum("_days")).alias("avg_turnover_lacs")))
