"""Raw files to typed, deduplicated, upserted tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.facts import adjusted_prices
from tidemark.sources import bronze, store
from tidemark.sources.bronze import Days, unique

PRICE_KEYS = ["trade_date", "symbol", "series"]
REJECT_REASON = "null/non-positive close or high<low"


def is_bad() -> Column:
    """Rows that may not enter the price table; a missing high or low counts as bad rather than vanishing."""
    close, high, low = F.col("close"), F.col("high"), F.col("low")
    return F.coalesce(F.col("trade_date").isNull() | F.col("symbol").isNull() | close.isNull() | (close <= 0)
                      | (high < low), F.lit(True))


def split_rejects(prices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their reason)."""
    judged = prices.withColumn("_bad", is_bad())
    return (judged.filter(~F.col("_bad")).drop("_bad"),
            judged.filter("_bad").drop("_bad").withColumn("_reason", F.lit(REJECT_REASON)))


def _row_hash(columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("_ingested_at", F.current_timestamp())


def _by_month(df: DataFrame, day: str) -> DataFrame:
    """With the first day of the month, by which tables are partitioned: a few files a month, whatever a day holds."""
    return df.withColumn("month", F.trunc(day, "month"))


def reject_counts() -> list[Column]:
    """Good rows, rejected rows, and how many are rejected for what; a row may fall under several."""
    close, high, low = F.col("close"), F.col("high"), F.col("low")
    reasons = {"no_date": F.col("trade_date").isNull(), "no_symbol": F.col("symbol").isNull(), "no_close": close.isNull(),
               "close_not_positive": close <= 0, "no_range": high.isNull() | low.isNull(), "high_below_low": high < low}
    return [F.count_if(~is_bad()).alias("good"), F.count_if(is_bad()).alias("rejected"),
            *(F.count_if(F.coalesce(test, F.lit(False))).alias(name) for name, test in reasons.items())]


def store_prices(prices: DataFrame, lake: str) -> DataFrame:
    """Good rows into the price table, the others with their reason into quarantine, the counts of both into the log.

    Every rejected row is kept, also those whose keys are missing or equal: a row's key in quarantine is the hash of
    all it holds, so running a batch again replaces its rows by themselves. The counts are observed by the job that
    writes the batch down.
    """
    seen = Observation()
    batch = store.settle(prices.observe(seen, *reject_counts()), "prices")
    good, rejects = split_rejects(batch)
    counts = seen.get
    if counts["rejected"]:
        rejects = _by_month(rejects.withColumn("_row", _row_hash(prices.columns)), "trade_date")
        store.upsert(_stamped(rejects), f"{lake}/_quarantine_stock_daily", ["month", "_row"], "month")
    stored = store.upsert(_stamped(_by_month(unique(good, PRICE_KEYS), "trade_date")), f"{lake}/stock_daily", ["month", *PRICE_KEYS], "month")
    log = prices.sparkSession.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))
    store.append(_stamped(log), f"{lake}/_ingest_log")
    return stored


def build_stock_daily(spark: SparkSession, raw: str, lake: str, days: Days = None) -> DataFrame | None:
    prices = bronze.prices(spark, raw, days)
    return None if prices is None else store_prices(prices, lake)


def _build(lake: str, table: str, df: DataFrame | None, keys: list[str], day: str, newest: str | None = None):
    """Upsert into a table by months of ``day``; the month is part of the key where the day is."""
    if df is None:
        return None
    parts = ["month"] * (day in keys)
    return store.upsert(_stamped(_by_month(unique(df, keys), day)), f"{lake}/{table}", [*parts, *keys], "month", newest)


def build_index_daily(spark: SparkSession, raw: str, lake: str, days: Days = None) -> DataFrame | None:
    return _build(lake, "index_daily", bronze.indices(spark, raw, days), ["trade_date", "index_name"], "trade_date")


def build_fund_nav(spark: SparkSession, raw: str, lake: str, days: Days = None) -> DataFrame | None:
    nav = bronze.fund_nav(spark, raw, days)
    return _build(lake, "fund_nav", None if nav is None else nav.filter("nav > 0"), ["scheme_code", "nav_date"], "nav_date")


def build_fund_nav_history(spark: SparkSession, raw: str, lake: str) -> DataFrame | None:
    """Rows of the newest folder's documents; those that cannot be read are set apart under their file's name."""
    documents = bronze.history_documents(spark, raw)
    if documents is None:
        return None
    seen = Observation()
    documents = store.settle(documents.observe(seen, F.count("broken").alias("broken")), "history-documents")
    if seen.get["broken"]:
        broken = documents.where("broken is not null").select("file", F.col("broken").alias("text"))
        store.upsert(_stamped(broken), f"{lake}/_quarantine_fund_nav_history", ["file", "text"])
    return _build(lake, "fund_nav_history", bronze.history_rows(documents), ["scheme_code", "nav_date"], "nav_date")


def build_stock_master(spark: SparkSession, raw: str, lake: str, days: Days = None) -> DataFrame | None:
    master = bronze.stock_master(spark, raw, days)
    if master is None:
        return None
    keys = ["snapshot_date", "symbol"]
    return store.upsert(_stamped(unique(master, keys)), f"{lake}/stock_master", keys, "snapshot_date")


def build_corporate_actions(spark: SparkSession, raw: str, lake: str, days: Days = None) -> DataFrame | None:
    """Of actions that landed several times the one in the newest folder stays, in whatever order folders are read."""
    return _build(lake, "corporate_actions", bronze.corporate_actions(spark, raw, days),
                  ["symbol", "ex_date", "action_type"], "ex_date", "_landed")


def build_announcements(spark: SparkSession, raw: str, lake: str, days: Days = None) -> DataFrame | None:
    """Filings from overlapping windows, one per ``seq_id``: the one in the newest folder, also if it moved to another
    month, and whatever the order in which folders are read.
    """
    return _build(lake, "announcements", bronze.announcements(spark, raw, days), ["seq_id"], "announced_at", "_landed")


def build_surveillance_lists(spark: SparkSession, raw: str, lake: str) -> DataFrame | None:
    """Rebuilt whole, so that a snapshot withdrawn from the raw files disappears here too."""
    lists = bronze.surveillance_lists(spark, raw)
    if lists is None:
        return None
    path = f"{lake}/surveillance_lists"
    store.rebuild(unique(lists, ["snapshot_date", "symbol", "list_type"]), path)
    return store.read_table(spark, path, lists.schema)


def build_stock_daily_adjusted(spark: SparkSession, lake: str) -> DataFrame | None:
    """Rebuilt whole: one new split changes every earlier price of its stock."""
    prices = store.read_table(spark, f"{lake}/stock_daily")
    if prices is None:
        return None
    actions = store.read_table(spark, f"{lake}/corporate_actions")
    if actions is None:
        actions = spark.createDataFrame([], "symbol string, ex_date date, factor double")
    path = f"{lake}/stock_daily_adjusted"
    adjusted = adjusted_prices(prices, actions)
    store.rebuild(adjusted, path, "month")
    return store.read_table(spark, path, adjusted.schema)


def build_all(spark: SparkSession, raw: str, lake: str, days: Days = None) -> dict[str, DataFrame | None]:
    out = {
        "stock_daily": build_stock_daily(spark, raw, lake, days),
        "index_daily": build_index_daily(spark, raw, lake, days),
        "fund_nav": build_fund_nav(spark, raw, lake, days),
        "fund_nav_history": build_fund_nav_history(spark, raw, lake),
        "stock_master": build_stock_master(spark, raw, lake),
        "corporate_actions": build_corporate_actions(spark, raw, lake),
        "announcements": build_announcements(spark, raw, lake),
        "surveillance_lists": build_surveillance_lists(spark, raw, lake),
    }
    out["stock_daily_adjusted"] = build_stock_daily_adjusted(spark, lake)
    return out
