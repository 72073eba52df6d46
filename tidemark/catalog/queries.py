"""Every registered query: (spark, folder) -> DataFrame over the whole tables of the folder."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalog import domain, rawtext
from tidemark.catalog.warehouse import DEFAULT, RELAXED, Warehouse
from tidemark.functions.classify import corporate_action
from tidemark.functions.cleaning import rounded
from tidemark.operators import checks
from tidemark.operators.asof import between_join
from tidemark.operators.windows import first_per
from tidemark.params import QualityParams, SurveillanceParams
from tidemark.plans import (calendar, daily, facts, funds, ingest, portfolio, quality, reference, screens, signals, triage,
                            validation)
from tidemark.session import checkpoint_dir
from tidemark.sources import bronze, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_DATE = dt.date(2001, 6, 29)
CALENDAR = (dt.date(1994, 12, 1), dt.date(2001, 12, 31))
LOOSE_QUALITY = QualityParams(min_stocks_per_trading_day=12, big_move_pct=20.0, continuity_limit=0.05)


def query(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Warehouse.of(spark, folder))
    return build


# ---------- prices, dimensions, facts ----------

@query
def bars(w):
    return w.source(domain.bars)


@query
def stock_metrics(w):
    return w.fact().withColumn("avg_deliv_pct_20d", rounded("avg_deliv_pct_20d", 6))


@query
def sector_performance(w):
    return funds.sector_performance(w.fact(), w.stocks())


@query
def split_adjust(w):
    return facts.adjusted_prices(w.source(domain.series_bars), w.actions()).select(
        "trade_date", "symbol", "series", "adj_factor", "adj_open", "adj_high", "adj_low", "adj_close",
        "adj_prev_close", "adj_vwap", "adj_volume")


@query
def staged_prices(w):
    return facts.staged_prices(facts.adjusted_prices(w.source(domain.series_bars), w.actions()))


@query
def corporate_action_factor(w):
    found = w.source(domain.action_filings).withColumn("action", corporate_action(F.col("subject")))
    return found.select("o_orderkey", "symbol", "ex_date", "subject", "action.action_type",
                        rounded("action.factor", 6).alias("factor"))


@query
def corporate_actions(w):
    return w.actions().withColumn("factor", rounded("factor", 6))


@query
def scd2_dim_stock(w):
    return w.stocks()


@query
def latest_stock_master(w):
    return reference.latest_master(w.stock_master())


@query
def scd2_fact_join(w):
    versions = w.stocks().select(F.col("symbol").alias("listed_symbol"), "stock_sk", "company_name", "industry",
                                 "version_no", "valid_from", "valid_to")
    prices = w.fact().select("trade_date", "symbol", "close").withColumn("listed_symbol", F.col("symbol"))
    dated = between_join(prices, versions, ["listed_symbol"], "trade_date", "valid_from", "valid_to")
    return dated.select("trade_date", "symbol", "close", F.coalesce("stock_sk", F.lit("unknown")).alias("stock_sk"),
                        "company_name", "industry", "version_no")


@query
def dim_date(w):
    return reference.dim_date(w.fact(), dt.date(1994, 1, 1), dt.date(2002, 3, 31))


@query
def dim_fund(w):
    return w.funds()


@query
def dim_index(w):
    return reference.dim_index(w.indices())


@query
def fact_index_daily(w):
    return facts.index_daily(w.indices(), reference.dim_index(w.indices()))


@query
def staged_nav(w):
    return w.staged_nav()


@query
def fact_fund_nav(w):
    return w.fund_nav()


@query
def news_classifier(w):
    return w.filings()


# ---------- signals and alerts ----------

@query
def volume_zscore(w):
    return w.signals(DEFAULT).select("trade_date", "symbol", "volume", "volume_ratio_20d", "volume_z")


@query
def peer_move(w):
    return w.signals(DEFAULT).select("trade_date", "symbol", "industry", "return_pct", "peer_return_pct", "price_z")


@query
def signals_default(w):
    return w.signals(DEFAULT)


@query
def signals_relaxed(w):
    return w.signals(RELAXED)


@query
def facts_by_day(w):
    return daily.stored(w.spark, w.taken_by_day(RELAXED), "facts").withColumn(
        "avg_deliv_pct_20d", rounded("avg_deliv_pct_20d", 6))


@query
def signals_by_day(w):
    return daily.stored(w.spark, w.taken_by_day(RELAXED), "signals")


def _fired(w, flag: str, *columns: str):
    return w.signals(RELAXED).filter(F.col(flag)).select("trade_date", "symbol", *columns)


@query
def rule_volume_spike(w):
    return _fired(w, "r_volume_spike", "volume", "volume_ratio_20d")


@query
def rule_price_shock(w):
    return _fired(w, "r_price_shock", "return_pct", "peer_return_pct")


@query
def rule_pump(w):
    return _fired(w, "r_pump", "return_5d_pct", "volume_ratio_5d", "deliv_pct_5d", "deliv_pct_20d_avg")


@query
def rule_dump_after_pump(w):
    return _fired(w, "r_dump_after_pump", "return_pct", "return_3d_pct")


@query
def rule_delivery(w):
    return _fired(w, "r_delivery_anomaly", "deliv_pct", "deliv_pct_20d_avg", "volume_ratio_20d")


@query
def rule_circuit_streak(w):
    return _fired(w, "r_circuit_streak", "close", "return_pct", "circuit_streak")


@query
def rule_gap(w):
    return _fired(w, "r_gap_move", "gap_pct", "return_pct")


@query
def alerts_flat(w):
    return w.alerts(DEFAULT)


@query
def alerts_hybrid(w):
    return w.alerts(SurveillanceParams(baseline="hybrid"))


@query
def alerts_per_stock(w):
    return w.alerts(SurveillanceParams(baseline="per_stock"))


@query
def alert_reasons(w):
    return w.alerts(RELAXED).select("alert_id", "trade_date", "symbol", "risk_score", "risk_band", "rules_triggered",
                                    "reason")


@query
def alert_news(w):
    return w.alerts(RELAXED).select("alert_id", "trade_date", "symbol", "news_types", "material_news_count",
                                    "exchange_query")


@query
def score_breakdown(w):
    return signals.score_breakdown(w.alerts(RELAXED))


# ---------- validation ----------

@query
def alert_outcomes(w):
    return w.outcomes(RELAXED)


@query
def surveillance_validation(w):
    return w.validated(RELAXED)


@query
def validation_headline(w):
    return validation.headline(w.validated(RELAXED))


@query
def lead_histogram(w):
    return validation.lead_histogram(w.outcomes(RELAXED))


@query
def acted_on_high(w):
    return validation.acted_on_high(w.outcomes(RELAXED))


@query
def baseline_ablation(w):
    return validation.ablation(w.measures(RELAXED), w.filings(), w.lists(), RELAXED)


@query
def event_study_5d(w):
    return w.events(RELAXED).withColumns({"ret": rounded("ret", 4), "market_ret": rounded("market_ret", 4)})


@query
def event_summary(w):
    return validation.event_summary(w.events(RELAXED))


@query
def event_pnl(w):
    return validation.event_pnl(w.events(RELAXED))


@query
def outcome_stats(w):
    return validation.outcome_stats(w.alerts(RELAXED), w.fact())


# ---------- funds and portfolio ----------

@query
def fund_returns(w):
    known = funds.established(w.fund_nav())
    found = funds.horizon_returns(known)
    return found.select("scheme_code", *[rounded(c, 6).alias(c) for c in found.columns[1:]])


@query
def fund_drawdown(w):
    return funds.max_drawdown(w.fund_nav()).withColumn("max_drawdown_3y", rounded("max_drawdown_3y", 6))


@query
def fund_rolling_1y(w):
    found = funds.rolling_year(w.fund_nav())
    return found.select("scheme_code", *[rounded(c, 6).alias(c) for c in found.columns[1:]])


@query
def fund_performance(w):
    return w.fund_performance()


@query
def portfolio_txn_staged(w):
    return w.staged_txns()


@query
def portfolio_txn_asof(w):
    return w.txns().withColumns({"quantity": rounded("quantity", 6)})


@query
def portfolio_holdings(w):
    return w.holdings()


@query
def portfolio_xirr(w):
    return portfolio.money_weighted(w.txns(), w.holdings())


@query
def sip_tracker(w):
    return portfolio.instalments(w.txns(), w.fund_nav(), w.funds())


@query
def symbols_held(w):
    return portfolio.symbols_held(w.txns())


def _paper(w):
    quantity = (F.pmod(F.col("o_orderkey"), F.lit(50)) + 1).cast("double")
    price = (100 + F.pmod(F.col("o_custkey"), F.lit(97))).cast("double")
    bought = w.source(domain.filed_orders).filter(F.col("o_orderstatus") == "O")
    return bought.select("symbol", F.col("o_orderdate").cast("date").alias("date"), quantity.alias("qty"),
                         price.alias("price"), (quantity * price).alias("amount"))


@query
def paper_mark_to_market(w):
    return portfolio.mark_to_market(_paper(w), w.fact())


@query
def paper_totals(w):
    return portfolio.paper_totals(portfolio.mark_to_market(_paper(w), w.fact()))


# ---------- screens ----------

@query
def stock_check(w):
    return w.stock_checks(RELAXED)


@query
def stock_levels(w):
    return w.stock_levels(RELAXED)


def _owned(w):
    held = w.txns().filter(F.col("asset_class") == "STOCK")
    return held.select("owner", F.col("instrument_id").alias("symbol")).distinct()


@query
def portfolio_scan(w):
    return screens.portfolio_scan(_owned(w), w.stock_levels(RELAXED))


@query
def portfolio_scan_counts(w):
    return screens.level_counts(screens.portfolio_scan(_owned(w), w.stock_levels(RELAXED)))


@query
def symbol_directory(w):
    return w.directory().withColumn("avg_turnover_lacs", rounded("avg_turnover_lacs", 4))


@query
def resolve_names(w):
    words = F.split("company_name", " ")
    kind = F.pmod(F.col("version_no"), F.lit(4))
    typed = w.stocks().select(
        F.when(kind == 0, F.concat(F.lit(" "), F.lower("symbol"), F.lit(".ns ")))
        .when(kind == 1, F.concat_ws(" ", F.get(words, F.lit(0)), F.get(words, F.lit(1))))
        .when(kind == 2, F.lower(F.concat_ws(" ", F.get(words, F.lit(0)), F.substring(F.get(words, F.lit(1)), 1, 3))))
        .otherwise(F.get(words, F.lit(1))).alias("token"))
    others = domain.table(w.spark, w.folder, "customer").select(F.col("c_name").alias("token"))
    return screens.resolve_names(typed.unionByName(others), w.directory())


@query
def day_overview(w):
    return screens.day_overview(w.alerts(RELAXED))


@query
def market_map(w):
    return screens.market_map(w.alerts(RELAXED), w.triage(RELAXED))


@query
def filter_alerts(w):
    chosen = screens.filter_alerts(w.alerts(RELAXED), ["HIGH", "MEDIUM"], ["PUMP_PATTERN", "CIRCUIT_STREAK"], False)
    return chosen.select("alert_id", "trade_date", "symbol", "risk_band", "rules_triggered")


@query
def rule_counts(w):
    return screens.rule_counts(w.alerts(RELAXED))


@query
def stock_timeline(w):
    return screens.timeline(w.fact(), w.alerts(RELAXED))


@query
def latest_filings(w):
    return screens.latest_filings(w.filings())


@query
def watch_suggestions(w):
    return screens.watch_suggestions(w.alerts(RELAXED))


# ---------- triage and digest ----------

@query
def triage_rules(w):
    return triage.rule_triage(w.alerts(RELAXED)).select("alert_id", "trade_date", "symbol", "verdict", "line", "source")


@query
def triage_replies(w):
    return w.triage(RELAXED)


@query
def triage_cache(w):
    third = F.pmod(F.col("date_key"), F.lit(3))
    ruled = triage.rule_triage(w.alerts(RELAXED))
    cached = ruled.filter(third < 2).withColumns({
        "verdict": F.when(third == 0, F.col("verdict")).otherwise("EXPLAINED"),
        "source": F.when(third == 0, F.col("source")).otherwise("llm:m0")})
    return triage.merge_cache(cached, w.triage(RELAXED))


@query
def triage_context(w):
    return triage.filings_context(w.alerts(RELAXED), w.filings())


@query
def day_alerts(w):
    return triage.day_alerts(w.alerts(RELAXED), w.triage(RELAXED))


@query
def digest_watchlist(w):
    return triage.watchlist(w.alerts(RELAXED)).select("trade_date", "position", "symbol", "risk_score",
                                                      "rules_triggered", "news_types", "exchange_query")


@query
def digest_lines(w):
    day = triage.day_alerts(w.alerts(RELAXED), w.triage(RELAXED))
    return triage.digest(day, w.alerts(RELAXED), w.daily_checks())


# ---------- calendar, quality, operations ----------

@query
def trading_calendar(w):
    return calendar.calendar(w.holidays(), *CALENDAR)


@query
def dq_missing_days(w):
    seen = domain.table(w.spark, w.folder, "orders").filter(F.col("o_totalprice") < 450000).select(
        F.col("o_orderdate").cast("date").alias("trade_date"))
    return quality.missing_days(seen, w.holidays(), RUN_DATE)


@query
def dq_stale(w):
    return quality.stale_prices(w.fact(), w.holidays(), dt.date(2001, 11, 30)).unionByName(
        quality.stale_nav(w.fund_nav(), dt.date(2001, 11, 9)))


@query
def dq_row_count(w):
    return quality.daily_row_counts(w.fact()).withColumn("usual", rounded("usual", 4))


@query
def dq_unexplained_moves(w):
    return quality.unexplained_moves(w.fact(), w.actions(), LOOSE_QUALITY)


@query
def dq_big_moves(w):
    return quality.big_moves(w.fact(), w.actions(), dt.date(1996, 3, 5), QualityParams(big_move_pct=3.0))


@query
def dq_duplicates(w):
    return checks.duplicates(domain.table(w.spark, w.folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_short_days(w):
    return checks.short_days(w.fact(), "trade_date", LOOSE_QUALITY.min_stocks_per_trading_day)


@query
def dq_relationships(w):
    listed = w.stocks().filter(F.col("version_no") > 3)
    return checks.orphans(w.fact(), "stock_sk", listed, "stock_sk").select("trade_date", "symbol", "stock_sk")


@query
def dq_accepted_values(w):
    return checks.outside(w.txns(), "txn_type", ["BUY", "SELL", "SIP"])


@query
def dq_expression(w):
    return checks.breaking(w.fact(), F.col("return_pct").between(-10, 10)).select("trade_date", "symbol", "return_pct")


@query
def dq_nulls(w):
    return checks.nulls(w.txns(), "unit_price").select("txn_id", "owner", "txn_date", "instrument_id")


@query
def dq_continuity(w):
    found = quality.continuity(w.fact(), w.actions(), LOOSE_QUALITY)
    return found.withColumn("factor", rounded("factor", 6))


def _tests(w):
    tables = {
        "dim_stock": w.stocks(), "dim_fund": w.funds(), "fact_stock_daily": w.fact(), "fact_fund_nav": w.fund_nav(),
        "fact_portfolio_txn": w.txns(), "fact_surveillance_alert": w.alerts(RELAXED),
        "int_alert_outcomes": w.outcomes(RELAXED), "mart_surveillance_validation": w.validated(RELAXED),
        "mart_portfolio_holdings": w.holdings(), "mart_fund_performance": w.fund_performance(),
        "dim_date": store.settle(dim_date(w), "dim_date"), "dim_index": store.settle(dim_index(w), "dim_index"),
        "fact_index_daily": store.settle(fact_index_daily(w), "fact_index_daily"), "int_surveillance_signals": store.settle(w.signals(RELAXED).select("trade_date", "symbol"), "signals"),
        "mart_sector_performance": store.settle(sector_performance(w), "sector_performance")}
    return quality.model_tests(tables, frozenset({"fact_stock_daily.complete_days"}), LOOSE_QUALITY)


@query
def dq_model_tests(w):
    return _tests(w)


@query
def dq_summary(w):
    return quality.model_test_summary(store.settle(_tests(w), "tests"))


@query
def pipeline_steps(w):
    return quality.step_seconds(w.runs(), None)


@query
def pipeline_steps_recent(w):
    return quality.step_seconds(w.runs())


@query
def pipeline_last_run(w):
    return quality.last_run(w.runs())


@query
def data_coverage(w):
    return quality.coverage(w.fact())


@query
def coverage_sketches(w):
    """Distinct traded parts of every month from merged day sketches, held against exact counts."""
    trades = domain.table(w.spark, w.folder, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"), "l_partkey")
    sketches = store.settle(quality.day_sketches(trades, "day", "l_partkey"), "day-sketches")
    month = F.trunc("day", "month").alias("month")
    exact = trades.groupBy(month).agg(F.count_distinct("l_partkey").alias("exact"))
    return quality.merged_sketches(sketches, month).join(exact, "month").select(
        "month", "days", (F.abs(F.col("estimate") - F.col("exact")) <= 0.05 * F.col("exact")).alias("within_bound"))


@query
def latest_check_batch(w):
    written = w.runs().select(F.col("step").alias("check_name"), "status", F.col("started_at").alias("checked_at"))
    return quality.latest_batch(written)


@query
def freshness(w):
    return quality.freshness(w.runs(), "started_at", dt.datetime(2024, 2, 4)).withColumn(
        "_latest", F.col("_latest").cast("date"))


# ---------- ingest ----------

@query
def price_rows_clean(w):
    good, _ = ingest.split_rejects(w.typed_prices())
    return bronze.unique(good, ingest.PRICE_KEYS)


@query
def price_files_stored(w):
    """Price files read, cleaned, upserted, and the newest of them upserted again; the table as it then lies on disk."""
    return w.lake_table("stock_daily")


@query
def price_files_quarantined(w):
    return w.lake_table("stock_daily", "_quarantine_stock_daily").drop("_row").withColumnRenamed("_reason", "reason")


@query
def price_file_counts(w):
    """The log of both runs: counts observed by the jobs that wrote the batches."""
    return w.lake_table("stock_daily", "_ingest_log")


@query
def index_files_stored(w):
    return w.lake_table("index_daily")


@query
def filing_files_stored(w):
    """Filings from JSON arrays in overlapping windows, with drafts, corrections and a folder that comes late."""
    return w.lake_table("announcements").withColumn("announced_at", F.date_format("announced_at", "yyyy-MM-dd HH:mm:ss"))


@query
def action_files_stored(w):
    return w.lake_table("corporate_actions").withColumn("factor", rounded("factor", 6))


@query
def nav_files_stored(w):
    return w.lake_table("fund_nav")


@query
def history_files_stored(w):
    return w.lake_table("fund_nav_history")


@query
def history_files_broken(w):
    """Documents of the newest snapshot that could not be read."""
    broken = w.lake_table("fund_nav_history", "_quarantine_fund_nav_history")
    return broken.select(F.regexp_extract("text", r'"scheme_code" : "(\d+)"', 1).cast("long").alias("scheme_code"))


@query
def master_files_stored(w):
    return w.lake_table("stock_master")


@query
def holiday_files(w):
    raw = f"{checkpoint_dir(w.spark)}/files-{uuid.uuid4().hex}"
    rawtext.write_holidays(w.holidays(), raw)
    return bronze.holidays(w.spark, raw)


@query
def portfolio_file_staged(w):
    path = f"{checkpoint_dir(w.spark)}/files-{uuid.uuid4().hex}"
    w.source(domain.portfolio).select("owner", "date", "type", "symbol", "quantity", "price", "amount", "asset_class").write.option(
        "header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return facts.staged_transactions(bronze.portfolio(w.spark, path))


@query
def scd2_merged(w):
    """The instrument dimension from a history merged snapshot by snapshot."""
    return reference.dim_of_versions(w.merged_versions())


@query
def reject_split(w):
    _, rejects = ingest.split_rejects(w.typed_prices())
    return rejects.withColumnRenamed("_reason", "reason")


@query
def dq_quarantine(w):
    _, rejects = ingest.split_rejects(w.typed_prices())
    return quality.quarantined(rejects, RUN_DATE, w.spark)


@query
def nav_text_parse(w):
    return bronze.parse_nav_lines(w.source(rawtext.nav_lines))


@query
def surveillance_lists_flatten(w):
    return bronze.flatten_lists(*rawtext.nested_lists(w.lists()))


@query
def wide_price_reshape(w):
    wide = w.fact().join(w.stocks().select("stock_sk", "industry"), "stock_sk").groupBy(
        F.col("trade_date").alias("Date")).agg(*[
            agg for name in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
            for agg in (F.max(F.when(F.col("industry") == name, F.col("close"))).alias(f"{name}|Close"),
                        F.sum(F.when(F.col("industry") == name, F.col("volume"))).cast("double")
                        .alias(f"{name}|Total Volume"))])
    return bronze.long_prices(wide)


@query
def watched_funds(w):
    chosen = w.funds().filter(F.col("plan") == "Direct").select("scheme_code", F.col("scheme_name").alias("label"))
    return bronze.watched(w.staged_nav().select("scheme_code", "nav_date", "nav"), chosen)


@query
def upsert_idempotent(w):
    trades = domain.table(w.spark, w.folder, "lineitem").groupBy(
        "l_linestatus", "l_partkey", F.col("l_shipdate").cast("date").alias("trade_date")).agg(
        F.count("*").alias("trades"), F.sum(F.col("l_quantity").cast("long")).alias("volume"))
    old = trades.filter(F.col("l_linestatus") == "F")
    new = trades.filter(F.col("l_linestatus") == "O")
    keys = ["l_partkey", "trade_date"]
    return store.merged(store.merged(old, new, keys), new, keys)


@query
def main_series(w):
    ranked = w.source(domain.series_bars).select("symbol", "trade_date", "series", "close", "volume")
    return first_per(ranked, ["symbol", "trade_date"], F.col("volume").desc(), F.col("series"))
