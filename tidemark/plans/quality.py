"""Pipeline-level checks, each one row (check_name, status, value, detail), and the run log reports."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions import text
from tidemark.functions.cleaning import rounded
from tidemark.operators import checks
from tidemark.operators.windows import by_date, rows
from tidemark.params import QualityParams
from tidemark.plans.calendar import expected_days


def _result(df: DataFrame, name: str, status: Column, value: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), status.alias("status"), value.cast("double").alias("value"),
                     detail.alias("detail"))


def _grade(value: Column, *limits: tuple[Column, str], otherwise: str = "FAIL") -> Column:
    chain = F.when(limits[0][0], limits[0][1])
    for test, status in limits[1:]:
        chain = chain.when(test, status)
    return chain.otherwise(otherwise)


def missing_days(present: DataFrame, holidays: DataFrame, run_date: dt.date, days: int = 14) -> DataFrame:
    """Expected trading days in the last `days` days without a day of files."""
    expected = expected_days(holidays, run_date - dt.timedelta(days=days), run_date)
    marked = expected.join(present.select(F.col("trade_date").alias("_have")).distinct(),
                           F.col("trade_date") == F.col("_have"), "left").agg(
        F.count("*").alias("_all"), F.count_if(F.col("_have").isNull()).alias("_missing"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("_have").isNull(), F.col("trade_date").cast("string")))),
                     ", ").alias("_list"))    # at most the days of the span
    n = F.col("_missing")
    return _result(marked, "missing_bhavcopy_files", _grade(n, (n == 0, "PASS")), n,
                   F.when(n == 0, text.phrase("all %s trading days in the last %s days present",
                                              F.col("_all").cast("string"), F.lit(str(days))))
                   .otherwise(F.concat(F.lit("missing: "), F.col("_list"))))


def stale_prices(fact: DataFrame, holidays: DataFrame, run_date: dt.date) -> DataFrame:
    """Trading days between the newest price and the newest day there should be one for."""
    newest = fact.agg(F.max("trade_date").alias("_latest"))
    run = F.lit(run_date)
    # from the newest price on, however old it is; a year back at least, so that the day expected is among them
    start = F.least(F.coalesce("_latest", run), F.date_sub(run, 366))
    closed = holidays.select(F.col("holiday").alias("trade_date")).distinct()
    spine = newest.select("_latest", F.explode(F.sequence(start, run, F.expr("interval 1 day"))).alias("trade_date"))
    due = spine.filter(F.weekday("trade_date") < 5).join(closed, "trade_date", "left_anti").agg(
        F.max("_latest").alias("_latest"), F.max("trade_date").alias("_expected"),
        F.count_if(F.col("trade_date") > F.col("_latest")).alias("_behind"))
    lag = F.when(F.col("_latest").isNull(), 99).otherwise(F.col("_behind"))
    return _result(due, "stale_stock_prices", _grade(lag, (lag == 0, "PASS"), (lag == 1, "WARN")), lag,
                   text.phrase("latest trade_date %s, expected %s (%s trading days behind)",
                               F.coalesce(F.col("_latest").cast("string"), F.lit("None")),
                               F.col("_expected").cast("string"), lag.cast("string")))


def stale_nav(nav: DataFrame, run_date: dt.date) -> DataFrame:
    newest = nav.agg(F.max("nav_date").alias("_latest"))
    age = F.coalesce(F.date_diff(F.lit(run_date), "_latest"), F.lit(99))
    return _result(newest, "stale_fund_nav", _grade(age, (age <= 4, "PASS"), (age <= 7, "WARN")), age,
                   text.phrase("latest NAV date %s (%s days old)",
                               F.coalesce(F.col("_latest").cast("string"), F.lit("None")), age.cast("string")))


def daily_row_counts(fact: DataFrame) -> DataFrame:
    """Stocks per day beside the mean of the 20 days before, graded, for every day."""
    counts = fact.groupBy("trade_date").agg(F.count("*").alias("stocks"))
    w = Window.orderBy("trade_date")    # one row per day
    usual = F.avg("stocks").over(rows(w, -20, -1))
    ratio = F.col("stocks") / F.col("usual")
    return counts.withColumn("usual", usual).withColumn("ratio", rounded(ratio, 3)).withColumn(
        "status", _grade(ratio, (F.col("usual").isNull(), "WARN"), (ratio >= 0.9, "PASS"), (ratio >= 0.8, "WARN")))


def row_count(fact: DataFrame, run_date: dt.date) -> DataFrame:
    day = F.col("trade_date") <= F.lit(run_date)
    last = daily_row_counts(fact.filter(day)).agg(
        *[F.max_by(c, "trade_date").alias(c) for c in ("stocks", "usual", "ratio", "status")])
    known = F.col("usual").isNotNull()
    return _result(last, "row_count_vs_20d_avg", F.when(known, F.col("status")).otherwise("WARN"), F.col("ratio"),
                   F.when(known, text.phrase("%s stocks vs 20-day avg %s", F.col("stocks").cast("string"),
                                             text.fixed(F.col("usual"), 0))).otherwise("not enough history"))


def quarantined(rejects: DataFrame | None, run_date: dt.date, spark: SparkSession) -> DataFrame:
    if rejects is None:
        return _result(spark.range(1), "quarantined_price_rows", F.lit("PASS"), F.lit(0),
                       F.lit("no quarantine table (no bad rows ever)"))
    n = F.col("_n")
    found = rejects.agg(F.count_if(F.col("trade_date") == F.lit(run_date)).alias("_n"))
    return _result(found, "quarantined_price_rows", _grade(n, (n == 0, "PASS"), (n < 20, "WARN")), n,
                   text.phrase("%s bad price rows on %s", n.cast("string"), F.lit(str(run_date))))


def unexplained_moves(fact: DataFrame, actions: DataFrame, p: QualityParams = QualityParams()) -> DataFrame:
    """Moves too large for an ordinary day on days without a corporate action of the stock."""
    acted = actions.select("symbol", F.col("ex_date").alias("trade_date")).distinct()
    big = fact.filter(F.abs("return_pct") > p.big_move_pct).select("trade_date", "symbol", "return_pct")
    return big.join(acted, ["symbol", "trade_date"], "left_anti")


def big_moves(fact: DataFrame, actions: DataFrame, run_date: dt.date, p: QualityParams = QualityParams()) -> DataFrame:
    shown = unexplained_moves(fact.filter(F.col("trade_date") == F.lit(run_date)), actions, p).orderBy(
        F.abs("return_pct").desc(), "symbol").limit(p.big_move_limit)
    said = F.concat("symbol", F.lit(" "), text.fixed(F.col("return_pct"), 1), F.lit("%"))
    listed = F.sort_array(F.collect_list(F.struct((-F.abs("return_pct")).alias("size"), "symbol", said.alias("said"))))
    summed = shown.agg(F.count("*").alias("_n"),
                       F.array_join(F.transform(listed, lambda m: m["said"]), ", ").alias("_list"))
    n = F.col("_n")
    return _result(summed, "moves_over_25pct_without_corp_action", _grade(n, (n <= 10, "PASS"), otherwise="WARN"), n,
                   F.when(n > 0, F.col("_list")).otherwise("none"))


def model_tests(tables: dict[str, DataFrame], warn_only: frozenset[str] = frozenset(),
                p: QualityParams = QualityParams()) -> DataFrame:
    """(test, failures, status) of every standing test of the given tables.

    All conditions on single rows of a table are counted in one pass over it; only uniqueness, references and
    value lists, which need a grouping of their own, read it again.
    """
    parts = []
    for name, conditions in row_conditions().items():
        if name not in tables:
            continue
        totals = tables[name].agg(*[F.count_if(~must).alias(test) for test, must in conditions.items()])
        rows = F.explode(F.array(*[F.struct(F.lit(f"{name}.{test}").alias("test"), F.col(test).alias("failures"))
                                   for test in conditions]))
        parts.append(totals.select(rows.alias("_row")).select("_row.*"))
    parts += [df.agg(F.count("*").alias("failures")).select(F.lit(name).alias("test"), "failures")
              for name, df in grouped_tests(tables, p).items()]
    warn = F.col("test").isin(*warn_only) if warn_only else F.lit(False)
    status = F.when(F.col("failures") == 0, "pass").when(warn, "warn").otherwise("fail")
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


def model_test_summary(results: DataFrame) -> DataFrame:
    def names(status: str) -> Column:
        found = F.array_join(F.sort_array(F.collect_list(F.when(F.col("status") == status, F.col("test")))), ", ")
        return F.when(found == "", "none").otherwise(found)

    summed = results.agg(F.count("*").alias("_all"), F.count_if(F.col("status") == "fail").alias("_bad"),
                         F.count_if(F.col("status") == "warn").alias("_warn"), names("fail").alias("_failed"),
                         names("warn").alias("_warned"))
    ran = F.col("_all") > 0
    status = F.when(F.col("_bad") > 0, "FAIL").when((F.col("_warn") > 0) | ~ran, "WARN").otherwise("PASS")
    said = text.phrase("%s nodes; failed: %s; warned: %s", F.col("_all").cast("string"), F.col("_failed"), F.col("_warned"))
    return _result(summed, "dbt_build", status, F.when(ran, F.col("_bad")),
                   F.when(ran, said).otherwise("no results of model tests"))


def row_conditions() -> dict[str, dict[str, Column]]:
    """What must hold on every row; an unknown (null) outcome passes."""
    c = F.col

    def present(column: str) -> Column:
        return c(column).isNotNull()

    return {
        "dim_date": {"not_null_date_key": present("date_key")},
        "dim_stock": {"not_null_stock_sk": present("stock_sk"), "valid_range": c("valid_from") < c("valid_to")},
        "dim_fund": {"not_null_scheme_code": present("scheme_code")},
        "dim_index": {"not_null_index_sk": present("index_sk")},
        "fact_stock_daily": {
            "not_null_stock_sk": present("stock_sk"),
            "price_range": (c("high") >= c("low")) & c("close").between(c("low") * 0.999, c("high") * 1.001),
            "delivery_range": c("deliv_pct").isNull() | c("deliv_pct").between(0, 100),
            "volume_sign": c("volume") >= 0},
        "fact_fund_nav": {"nav_sign": c("nav") > 0},
        "fact_portfolio_txn": {"not_null_txn_id": present("txn_id"), "not_null_unit_price": present("unit_price")},
        "fact_surveillance_alert": {
            "not_null_alert_id": present("alert_id"), "not_null_reason": present("reason"),
            "score_range": c("risk_score").between(0, 100), "rules_named": c("rules_triggered") != ""},
        "int_alert_outcomes": {"not_null_symbol": present("symbol")},
        "mart_surveillance_validation": {"not_null_segment": present("segment")},
        "mart_portfolio_holdings": {"held_sign": c("held_qty") >= -0.0001,
                                    "not_null_current_price": present("current_price")},
        "mart_fund_performance": {"not_null_scheme_code": present("scheme_code")},
    }


UNIQUE = {
    "dim_date": ("unique_date_key", ["date_key"]), "dim_stock": ("unique_stock_sk", ["stock_sk"]),
    "dim_fund": ("unique_scheme_code", ["scheme_code"]), "dim_index": ("unique_index_sk", ["index_sk"]),
    "fact_stock_daily": ("unique_day_symbol", ["trade_date", "symbol"]),
    "fact_index_daily": ("unique_day_index", ["trade_date", "index_name"]),
    "fact_fund_nav": ("unique_scheme_day", ["scheme_code", "nav_date"]),
    "fact_portfolio_txn": ("unique_txn_id", ["txn_id"]),
    "int_surveillance_signals": ("unique_day_symbol", ["trade_date", "symbol"]),
    "fact_surveillance_alert": ("unique_alert_id", ["alert_id"]),
    "int_alert_outcomes": ("unique_symbol", ["symbol"]),
    "mart_surveillance_validation": ("unique_segment", ["segment"]),
    "mart_portfolio_holdings": ("unique_holding", ["owner", "asset_class", "instrument_id"]),
    "mart_fund_performance": ("unique_scheme_code", ["scheme_code"]),
    "mart_sector_performance": ("unique_day_industry", ["trade_date", "industry"]),
}
ALLOWED = {
    "dim_fund": ("plan_values", "plan", ["Direct", "Regular"]),
    "fact_portfolio_txn": ("txn_type_values", "txn_type", list(fixed.TXN_TYPES)),
    "fact_surveillance_alert": ("band_values", "risk_band", list(fixed.BANDS)),
    "int_alert_outcomes": ("band_values", "best_band", [*fixed.BANDS, fixed.NOT_ALERTED]),
}
LINKS = (("fact_stock_daily", "date_key", "dim_date"), ("fact_stock_daily", "stock_sk", "dim_stock"),
         ("fact_index_daily", "index_sk", "dim_index"), ("fact_fund_nav", "scheme_code", "dim_fund"),
         ("fact_surveillance_alert", "stock_sk", "dim_stock"))


def grouped_tests(t: dict[str, DataFrame], p: QualityParams = QualityParams()) -> dict[str, DataFrame]:
    """Offending groups or references, by test name."""
    out = {f"{name}.{test}": checks.duplicates(t[name], keys) for name, (test, keys) in UNIQUE.items() if name in t}
    out |= {f"{name}.{test}": checks.outside(t[name], column, values)
            for name, (test, column, values) in ALLOWED.items() if name in t}
    out |= {f"{child}.{key}_in_{parent}": checks.orphans(t[child], key, t[parent], key)
            for child, key, parent in LINKS if child in t and parent in t}
    if "fact_stock_daily" in t:
        out["fact_stock_daily.complete_days"] = checks.short_days(
            t["fact_stock_daily"], "trade_date", p.min_stocks_per_trading_day)
    return out


def continuity(fact: DataFrame, actions: DataFrame, p: QualityParams = QualityParams()) -> DataFrame:
    """Ex-dates on which the adjusted close still jumped: the factor was wrong or missing."""
    px = fact.select("symbol", "trade_date", "close",
                     F.lag("close").over(by_date("symbol", date="trade_date")).alias("prev_row_close"))
    hits = actions.join(px, (actions["symbol"] == px["symbol"]) & (actions["ex_date"] == px["trade_date"]))
    return hits.filter(F.abs(F.col("close") / F.col("prev_row_close") - 1) > p.continuity_limit).select(
        actions["symbol"], "ex_date", "factor", "prev_row_close", "close")


def freshness(table: DataFrame, stamp: str, now: dt.datetime, warn_days: int = 4, error_days: int = 7) -> DataFrame:
    age = F.date_diff(F.lit(now.date()), F.to_date("_latest"))
    return table.agg(F.max(stamp).alias("_latest")).select(
        "_latest", age.alias("age_days"),
        F.when(age >= error_days, "error").when(age >= warn_days, "warn").otherwise("pass").alias("status"))


def run_checks(run_date: dt.date, fact: DataFrame, nav: DataFrame, holidays: DataFrame, actions: DataFrame,
               present: DataFrame, rejects: DataFrame | None = None, tests: DataFrame | None = None) -> DataFrame:
    """The day's checks as rows ready to replace those of an earlier run for the same date."""
    spark = fact.sparkSession
    parts = [missing_days(present, holidays, run_date), quarantined(rejects, run_date, spark),
             stale_prices(fact, holidays, run_date), stale_nav(nav, run_date), row_count(fact, run_date),
             big_moves(fact, actions, run_date),
             model_test_summary(spark.createDataFrame([], "test string, status string") if tests is None else tests)]
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(run_date).alias("run_date"), "*", F.current_timestamp().alias("checked_at"))


# ---------- run log ----------

def coverage(fact: DataFrame) -> DataFrame:
    return fact.agg(F.max("trade_date").alias("latest_day"), F.countDistinct("trade_date").alias("days"),
                    F.countDistinct("symbol").alias("stocks"))


def day_sketches(rows: DataFrame, day: str, column: str, lg_k: int = 14) -> DataFrame:
    """(day, sketch): a HyperLogLog sketch of the distinct values of each day, to be stored and merged for any span.

    A sketch has at most 2^lg_k bytes; at 14 its estimate's standard error is 0.8 percent, whatever the span.
    """
    return rows.groupBy(F.col(day).alias("day")).agg(F.hll_sketch_agg(column, lg_k).alias("sketch"))


def merged_sketches(sketches: DataFrame, span: Column) -> DataFrame:
    """(span, days, estimate): about how many distinct values each span of days has; the rows are not read again."""
    return sketches.groupBy(span).agg(F.count(F.lit(1)).alias("days"),
                                      F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def step_seconds(runs: DataFrame, newest: int | None = 60) -> DataFrame:
    """Mean seconds of the successful steps among the newest log entries (all of them with None)."""
    log = runs if newest is None else runs.orderBy(F.col("started_at").desc(), "run_id", "step").limit(newest)
    order = F.array_position(F.array(*[F.lit(s) for s in fixed.STEPS]), F.col("step")).cast("int")
    return log.filter(F.col("status") == "SUCCESS").groupBy("step").agg(
        rounded(F.avg("duration_s"), 3).alias("mean_s"), F.count("*").alias("runs")).withColumn(
        "position", order).filter("position > 0")


def last_run(runs: DataFrame, steps: int = 7) -> DataFrame:
    """Did any of the newest steps fail?"""
    recent = runs.orderBy(F.col("started_at").desc(), "run_id", "step").limit(steps)
    return recent.agg(F.max("started_at").alias("last_started"), F.count_if(F.col("status") == "FAILED").alias("failed"))


def latest_batch(results: DataFrame) -> DataFrame:
    """The check results written within a minute of the newest one."""
    newest = results.agg(F.max("checked_at").alias("_newest"))
    return results.join(F.broadcast(newest)).filter(
        F.col("checked_at") >= F.col("_newest") - F.expr("interval 1 minute")).drop("_newest")
