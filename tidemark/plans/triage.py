"""One-line news triage of alerts, its cache, and the daily digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions import text
from tidemark.operators.asof import spread_days
from tidemark.operators.windows import first_per, top_per

RULES_SOURCE = "rules"
REPLY = "struct<verdict:string,line:string>"


def rule_triage(alert: DataFrame) -> DataFrame:
    """Verdict from the filings alone: news may explain the move, silence does not."""
    news = F.col("news_types")
    line = (F.when(news.isNotNull(), text.phrase(fixed.TRIAGE_NEWS, text.plain_words(news)))
            .when(F.col("exchange_query"), fixed.TRIAGE_QUERY).otherwise(fixed.TRIAGE_NONE))
    verdict = F.when(news.isNotNull(), fixed.UNCLEAR).otherwise(fixed.UNEXPLAINED)
    return alert.withColumns({"verdict": verdict, "line": line, "source": F.lit(RULES_SOURCE)})


def read_reply(reply: Column) -> Column:
    """struct(verdict, line) of a usable stored reply, null for anything else."""
    body = F.regexp_replace(F.regexp_replace(F.trim(reply), r"^```json", ""), r"```$", "")
    parsed = F.from_json(body, REPLY, {"mode": "PERMISSIVE"})
    verdict = F.upper(parsed["verdict"])
    line = F.substring(F.trim(F.regexp_replace(parsed["line"], r"\s+", " ")), 1, fixed.TRIAGE_LINE_CHARS)
    return F.when(verdict.isin(*fixed.VERDICTS) & (F.length(line) > 0),
                  F.struct(verdict.alias("verdict"), line.alias("line")))


def triage_with_replies(alert: DataFrame, replies: DataFrame, model: str) -> DataFrame:
    """Rule triage, replaced by a stored reply (alert_id, reply) where the alert has news and the reply is usable."""
    ruled = rule_triage(alert)
    answered = replies.select("alert_id", read_reply(F.col("reply")).alias("_reply"))
    use = F.col("news_types").isNotNull() & F.col("_reply").isNotNull()
    return ruled.join(answered, "alert_id", "left").select(
        "alert_id", "trade_date", "symbol",
        F.when(use, F.col("_reply.verdict")).otherwise(F.col("verdict")).alias("verdict"),
        F.when(use, F.col("_reply.line")).otherwise(F.col("line")).alias("line"),
        F.when(use, f"llm:{model}").otherwise(F.col("source")).alias("source"))


def merge_cache(cached: DataFrame, fresh: DataFrame) -> DataFrame:
    """Keep what was answered before; a rules answer gives way to a better fresh one."""
    columns = ["alert_id", "trade_date", "symbol", "verdict", "line", "source"]
    both = cached.select(*columns).withColumn("_fresh", F.lit(1)).unionByName(
        fresh.select(*columns).withColumn("_fresh", F.lit(2)))
    by_rules = F.col("source") == RULES_SOURCE
    preference = (F.when((F.col("_fresh") == 1) & ~by_rules, 1).when(~by_rules, 2)
                  .when(F.col("_fresh") == 1, 3).otherwise(4))
    return first_per(both, ["alert_id"], preference).drop("_fresh")


def filings_context(alert: DataFrame, filings: DataFrame, lookback_days: int = 3) -> DataFrame:
    """The newest non-routine filings behind each alert with news, as one text.

    Filings are cut to the newest few per (symbol, day) before they meet the alerts; older ones of that day
    can never be among the newest few of any alert.
    """
    newest = [F.col("announced_at").desc(), F.col("seq_id")]
    useful = filings.filter(F.col("news_type") != fixed.ROUTINE)
    daily = top_per(useful, ["symbol", "announced_date"], fixed.TRIAGE_FILINGS, *newest)
    carried = spread_days(daily, "announced_date", "trade_date", lookback_days)
    due = alert.filter(F.col("news_types").isNotNull()).select("alert_id", "symbol", "trade_date")
    kept = top_per(due.join(carried, ["symbol", "trade_date"]), ["alert_id"], fixed.TRIAGE_FILINGS, *newest,
                   rank="position")
    line = text.phrase("- %s [%s] %s", F.date_format("announced_at", "dd MMM HH:mm"), F.col("category"),
                       F.substring("summary", 1, fixed.TRIAGE_SUMMARY_CHARS))
    return kept.withColumn("_line", line).groupBy("alert_id", "symbol", "trade_date").agg(
        F.count("*").alias("filings"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "_line"))),
                                 lambda s: s["_line"]), "\n").alias("context"))


def day_alerts(alert: DataFrame, triage: DataFrame) -> DataFrame:
    """Alerts in reading order, with the triage of the HIGH ones."""
    lines = triage.select("alert_id", "verdict", F.col("line").alias("triage"), F.col("source").alias("triage_source"))
    high = F.col("risk_band") == "HIGH"
    joined = alert.join(lines, "alert_id", "left")
    return joined.select(
        "alert_id", "trade_date", "symbol", "company_name", "industry", "risk_score", "risk_band", "rules_triggered",
        "reason", "news_types", "material_news_count", "exchange_query",
        *[F.when(high, F.col(c)).alias(c) for c in ("verdict", "triage", "triage_source")],
    ).orderBy(F.col("trade_date").desc(), F.col("risk_score").desc(), "symbol")


def with_repeats(alert: DataFrame) -> DataFrame:
    """Mark alerts whose symbol already raised one on any of the previous few alert days."""
    days = Window.orderBy("trade_date")    # one row per alert day
    numbered = alert.select("trade_date").distinct().select("trade_date", F.row_number().over(days).alias("_day"))
    before = F.lag("_day").over(Window.partitionBy("symbol").orderBy("_day"))
    return alert.join(numbered, "trade_date").withColumn(
        "repeated", F.coalesce(F.col("_day") - before <= fixed.DIGEST_REPEAT_DAYS, F.lit(False))).drop("_day")


def watchlist(alert: DataFrame) -> DataFrame:
    """Each day's strongest new MEDIUM names."""
    fresh = with_repeats(alert).filter((F.col("risk_band") == "MEDIUM") & ~F.col("repeated"))
    return top_per(fresh, ["trade_date"], fixed.DIGEST_WATCHLIST, F.col("risk_score").desc(), F.col("symbol"),
                   rank="position")


def quality_line(checks: DataFrame | None, run_dates: DataFrame) -> DataFrame:
    """One sentence per run date about the data checks."""
    if checks is None:
        return run_dates.select("trade_date", F.lit("not checked in this run").alias("_quality"))
    bad = F.when(F.col("status") != "PASS", F.concat_ws("=", "check_name", "status"))
    summed = checks.groupBy(F.col("run_date").alias("trade_date")).agg(
        F.array_join(F.sort_array(F.collect_list(bad)), "; ").alias("_bad"))    # one row per kind of check
    said = F.when(F.col("_bad").isNull(), "not checked in this run").when(
        F.col("_bad") == "", "all checks passed").otherwise(F.col("_bad"))
    return run_dates.join(summed, "trade_date", "left").select("trade_date", said.alias("_quality"))


def digest(day_alert: DataFrame, alert: DataFrame, checks: DataFrame | None = None) -> DataFrame:
    """The digest of every alert day as ordered lines (trade_date, section, position, text).

    `day_alert` carries the triage, as from day_alerts.
    """
    score = text.fixed(F.col("risk_score"), 0)
    counts = alert.groupBy("trade_date").agg(
        F.count("*").alias("_all"), F.count_if(F.col("risk_band") == "HIGH").alias("_high"),
        F.count_if(F.col("risk_band") == "MEDIUM").alias("_medium"))

    def lines(df: DataFrame, section: int, position: Column, said: Column) -> DataFrame:
        return df.select("trade_date", F.lit(section).alias("section"), position.cast("int").alias("position"),
                         said.alias("text")).filter(F.col("text").isNotNull())

    def s(c: str) -> Column:
        return F.col(c).cast("string")

    first = F.lit(0)
    title = lines(counts, 1, first, text.phrase(fixed.DIGEST_TITLE, F.date_format("trade_date", "dd MMM yyyy")))
    totals = lines(counts, 2, first, text.phrase(fixed.DIGEST_COUNTS, s("_all"), s("_high"), s("_medium")))
    high_head = lines(counts, 3, first, F.when(F.col("_high") > 0, text.phrase(fixed.DIGEST_HIGH, s("_high")))
                      .otherwise(fixed.DIGEST_NO_HIGH))
    place = F.row_number().over(Window.partitionBy("trade_date").orderBy(F.col("risk_score").desc(), "symbol"))
    high = day_alert.filter(F.col("risk_band") == "HIGH").withColumn("_place", place)
    icon = F.lit(fixed.DIGEST_ICON_OTHER)
    for verdict, sign in fixed.DIGEST_ICONS.items():
        icon = F.when(F.col("verdict") == verdict, sign).otherwise(icon)
    named = F.rtrim(text.phrase("• %s (%s) %s", F.col("symbol"), score, F.coalesce("company_name", F.lit(""))))
    triaged = F.when(F.col("triage").isNotNull(), F.concat(F.lit("  "), icon, F.lit(" "), F.col("triage")))
    high_lines = [lines(high, 4, F.col("_place") * 3 + i, said)
                  for i, said in enumerate((named, F.concat(F.lit("  "), F.col("reason")), triaged))]
    watched = watchlist(alert)
    news = F.when(F.col("news_types").isNotNull(), F.concat(F.lit(" · news: "), text.plain_words(F.col("news_types"))))
    query = F.when(F.col("exchange_query"), " · NSE query")
    watch_head = lines(watched.groupBy("trade_date").agg(F.count("*").alias("_n")), 5, first,
                       text.phrase(fixed.DIGEST_WATCH, s("_n")))
    watch_lines = lines(watched, 6, F.col("position"), F.concat_ws(
        "", text.phrase("• %s (%s) %s", F.col("symbol"), score, F.lower("rules_triggered")), news, query))
    quality = lines(quality_line(checks, counts.select("trade_date")), 7, first,
                    text.phrase(fixed.DIGEST_QUALITY, F.col("_quality")))
    closing = lines(counts, 8, first, F.lit(fixed.DIGEST_CLOSING))
    out = title
    for part in (totals, high_head, *high_lines, watch_head, watch_lines, quality, closing):
        out = out.unionByName(part)
    return out
