"""Questions asked of the finished tables: is this stock safe, which names are meant, what happened today."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions import text
from tidemark.functions.cleaning import rounded
from tidemark.operators.windows import first_per, top_per

ORDER = {"bad": 0, "warn": 1, "ok": 2}
LEVELS = {"bad": "red", "warn": "amber", "ok": "green"}
RECENT_BARS = 25


def recent_day(fact: DataFrame, n: int) -> DataFrame:
    """One row: the n-th newest day present in the data."""
    return fact.select("trade_date").distinct().orderBy(F.col("trade_date").desc()).limit(n).agg(
        F.min("trade_date").alias("since"))


def _check(df: DataFrame, rank: int, kind: Column | str, title: Column | str, detail: Column | str) -> DataFrame:
    def as_column(x: Column | str) -> Column:
        return F.lit(x) if isinstance(x, str) else x

    return df.select("symbol", F.lit(rank).alias("place"), as_column(kind).alias("kind"),
                     as_column(title).alias("title"), as_column(detail).alias("detail"))


def _day(c: str) -> Column:
    return F.date_format(c, "dd MMM")


def _list_check(symbols: DataFrame, lists: DataFrame) -> DataFrame:
    newest = lists.agg(F.max("snapshot_date").alias("snapshot_date"))
    current = first_per(lists.join(F.broadcast(newest), "snapshot_date"), ["symbol"], F.col("list_type")).select(
        "symbol", "description", "snapshot_date")
    on = F.col("snapshot_date").isNotNull()
    return _check(
        symbols.join(current, "symbol", "left"), 1, F.when(on, "bad").otherwise("ok"),
        F.when(on, fixed.CHECK_LISTED).otherwise(fixed.CHECK_NOT_LISTED),
        F.when(on, text.phrase(fixed.DETAIL_LISTED, F.coalesce("description", F.lit("")), _day("snapshot_date")))
        .otherwise(fixed.DETAIL_NOT_LISTED))


def _strongest(alert: DataFrame, triage: DataFrame, since: DataFrame) -> DataFrame:
    """Each symbol's strongest recent HIGH or MEDIUM alert, and how many there were."""
    recent = alert.filter(F.col("risk_band").isin("HIGH", "MEDIUM")).join(
        F.broadcast(since), F.col("trade_date") >= F.col("since"))
    top = first_per(recent, ["symbol"], F.col("risk_score").desc(), F.col("trade_date").desc())
    times = recent.groupBy("symbol").agg(F.count("*").alias("_times"))
    lines = triage.select("alert_id", "verdict", F.col("line").alias("triage"))
    return top.join(times, "symbol").join(lines, "alert_id", "left").select(
        "symbol", "_times", "trade_date", "risk_band", "reason", "news_types", "verdict", "triage")


def _alert_checks(symbols: DataFrame, strongest: DataFrame) -> list[DataFrame]:
    all_symbols = symbols.join(strongest, "symbol", "left")
    flagged = F.col("risk_band").isNotNull()
    by_band = F.when(F.col("risk_band") == "HIGH", "bad").otherwise("warn")
    first_two = F.lower(F.array_join(F.slice(F.split("reason", "; "), 1, 2), "; "))
    activity = _check(
        all_symbols, 2, F.when(flagged, by_band).otherwise("ok"),
        F.when(flagged, text.phrase(fixed.CHECK_FLAGGED, F.col("_times").cast("string"),
                                    F.when(F.col("_times") > 1, "s").otherwise(""), F.lower("risk_band")))
        .otherwise(fixed.CHECK_CALM),
        F.when(flagged, text.phrase(fixed.DETAIL_FLAGGED, _day("trade_date"), first_two))
        .otherwise(fixed.DETAIL_CALM))
    judged, filed = F.col("verdict").isNotNull(), F.col("news_types").isNotNull()
    by_verdict = (F.when(F.col("verdict") == fixed.EXPLAINED, "ok").when(F.col("verdict") == fixed.UNCLEAR, "warn")
                  .otherwise("bad"))
    news = _check(
        strongest, 3, F.when(judged, by_verdict).when(filed, "ok").otherwise(by_band),
        F.when(judged, fixed.CHECK_TRIAGE).when(filed, fixed.CHECK_NEWS).otherwise(fixed.CHECK_NO_NEWS),
        F.when(judged, F.col("triage"))
        .when(filed, text.phrase(fixed.DETAIL_NEWS, text.plain_words(F.col("news_types"))))
        .otherwise(fixed.DETAIL_NO_NEWS))
    return [activity, news]


def _query_check(symbols: DataFrame, filings: DataFrame, since: DataFrame) -> DataFrame:
    asked = filings.filter(F.col("news_type") == fixed.EXCHANGE_QUERY).join(
        F.broadcast(since), F.col("announced_date") >= F.col("since"))
    summed = asked.groupBy("symbol").agg(
        F.count("*").alias("_times"), F.max("announced_date").alias("_when"),
        F.max_by("category", F.struct("announced_at", "seq_id")).alias("_what"))
    on, more = F.col("_times").isNotNull(), F.col("_times") > 1
    return _check(
        symbols.join(summed, "symbol", "left"), 4, F.when(on, "bad").otherwise("ok"),
        F.when(on, fixed.CHECK_QUERIED).otherwise(fixed.CHECK_NOT_QUERIED),
        F.when(more, text.phrase(fixed.DETAIL_QUERIED_MORE, F.col("_what"), _day("_when"),
                                 (F.col("_times") - 1).cast("string")))
        .when(on, text.phrase(fixed.DETAIL_QUERIED_ONCE, F.col("_what"), _day("_when")))
        .otherwise(fixed.DETAIL_NOT_QUERIED))


def recent_bars(fact: DataFrame) -> DataFrame:
    """Latest row of every symbol with its 20-row mean turnover and its close 20 rows earlier."""
    last = top_per(fact, ["symbol"], RECENT_BARS, F.col("trade_date").desc(), rank="_back")

    def at(c: str, position: int) -> Column:
        return F.max(F.when(F.col("_back") == position, F.col(c)))

    return last.groupBy("symbol").agg(
        at("trade_date", 1).alias("as_of"), at("close", 1).alias("close"), at("deliv_pct", 1).alias("_delivered"),
        at("avg_deliv_pct_20d", 1).alias("_usual"), at("close", 21).alias("_close_20"),
        F.avg(F.when(F.col("_back") <= 20, F.col("turnover_lacs"))).alias("_turnover_lacs"))


def _price_checks(bars: DataFrame) -> list[DataFrame]:
    crores = F.col("_turnover_lacs") / 100
    thin = crores < 1
    liquidity = _check(
        bars, 5, F.when(thin, "warn").otherwise("ok"),
        F.when(thin, text.phrase(fixed.CHECK_THIN, text.fixed(crores, 2)))
        .otherwise(text.phrase(fixed.CHECK_LIQUID, text.grouped(crores))),
        F.when(thin, fixed.DETAIL_THIN).otherwise(fixed.DETAIL_LIQUID))
    delivery = _check(
        bars.filter(F.col("_delivered") < 0.6 * F.col("_usual")), 6, "warn", fixed.CHECK_DELIVERY,
        text.phrase(fixed.DETAIL_DELIVERY, text.fixed(F.col("_delivered"), 0), text.fixed(F.col("_usual"), 0)))
    run = (F.col("close") / F.col("_close_20") - 1) * 100
    moved = bars.withColumn("_run", run).filter(F.abs("_run") >= 30)
    rose = F.col("_run") > 0
    size = text.fixed(F.abs("_run"), 0)
    trend = _check(moved, 7, "warn", F.when(rose, text.phrase(fixed.CHECK_RISE, size))
                   .otherwise(text.phrase(fixed.CHECK_FALL, size)),
                   F.when(rose, fixed.DETAIL_RISE).otherwise(fixed.DETAIL_FALL))
    return [liquidity, delivery, trend]


def stock_checks(fact: DataFrame, alert: DataFrame, triage: DataFrame, filings: DataFrame,
                 lists: DataFrame) -> DataFrame:
    """The safety checklist of every stock at once, worst first (symbol, position, kind, title, detail)."""
    bars = recent_bars(fact)
    symbols = bars.select("symbol")
    strongest = _strongest(alert, triage, recent_day(fact, 10))
    parts = [_list_check(symbols, lists), *_alert_checks(symbols, strongest),
             _query_check(symbols, filings, recent_day(fact, 22)), *_price_checks(bars)]
    severity = reduce(lambda chain, kind: F.when(F.col("kind") == kind, ORDER[kind]).otherwise(chain), ORDER, F.lit(9))
    w = Window.partitionBy("symbol").orderBy("_severity", "place")    # seven checks per symbol
    return reduce(DataFrame.unionByName, parts).withColumn("_severity", severity).withColumn(
        "position", F.row_number().over(w)).select("symbol", "position", "kind", "title", "detail")


def stock_levels(checked: DataFrame, fact: DataFrame) -> DataFrame:
    """One verdict per stock: its worst check decides."""
    worst = checked.filter("position = 1")
    level = reduce(lambda chain, kind: F.when(F.col("kind") == kind, LEVELS[kind]).otherwise(chain), LEVELS,
                   F.lit(None))
    newest = fact.groupBy("symbol").agg(F.max("trade_date").alias("as_of"),
                                        F.max_by("close", "trade_date").alias("close"))
    return worst.join(newest, "symbol").select(
        "symbol", level.alias("level"),
        F.when(F.col("kind") != "ok", F.col("title")).otherwise("—").alias("main_reason"), "as_of", "close")


GRAM = 3


def _pieces(text: Column, size: int) -> Column:
    """All substrings of ``size`` letters."""
    places = F.sequence(F.lit(1), F.length(text) - (size - 1))
    return F.when(F.length(text) >= size, F.transform(places, lambda i: F.substring(text, i, size))).otherwise(F.array())


def _grams(text: Column) -> Column:
    """Distinct substrings of ``GRAM`` letters, or the whole of a shorter text."""
    return F.when(F.length(text) <= GRAM, F.array(text)).otherwise(F.array_distinct(_pieces(text, GRAM)))


def name_candidates(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """(_t, symbol, _name, _turnover): names that hold the rarest gram of each wanted text ``_t``, all that contain it among them.

    How many names hold each gram is counted first. A text with a gram that no name holds has no candidates; any other
    meets only the names of its rarest gram, so texts that start alike, or hold a common word, do not meet them all.
    """
    all_sizes = F.flatten(F.array(*[_pieces(F.col("_name"), size) for size in range(1, GRAM + 1)]))
    index = known.select("*", F.explode(F.array_distinct(all_sizes)).alias("_gram"))
    held = index.groupBy("_gram").agg(F.count("*").alias("_names"))
    asked = wanted.select("_t", F.size(_grams(F.col("_t"))).alias("_needed"), F.explode(_grams(F.col("_t"))).alias("_gram"))
    rarest = asked.join(held, "_gram").groupBy("_t", "_needed").agg(
        F.count("*").alias("_found"), F.min_by("_gram", F.struct("_names", "_gram")).alias("_gram"))
    return rarest.filter("_found = _needed").select("_t", "_gram").join(index, "_gram").drop("_gram")


def resolve_names(tokens: DataFrame, directory: DataFrame) -> DataFrame:
    """Match typed tokens to symbols: the symbol itself, else the best company name.

    Exact name beats a name starting with the token, which beats a name containing it; ties go to the most
    traded stock. Null and blank tokens are left out.
    """
    cleaned = F.regexp_replace(F.upper(F.trim("token")), fixed.TICKER_SUFFIX_PATTERN, "")
    wanted = tokens.select(F.trim("token").alias("token"), cleaned.alias("_t")).filter(F.col("_t") != "").distinct()
    known = directory.select("symbol", F.upper(F.coalesce("company_name", F.lit(""))).alias("_name"),
                             F.coalesce("avg_turnover_lacs", F.lit(0.0)).alias("_turnover"))
    symbols = known.select(F.col("symbol").alias("_t"), F.col("symbol").alias("_direct"))
    named = wanted.select("_t").distinct().join(symbols, "_t", "left_anti")
    candidates = name_candidates(named, known).filter(F.col("_name").contains(F.col("_t")))
    base = F.trim(F.regexp_replace("_name", fixed.NAME_SUFFIX_PATTERN, ""))
    rank = (F.when(base == F.col("_t"), 0).when(F.col("_name").startswith(F.col("_t")), 1).otherwise(2))
    best = first_per(candidates.withColumn("_rank", rank), ["_t"], F.col("_rank"), F.col("_turnover").desc(),
                     F.col("symbol")).select("_t", "symbol", "_rank")
    return wanted.join(symbols, "_t", "left").join(best, "_t", "left").select(
        "token", F.coalesce("_direct", "symbol").alias("symbol"),
        F.when(F.col("_direct").isNotNull(), "symbol").when(F.col("_rank") == 0, "exact name")
        .when(F.col("_rank") == 1, "name starts with").when(F.col("_rank") == 2, "name contains")
        .otherwise("not found").alias("matched_by"))


def portfolio_scan(holdings: DataFrame, levels: DataFrame) -> DataFrame:
    """Verdicts of the stocks each owner holds (owner, symbol), riskiest first."""
    rank = F.when(F.col("level") == "red", 0).when(F.col("level") == "amber", 1).otherwise(2)
    return holdings.join(levels, "symbol").withColumn("rank", rank).select(
        "owner", "rank", "symbol", "level", "main_reason", "close")


def level_counts(scan: DataFrame) -> DataFrame:
    return scan.groupBy("owner").agg(
        F.count("*").alias("checked"), F.count_if(F.col("level") == "red").alias("high_caution"),
        F.count_if(F.col("level") == "amber").alias("some_signs"), F.count_if(F.col("level") == "green").alias("no_signs"))


def day_overview(alert: DataFrame) -> DataFrame:
    """Counts per alert day, and the change against the alert day before."""
    high = F.col("risk_band") == "HIGH"
    days = alert.groupBy("trade_date").agg(
        F.count("*").alias("flagged"), F.count_if(high).alias("high"),
        F.count_if(high & F.col("news_types").isNull()).alias("high_without_news"),
        F.count_if("exchange_query").alias("queried"))
    before = F.lag("flagged").over(Window.orderBy("trade_date"))    # one row per alert day
    return days.withColumn("change", F.col("flagged") - before)


def market_map(alert: DataFrame, triage: DataFrame) -> DataFrame:
    """Position, size and caption of every alert on a move-by-volume chart."""
    lines = triage.select("alert_id", F.col("line").alias("triage"))
    filed = F.when(F.col("news_types").isNotNull(),
                   F.concat(F.lit("Filings: "), text.plain_words(F.col("news_types"))))
    return alert.join(lines, "alert_id", "left").select(
        "trade_date", "symbol", "company_name", "risk_band", "risk_score", "return_pct",
        F.greatest(F.coalesce("volume_ratio_20d", F.lit(1.0)), F.lit(0.2)).alias("volume_x"),
        rounded(9 + F.col("risk_score") / 7).alias("size"),
        text.plain_words(F.col("rules_triggered")).alias("rules"),
        F.coalesce("triage", filed, F.lit("No company news in 3 days")).alias("news"))


def filter_alerts(alert: DataFrame, bands: list[str] | None = None, rules: list[str] | None = None,
                  has_news: bool | None = None) -> DataFrame:
    """Alerts of the given bands that fired any of the given rules, with or without company news."""
    out = alert
    if bands:
        out = out.filter(F.col("risk_band").isin(*bands))
    if rules:
        out = out.filter(F.arrays_overlap(F.split("rules_triggered", ", "), F.array(*[F.lit(r) for r in rules])))
    if has_news is not None:
        out = out.filter(F.col("news_types").isNotNull() if has_news else F.col("news_types").isNull())
    return out


def rule_counts(alert: DataFrame) -> DataFrame:
    """How often each rule fired, per day."""
    return alert.select("trade_date", F.explode(F.split("rules_triggered", ", ")).alias("rule")).groupBy(
        "trade_date", "rule").agg(F.count("*").alias("alerts"))


def timeline(fact: DataFrame, alert: DataFrame) -> DataFrame:
    """Bars with the alert marks drawn above their highs."""
    marks = alert.select("symbol", "trade_date", "risk_band", "risk_score", "rules_triggered")
    bars = fact.select("symbol", "trade_date", "open", "high", "low", "close", "volume",
                       F.coalesce("volume_ratio_20d", F.lit(1.0)).alias("volume_x"))
    return bars.join(marks, ["symbol", "trade_date"], "left").withColumn(
        "mark_at", F.when(F.col("risk_band").isNotNull(), rounded(F.col("high") * 1.035, 4)))


def latest_filings(filings: DataFrame, n: int = 12) -> DataFrame:
    """The newest non-routine filings of every symbol."""
    useful = filings.filter(F.col("news_type") != fixed.ROUTINE)
    return top_per(useful, ["symbol"], n, F.col("announced_at").desc(), F.col("seq_id"), rank="position").select(
        "symbol", "position", "announced_at", "category", "summary", "attachment_url")


def watch_suggestions(alert: DataFrame, n: int = 3) -> DataFrame:
    """The strongest HIGH symbols of the newest alert day."""
    newest = alert.agg(F.max("trade_date").alias("trade_date"))
    today = alert.join(F.broadcast(newest), "trade_date").filter(F.col("risk_band") == "HIGH")
    return today.orderBy(F.col("risk_score").desc(), "symbol").limit(n).select("symbol", "risk_score")
