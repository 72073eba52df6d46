"""Seven surveillance rules on every stock-day, and the scored, explained alerts they raise."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.functions import text
from tidemark.functions.classify import is_etf
from tidemark.functions.cleaning import ratio, rounded
from tidemark.operators.asof import spread_days
from tidemark.operators.grouping import counted, median_of_counts
from tidemark.operators.windows import any_before, by_date, rows, with_streak, zscore
from tidemark.params import BASELINES, SurveillanceParams
from tidemark.sources.store import settle


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def peer_returns(universe: DataFrame) -> DataFrame:
    """What the rest did: the median move of the industry that day, of the whole market where that is unknown.

    Stock-days are first counted per equal return, so neither median weighs more than its distinct values.
    """
    counts = counted(universe, ["trade_date", "industry"], F.col("return_pct"))
    classified = F.col("industry") != fixed.UNCLASSIFIED
    sectors = median_of_counts(counts, ["trade_date", "industry"], "_sector")
    market = median_of_counts(counts, ["trade_date"], "_market")
    return sectors.join(market, "trade_date").select(
        "trade_date", "industry",
        F.coalesce(F.when(classified, F.col("_sector")), F.col("_market")).alias("peer_return_pct"))


def _at_circuit(p: SurveillanceParams) -> Column:
    move = F.col("return_pct")
    near = reduce(lambda a, b: a | b,
                  [F.abs(F.abs(move) - band) < p.circuit_tolerance for band in p.circuit_bands])
    at_top = (F.col("close") == F.col("high")) & (move > 0)
    at_bottom = (F.col("close") == F.col("low")) & (move < 0)
    return (at_top | at_bottom) & near


def _rules(p: SurveillanceParams) -> dict[str, Column]:
    """Rule conditions for the chosen baseline; unused branches never reach the plan."""
    move, peer = F.col("return_pct"), F.col("peer_return_pct")
    volume_x, volume_z, price_z = F.col("volume_ratio_20d"), F.col("volume_z"), F.col("price_z")
    traded = F.col("turnover_lacs") >= p.min_spike_turnover_cr * 100
    if p.baseline == "per_stock":
        spike = (volume_z >= p.volume_spike_z) & (volume_x >= p.volume_spike_min_x) & traded
        shock = (price_z >= p.price_shock_z) & (F.abs(move - peer) >= p.price_shock_min_pct)
    else:
        spike = (volume_x >= p.volume_spike_x) & traded
        shock = (F.abs(move) >= p.price_shock_pct) & (F.abs(peer) < p.sector_calm_pct)
        if p.baseline == "hybrid":
            spike = spike & (volume_z >= p.volume_spike_z)
            shock = shock & (price_z >= p.price_shock_z)
    delivered, usual = F.col("deliv_pct"), F.col("deliv_pct_base")
    delivery = (((delivered >= usual + p.delivery_z * F.col("deliv_pct_std")) & (volume_x >= p.delivery_high_min_x))
                | ((delivered <= usual * p.delivery_low_ratio) & (volume_x >= p.delivery_low_min_x)))
    gap = ((F.abs("gap_pct") >= p.gap_pct)
           & (F.signum(F.col("close") - F.col("open")) == F.signum(F.col("gap_pct"))))
    return {"spike": spike, "shock": shock, "delivery": delivery, "gap": gap}


def measured(fact: DataFrame, stocks: DataFrame, p: SurveillanceParams = SurveillanceParams()) -> DataFrame:
    """What the rules look at, for every stock-day and any baseline.

    All row baselines share one sort per symbol and never look at peers, so the peer medians are computed
    beside them and joined afterwards instead of forcing a second sort by symbol.
    """
    named = stocks.select("stock_sk", "industry", "company_name")
    universe = fact.filter(~is_etf(F.col("symbol"))).join(named, "stock_sk")
    w = by_date("symbol", date="trade_date")
    last20, last5, earlier20 = rows(w, -20, -1), rows(w, -4, 0), rows(w, -24, -5)
    pump = ((F.col("return_5d_pct") >= p.pump_return_5d_pct) & (F.col("volume_ratio_5d") >= p.pump_volume_x)
            & (F.col("deliv_pct_5d") < F.col("deliv_pct_base") * p.pump_low_delivery_ratio))

    based = universe.withColumn(
        "_log_volume", F.log(F.greatest(F.col("volume"), F.lit(1)).cast("double"))).select(
        "*",
        zscore(F.col("_log_volume"), last20).alias("volume_z"),
        ratio(F.avg("volume").over(last5), F.avg("volume").over(earlier20)).alias("volume_ratio_5d"),
        F.avg("deliv_pct").over(last5).alias("deliv_pct_5d"),
        F.avg("deliv_pct").over(earlier20).alias("deliv_pct_base"),
        F.stddev_samp("deliv_pct").over(earlier20).alias("deliv_pct_std"),
        (F.avg("turnover_lacs").over(earlier20) / 100).alias("avg_turnover_cr_20d"),
        (ratio(F.col("close"), F.lag("close", 3).over(w)) - 1).alias("return_3d"),
    ).drop("_log_volume").withColumns({"at_circuit": _at_circuit(p), "pump_due": pump})
    # the memory looks at the bare pump condition, whether or not that row had enough history
    based = based.withColumn("pumped_recently", any_before(F.col("pump_due"), w, p.dump_lookback_days))
    if p.circuit_same_direction:
        up = with_streak(based, F.col("at_circuit") & (F.col("return_pct") > 0), w, "_up")
        based = with_streak(up, F.col("at_circuit") & (F.col("return_pct") < 0), w, "_down").withColumn(
            "circuit_streak", F.greatest("_up", "_down")).drop("_up", "_down")
    else:
        based = with_streak(based, F.col("at_circuit"), w, "circuit_streak")

    # settled, so that its size is known and the wide rows are not shuffled by day for a small table
    peers = settle(peer_returns(universe), "peers")
    floor = F.greatest(F.col("volatility_20d_pct"), F.lit(p.volatility_floor_pct))
    return (based.join(peers, ["trade_date", "industry"], "left")
            .withColumn("price_z", F.abs(F.col("return_pct") - F.col("peer_return_pct")) / floor))


def _shown() -> list[str | Column]:
    def shown(c: str) -> Column:
        return rounded(c, 2).alias(c)

    return ["trade_date", "date_key", "symbol", "stock_sk", "company_name", "industry", "series", "close", "return_pct",
            "gap_pct", "return_5d_pct", rounded(F.col("return_3d") * 100, 2).alias("return_3d_pct"), "volume",
            "volume_ratio_20d", shown("volume_ratio_5d"), shown("volume_z"), shown("price_z"), "deliv_pct",
            shown("deliv_pct_5d"), rounded("deliv_pct_base", 2).alias("deliv_pct_20d_avg"), shown("peer_return_pct"),
            shown("avg_turnover_cr_20d"), "circuit_streak", "history_days"]


def _flags(p: SurveillanceParams) -> dict[str, Column]:
    """The seven rules over the measures. A row needs history before any rule may fire."""
    seasoned = F.col("history_days") >= p.min_history_days
    rule = _rules(p)
    fell = (F.col("return_pct") <= -p.dump_return_pct) | (F.col("return_3d") <= -p.dump_return_3d_pct / 100.0)
    return {
        "r_volume_spike": seasoned & _true(rule["spike"]),
        "r_price_shock": seasoned & _true(rule["shock"]),
        "r_pump": seasoned & _true(F.col("pump_due")),
        "r_dump_after_pump": seasoned & F.col("pumped_recently") & fell,
        "r_delivery_anomaly": seasoned & _true(rule["delivery"]),
        "r_circuit_streak": seasoned & (F.col("circuit_streak") >= p.circuit_streak_days),
        "r_gap_move": seasoned & _true(rule["gap"])}


def flagged(measures: DataFrame, p: SurveillanceParams = SurveillanceParams()) -> DataFrame:
    """The seven rules under one baseline."""
    return measures.select(*_shown(), *[c.alias(name) for name, c in _flags(p).items()])


def signals(fact: DataFrame, stocks: DataFrame, p: SurveillanceParams = SurveillanceParams()) -> DataFrame:
    return flagged(measured(fact, stocks, p), p)


def _points(p: SurveillanceParams, prefix: str = "") -> dict[str, Column]:
    """Points of each rule when it fired; the steeper the event the more, up to a cap."""
    if p.baseline == "per_stock":
        volume, shock = 8 * F.col("volume_z"), 6 * F.col("price_z")
    else:
        volume = 10 * F.log2("volume_ratio_20d")
        shock = 2 * F.abs(F.col("return_pct") - F.col("peer_return_pct"))
    earned = {
        "pts_volume": F.least(F.lit(40.0), rounded(volume)),
        "pts_price_shock": F.least(F.lit(30.0), rounded(shock)),
        "pts_pump": F.lit(25),
        "pts_dump": F.lit(30),
        "pts_delivery": F.lit(15),
        "pts_circuit": F.least(F.lit(30), 10 * F.col("circuit_streak")),
        "pts_gap": F.least(F.lit(20.0), rounded(2 * F.abs("gap_pct"))),
    }
    points = {name: F.when(F.col(prefix + flag), earned[name]).otherwise(0) for flag, name, _ in fixed.RULES}
    points["pts_illiquid"] = F.when(F.col("avg_turnover_cr_20d") < p.illiquid_turnover_cr, 10).otherwise(0)
    return points


def risk_band(score: Column, p: SurveillanceParams) -> Column:
    return F.when(score >= p.high_score, "HIGH").when(score >= p.medium_score, "MEDIUM").otherwise("LOW")


def _reason(p: SurveillanceParams) -> Column:
    def n(c: str, places: int = 1) -> Column:
        return text.fixed(F.col(c), places)

    move, peer = text.signed(F.col("return_pct")), text.signed(F.col("peer_return_pct"))
    if p.baseline == "per_stock":
        volume = text.phrase(fixed.REASON_VOLUME_Z, n("volume_ratio_20d"), n("volume_z"))
        shock = text.phrase(fixed.REASON_SHOCK_Z, move, peer, n("price_z"))
    else:
        volume = text.phrase(fixed.REASON_VOLUME, n("volume_ratio_20d"))
        shock = text.phrase(fixed.REASON_SHOCK, move, peer)
    parts = {
        "r_volume_spike": volume,
        "r_price_shock": shock,
        "r_pump": text.phrase(fixed.REASON_PUMP, n("return_5d_pct"), n("volume_ratio_5d"), n("deliv_pct_5d", 0),
                              n("deliv_pct_20d_avg", 0)),
        "r_dump_after_pump": text.phrase(fixed.REASON_DUMP, n("return_pct"), n("return_3d_pct")),
        "r_delivery_anomaly": text.phrase(fixed.REASON_DELIVERY, n("deliv_pct", 0), n("deliv_pct_20d_avg", 0),
                                          n("volume_ratio_20d")),
        "r_circuit_streak": text.phrase(fixed.REASON_CIRCUIT, F.col("circuit_streak").cast("string")),
        "r_gap_move": text.phrase(fixed.REASON_GAP, text.signed(F.col("gap_pct"))),
    }
    fired = [F.when(F.col(flag), parts[flag]) for flag, _, _ in fixed.RULES]
    thin = F.when(F.col("pts_illiquid") > 0, text.phrase(fixed.REASON_ILLIQUID, n("avg_turnover_cr_20d", 2)))
    return F.concat_ws("; ", *fired, thin)


def _any_fired(prefix: str = "") -> Column:
    return reduce(lambda a, b: a | b, [F.col(prefix + flag) for flag, _, _ in fixed.RULES])


def _risk_score(prefix: str = "") -> Column:
    """Strongest rule in full, the others at half, plus illiquidity."""
    names = [prefix + name for _, name, _ in fixed.RULES]
    strongest = F.greatest(*names)
    everything = reduce(lambda a, b: a + b, [F.col(n) for n in names])
    return F.least(F.lit(100.0), rounded(strongest + 0.5 * (everything - strongest) + F.col(prefix + "pts_illiquid")))


def scored(signal: DataFrame, p: SurveillanceParams = SurveillanceParams()) -> DataFrame:
    """Signals that reach the minimum score."""
    return (signal.filter(_any_fired()).withColumns({n: c.cast("double") for n, c in _points(p).items()})
            .withColumn("risk_score", _risk_score()).filter(F.col("risk_score") >= p.min_alert_score))


def scored_by_baseline(measures: DataFrame, p: SurveillanceParams = SurveillanceParams()) -> DataFrame:
    """(trade_date, symbol, and for each baseline its risk score, null where it raises no alert), every stock-day once."""
    chosen = {baseline: replace(p, baseline=baseline) for baseline in BASELINES}
    flags = [c.alias(f"{b}_{name}") for b, q in chosen.items() for name, c in _flags(q).items()]
    judged = measures.select(*_shown(), *flags)
    points = judged.withColumns({f"{b}_{n}": c.cast("double") for b, q in chosen.items()
                                 for n, c in _points(q, f"{b}_").items()})
    scores = points.select("trade_date", "symbol", *[F.when(_any_fired(f"{b}_"), _risk_score(f"{b}_")).alias(b) for b in chosen])
    return scores.select("trade_date", "symbol", *[F.when(F.col(b) >= p.min_alert_score, F.col(b)).alias(b) for b in chosen])


def news_by_day(filings: DataFrame, lookback_days: int) -> DataFrame:
    """What was filed in the days up to each date, per symbol.

    Filings are carried forward to the days they count for and combined there, so the alerts meet at most
    one row each however many filings a symbol has.
    """
    kind = F.col("news_type")
    material = ~kind.isin(fixed.ROUTINE, fixed.EXCHANGE_QUERY)
    useful = filings.filter(kind != fixed.ROUTINE)
    carried = spread_days(useful.select("symbol", "announced_date", "news_type"), "announced_date", "trade_date",
                          lookback_days)
    seen = carried.groupBy("symbol", "trade_date").agg(
        *[F.max((kind == name).cast("int")).alias(f"_{name}") for name in fixed.MATERIAL_NEWS],
        F.count_if(material).alias("material_news_count"),
        F.bool_or(kind == fixed.EXCHANGE_QUERY).alias("exchange_query"))
    listed = F.concat_ws(", ", *[F.when(F.col(f"_{name}") == 1, name) for name in fixed.MATERIAL_NEWS])
    return seen.select("symbol", "trade_date", F.nullif(listed, F.lit("")).alias("news_types"),
                       "material_news_count", "exchange_query")


def alerts(signal: DataFrame, filings: DataFrame, p: SurveillanceParams = SurveillanceParams()) -> DataFrame:
    """Scored, explained alerts with the filings around them as context; news never changes a score."""
    found = scored(signal, p)
    joined = found.join(news_by_day(filings, p.news_lookback_days), ["symbol", "trade_date"], "left")
    rule_names = F.concat_ws(", ", *[F.when(F.col(flag), label) for flag, _, label in fixed.RULES])
    return joined.select(
        F.md5(F.concat_ws("|", F.col("trade_date").cast("string"), "symbol")).alias("alert_id"),
        "date_key", "trade_date", "symbol", "stock_sk", "company_name", "industry", "risk_score",
        risk_band(F.col("risk_score"), p).alias("risk_band"), rule_names.alias("rules_triggered"),
        _reason(p).alias("reason"), "close", "return_pct", "gap_pct", "return_5d_pct", "volume", "volume_ratio_20d",
        "deliv_pct", "deliv_pct_20d_avg", "peer_return_pct", "avg_turnover_cr_20d", "circuit_streak", "volume_z",
        "price_z", *[name for _, name, _ in fixed.RULES], "pts_illiquid", "news_types",
        F.coalesce("material_news_count", F.lit(0)).alias("material_news_count"),
        F.coalesce("exchange_query", F.lit(False)).alias("exchange_query"))


def score_breakdown(alert: DataFrame) -> DataFrame:
    """(alert, rule, points) for the rules that earned any."""
    published = {points: label for _, points, label in fixed.RULES}
    published["pts_illiquid"] = "ILLIQUID"
    long = alert.select("alert_id", "trade_date", "symbol", *published).unpivot(
        ["alert_id", "trade_date", "symbol"], list(published), "_column", "points").filter("points > 0")
    names = F.create_map(*[F.lit(x) for pair in published.items() for x in pair])
    return long.select("alert_id", "trade_date", "symbol", names[F.col("_column")].alias("rule"), "points")
