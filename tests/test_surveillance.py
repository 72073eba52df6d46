"""Scores, explanations, validation, triage and digest on small hand-made tables."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.params import SurveillanceParams
from tidemark.plans import screens, signals, triage, validation

TODAY = dt.date(2026, 10, 6)
SIGNAL = ("trade_date date, date_key int, symbol string, stock_sk string, company_name string, industry string, "
          "series string, close double, return_pct double, gap_pct double, return_5d_pct double, return_3d_pct double, "
          "volume long, volume_ratio_20d double, volume_ratio_5d double, volume_z double, price_z double, "
          "deliv_pct double, deliv_pct_5d double, deliv_pct_20d_avg double, peer_return_pct double, "
          "avg_turnover_cr_20d double, circuit_streak long, history_days long, r_volume_spike boolean, "
          "r_price_shock boolean, r_pump boolean, r_dump_after_pump boolean, r_delivery_anomaly boolean, "
          "r_circuit_streak boolean, r_gap_move boolean")
CALM = dict(trade_date=TODAY, date_key=20261006, symbol="ONE", stock_sk="k", company_name="One Ltd", industry="IT",
            series="EQ", close=100.0, return_pct=1.0, gap_pct=0.0, return_5d_pct=0.0, return_3d_pct=0.0, volume=1000,
            volume_ratio_20d=1.0, volume_ratio_5d=1.0, volume_z=0.0, price_z=0.0, deliv_pct=50.0, deliv_pct_5d=50.0,
            deliv_pct_20d_avg=50.0, peer_return_pct=0.0, avg_turnover_cr_20d=5.0, circuit_streak=0, history_days=90,
            r_volume_spike=False, r_price_shock=False, r_pump=False, r_dump_after_pump=None, r_delivery_anomaly=False,
            r_circuit_streak=False, r_gap_move=False)


def judged(spark, filings=(), p=SurveillanceParams(), **changes):
    row = {**CALM, **changes}
    filed = spark.createDataFrame(list(filings), "symbol string, announced_date date, news_type string")
    return signals.alerts(spark.createDataFrame([tuple(row.values())], SIGNAL), filed, p).collect()


def test_correlated_rules_are_dampened_and_news_is_attached(spark):
    def day(n):
        return TODAY - dt.timedelta(days=n)

    # 10 log2(6) = 25.8 and 2 |-10.4 - 1.3| = 23.4 points, the smaller at half: 26 + 23 / 2 = 37.5
    found = judged(spark, [("ONE", day(1), "ORDER_WIN"), ("ONE", day(3), "CORPORATE_DEAL"), ("ONE", day(1), "ORDER_WIN"),
                           ("ONE", day(0), "ROUTINE"), ("ONE", day(4), "RESULTS"), ("TWO", day(0), "RESULTS")],
                   return_pct=-10.4, peer_return_pct=1.3, volume_ratio_20d=6.0, r_volume_spike=True, r_price_shock=True)
    a, = found
    assert (a["pts_volume"], a["pts_price_shock"], a["risk_score"], a["risk_band"]) == (26.0, 23.0, 38.0, "LOW")
    assert a["rules_triggered"] == "VOLUME_SPIKE, PRICE_SHOCK"
    assert a["reason"] == "Volume 6.0x its 20-day average; Moved -10.4% while its sector moved +1.3%"
    assert (a["news_types"], a["exchange_query"]) == ("CORPORATE_DEAL, ORDER_WIN", False)


def test_thinly_traded_pump_with_a_gap(spark):
    # 25 for the pump, half of 2 x 7.3 = 15 for the gap, 10 for the thin trade: 42.5
    a, = judged(spark, [("ONE", TODAY - dt.timedelta(days=2), "EXCHANGE_QUERY")], return_5d_pct=21.4, volume_ratio_5d=3.2,
                deliv_pct_5d=17.0, deliv_pct_20d_avg=44.0, gap_pct=7.3, avg_turnover_cr_20d=0.25, r_pump=True,
                r_gap_move=True)
    assert (a["risk_score"], a["risk_band"], a["rules_triggered"]) == (43.0, "MEDIUM", "PUMP_PATTERN, GAP_MOVE")
    assert a["reason"] == ("Up 21.4% in 5 days on 3.2x volume with delivery only 17% (usual 44%); "
                           "Opened +7.3% from previous close and held the gap; Thinly traded (avg turnover Rs 0.25 cr/day)")
    assert (a["news_types"], a["material_news_count"], a["exchange_query"]) == (None, 0, True)


def test_points_below_the_minimum_are_no_alert(spark):
    assert judged(spark, deliv_pct=12.0, volume_ratio_20d=3.5, r_delivery_anomaly=True) == []     # 15 points


def test_score_is_capped_and_high(spark):
    a, = judged(spark, volume_ratio_20d=40.0, return_pct=30.0, gap_pct=20.0, circuit_streak=6, avg_turnover_cr_20d=0.1,
                **{flag: True for flag in CALM if flag.startswith("r_")})
    assert (a["risk_score"], a["risk_band"]) == (100.0, "HIGH")


def test_per_stock_points_and_words(spark):
    p = SurveillanceParams(baseline="per_stock")
    a, = judged(spark, p=p, volume_ratio_20d=2.5, volume_z=4.26, price_z=4.0, return_pct=-6.0, r_volume_spike=True,
                r_price_shock=True)
    assert (a["pts_volume"], a["pts_price_shock"], a["risk_score"]) == (34.0, 24.0, 46.0)
    assert a["reason"] == ("Volume 2.5x its 20-day average (4.3 sd above its own normal); "
                           "Moved -6.0% while its sector moved +0.0% (4.0x its usual daily swing)")


def test_unknown_baseline_is_refused():
    with pytest.raises(ValueError):
        SurveillanceParams(baseline="other")


OUTCOME = ("symbol string, best_band string, exchange_queried boolean, query_lead_days int, on_stasm boolean, "
           "on_any_list boolean")


def test_lift_against_the_base_rate(spark):
    # of eight stocks three are queried (37.5 %), two are on the short list (25 %), three on any list
    rows = [("P", "HIGH", True, 4, True, True), ("Q", "HIGH", False, None, False, True), ("R", "LOW", True, -2, False, False),
            ("S", "NOT_ALERTED", False, None, True, True), ("T", "NOT_ALERTED", True, None, False, False)]
    rows += [(f"U{i}", "NOT_ALERTED", False, None, False, False) for i in range(3)]
    got = {r["segment"]: r for r in validation.validation(spark.createDataFrame(rows, OUTCOME)).collect()}
    assert [s for s in got] == ["HIGH", "LOW", "ANY_ALERT", "NOT_ALERTED", "ALL_STOCKS"]

    def of(segment, *columns):
        return tuple(got[segment][c] for c in columns)

    assert of("HIGH", "queried_pct", "queried_lift", "stasm_lift", "any_list_lift", "flagged_before_query") == (
        50.0, 1.3, 2.0, 2.7, 1)
    assert of("LOW", "queried_lift", "stasm_lift", "flagged_after_query", "median_query_lead_days") == (2.7, 0.0, 1, -2.0)
    assert of("ANY_ALERT", "stocks", "queried_pct", "queried_lift", "stasm_lift", "median_query_lead_days") == (
        3, 66.7, 1.8, 1.3, 1.0)
    assert of("NOT_ALERTED", "queried_lift", "stasm_lift", "median_query_lead_days") == (0.5, 0.8, None)
    assert of("ALL_STOCKS", "queried_lift", "any_list_lift") == (1.0, 1.0)


def test_lead_histogram_names_only_the_first_few(spark):
    rows = [(f"S{i:02d}", "LOW", True, 12, False, False) for i in range(10)] + [("T", "LOW", True, -9, False, False)]
    got = {r["bucket"]: r for r in validation.lead_histogram(spark.createDataFrame(rows, OUTCOME)).collect()}
    assert len(got) == 11 and got[7]["n"] == 10 and got[0]["n"] == 0 and got[0]["names"] == ""
    assert got[7]["names"] == ", ".join(f"S{i:02d}" for i in range(8)) + " and more" and got[-3]["names"] == "T"


ALERT = ("alert_id string, trade_date date, symbol string, company_name string, risk_score double, risk_band string, "
         "rules_triggered string, reason string, news_types string, exchange_query boolean, industry string, "
         "material_news_count long")


def alert_rows(spark, rows):
    full = [(f"a{i}", d, s, f"{s} Ltd", score, band, "VOLUME_SPIKE, PRICE_SHOCK", "Volume 9.0x", news, query, "IT", 0)
            for i, (d, s, score, band, news, query) in enumerate(rows)]
    return spark.createDataFrame(full, ALERT)


def test_rule_triage(spark):
    rows = [(TODAY, "QUIET", 72.0, "HIGH", None, False), (TODAY, "ASKED", 33.0, "LOW", None, True),
            (TODAY, "FILED", 55.0, "MEDIUM", "CORPORATE_DEAL, REGULATORY_LEGAL", True)]
    got = {r["symbol"]: (r["verdict"], r["line"]) for r in triage.rule_triage(alert_rows(spark, rows)).collect()}
    assert [got[s][0] for s in ("QUIET", "ASKED", "FILED")] == ["UNEXPLAINED", "UNEXPLAINED", "UNCLEAR"]
    assert len({line for _, line in got.values()}) == 3 and "corporate deal, regulatory legal" in got["FILED"][1]


@pytest.mark.parametrize("reply, verdict, line", [
    (' ```json{"line": "Board  met \\t today ", "verdict": "unclear"}```', "UNCLEAR", "Board met today"),
    ('{"verdict": "LIKELY", "line": "an order"}', None, None),
    ('{"line": "no verdict given"}', None, None),
    ('{"verdict": "UNEXPLAINED", "line": "   "}', None, None),
    ("[timed out", None, None),
    ('{"verdict": "EXPLAINED", "line": "' + "split  " * 60 + '"}', "EXPLAINED", ("split " * 24)[:140]),
])
def test_reply(spark, reply, verdict, line):
    got = spark.createDataFrame([(reply,)], "r string").select(triage.read_reply(F.col("r")).alias("x")).first()["x"]
    assert got is None if verdict is None else (got["verdict"], got["line"]) == (verdict, line)


def test_reply_is_used_only_with_news(spark):
    rows = [(TODAY, "A", 80.0, "HIGH", None, False), (TODAY, "B", 80.0, "HIGH", "RESULTS", False),
            (TODAY, "C", 80.0, "HIGH", "RESULTS", False)]
    replies = spark.createDataFrame([("a0", '{"verdict": "EXPLAINED", "line": "z"}'),
                                     ("a1", '{"verdict": "EXPLAINED", "line": "z"}')], "alert_id string, reply string")
    got = {r["symbol"]: (r["verdict"], r["source"])
           for r in triage.triage_with_replies(alert_rows(spark, rows), replies, "gm").collect()}
    assert got == {"A": ("UNEXPLAINED", "rules"), "B": ("EXPLAINED", "llm:gm"), "C": ("UNCLEAR", "rules")}


def test_cache_prefers_better_answers(spark):
    schema = "alert_id string, trade_date date, symbol string, verdict string, line string, source string"
    cached = spark.createDataFrame([("1", TODAY, "A", "UNCLEAR", "old", "rules"), ("2", TODAY, "B", "EXPLAINED", "old", "llm:m"),
                                    ("3", TODAY, "C", "UNCLEAR", "old", "rules")], schema)
    fresh = spark.createDataFrame([("1", TODAY, "A", "EXPLAINED", "new", "llm:m"), ("2", TODAY, "B", "UNCLEAR", "new", "rules"),
                                   ("3", TODAY, "C", "UNCLEAR", "new", "rules"), ("4", TODAY, "D", "UNCLEAR", "new", "rules")],
                                  schema)
    got = {r["alert_id"]: r["line"] for r in triage.merge_cache(cached, fresh).collect()}
    assert got == {"1": "new", "2": "old", "3": "old", "4": "new"}


def digest_text(spark, rows, checks=None):
    alert = alert_rows(spark, rows)
    day = triage.day_alerts(alert, triage.rule_triage(alert))
    lines = triage.digest(day, alert, checks).filter(F.col("trade_date") == F.lit(TODAY)).orderBy("section", "position")
    return [r["text"] for r in lines.collect()]


def test_digest_lists_high_names_then_new_medium_ones(spark):
    def before(n):
        return TODAY - dt.timedelta(days=n)

    rows = [(TODAY, "RIVER", 91.0, "HIGH", "CORPORATE_DEAL", False), (TODAY, "STONE", 76.0, "HIGH", None, True),
            (TODAY, "CLOUD", 61.0, "MEDIUM", None, False), (TODAY, "MEADOW", 41.0, "MEDIUM", None, False),
            (before(2), "MEADOW", 44.0, "MEDIUM", None, False), (before(2), "GROVE", 71.0, "HIGH", None, False)]
    checks = spark.createDataFrame([(TODAY, "counts", "PASS")], "run_date date, check_name string, status string")
    lines = digest_text(spark, rows, checks)
    assert lines[1:3] == ["4 flagged · 2 HIGH · 2 MEDIUM", "🚨 HIGH (2)"]
    assert lines.index("• RIVER (91) RIVER Ltd") < lines.index("• STONE (76) STONE Ltd")
    assert any(x.startswith("• CLOUD (61)") for x in lines) and not any("MEADOW" in x or "GROVE" in x for x in lines)
    assert "👀 Watchlist: top 1 new MEDIUM names" in lines and "🩺 Data quality: all checks passed" in lines


def test_digest_without_high_names_and_checks(spark):
    lines = digest_text(spark, [(TODAY, "CLOUD", 52.0, "MEDIUM", "ORDER_WIN", False)])
    assert "🚨 No HIGH alerts today" in lines and "🩺 Data quality: not checked in this run" in lines


@pytest.mark.parametrize("gap, repeated", [(6, False), (5, True), (1, True)])
def test_a_name_is_new_again_after_five_alert_days(spark, gap, repeated):
    rows = [(TODAY - dt.timedelta(days=n), "X" if n in (0, gap) else f"Y{n}", 45.0, "MEDIUM", None, False) for n in range(7)]
    got = triage.with_repeats(alert_rows(spark, rows)).filter("symbol = 'X'").orderBy("trade_date").collect()
    assert [r["repeated"] for r in got] == [False, repeated]


def test_resolve_names(spark):
    directory = spark.createDataFrame([
        ("TCS", "Tata Consultancy Services Limited", 90.0), ("TATAM", "Tata Motors Limited", 80.0),
        ("INFY", "Infosys Limited", 70.0), ("NEWT", "New Tata Ltd.", 99.0), ("ONLY", None, 1.0)],
        "symbol string, company_name string, avg_turnover_lacs double")
    tokens = spark.createDataFrame([(t,) for t in ("tcs.NS", " infosys", "tata", "MOTORS", "nobody", "", "a.c", "new tata",
                                                   "s")], "token string")
    got = {r["token"]: (r["symbol"], r["matched_by"]) for r in screens.resolve_names(tokens, directory).collect()}
    assert got == {"tcs.NS": ("TCS", "symbol"), "infosys": ("INFY", "exact name"), "tata": ("TCS", "name starts with"),
                   "MOTORS": ("TATAM", "name contains"), "nobody": (None, "not found"), "a.c": (None, "not found"),
                   "new tata": ("NEWT", "exact name"), "s": ("TCS", "name contains")}


def test_names_that_start_alike_meet_few_tokens(spark):
    """2,000 names and tokens share their first word; only names that hold a token's rarest gram are candidates."""
    number = F.lpad(F.conv(F.col("id"), 10, 36), 4, "0")
    known = spark.range(2000).select(F.concat(F.lit("S"), "id").alias("symbol"),
                                     F.concat(F.lit("ALPHA "), number, F.lit(" LIMITED")).alias("_name"),
                                     F.col("id").cast("double").alias("_turnover"))
    wanted = spark.range(2000).select(F.concat(F.lit("ALPHA "), number).alias("_t"))
    pairs = screens.name_candidates(wanted, known)
    assert pairs.filter(F.col("_name").contains(F.col("_t"))).count() == 2000
    assert pairs.count() < 2000 * 60            # four million met on the first letters
    unknown = spark.createDataFrame([("ALPHQ 0001",)], "_t string")
    assert screens.name_candidates(unknown, known).count() == 0
