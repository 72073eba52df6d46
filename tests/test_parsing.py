"""Text and file readers."""
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions.classify import corporate_action, index_family, news_type
from tidemark.functions.cleaning import date_key, day, month_steps, number, require_columns, rounded, whole
from tidemark.operators.ordering import forward_fill
from tidemark.sources import bronze


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("subject, kind, factor", [
    ("Stock SPLIT of shares from Rs. 6 each to Rs.1.50 each", "SPLIT", 4.0),
    ("split: from re 12 to re 4", "SPLIT", 3.0),
    ("Record date for bonus 3:4", "BONUS", 1.75),
    ("BONUS  9 :2 issue", "BONUS", 5.5),
    ("Rights from Rs 10 to Rs 2", None, None),
    ("Split from Rs 2 to Rs 2", None, None),
    ("Split from Rs 1.2.3 to Rs 2", None, None),
    ("Bonus 0:5", None, None),
    ("Final Dividend - Rs 4", None, None),
    ("", None, None),
])
def test_corporate_action(spark, subject, kind, factor):
    found = one(spark, corporate_action(F.col("s")), s=subject)
    assert (found is None) == (kind is None)
    if kind:
        assert found["action_type"] == kind and found["factor"] == pytest.approx(factor)


@pytest.mark.parametrize("category, summary, kind", [
    ("Spurt in Volume", "x", "EXCHANGE_QUERY"), ("Clarification sought", "x", "EXCHANGE_QUERY"),
    ("Outcome of Board Meeting", "x", "RESULTS"), ("Press Release", "Update for q2 fy 27", "RESULTS"),
    ("Press Release", "FAQ2FY27", "OTHER"), ("Award of orders/contracts", "x", "ORDER_WIN"),
    ("Open Offer", "x", "CORPORATE_DEAL"), ("open offer", "x", "OTHER"), ("Action(s) taken", "x", "REGULATORY_LEGAL"),
    ("Copy of Newspaper Publication", "x", "ROUTINE"), ("Extension  of Financial Year", "x", "ROUTINE"),
    ("Extension of Financial Year", "x", "OTHER"),
])
def test_news_type(spark, category, summary, kind):
    assert one(spark, news_type(F.col("c"), F.col("s")), c=category, s=summary) == kind


def test_news_type_without_category(spark):
    df = spark.createDataFrame([(None, "Q1 FY25 update"), (None, None)], "c string, s string")
    assert [r[0] for r in df.select(news_type(F.col("c"), F.col("s"))).collect()] == ["RESULTS", "OTHER"]


@pytest.mark.parametrize("name, family", [
    ("Nifty 50", "Broad Market"), ("Nifty Midcap 150", "Broad Market"), ("Nifty50", "Strategy / Thematic"),
    ("Nifty IT", "Sectoral"), ("NIFTY BANK", "Sectoral"), ("India VIX", "Volatility"), ("Nifty 10 yr SDL", "Fixed Income"),
])
def test_index_family(spark, name, family):
    assert one(spark, index_family(F.col("n")), n=name) == family


def test_cleaning(spark):
    assert one(spark, number("v"), v=" 12.5 ") == 12.5
    assert one(spark, number("v"), v="-") is None
    assert one(spark, number("v"), v="junk") is None
    assert one(spark, day("v"), v=" 06-Oct-2026") == dt.date(2026, 10, 6)
    assert one(spark, day("v"), v="2026/10/06") is None
    assert one(spark, date_key("v"), v=dt.date(2026, 1, 9)) == 20260109
    assert one(spark, month_steps(F.col("a"), F.col("b")), a=dt.date(2025, 12, 31), b=dt.date(2026, 1, 1)) == 1
    assert one(spark, rounded("v", 3), v=-3.5514999999999994) == -3.552


@pytest.mark.parametrize("places", [0, 2, 4, 6])
def test_rounding_is_half_up_at_every_magnitude(spark, places):
    import math
    import random
    from decimal import ROUND_HALF_UP, Decimal
    rng = random.Random(places)
    values = [8388608.125, 20000000.125, 1.0000004996, 1.005, 2.675, -0.5, 0.0, 1e15 + 0.5, None]
    for power in range(-3, 13):
        for _ in range(40):
            x = rng.uniform(-1, 1) * 10.0 ** power
            values += [x, float(f"{x:.{places}f}5")]        # the second is a tie, as its digits read
    got = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x double").select(
        "i", rounded("x", places).alias("r")).collect()
    unit = Decimal(1).scaleb(-places)
    hair = 5e-10 if places < 5 else 5e-6 * 10.0 ** -places
    for i, r in got:
        x = values[i]
        if x is None:
            assert r is None
            continue
        plain, over = (Decimal(repr(y)).quantize(unit, ROUND_HALF_UP) for y in
                       (x, x + math.copysign(hair + 4 * math.ulp(x), x)))
        close = 8 * math.ulp(x)
        assert abs(r - float(plain)) <= close or abs(r - float(over)) <= close, x
        if x == float(f"{x:.{places + 1}f}"):               # the digits say where it goes
            assert abs(r - float(plain)) <= close, x


@pytest.mark.parametrize("text, value", [("12.9", 12), ("-3", -3), ("NaN", None), ("1e30", None), ("Infinity", None),
                                         ("", None), ("7e2", 700)])
def test_whole_numbers_of_untidy_text(spark, text, value):
    assert spark.createDataFrame([(text,)], "v string").select(whole("v").alias("x")).first()["x"] == value


def test_header_blanks_and_missing_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["A ", " B"])
    assert require_columns(df, ["A", "B"], "x").columns == ["A", "B"]
    with pytest.raises(ValueError, match="schema drift"):
        require_columns(df, ["A", "C"], "x")


NAV_TEXT = """Scheme Code;ISIN Div Payout/ ISIN Growth;ISIN Div Reinvestment;Scheme Name;Net Asset Value;Date

Open Ended Schemes(Equity Scheme - Mid Cap Fund)

First House Mutual Fund

201;INF001;-;First Mid Cap - Growth;45.5;06-Oct-2026
202;INF002;INF003;First Mid Cap - IDCW;N.A.;06-Oct-2026
203;INF004;-;First Bad Date;10.0;sometime

Close Ended Schemes(Debt Scheme (Short))
Second House Mutual Fund
204;-;;Second Debt;Direct;Growth;99.25;05-Oct-2026
x05;-;-;Not a code;1;05-Oct-2026
"""


def nav_rows(df):
    return {r["scheme_code"]: r.asDict() for r in df.collect()}


def check_nav(rows):
    assert sorted(rows) == [201, 202, 204]
    assert rows[201]["nav"] == 45.5 and rows[201]["isin_reinvest"] is None
    assert rows[201]["category"] == "Equity Scheme - Mid Cap Fund" and rows[201]["amc"] == "First House Mutual Fund"
    assert rows[202]["nav"] is None and rows[202]["isin_reinvest"] == "INF003"
    assert rows[204]["nav"] == 99.25 and rows[204]["nav_date"] == dt.date(2026, 10, 5)
    assert rows[204]["amc"] == "Second House Mutual Fund" and rows[204]["isin_growth"] is None
    assert rows[204]["category"] == "Debt Scheme (Short"


def test_nav_file(spark, tmp_path):
    folder = tmp_path / "amfi_navall" / "dt=2026-10-06"
    folder.mkdir(parents=True)
    (folder / "NAVAll.txt").write_text(NAV_TEXT)
    check_nav(nav_rows(bronze.fund_nav(spark, str(tmp_path))))
    assert bronze.fund_nav(spark, str(tmp_path), [dt.date(2026, 10, 7)]).count() == 0
    assert bronze.fund_nav(spark, str(tmp_path / "nowhere")) is None


@pytest.mark.parametrize("size", [1, 3, 100])
def test_nav_lines_in_chunks_of_any_size(spark, size):
    lines = [("f", i // size, i, text) for i, text in enumerate(NAV_TEXT.splitlines())]
    check_nav(nav_rows(bronze.parse_nav_lines(
        spark.createDataFrame(lines, "file string, chunk long, line_no long, line string"))))


def test_nav_file_split_over_tasks(spark, tmp_path):
    """A file larger than a split keeps its headings across the cut."""
    folder = tmp_path / "amfi_navall" / "dt=2026-10-06"
    folder.mkdir(parents=True)
    heads = ["Open Ended Schemes(Kind %d)\nHouse %d\n" % (k, k) for k in range(3)]
    body = ["".join(f"{k * 10000 + i};I;-;Name;1.5;06-Oct-2026\n" for i in range(3000)) for k in range(3)]
    (folder / "NAVAll.txt").write_text("".join(h + b for h, b in zip(heads, body)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = bronze.nav_lines(spark, str(tmp_path))
        assert lines.select("chunk").distinct().count() > 5
        got = bronze.parse_nav_lines(lines).groupBy((F.col("scheme_code") / 10000).cast("int").alias("k")).agg(
            F.count("*").alias("n"), F.min("amc").alias("lo"), F.max("amc").alias("hi"),
            F.min("category").alias("c")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r["k"], r["n"], r["lo"], r["hi"], r["c"]) for r in got) == [
        (k, 3000, f"House {k}", f"House {k}", f"Kind {k}") for k in range(3)]


def test_forward_fill_matches_a_plain_loop(spark):
    import random
    random.seed(3)
    rows = [(f"g{g}", i // 4, i, random.choice([None, None, f"v{i}"])) for g in range(3) for i in range(40)]
    got = forward_fill(spark.createDataFrame(rows, "g string, c int, i int, v string"), ["g"], "c", ["i"], ["v"])
    expected, last = {}, {}
    for g, _, i, v in rows:
        last[g] = v if v is not None else last.get(g)
        expected[g, i] = last[g]
    assert {(r["g"], r["i"]): r["v"] for r in got.collect()} == expected


def put(root, source, day, name, payload):
    folder = root / source / f"dt={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(payload if isinstance(payload, str) else json.dumps(payload))


def test_fund_history_takes_newest_snapshot_and_skips_bad_rows(spark, tmp_path):
    meta = {"scheme_code": 7, "scheme_name": "S", "fund_house": "H", "scheme_category": "C"}
    put(tmp_path, "mfapi_history", "2026-10-01", "7.json", {"meta": meta, "data": [{"date": "01-10-2026", "nav": "9"}]})
    put(tmp_path, "mfapi_history", "2026-10-06", "7.json", {"meta": meta, "data": [
        {"date": "06-10-2026", "nav": "88.997"}, {"date": "03-10-2026", "nav": "0.0"}, {"date": "bad", "nav": "1"},
        {"nav": "3"}]})
    rows = bronze.fund_history(spark, str(tmp_path)).collect()
    assert [(r["scheme_code"], r["nav_date"], r["nav"], r["amc"]) for r in rows] == [
        (7, dt.date(2026, 10, 6), 88.997, "H")]


def test_lists_filings_actions_holidays(spark, tmp_path):
    root = str(tmp_path)
    put(tmp_path, "nse_surveillance_lists", "2026-10-06", "asm.json", {
        "shortterm": {"data": [{"symbol": " aa ", "asmSurvIndicator": "I", "survDesc": "d"}]}, "longterm": {"data": []}})
    alone = {(r["symbol"], r["list_type"]) for r in bronze.surveillance_lists(spark, root).collect()}
    assert alone == {("AA", "STASM")}
    put(tmp_path, "nse_surveillance_lists", "2026-10-06", "gsm.json", [{"symbol": "bb", "gsmStage": "2", "survDesc": "e"}])
    lists = {(r["symbol"], r["list_type"], r["stage"]) for r in bronze.surveillance_lists(spark, root).collect()}
    assert lists == {("AA", "STASM", "I"), ("BB", "GSM", "2")}
    put(tmp_path, "nse_announcements", "2026-10-06", "a.json", [
        {"seq_id": "1", "symbol": "aa", "sort_date": "2026-10-06 09:30:00", "desc": " Results ", "attchmntText": None},
        {"symbol": "aa", "sort_date": "2026-10-06 09:30:00"}, {"seq_id": "3", "symbol": "aa", "sort_date": "today"}])
    filed = bronze.announcements(spark, root).collect()
    assert [(r["seq_id"], r["symbol"], r["category"], r["summary"]) for r in filed] == [("1", "AA", "Results", "")]
    put(tmp_path, "nse_corp_actions", "2026-10-06", "c.json", [
        {"symbol": "aa", "series": "EQ", "exDate": "01-Oct-2026", "subject": "Bonus 1:1"},
        {"symbol": "aa", "series": "EQ", "exDate": "-", "subject": "Bonus 1:1"},
        {"symbol": "aa", "series": "EQ", "exDate": "01-Oct-2026", "subject": "Dividend"}])
    assert [(r["ex_date"], r["factor"]) for r in bronze.corporate_actions(spark, root).collect()] == [
        (dt.date(2026, 10, 1), 2.0)]
    for day, text in (("2026-01-01", "old"), ("2026-02-01", "new")):
        put(tmp_path, "nse_holidays", day, "holidays.json", {"CM": [
            {"tradingDate": "02-Oct-2026", "description": text}, {"tradingDate": "?", "description": "x"}]})
    assert [tuple(r) for r in bronze.holidays(spark, root).collect()] == [(dt.date(2026, 10, 2), "new")]


def test_portfolio_watchlist_and_wide_prices(spark, tmp_path):
    (tmp_path / "p.csv").write_text("owner,date,type,symbol,quantity,price,amount,asset_class\n"
                                    "u,2026-08-18,BUY,AA,10,5.5,,STOCK\nu,2026-08-18,SIP,7,,,500,MUTUAL_FUND\n")
    (tmp_path / "w.csv").write_text("scheme_code,label\n7,seven\n")
    p = bronze.portfolio(spark, str(tmp_path / "p.csv"))
    assert p.filter("amount is null").count() == 1 and dict(p.dtypes)["date"] == "date"
    nav = spark.createDataFrame([(7, 1.0), (8, 2.0)], "scheme_code long, nav double")
    assert [r["scheme_code"] for r in bronze.watched(nav, bronze.watchlist(spark, str(tmp_path / "w.csv"))).collect()] == [7]
    wide = spark.createDataFrame([(dt.date(2026, 1, 1), 1.0, 2.0, 3.0)],
                                 "Date date, `A|Adj Close` double, `A|Volume` double, `B|Volume` double")
    rows = {r["ticker"]: (r["adj_close"], r["volume"]) for r in bronze.long_prices(wide).collect()}
    assert rows == {"A": (1.0, 2.0), "B": (None, 3.0)}
