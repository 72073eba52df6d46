"""Sinks, raw-to-typed builds, history of instruments, plan shapes."""
import datetime as dt

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.catalog import domain, rawtext
from tidemark.catalog.warehouse import Warehouse
from tidemark.operators.windows import by_date, rows
from tidemark.params import SurveillanceParams
from tidemark.plans import calendar, facts, history, ingest, portfolio, quality, reference, signals
from tidemark.sources import store
from tidemark.streaming.landing import keep_table_current
from test_parsing import put

SMOKE = "/root/testdata/sf0.001"
D1, D2 = dt.date(2026, 10, 5), dt.date(2026, 10, 6)
HEADER = ("SYMBOL, SERIES, DATE1, PREV_CLOSE, OPEN_PRICE, HIGH_PRICE, LOW_PRICE, LAST_PRICE, CLOSE_PRICE, AVG_PRICE, "
          "TTL_TRD_QNTY, TURNOVER_LACS, NO_OF_TRADES, DELIV_QTY, DELIV_PER\n")


def price(symbol, day, close="100", high="110", low="90", series="EQ", prev="95"):
    return f"{symbol}, {series}, {day}, {prev}, 96, {high}, {low}, 100, {close}, 99, 1000, 5.5, 10, -, -\n"


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_upsert_twice_is_upsert_once(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(D1, "A", 1), (D2, "A", 2)], "d date, k string, v int")
    again = spark.createDataFrame([(D2, "A", 20), (D2, "B", 30)], "d date, k string, v int")
    store.upsert(first, path, ["d", "k"], "d")
    for _ in range(2):
        got = store.upsert(again, path, ["d", "k"], "d")
        assert rows_of(got, "d", "k", "v") == [(D1, "A", 1), (D2, "A", 20), (D2, "B", 30)]


def test_upsert_matches_null_keys_and_plain_tables(spark, tmp_path):
    path = str(tmp_path / "q")
    rejected = spark.createDataFrame([(None, "A", "why"), (D1, None, "why")], "d date, k string, r string")
    for _ in range(2):
        assert store.upsert(rejected, path, ["d", "k"], "d").count() == 2
    plain = str(tmp_path / "p")
    for _ in range(2):
        assert store.upsert(spark.createDataFrame([("s1", 1)], "seq string, v int"), plain, ["seq"]).count() == 1


def test_every_reject_is_kept_and_a_batch_can_be_run_again(spark, tmp_path):
    columns = "trade_date date, symbol string, series string, close double, high double, low double"
    bad = [(None, "A", "EQ", 5.0, 6.0, 4.0), (None, "A", "EQ", 7.0, 8.0, 6.0), (D1, None, "EQ", 5.0, 6.0, 4.0),
           (D1, "B", "EQ", -1.0, 6.0, 4.0), (D1, "B", "EQ", -2.0, 6.0, 4.0), (D1, "B", "EQ", -2.0, 6.0, 4.0)]
    lake = str(tmp_path / "lake")
    for _ in range(2):      # the first batches have no good row
        assert ingest.store_prices(spark.createDataFrame(bad, columns), lake).count() == 0
    good = [(D1, "A", "EQ", 5.0, 6.0, 4.0), (D2, "A", "EQ", 5.5, 6.0, 4.0)]
    for _ in range(2):
        assert ingest.store_prices(spark.createDataFrame(good + bad[:2], columns), lake).count() == 2
        kept = spark.read.parquet(f"{lake}/_quarantine_stock_daily")
        assert rows_of(kept.fillna({"symbol": ""}), "symbol", "close") == sorted((r[1] or "", r[3]) for r in bad)


def test_upsert_reads_only_the_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [D1 - dt.timedelta(days=n) for n in range(30)]
    store.overwrite(spark.createDataFrame([(d, "A", 1) for d in days], "d date, k string, v int"), path, "d")
    update = spark.createDataFrame([(D1, "A", 2), (None, "B", 3)], "d date, k string, v int")
    plan = store.touched(store.read_table(spark, path), update, "d")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "PartitionFilters" in plan
    assert store.upsert(update, path, ["d", "k"], "d").count() == 31


def test_a_broken_rebuild_leaves_a_whole_table(spark, tmp_path):
    path = str(tmp_path / "t")
    store.rebuild(spark.createDataFrame([("old",)], "v string"), path)
    (tmp_path / "t" / "version=2" / "_temporary").mkdir(parents=True)
    assert rows_of(store.read_table(spark, path), "v") == [("old",)]        # what a run wrote that was broken off
    for value in ("new", "newer"):
        store.rebuild(spark.createDataFrame([(value,)], "v string"), path)
        assert rows_of(store.read_table(spark, path), "v") == [(value,)]
    store.rebuild(spark.createDataFrame([], "v string"), path)
    assert store.read_table(spark, path, spark.createDataFrame([], "v string").schema).count() == 0


def test_keys_that_move_to_another_partition(spark, tmp_path):
    path, columns = str(tmp_path / "t"), "month date, k string, v int, _landed date"
    store.upsert(spark.createDataFrame([(D1, "a", 1, D1), (D2, "b", 1, D1)], columns), path, ["k"], "month", "_landed")
    moved = spark.createDataFrame([(D2, "a", 2, D2)], columns)
    late = spark.createDataFrame([(D1, "a", 0, D1 - dt.timedelta(days=9)), (D1, "b", 5, D1)], columns)
    for _ in range(2):
        got = store.upsert(moved, path, ["k"], "month", "_landed")
        assert rows_of(got, "month", "k", "v") == [(D2, "a", 2), (D2, "b", 1)]
    for _ in range(2):      # the first row is older than what is stored, the second as old
        got = store.upsert(late, path, ["k"], "month", "_landed")
        assert rows_of(got, "month", "k", "v") == [(D1, "b", 5), (D2, "a", 2)]


def test_a_hot_day_is_split_and_small_days_share_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(100).selectExpr("date_add(date'2026-01-01', cast(id as int)) as d", "id as v").repartition(8)
    store.overwrite(rows, path, "d")
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 100


def test_replace_append_overwrite(spark, tmp_path):
    path = str(tmp_path / "dq")
    store.overwrite(spark.createDataFrame([(D1, "a"), (D2, "b")], "run_date date, c string"), path, "run_date")
    store.replace_partitions(spark.createDataFrame([(D2, "x"), (D2, "y")], "run_date date, c string"), path, "run_date")
    assert rows_of(spark.read.parquet(path), "c") == [("a",), ("x",), ("y",)]
    log = str(tmp_path / "log")
    for _ in range(2):
        store.append(spark.createDataFrame([(1,)], "a int"), log)
    assert spark.read.parquet(log).count() == 2
    assert store.read_table(spark, str(tmp_path / "none")) is None


def test_price_files_to_adjusted_prices(spark, tmp_path):
    raw, lake = tmp_path / "raw", str(tmp_path / "lake")
    put(raw, "nse_bhavcopy", "2026-10-05", "a.csv", HEADER + price(" aa ", "05-Oct-2026") + price("AA", "05-Oct-2026")
        + price("BAD", "05-Oct-2026", close="0") + price("NOHIGH", "05-Oct-2026", high="-")
        + price("FLIP", "05-Oct-2026", high="1", low="2") + price("WHEN", "sometime"))
    put(raw, "nse_bhavcopy", "2026-10-06", "b.csv", HEADER + price("AA", "06-Oct-2026", close="50", high="55", low="45")
        + price("AA", "06-Oct-2026", close="51", series="BE", high="55", low="45"))
    put(raw, "nse_corp_actions", "2026-10-05", "c.json", [
        {"symbol": "AA", "series": "EQ", "exDate": "06-Oct-2026", "subject": "Split from Rs 10 to Rs 5"}])
    for _ in range(2):     # a second run changes nothing
        built = ingest.build_stock_daily(spark, str(raw), lake)
        assert rows_of(built, "symbol", "series", "close") == [("AA", "BE", 51.0), ("AA", "EQ", 50.0), ("AA", "EQ", 100.0)]
        rejects = spark.read.parquet(f"{lake}/_quarantine_stock_daily")
        assert rows_of(rejects, "symbol") == [("BAD",), ("FLIP",), ("NOHIGH",), ("WHEN",)]
    assert ingest.build_stock_daily(spark, str(raw), str(tmp_path / "l2"), [D1]).count() == 1
    ingest.build_corporate_actions(spark, str(raw), lake)
    adjusted = ingest.build_stock_daily_adjusted(spark, lake)
    assert rows_of(adjusted, "trade_date", "series", "adj_factor", "adj_close", "adj_volume") == [
        (D1, "EQ", 2.0, 50.0, 2000), (D2, "BE", 1.0, 51.0, 1000), (D2, "EQ", 1.0, 50.0, 1000)]
    assert rows_of(facts.staged_prices(adjusted), "trade_date", "series", "close", "raw_close") == [
        (D1, "EQ", 50.0, 100.0), (D2, "EQ", 50.0, 50.0)]
    with pytest.raises(ValueError, match="schema drift"):
        put(tmp_path / "raw2", "nse_bhavcopy", "2026-10-05", "a.csv", "SYMBOL,SERIES\nA,EQ\n")
        ingest.build_stock_daily(spark, str(tmp_path / "raw2"), lake)


def test_all_sources_build(spark, tmp_path):
    raw, lake = tmp_path / "raw", str(tmp_path / "lake")
    put(raw, "nse_bhavcopy", "2026-10-05", "a.csv", HEADER + price("AA", "05-Oct-2026"))
    put(raw, "nse_indices", "2026-10-05", "i.csv",
        "Index Name,Index Date,Open Index Value,High Index Value,Low Index Value,Closing Index Value,Points Change,"
        "Change(%),Volume,Turnover (Rs. Cr.),P/E,P/B,Div Yield\nNifty 50,05-10-2026,1,2,0.5,1.5,0.1,0.2,-,-,20,3,1\n"
        "Nifty 50,05-10-2026,1,2,0.5,1.5,0.1,0.2,-,-,20,3,1\nNifty X,05-10-2026,1,2,0.5,-,0.1,0.2,-,-,20,3,1\n")
    put(raw, "nse_equity_list", "2026-10-05", "e.csv",
        "SYMBOL,NAME OF COMPANY, SERIES, DATE OF LISTING, ISIN NUMBER, FACE VALUE\nAA,Aa Limited,EQ,01-Jan-2000,IN1,10\n"
        "BB,Bb Limited,EQ,01-Jan-2001,IN2,5\n")
    put(raw, "nse_nifty500", "2026-10-04", "n.csv", "Symbol,Industry\nBB,Old\n")
    put(raw, "nse_nifty500", "2026-10-05", "n.csv", "Symbol,Industry\naa,IT\nZZ,Oil\n")
    built = ingest.build_all(spark, str(raw), lake)
    assert rows_of(built["index_daily"], "index_name", "close", "volume") == [("Nifty 50", 1.5, None)]
    assert rows_of(built["stock_master"], "symbol", "industry", "in_nifty500") == [("AA", "IT", True), ("BB", None, False)]
    assert built["fund_nav"] is None and built["announcements"] is None
    assert built["stock_daily_adjusted"].first()["adj_factor"] == 1.0
    found = quality.missing_days(ingest.bronze.present_days(spark, str(raw)),
                                 spark.createDataFrame([], "holiday date, description string"), D2, days=1).first()
    assert (found["status"], found["detail"]) == ("FAIL", "missing: 2026-10-06")


def test_landing_stream_upserts(spark, tmp_path):
    raw, lake = tmp_path / "raw", str(tmp_path / "lake")
    put(raw, "nse_bhavcopy", "2026-10-05", "a.csv", HEADER.replace(" ", "") + price("AA", "05-Oct-2026"))
    keep_table_current(spark, str(raw), lake, str(tmp_path / "progress"))
    put(raw, "nse_bhavcopy", "2026-10-06", "b.csv", HEADER.replace(" ", "") + price("AA", "05-Oct-2026", close="101")
        + price("AA", "06-Oct-2026") + price("BAD", "06-Oct-2026", close="0"))
    keep_table_current(spark, str(raw), lake, str(tmp_path / "progress"))
    assert rows_of(spark.read.parquet(f"{lake}/stock_daily"), "trade_date", "close") == [(D1, 101.0), (D2, 100.0)]
    assert rows_of(spark.read.parquet(f"{lake}/_quarantine_stock_daily"), "symbol") == [("BAD",)]


MASTER = ("snapshot_date date, symbol string, company_name string, series string, listing_date date, isin string, "
          "face_value double, industry string, in_nifty500 boolean")


def master(spark, rows):
    return spark.createDataFrame([(d, s, name, "EQ", D1, "IN", face, None, False) for d, s, name, face in rows], MASTER)


def test_history_of_a_stock(spark):
    days = [dt.date(2026, m, 1) for m in range(1, 7)]
    rows = [(d, "KEEP", "Keep", 10.0) for d in days]
    rows += [(days[0], "GONE", "Old", 10.0), (days[1], "GONE", "New", 10.0), (days[2], "GONE", "New", 5.0),
             (days[5], "GONE", "New", 5.0)]
    dim = reference.dim_stock(master(spark, rows))
    got = [tuple(r) for r in dim.filter("symbol = 'GONE'").orderBy("version_no").select(
        "company_name", "face_value", "valid_from", "valid_to", "is_current", "version_no", "industry").collect()]
    start, end = dt.date(1900, 1, 1), dt.date(9999, 12, 31)
    assert got == [("Old", 10.0, start, days[1], False, 1, "Unclassified"), ("New", 10.0, days[1], days[2], False, 2, "Unclassified"),
                   ("New", 5.0, days[2], days[3], False, 3, "Unclassified"), ("New", 5.0, days[5], end, True, 4, "Unclassified")]
    assert dim.filter("symbol = 'KEEP'").count() == 1 and dim.filter("stock_sk = 'unknown'").count() == 1


@pytest.mark.parametrize("cuts", [[1, 2, 3, 4, 5, 6], [4], [2, 5]])
def test_history_merged_in_any_split_is_the_full_build(spark, tmp_path, cuts):
    days = [dt.date(2026, m, 1) for m in range(1, 8)]
    rows = [(d, "KEEP", "Keep", 10.0) for d in days]
    rows += [(d, "TURN", "Turn", 10.0 + i % 2) for i, d in enumerate(days)]
    rows += [(d, "BACK", "Back", 1.0) for i, d in enumerate(days) if i not in (1, 2, 4)]
    rows += [(days[3], "ONCE", "Once", 1.0), (days[6], "LAST", "Last", 1.0)]
    rows += [(d, "GONE", "Gone", 1.0) for d in days[:3]]
    snapshots, path = master(spark, rows), str(tmp_path / "versions")
    bounds = [0, *cuts, len(days)]
    for lo, hi in zip(bounds, bounds[1:]):
        for _ in range(2 if hi == 4 else 1):        # a batch that is merged again changes nothing
            history.merge_snapshots(snapshots.where(F.col("snapshot_date").isin(days[lo:hi])), path)
    columns = ["symbol", "version_no", "company_name", "face_value", "opened_on", "closed_on"]
    key = lambda r: tuple(r)[:2]
    got = sorted(history.versions(spark, path).select(*columns).collect(), key=key)
    assert got == sorted(reference.stock_versions(snapshots).select(*columns).collect(), key=key)


def test_headings_carry_over_the_splits_of_a_file(spark, tmp_path):
    lines = []
    for c in range(40):
        lines += [f"Open Ended Schemes(Category {c // 4})", f"House {c}"] if c % 4 == 0 else [f"House {c}"]
        lines += [f"{1000 * c + i};IN{i};-;Scheme {c};{i + 1}.5;05-Oct-2026" for i in range(c * 7 % 50)]
    put(tmp_path, "amfi_navall", "2026-10-05", "NAVAll.txt", "\n".join(lines))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
        raw = ingest.bronze.nav_lines(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 20
        got = ingest.build_fund_nav(spark, str(tmp_path), str(tmp_path / "lake"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    expected = [(1000 * c + i, f"House {c}", f"Category {c // 4}") for c in range(40) for i in range(c * 7 % 50)]
    assert rows_of(got, "scheme_code", "amc", "category") == expected


def test_calendar(spark):
    d = dt.date
    holiday = spark.createDataFrame([(d(2031, 12, 25), "Midwinter"), (d(2031, 12, 26), "Day after")],
                                    "holiday date, description string")
    assert [calendar.is_trading_day(holiday, d(2031, 12, n)) for n in (24, 25, 26, 27)] == [True, False, False, False]
    assert calendar.previous_trading_day(holiday, d(2031, 12, 29)) == d(2031, 12, 24)      # a Monday, after four shut days
    assert calendar.expected_days(holiday, d(2031, 12, 22), d(2031, 12, 31)).count() == 6
    long = spark.range(400).selectExpr("date_sub(date'2031-12-31', cast(id as int)) as holiday", "'shut' as description")
    assert calendar.previous_trading_day(long, d(2032, 1, 1)) == d(2030, 11, 26)


def bars(spark, n_symbols=4, n_days=60):
    i = F.col("id")
    day, symbol = i % n_days, (i / n_days).cast("int")
    return spark.range(n_symbols * n_days).select(
        F.date_add(F.lit(D1), day.cast("int")).alias("trade_date"), F.concat(F.lit("S"), symbol.cast("string")).alias("symbol"),
        F.lit("EQ").alias("series"), *[(100 + F.pmod(F.hash(i, F.lit(c)), F.lit(50))).cast("double").alias(c)
                                       for c in ("open", "high", "low", "close", "prev_close", "vwap")],
        (F.pmod(F.hash(i), F.lit(1000)) + 1).cast("long").alias("volume"), F.lit(1.0).alias("raw_close"),
        F.lit(1).cast("long").alias("raw_volume"), F.lit(1.0).alias("adj_factor"), F.lit(300.0).alias("turnover_lacs"),
        F.lit(1).cast("long").alias("num_trades"), F.lit(1).cast("long").alias("deliv_qty"),
        F.pmod(F.hash(i, F.lit("d")), F.lit(100)).cast("double").alias("deliv_pct"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_row_baselines_share_one_sort_and_no_python(spark, tmp_path):
    path = str(tmp_path / "fact")
    dim = reference.dim_stock(master(spark, [(D1, f"S{k}", f"S{k}", 1.0) for k in range(4)]))
    dim.write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    facts.stock_daily(bars(spark), dim).write.parquet(path)
    measured = signals.measured(spark.read.parquet(path), dim)
    plan = plan_of(signals.flagged(measured, SurveillanceParams()))
    assert plan.count("hashpartitioning(symbol") == 1
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "vwap" not in scan and "raw_close" not in scan


@pytest.mark.parametrize("same_direction, streaks", [(False, [1, 2, 3, 4, 0, 1]), (True, [1, 2, 1, 2, 0, 1])])
def test_circuit_streaks(spark, same_direction, streaks):
    up = F.pmod(F.date_diff("trade_date", F.lit(D1)), F.lit(6)).isin(0, 1, 5)
    quiet = F.date_diff("trade_date", F.lit(D1)) == 4
    prices = bars(spark, 1, 6).withColumns({"prev_close": F.lit(100.0), "open": F.lit(100.0)}).withColumn(
        "close", F.when(quiet, 101.0).when(up, 105.0).otherwise(95.0)).withColumns(
        {"high": F.greatest("close", "open"), "low": F.least("close", "open")})
    dim = reference.dim_stock(master(spark, [(D1, "S0", "S0", 1.0)]))
    p = SurveillanceParams(circuit_same_direction=same_direction)
    got = signals.measured(facts.stock_daily(prices, dim), dim, p).orderBy("trade_date").select("circuit_streak").collect()
    assert [r[0] for r in got] == streaks


def test_bucketed_table_needs_no_shuffle_for_windows(spark):
    store.save_bucketed(bars(spark), "bucketed_bars", "symbol", "trade_date", 4)
    df = spark.table("bucketed_bars").withColumn("m", F.avg("close").over(rows(by_date("symbol", date="trade_date"), -20, -1)))
    assert "Exchange" not in plan_of(df)
    spark.sql("drop table bucketed_bars")


def test_adjustment_keeps_traded_value(spark):
    actions = spark.createDataFrame([("S1", dt.date(2026, 10, 20), 5.0), ("S1", dt.date(2026, 11, 20), 1.5)],
                                    "symbol string, ex_date date, factor double")
    prices = bars(spark).withColumn("last", F.col("close"))
    got = facts.adjusted_prices(prices, actions)
    worst = got.agg(F.max(F.abs(F.col("adj_close") * F.col("volume") * F.col("adj_factor")
                                - F.col("close") * F.col("volume"))).alias("e")).first()["e"]
    assert worst < 1.0 and got.filter("adj_factor = 7.5").count() == 15


def test_prices_of_one_day_are_pruned_to_its_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    store.overwrite(bars(spark), path, "trade_date")
    plan = plan_of(spark.read.parquet(path).filter(F.col("trade_date") == F.lit(D1)).select("symbol"))
    assert "PartitionFilters: [isnotnull(trade_date" in plan and "close" not in plan


def test_run_checks(spark):
    holiday = spark.createDataFrame([], "holiday date, description string")
    fact = bars(spark).withColumn("return_pct", F.lit(30.0))
    nav = spark.createDataFrame([(1, D1)], "scheme_code long, nav_date date")
    actions = spark.createDataFrame([("S1", D1)], "symbol string, ex_date date")
    present = fact.select("trade_date").distinct()
    run_date = dt.date(2026, 12, 3)
    got = {r["check_name"]: r for r in quality.run_checks(run_date, fact, nav, holiday, actions, present).collect()}
    assert got["missing_bhavcopy_files"]["status"] == "PASS"
    assert got["stale_stock_prices"]["status"] == "PASS" and got["stale_fund_nav"]["status"] == "FAIL"
    assert got["row_count_vs_20d_avg"]["value"] == 1.0 and got["quarantined_price_rows"]["status"] == "PASS"
    assert got["moves_over_25pct_without_corp_action"]["value"] == 4
    assert got["moves_over_25pct_without_corp_action"]["detail"].startswith("S0 30.0%, S1 30.0%")


def test_price_files_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    rows = spark.range(400).select(*[
        F.when(F.col("id") % 7 == 0, "soon").otherwise(F.concat(F.lit("05-Oct-"), (1990 + F.col("id") % 9).cast("string"))).alias(c)
        if c == "DATE1" else F.col("id").cast("string").alias(c) for c in fixed.PRICE_COLUMNS]).repartition(1)
    name, write, seen = "spark.sql.maxConcurrentOutputFileWriters", DataFrameWriter.csv, []
    before = spark.conf.get(name)
    monkeypatch.setattr(DataFrameWriter, "csv", lambda self, *a: (seen.append(int(spark.conf.get(name))), write(self, *a)))
    rawtext.write_price_files(rows, str(tmp_path))
    assert seen[0] >= 10 and spark.conf.get(name) == before
    read = spark.read.option("header", True).csv(str(tmp_path / "nse_bhavcopy"))
    assert rows_of(read, "SYMBOL", "DATE1") == rows_of(rows, "SYMBOL", "DATE1")


def test_arrays_hold_some_thousand_rows_however_many_folders_there_are(spark, tmp_path):
    rows = spark.range(4 * rawtext.DOCUMENT_ROWS).select(
        F.when(F.col("id") % 8 > 0, F.date_add(F.lit(D1), (F.col("id") % 8).cast("int"))).alias("dt"), F.col("id").alias("k"))
    rawtext._write_arrays(rows, str(tmp_path / "few"))
    files = list((tmp_path / "few").rglob("*.txt"))
    assert len(files) == len({f.parent for f in files}) == 8
    read = spark.read.schema("k long").option("multiLine", True).json(str(tmp_path / "few"))
    assert read.count() == rows.count() and read.select("k").distinct().count() == rows.count()
    rawtext._write_arrays(rows.withColumn("dt", F.lit(D1)), str(tmp_path / "many"))
    assert 2 <= len(list((tmp_path / "many").rglob("*.txt"))) <= 4


def test_both_landings_of_an_action_come_from_one_pass(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(rawtext, "_write_arrays", lambda rows, path: seen.append(rows))
    subjects = spark.createDataFrame([("AA", D1, "Bonus 2:1"), ("BB", D2, "Interim Dividend"), ("CC", None, "Bonus 1:1"), ("DD", D1, None)],
                                     "symbol string, ex_date date, subject string")
    rawtext.write_actions(subjects, "raw")
    before, on = dt.date(2026, 7, 1), dt.date(2026, 10, 1)
    assert seen[0].columns == ["dt", "symbol", "series", "exDate", "subject"]
    assert set(map(tuple, seen[0].collect())) == {
        (before, "aa ", "EQ", "05-Oct-2026", "Bonus 9:1"), (on, "aa ", "EQ", "05-Oct-2026", "Bonus 2:1"),
        (before, "bb ", "EQ", "06-Oct-2026", " Interim Dividend"), (None, "cc ", "EQ", None, "Bonus 9:1"),
        (None, "cc ", "EQ", None, "Bonus 1:1"), (before, "dd ", "EQ", "05-Oct-2026", None)}
    assert seen[0].count() == 6 and "Union" not in plan_of(seen[0])


def test_parsed_prices_trim_and_cast_each_text_once(spark, tmp_path):
    rows = spark.createDataFrame([tuple([" a ", "eq", " 05-Oct-2026 ", *["-", " 1.5 ", "NaN", "1e999", "n/a", "", "-2", " 7.9 ", "3", "1e30", "x", "4"]])],
                                 [f"{c}" for c in fixed.PRICE_COLUMNS])
    rows.write.parquet(str(tmp_path / "raw"))
    typed = ingest.bronze.typed_prices(spark.read.parquet(str(tmp_path / "raw")))
    assert tuple(typed.first()) == (D1, "A", "EQ", None, 1.5, None, None, None, None, -2.0, 7, 3.0, None, None, 4.0)
    assert typed.columns[10:] == ["volume", "turnover_lacs", "num_trades", "deliv_qty", "deliv_pct"]
    plan = plan_of(typed)
    assert plan.count("trim(CLOSE_PRICE") == 1 and plan.count("as double)") == 12
    trades = plan_of(domain.trades(spark, SMOKE))
    assert "SortMergeJoin" not in trades and "Exchange hashpartitioning(l_suppkey" not in trades
    w = Warehouse.of(spark, SMOKE)
    good, _ = ingest.split_rejects(w.typed_prices())
    assert "gettimestamp" not in plan_of(good)


def test_flows_of_a_holding_are_summed_once(spark):
    txns = spark.createDataFrame([("a", "STOCK", "X", D1, -10.0), ("a", "STOCK", "X", D1, -5.0), ("a", "STOCK", "X", D2, 4.0)],
                                 "owner string, asset_class string, instrument_id string, txn_date date, cash_flow double")
    held = spark.createDataFrame([("a", "STOCK", "X", D2, 20.0)],
                                 "owner string, asset_class string, instrument_id string, price_date date, current_value double")
    got = portfolio.money_weighted(txns, held)
    assert rows_of(got, "level", "total_invested", "total_received", "current_value") == [
        ("HOLDING", 15.0, 4.0, 20.0), ("PORTFOLIO", 15.0, 4.0, 20.0)]
    assert plan_of(got).count("sum(_amount") == 2       # of the portfolio alone, before and after its shuffle


def test_snapshots_of_stocks_are_taken_from_the_orders_once(spark, monkeypatch):
    seen, made = [], reference.dim_stock
    monkeypatch.setattr(reference, "dim_stock", lambda master: (seen.append(master), made(master))[1])
    w = Warehouse(spark, SMOKE)
    w.stocks()
    assert "Join" not in plan_of(seen[0]) and "Window" not in plan_of(seen[0])
    assert sorted(map(tuple, seen[0].collect())) == sorted(map(tuple, domain.stock_master(spark, SMOKE).collect()))
