"""Facts and signals taken day by day against the full build."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.params import SurveillanceParams
from tidemark.plans import daily, facts, signals

FIRST = dt.date(2025, 1, 1)
SCHEMA = ("trade_date date, symbol string, series string, open double, high double, low double, close double, "
          "prev_close double, vwap double, volume long, raw_close double, raw_volume long, adj_factor double, "
          "turnover_lacs double, num_trades long, deliv_qty long, deliv_pct double")
LOOSE = dict(volume_spike_x=1.5, price_shock_pct=2.0, pump_return_5d_pct=1.0, pump_volume_x=0.8,
             pump_low_delivery_ratio=1.2, circuit_tolerance=0.3, circuit_streak_days=2, min_history_days=5,
             dump_return_pct=3.0, dump_return_3d_pct=5.0)


def prices(spark, days=70):
    """Random walks with gaps; UP rises by its circuit every day, LATE begins late, GONE ends early, XBEES is a fund."""
    rng, out = random.Random(3), []
    for symbol in ("UP", "DOWN", "A", "B", "C", "LATE", "GONE", "XBEES"):
        close = 1000.0
        for n in range(days):
            if (symbol == "LATE" and n < 52) or (symbol == "GONE" and n > 30) or (symbol == "B" and n % 7 == 3):
                continue
            before = close
            move = {"UP": 0.05, "DOWN": -0.05 if n > 20 else 0.0}.get(symbol, rng.uniform(-0.06, 0.06))
            close = round(before * (1 + move), 4)
            opened = before if symbol in ("UP", "DOWN") else round(before * (1 + rng.uniform(-0.03, 0.03)), 4)
            volume = rng.randint(100, 900)
            delivered = None if rng.random() < 0.1 else rng.uniform(10, 90)
            out.append((FIRST + dt.timedelta(days=n), symbol, "EQ", opened, max(opened, close), min(opened, close), close, before,
                        (opened + close) / 2, volume, close, volume, 1.0, rng.uniform(50, 900), volume // 3, volume // 2,
                        delivered))
    return spark.createDataFrame(out, SCHEMA).coalesce(2)


def stocks(spark):
    rows = [(f"k{s}", s, dt.date(1900, 1, 1), dt.date(9999, 12, 31), "IT" if s in "AB" else "Unclassified", f"{s} Ltd")
            for s in ("UP", "DOWN", "A", "B", "C", "LATE", "GONE", "XBEES")]
    return spark.createDataFrame(rows, "stock_sk string, symbol string, valid_from date, valid_to date, industry string, "
                                       "company_name string")


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("same_direction, batches", [
    (False, [(0, 45), (45, 46), (45, 46), (40, 70)]),       # one batch again, one that overlaps
    (True, [(0, 50), (50, 70)])])
def test_day_by_day_equals_the_full_build(spark, tmp_path, same_direction, batches):
    p = SurveillanceParams(**LOOSE, circuit_same_direction=same_direction)
    table, dim, path = prices(spark), stocks(spark), str(tmp_path / "taken")
    for lo, hi in batches:
        batch = table.where(F.col("trade_date").between(FIRST + dt.timedelta(days=lo), FIRST + dt.timedelta(days=hi - 1)))
        daily.take(batch, dim, path, p)
    fact = facts.stock_daily(table, dim)
    assert rows_of(daily.stored(spark, path, "facts")) == rows_of(fact)
    found = daily.stored(spark, path, "signals")
    assert rows_of(found) == rows_of(signals.signals(fact, dim, p))
    streaks = {r.symbol: r.streak for r in found.groupBy("symbol").agg(F.max("circuit_streak").alias("streak")).collect()}
    assert streaks["UP"] == 70 > daily.LONGEST_BASELINE + p.dump_lookback_days and streaks["DOWN"] == 49
    assert found.where("r_dump_after_pump and trade_date > date '2025-02-20'").count() > 0


def test_state_is_bounded_and_an_empty_one_starts_anew(spark):
    p = SurveillanceParams(**LOOSE)
    table, dim = prices(spark, 60), stocks(spark)
    fact = facts.stock_daily(table, dim)
    state = daily.state_of(fact, signals.measured(fact, dim, p), p)
    assert state.groupBy("symbol").count().agg(F.max("count")).first()[0] == daily.LONGEST_BASELINE + p.dump_lookback_days
    day = daily.advance(state.limit(0), table, dim, p)
    assert rows_of(day.fact) == rows_of(fact) and rows_of(day.state) == rows_of(state)
    assert daily.advance(state, table, dim, p).fact.count() == 0
