"""Shared operators against plain loops, with hot keys and copies among the rows."""
import bisect
import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.functions.xirr import xirr
from tidemark.operators import checks
from tidemark.operators.asof import asof_join, between_join, forward_product, spread_days
from tidemark.operators.grouping import median, most_common
from tidemark.operators.ordering import dense_ids
from tidemark.operators.windows import any_before, by_date, top_per, with_streak

DAY = dt.date(2026, 1, 1)


def days(n):
    return DAY + dt.timedelta(days=n)


@pytest.mark.parametrize("tolerance", [None, 4])
def test_asof_join(spark, tolerance):
    random.seed(1)
    right = [(k, days(d), float(d)) for k in "abc" for d in random.sample(range(60), 12)]
    left = [(i, random.choice("aaaaabcz"), days(random.randrange(70))) for i in range(300)]
    got = asof_join(spark.createDataFrame(left, "i int, k string, d date"),
                    spark.createDataFrame(right, "k string, rd date, v double"), ["k"], "d", "rd",
                    {"v": "v", "rd": "matched"}, tolerance_days=tolerance)
    expected = {}
    for i, k, d in left:
        known = sorted((rd, v) for rk, rd, v in right if rk == k)
        at = bisect.bisect_right([rd for rd, _ in known], d) - 1
        hit = known[at] if at >= 0 else None
        expected[i] = hit[1] if hit and (tolerance is None or (d - hit[0]).days <= tolerance) else None
    assert {r["i"]: r["v"] for r in got.collect()} == expected
    inner = asof_join(spark.createDataFrame(left, "i int, k string, d date"),
                      spark.createDataFrame(right, "k string, rd date, v double"), ["k"], "d", "rd", {"v": "v"},
                      how="inner", tolerance_days=tolerance)
    assert inner.count() == sum(v is not None for v in expected.values())


def test_forward_product_counts_strictly_later_factors(spark):
    rows = spark.createDataFrame([("a", days(i)) for i in range(5)] + [("b", days(0))], "k string, d date")
    factors = spark.createDataFrame([("a", days(2), 5.0), ("a", days(2), 2.0), ("a", days(9), 3.0)],
                                    "k string, ex date, f double")
    got = forward_product(rows, factors, ["k"], "d", "ex", "f", "p").collect()
    assert {(r["k"], (r["d"] - DAY).days): round(r["p"], 9) for r in got} == {
        ("a", 0): 30.0, ("a", 1): 30.0, ("a", 2): 3.0, ("a", 3): 3.0, ("a", 4): 3.0, ("b", 0): 1.0}


def test_spread_and_between(spark):
    filed = spark.createDataFrame([("a", days(1))], "k string, d date")
    assert sorted(r["t"] for r in spread_days(filed, "d", "t", 3).collect()) == [days(i) for i in (1, 2, 3, 4)]
    facts = spark.createDataFrame([("a", days(i)) for i in range(4)], "k string, d date")
    versions = spark.createDataFrame([("a", days(1), days(3), 1)], "k2 string, lo date, hi date, v int").withColumnRenamed("k2", "k")
    got = between_join(facts, versions, ["k"], "d", "lo", "hi").orderBy(facts["d"]).select("v").collect()
    assert [r["v"] for r in got] == [None, 1, 1, None]


def test_streak_and_memory(spark):
    random.seed(2)
    hits = [random.choice([True, True, False, None]) for _ in range(60)]
    df = spark.createDataFrame([("a", days(i), h) for i, h in enumerate(hits)], "k string, d date, h boolean")
    w = by_date("k", date="d")
    got = with_streak(df, F.col("h"), w, "s").withColumn("m", any_before(F.col("h"), w, 4)).orderBy("d").collect()
    run, streaks = 0, []
    for h in hits:
        run = run + 1 if h else 0
        streaks.append(run)
    assert [r["s"] for r in got] == streaks
    assert [r["m"] for r in got] == [None] + [any(h is True for h in hits[max(0, i - 4):i]) for i in range(1, 60)]


def test_median_and_mode_with_a_hot_group(spark):
    random.seed(4)
    rows = [("hot" if random.random() < 0.6 else f"k{i % 7}", round(random.gauss(0, 3), 1)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v double")
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    got = {r["k"]: r["m"] for r in median(df, ["k"], F.col("v"), "m").collect()}
    assert got == pytest.approx({k: statistics.median(v) for k, v in groups.items()})
    mode = {r["k"]: r["m"] for r in most_common(df, ["k"], "v", "m").collect()}
    assert mode == {k: min(set(v), key=lambda x: (-v.count(x), x)) for k, v in groups.items()}


def test_dense_ids_with_copies_and_nulls(spark):
    random.seed(5)
    rows = [(random.choice(["a", "b", None]), random.choice([1, 2, None])) for _ in range(500)] + [("a", 1)] * 400
    df = spark.createDataFrame(rows, "k string, n int")
    got = dense_ids(df, [F.col("k").asc_nulls_last(), F.col("n").asc_nulls_last()], "id").collect()
    assert sorted(r["id"] for r in got) == list(range(1, len(rows) + 1))

    def place(r):
        return (r[0] is None, r[0] or "", r[1] is None, r[1] or 0)

    assert [place(r) for r in sorted(got, key=lambda r: r["id"])] == sorted(place(r) for r in rows)


def test_top_per(spark):
    df = spark.createDataFrame([("a", i) for i in range(100)] + [("b", 1)], "k string, v int")
    got = top_per(df, ["k"], 2, F.col("v").desc(), rank="r").collect()
    assert sorted((r["k"], r["v"], r["r"]) for r in got) == [("a", 98, 2), ("a", 99, 1), ("b", 1, 1)]


def solve(spark, flows):
    start = min((d for d, _ in flows), default=DAY)
    data = [([(int((d - start).days), float(a)) for d, a in flows],)]
    df = spark.createDataFrame(data, "f array<struct<days:int,amount:double>>")
    return df.select(xirr(F.col("f")).alias("r")).first()["r"]


def test_xirr(spark):
    d = dt.date
    # the example of the spreadsheet function's manual
    assert solve(spark, [(d(2008, 1, 1), -10000), (d(2008, 3, 1), 2750), (d(2008, 10, 30), 4250),
                         (d(2009, 2, 15), 3250), (d(2009, 4, 1), 2750)]) == pytest.approx(0.373363, abs=1e-5)
    # one payment in, one out: the ratio to the power of a year over the days between
    for paid, got, days in ((820.0, 1000.0, 731), (64.0, 41.5, 200), (3.0, 3.0, 90)):
        flows = [(DAY, -paid), (DAY + dt.timedelta(days=days), got)]
        assert solve(spark, flows) == pytest.approx((got / paid) ** (365 / days) - 1, abs=1e-6)
    # whatever the flows, at the rate found they are worth nothing
    flows = [(DAY + dt.timedelta(days=45 * i), -70 - 11 * (i % 4)) for i in range(9)] + [(DAY + dt.timedelta(days=430), 905)]
    rate = solve(spark, flows)
    assert sum(a / (1 + rate) ** ((day - DAY).days / 365) for day, a in flows) == pytest.approx(0, abs=1e-4)
    assert solve(spark, [(DAY, 12), (DAY + dt.timedelta(days=7), 30)]) is None
    assert solve(spark, []) is None


def test_table_checks(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (None, "z")], "k int, v string")
    assert [tuple(r) for r in checks.duplicates(df, ["k"]).collect()] == [(1, 2)]
    assert checks.nulls(df, "v").count() == 1
    assert [tuple(r) for r in checks.outside(df, "v", ["x", "y"]).collect()] == [("z", 1)]
    parent = spark.createDataFrame([(1,)], "id int")
    assert [r["k"] for r in checks.orphans(df, "k", parent, "id").collect()] == [2]
    assert checks.breaking(df, F.col("k") < 2).count() == 1
