"""Annualised money-weighted return as a column: bisection with higher-order functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

LOWEST, HIGHEST = -0.9999, 100.0
STEPS = 40          # the bracket ends narrower than 10^-9
DAYS_PER_YEAR = 365.0


def net_present_value(flows: Column, rate: Column) -> Column:
    """flows: array<struct<days:int, amount:double>>, days counted from the first flow."""
    return F.aggregate(
        flows, F.lit(0.0),
        lambda total, f: total + f["amount"] / F.pow(1.0 + rate, f["days"] / F.lit(DAYS_PER_YEAR)))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated a single time, however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _rate(flows: Column) -> Column:
    has_both = F.exists(flows, lambda f: f["amount"] < 0) & F.exists(flows, lambda f: f["amount"] > 0)
    start = F.struct(F.lit(LOWEST).alias("lo"), F.lit(HIGHEST).alias("hi"),
                     net_present_value(flows, F.lit(LOWEST)).alias("at_low"))

    def narrow(b: Column, _: Column) -> Column:
        middle = (b["lo"] + b["hi"]) / 2
        keep_lower = b["at_low"] * net_present_value(flows, middle) < 0
        return F.when(keep_lower, F.struct(b["lo"].alias("lo"), middle.alias("hi"), b["at_low"].alias("at_low"))
                      ).otherwise(F.struct(middle.alias("lo"), b["hi"].alias("hi"), b["at_low"].alias("at_low")))

    crosses = net_present_value(flows, F.lit(LOWEST)) * net_present_value(flows, F.lit(HIGHEST)) <= 0
    found = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, narrow, lambda b: (b["lo"] + b["hi"]) / 2)
    return F.when(has_both & crosses, found)


def xirr(flows: Column) -> Column:
    """Rate that makes the flows worth nothing today; null when no rate in the bracket does."""
    return _once(flows, _rate)
