"""Classifiers over free text, as pure column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _first_match(cases: list[tuple[str, Column]], otherwise: str) -> Column:
    chain = F.when(cases[0][1], cases[0][0])
    for label, test in cases[1:]:
        chain = chain.when(test, label)
    return chain.otherwise(otherwise)


def news_type(category: Column, summary: Column) -> Column:
    """What a filing means for an unusual move; the first matching class wins."""
    lowered = F.lower(category)
    cases = []
    for label, contains, starts, equals in fixed.FILING_CLASSES:
        tests = [lowered.contains(w) for w in contains] + [lowered.startswith(w) for w in starts]
        if equals:
            tests.append(category.isin(*equals))
        if label == "RESULTS":
            tests.append(summary.rlike(fixed.RESULTS_SUMMARY_PATTERN))
        cases.append((label, _any(tests)))
    return _first_match(cases, fixed.FILING_OTHER)


def index_family(name: Column) -> Column:
    return _first_match([(label, name.rlike(pattern)) for label, pattern in fixed.INDEX_FAMILIES], fixed.INDEX_OTHER)


def asset_class(category: Column) -> Column:
    lowered = F.lower(category)
    return _first_match([(label, lowered.startswith(p.lower())) for p, label in fixed.ASSET_CLASSES], "Other")


def sub_category(category: Column) -> Column:
    return F.trim(F.split_part(category, F.lit(" - "), F.lit(2)))


def plan_type(scheme_name: Column) -> Column:
    return F.when(F.lower(scheme_name).contains("direct"), "Direct").otherwise("Regular")


def option_type(scheme_name: Column) -> Column:
    lowered = F.lower(scheme_name)
    return (F.when(lowered.contains("idcw") | lowered.contains("dividend"), "IDCW")
            .when(lowered.contains("growth"), "Growth")
            .otherwise("Other"))


def corporate_action(subject: Column) -> Column:
    """struct(action_type, factor) of a price-changing action; null for all other filings."""
    old = F.regexp_extract(subject, fixed.SPLIT_PATTERN, 1).try_cast("double")
    new = F.regexp_extract(subject, fixed.SPLIT_PATTERN, 2).try_cast("double")
    is_split = F.lower(subject).contains(fixed.SPLIT_WORD) & (old > 0) & (new > 0) & (old != new)
    fresh = F.regexp_extract(subject, fixed.BONUS_PATTERN, 1).try_cast("double")
    held = F.regexp_extract(subject, fixed.BONUS_PATTERN, 2).try_cast("double")
    is_bonus = F.lower(subject).contains(fixed.BONUS_WORD) & (fresh > 0) & (held > 0)
    return (F.when(is_split, F.struct(F.lit("SPLIT").alias("action_type"), F.try_divide(old, new).alias("factor")))
            .when(is_bonus, F.struct(F.lit("BONUS").alias("action_type"),
                                     F.try_divide(fresh + held, held).alias("factor"))))


def is_etf(symbol: Column) -> Column:
    return symbol.endswith(fixed.ETF_SUFFIX) | symbol.contains(fixed.ETF_WORD)
