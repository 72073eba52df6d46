"""Numbers inside sentences: round on the decimal text first, then print."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.cleaning import rounded


def fixed(value: Column, places: int) -> Column:
    return F.format_string(f"%.{places}f", rounded(value.cast("double"), places))


def signed(value: Column, places: int = 1) -> Column:
    return F.format_string(f"%+.{places}f", rounded(value.cast("double"), places))


def grouped(value: Column, places: int = 0) -> Column:
    return F.format_string(f"%,.{places}f", rounded(value.cast("double"), places))


def phrase(template: str, *parts: Column) -> Column:
    return F.format_string(template, *parts)


def plain_words(value: Column) -> Column:
    """ORDER_WIN -> order win."""
    return F.lower(F.replace(value, F.lit("_"), F.lit(" ")))
