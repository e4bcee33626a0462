"""Column functions that turn raw text into typed values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FIRST = "d/M/yyyy"
MONTH_FIRST = "M/d/yyyy"
BLANKS = ("", "nan", "None")


def two_pass_date(text: Column) -> Column:
    """Day first; month first only where that fails.

    Exchanges day and month of every month-first date whose day is at most 12.
    Kept for parity with data prepared that way; prefer :func:`date_by_rule`.
    """
    raw = F.trim(text)
    return F.coalesce(F.try_to_date(raw, DAY_FIRST), F.try_to_date(raw, MONTH_FIRST))


def date_by_rule(text: Column, rules: Iterable[tuple[int | None, int | None, str]]) -> Column:
    """Choose the pattern by the year, which no exchange of day and month can alter."""
    raw = F.trim(text)
    year = F.element_at(F.split(raw, "/"), -1).try_cast("int")
    parsed = F.lit(None).cast("date")
    for first, last, pattern in reversed(list(rules)):
        applies = year.isNotNull()
        if first is not None:
            applies = applies & (year >= first)
        if last is not None:
            applies = applies & (year <= last)
        parsed = F.when(applies, F.try_to_date(raw, pattern)).otherwise(parsed)
    return parsed


def is_ambiguous_date(text: Column) -> Column:
    """Both patterns accept the text and disagree."""
    raw = F.trim(text)
    first, second = F.try_to_date(raw, DAY_FIRST), F.try_to_date(raw, MONTH_FIRST)
    return F.coalesce(first != second, F.lit(False))


def number(text: Column) -> Column:
    """Thousands separators out, blanks to NULL; never NaN."""
    plain = F.trim(F.replace(text, F.lit(","), F.lit("")))
    value = F.when(~plain.isin(*BLANKS), plain).try_cast("double")
    return F.when(~F.isnan(value), value)


def match_key(text: Column) -> Column:
    return F.upper(F.trim(text))


def half_even(value: Column, places: int) -> Column:
    return F.bround(value, places)


def mean(column: str) -> Column:
    """Average whose sum stays exact for decimal columns, so that neither the order
    of the rows nor their partitions can show in it."""
    return F.sum(column).cast("double") / F.nullif(F.count(column), F.lit(0))


def per_cent(part: Column, whole: Column) -> Column:
    """Null, not an error, where there is nothing to compare with."""
    return F.try_divide(part * 100.0, whole)
