"""Month arithmetic and zone-free date expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_bounds(year: int, first: int, last: int | None = None) -> tuple[date, date]:
    """``[first day of first month, first day after last month)``; December rolls over."""
    last = first if last is None else last
    rolled, zero_based = divmod(last, 12)
    return date(year, first, 1), date(year + rolled, zero_based + 1, 1)


def month_number(year: int, month: int) -> int:
    """Months since year 0, so that December and January are neighbours."""
    return 12 * year + month - 1


def month_day(number: int) -> date:
    """First day of the month with this ``month_number``."""
    return date(number // 12, number % 12 + 1, 1)


def month_runs(months: Iterable[int]) -> list[tuple[int, int]]:
    """Collapse months (or month numbers) into runs of neighbours: ``[1, 2, 4] -> [(1, 2), (4, 4)]``."""
    runs: list[tuple[int, int]] = []
    for month in sorted(set(months)):
        if runs and runs[-1][1] == month - 1:
            runs[-1] = (runs[-1][0], month)
        else:
            runs.append((month, month))
    return runs


def in_ranges(ts: Column, ranges: Sequence[tuple[date, date]]) -> Column:
    """True inside any half-open range. Plain comparisons, so Parquet can prune on them."""
    terms = [(ts >= F.lit(lo)) & (ts < F.lit(hi)) for lo, hi in ranges]
    predicate = terms[0]
    for term in terms[1:]:
        predicate = predicate | term
    return predicate


def month_start(ts: Column) -> Column:
    """First day of the month as a DATE; a cheap grouping key that ignores the session zone."""
    return F.trunc(F.to_date(ts), "month")


def month_label(ts: Column) -> Column:
    """``yyyy-MM``, going through DATE so that a zone-free timestamp is never shifted."""
    return F.date_format(F.to_date(ts), "yyyy-MM")


def label_span(lo: date, hi: date) -> tuple[str, str]:
    """First and last ``yyyy-MM`` label touched by ``[lo, hi)``."""
    return lo.strftime("%Y-%m"), (hi - timedelta(days=1)).strftime("%Y-%m")
