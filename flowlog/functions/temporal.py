"""Time arithmetic and calendar labels (SC16-SC19)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from flowlog.functions._util import as_col

# Weekday labels, Monday first (weekday() is 0 = Monday).
WEEKDAY_LABELS = ["Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado", "Domingo"]


def minutes_between(start, end) -> Column:
    """Fractional minutes from ``start`` to ``end`` (microsecond exact)."""
    return F.timestamp_diff("MICROSECOND", as_col(start), as_col(end)) / F.lit(60_000_000.0)


def span_minutes(first, last) -> Column:
    """Whole minutes between two epoch-second stamps, truncated (EL5, SC16)."""
    secs = F.unix_timestamp(as_col(last)) - F.unix_timestamp(as_col(first))
    return (secs / F.lit(60)).cast("int")


def month_key(ts) -> Column:
    """``yyyy-MM`` month stamp."""
    return F.date_format(as_col(ts), "yyyy-MM")


def weekday_label(ts, labels=tuple(WEEKDAY_LABELS)) -> Column:
    """Locale-free weekday name from a literal label array."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]), F.weekday(as_col(ts)) + 1)
