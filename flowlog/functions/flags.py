"""Temporal consistency flags with the reference's two null polarities (DQ3, DQ4)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from flowlog.functions._util import as_col


def violation_flag(a, b) -> Column:
    """True iff both sides are present and ``a > b``; otherwise False."""
    return F.coalesce(as_col(a) > as_col(b), F.lit(False))


def ok_flag(a, b) -> Column:
    """Null if either side is null, else ``a <= b`` (three-valued)."""
    return as_col(a) <= as_col(b)
