from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(c) -> Column:
    """Column name or Column -> Column."""
    return F.col(c) if isinstance(c, str) else c


def apart(c) -> Column:
    """The same value, worked out by an expression that Spark keeps out of whole-stage code.

    The JVM interprets a method of more than 8000 bytes of code, several times slower; many
    costly columns of one projection make such a method. A projection with one such column is
    compiled in small methods instead. Columns that nothing reads are still pruned one by one.
    """
    return F.get(F.transform(F.array(as_col(c)), lambda x: x), F.lit(0))
