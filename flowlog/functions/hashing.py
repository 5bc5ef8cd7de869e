"""Salted SHA-256 pseudonyms (AN1)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from flowlog.functions._util import as_col


def id_text(c) -> Column:
    """Normalise an identifier to text before hashing.

    Only a zero fraction is cut, by string operations: ``123.0`` and ``123``
    hash alike, and so does a float-typed column (printed ``1.0E7`` when large).
    All other text stays as it is, leading zeros included (``0012`` and ``12``
    are two ids, as are ``12d`` or the texts ``1e3`` and ``1.0E7``); null stays null.
    """
    text = as_col(c).cast("string")
    exact = text.try_cast("decimal(38,6)")
    is_float = F.typeof(as_col(c)).isin("double", "float")
    printed_float = is_float & text.rlike(r"^-?\d\.\d+E\d{1,2}$") & exact.isNotNull() & (exact == F.floor(exact))
    # the plain search first: the pattern is tried only on texts that hold a zero fraction
    return (F.when(F.contains(text, F.lit(".0")) & text.rlike(r"^-?\d+\.0+$"), F.regexp_replace(text, r"\.0+$", ""))
            .when(printed_float, exact.cast("decimal(38,0)").cast("string"))
            .otherwise(text))


def salted_sha256(c, salt: str, normalise: bool = True) -> Column:
    """Hex ``sha256(salt || '.' || value)``; ``concat`` keeps null as null."""
    value = id_text(c) if normalise else as_col(c).cast("string")
    return F.sha2(F.concat(F.lit(salt), F.lit("."), value), 256)
