"""Pseudonymisation policies (AN1-AN5)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from flowlog.config import ColumnPolicy
from flowlog.functions import parse_date, salted_sha256

AGE_COLUMN = "IDADE_CALCULADA"


def hash_columns(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    """Replace present columns by their salted SHA-256 hex (AN1); null stays null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: salted_sha256(F.col(f"`{c}`"), salt) for c in present}) if present else df


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop listed columns that exist (AN2)."""
    return df.drop(*[c for c in columns if c in df.columns])


def generalise_birth_date(df: DataFrame, column: str, as_of: _dt.date | str,
                          out_col: str = AGE_COLUMN, fmt: str | None = None) -> DataFrame:
    """Birth date -> age in whole years ``round(days / 365.25)``; drops the date (AN3).

    ``as_of`` is explicit so results are reproducible; unparsable dates give
    null; a table without the column is returned unchanged.
    """
    if column not in df.columns:
        return df
    src = F.col(f"`{column}`")
    is_text = isinstance(df.schema[column].dataType, T.StringType)
    dob = parse_date(src, fmt) if is_text else F.to_date(src)
    age = F.round(F.datediff(F.lit(as_of).cast("date"), dob) / 365.25).cast("int")
    return df.withColumn(out_col, age).drop(column)


def apply_policy(df: DataFrame, policy: ColumnPolicy, salt: str | None,
                 as_of: _dt.date | str, date_format: str | None = None) -> DataFrame:
    """Drop, then hash, then generalise (AN5).  A missing salt raises before any plan is built."""
    if not salt:
        raise ValueError("a non-empty salt is required for pseudonymisation")
    out = drop_columns(df, policy.drop_columns)
    out = hash_columns(out, policy.hash_columns, salt)
    for c in policy.generalize_columns:
        out = generalise_birth_date(out, c, as_of, fmt=date_format)
    return out


def apply_policies(tables: dict[str, DataFrame], policies: dict[str, ColumnPolicy],
                   salt: str | None, as_of) -> dict[str, DataFrame]:
    """Apply each dataset's policy; datasets without a policy are skipped (not returned)."""
    return {name: apply_policy(df, policies[name], salt, as_of)
            for name, df in tables.items() if name in policies}
