"""Text -> typed value parsing that never throws under ANSI mode (SC2-SC9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from flowlog.functions._util import as_col

# The value repairs applied to raw text columns (pattern, replacement).
DEFAULT_REPAIRS = [
    (r"\?", "o"),
    ("AMARELO1", "AMARELO"),
    ("MASCULIN0", "MASCULINO"),
    (r"INTERNAC\?O", "INTERNACAO"),
    ("Âº", "º"),
]

# Fixed value: a date glued to its time, e.g. 05/03/202607:08.
GLUED_DATETIME = (r"(\d{2}/\d{2}/\d{4})(\d{2}:\d{2})", "$1 $2")


# A layout that a cast reads too, and texts that it and the layout's parser read alike.
CAST_FORMAT = "yyyy-MM-dd HH:mm:ss"
CAST_TEXT = r"\A(?!0000)\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\z"


def parse_timestamp(c, fmt: str | None = None) -> Column:
    """``try_to_timestamp``: unparsable text (``//``, ``''``) gives null.

    Texts of the layout ``yyyy-MM-dd HH:mm:ss`` are cast, which takes a fraction of the parser's time; what
    the cast refuses goes to the parser.
    """
    c = as_col(c)
    if fmt is None:
        return F.try_to_timestamp(c)
    if fmt == CAST_FORMAT:
        return F.coalesce(F.when(c.rlike(CAST_TEXT), F.try_to_timestamp(c)), F.try_to_timestamp(c, F.lit(fmt)))
    return F.try_to_timestamp(c, F.lit(fmt))


def parse_date(c, fmt: str | None = None) -> Column:
    c = as_col(c)
    if fmt is None:
        return F.try_to_date(c) if hasattr(F, "try_to_date") else c.try_cast("date")
    return F.try_to_date(c, fmt)


def parse_int(c) -> Column:
    """``try_cast(.. as int)``: ``'12.0'`` and ``''`` give null, as the reference's cast."""
    return as_col(c).try_cast("int")


def parse_double(c) -> Column:
    return as_col(c).try_cast("double")


def combine_date_time(d, t, fmt: str | None = None) -> Column:
    """Date text + time text -> timestamp (SC5).

    ``concat_ws`` skips nulls, so a date with a null time parses as midnight
    under the default format and as null under an explicit one.
    """
    return parse_timestamp(F.concat_ws(" ", as_col(d), as_col(t)), fmt)


def nullify(c, sentinel: str = "//") -> Column:
    """Sentinel text -> null (SC9)."""
    return F.nullif(as_col(c), F.lit(sentinel))


def respace_datetime(c) -> Column:
    """Insert the missing space between a dd/MM/yyyy date and its HH:mm time (SC8)."""
    pattern, repl = GLUED_DATETIME
    return F.regexp_replace(as_col(c), pattern, repl)


def regex_repair(c, rules: Sequence[tuple[str, str]] = tuple(DEFAULT_REPAIRS)) -> Column:
    """Apply (pattern, replacement) rules in order (SC7)."""
    out = as_col(c)
    for pattern, repl in rules:
        out = F.regexp_replace(out, pattern, repl)
    return out
