"""Column-expression helpers (all built-in Spark expressions, no UDFs)."""

from flowlog.functions.parsing import (
    combine_date_time, nullify, parse_date, parse_double, parse_int, parse_timestamp,
    regex_repair, respace_datetime,
)
from flowlog.functions.temporal import (
    minutes_between, month_key, span_minutes, weekday_label,
)
from flowlog.functions.flags import ok_flag, violation_flag
from flowlog.functions.hashing import id_text, salted_sha256

__all__ = [
    "combine_date_time", "nullify", "parse_date", "parse_double", "parse_int",
    "parse_timestamp", "regex_repair", "respace_datetime", "minutes_between",
    "month_key", "span_minutes", "weekday_label", "ok_flag", "violation_flag",
    "id_text", "salted_sha256",
]
