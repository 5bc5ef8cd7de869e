"""Declarative configuration objects: sources, events, policies, rules."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Union

from pyspark.sql import Column

ColumnLike = Union[str, Column, None]

# Canonical event-log columns, in order (the log adds duration_minutes).
CANONICAL_COLUMNS = [
    "case_id", "activity", "timestamp", "lifecycle", "event_type", "case_type",
    "outcome", "resource", "specialty", "location", "source",
]
LOG_COLUMNS = CANONICAL_COLUMNS + ["duration_minutes"]

# Columns that order events inside a case, after the timestamp.  The reference
# orders by (case, timestamp) only; the remaining keys make the order total.
TIE_BREAK = ["source", "event_seq", "activity", "specialty", "resource", "location",
             "case_type", "event_type"]


@dataclass(frozen=True)
class EventSpec:
    """One timestamp column of a wide source row that becomes one event."""

    ts_col: ColumnLike
    activity: str
    resource_col: ColumnLike = None


@dataclass(frozen=True)
class SourceSpec:
    """How one source table maps onto the canonical event schema.

    String fields name columns of the source table; ``Column`` values are
    expressions; literal fields are written as ``F.lit``.  Either ``events``
    (wide table: one event per timestamp column) or ``activity_col`` and
    ``ts_col`` (already one row per event) must be given.
    """

    name: str
    case_col: ColumnLike
    event_type: str
    case_type: ColumnLike
    specialty_col: ColumnLike = None
    resource_col: ColumnLike = None
    location_col: ColumnLike = None
    events: tuple[EventSpec, ...] = ()
    activity_col: ColumnLike = None
    ts_col: ColumnLike = None
    lifecycle: str = "complete"


@dataclass(frozen=True)
class ColumnPolicy:
    """Pseudonymisation policy of one dataset."""

    name: str
    hash_columns: tuple[str, ...] = ()
    drop_columns: tuple[str, ...] = ()
    generalize_columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class Rule:
    """A data-quality expectation: SQL predicate, action 'warn' or 'drop'."""

    name: str
    predicate: str
    action: str = "warn"


@dataclass(frozen=True)
class SkewConfig:
    """How ordered operators find and split hot keys (cases, users, files).

    ``mode='detect'``: a ``sample_fraction`` sample estimates rows per key;
    keys estimated at ``hot_rows`` or more are split into buckets of about ``bucket_rows`` rows along
    the first sort column, at sampled quantiles, if they are among the
    4096 largest keys (see operators/sequence.py).  ``mode='off'``: no splitting.  ``mode='all'``:
    every key is split (tests exercise the split path with it).
    """

    mode: str = "detect"
    hot_rows: int = 1_000_000
    sample_fraction: float = 0.01
    bucket_rows: int = 100_000


@dataclass(frozen=True)
class MiningConfig:
    """Knobs shared by the mining operators.

    ``skew`` controls how a case holding a large share of all rows is spread
    over many tasks; percentiles are exact (see operators/quantiles.py);
    ``approx`` switches to ``percentile_approx``.
    """

    skew: SkewConfig = SkewConfig()
    approx: bool = False
    accuracy: int = 10000
    seeds: tuple[str, str] = ("flowlog-a", "flowlog-b")
    hot_cases: object = None   # precomputed hot-key table, see eventlog.with_hot_cases
