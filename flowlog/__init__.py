"""flowlog: process mining on Spark DataFrames.

Raw per-record tables are cleaned, checked, deduplicated and reshaped into one
canonical event log; the log is then mined (variants, transition times,
performance spectrum, directly-follows models, conformance, hand-over and
subcontracting networks) with DataFrame operators only.
"""

from flowlog.config import CANONICAL_COLUMNS, EventSpec, SourceSpec

__all__ = ["CANONICAL_COLUMNS", "EventSpec", "SourceSpec"]
