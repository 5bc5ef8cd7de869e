"""DuckDB-runnable SQL building blocks mirroring the sample logs."""

from __future__ import annotations

from flowlog.plans.sample_logs import MILESTONES

EVENT_ORDER = ("timestamp NULLS LAST, source NULLS LAST, event_seq NULLS LAST, activity NULLS LAST, "
               "specialty NULLS LAST, resource NULLS LAST, location NULLS LAST, "
               "case_type NULLS LAST, event_type NULLS LAST")

LOG_A = """log_a AS (
  SELECT CAST(e.user_id AS VARCHAR) || '_' || CAST(CAST(e.ts AS DATE) AS VARCHAR) AS case_id,
         e.event_type AS activity, e.ts AS timestamp, 'complete' AS lifecycle,
         'web' AS event_type, 'session' AS case_type, CAST(NULL AS VARCHAR) AS outcome,
         json_extract_string(e.props, '$.k') AS resource,
         CASE WHEN e.event_type = 'error' THEN NULL WHEN e.value < 50 THEN 'low'
              WHEN e.value < 150 THEN 'mid' ELSE 'high' END AS specialty,
         CAST(NULL AS VARCHAR) AS location, 'events' AS source, 0 AS event_seq
  FROM events e)"""

LOG_B = """log_b AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS case_id, 'placed' AS activity, o_orderdate AS timestamp,
         'complete' AS lifecycle, 'order' AS event_type, 'order' AS case_type,
         CAST(NULL AS VARCHAR) AS outcome, CAST(NULL AS VARCHAR) AS resource,
         o_orderpriority AS specialty, o_orderstatus AS location, 'orders' AS source, 0 AS event_seq
  FROM orders
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR), 'shipped', l_shipdate, 'complete', 'shipment', 'order',
         CAST(NULL AS VARCHAR), CAST(l_suppkey AS VARCHAR), l_returnflag, l_linestatus, 'lineitem', 0
  FROM lineitem)"""

MS_WIDE = "ms_wide AS (\n  SELECT CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS case_id, user_id,\n" + \
    "".join(f"         min(ts) FILTER (WHERE event_type = '{t}') AS first_{t},\n" for t, _ in MILESTONES) + \
    "         count(*) AS n_events\n  FROM events GROUP BY 1, 2)"

LOG_M = "log_m AS (\n" + "\n  UNION ALL\n".join(
    f"  SELECT case_id, '{label}' AS activity, first_{t} AS timestamp, 'complete' AS lifecycle, "
    f"'milestone' AS event_type, 'session' AS case_type, CAST(NULL AS VARCHAR) AS outcome, "
    f"CAST(user_id AS VARCHAR) AS resource, CAST(NULL AS VARCHAR) AS specialty, "
    f"CAST(NULL AS VARCHAR) AS location, 'sessions' AS source, {i} AS event_seq FROM ms_wide"
    for i, (t, label) in enumerate(MILESTONES)) + ")"

LOG_X = "log_x AS (SELECT * FROM log_b UNION ALL SELECT * FROM log_m)"

CTES = {"log_a": [LOG_A], "log_b": [LOG_B], "log_m": [MS_WIDE, LOG_M],
        "log_x": [LOG_B, MS_WIDE, LOG_M, LOG_X], "ms_wide": [MS_WIDE]}


def register_log(name: str, ctes: list[str]) -> None:
    """Make another log CTE (with its dependencies) usable by :func:`with_logs`."""
    CTES[name] = ctes


def with_logs(*names: str) -> str:
    """A WITH prefix defining the named logs (dependencies included once)."""
    parts: list[str] = []
    for n in names:
        for p in CTES[n]:
            if p not in parts:
                parts.append(p)
    return "WITH " + ",\n".join(parts)


def mining(log: str) -> str:
    return f"(SELECT * FROM {log} WHERE case_id IS NOT NULL AND activity IS NOT NULL AND timestamp IS NOT NULL)"
