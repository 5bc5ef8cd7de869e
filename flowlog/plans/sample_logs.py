"""Event logs derived from the driver's tables (TESTDATA.md).

* sessions (log A): ``events``; case = user and calendar day, activity = event type.
* orders (log B): ``orders`` (one "placed" event) and ``lineitem`` (one
  "shipped" event per line); case = order key; two sources.
* session milestones: ``events`` pivoted to one wide row per session with the
  first time of each event type (nulls where a type never occurs) - the wide
  shape that the unpivot operator turns back into events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlog.config import EventSpec, SourceSpec
from flowlog.operators.eventlog import to_events, union_logs
from flowlog.sources.tables import read_table

# Event types of the events table and the milestone activity names.
MILESTONES = [
    ("signup", "Signup"),
    ("view", "View"),
    ("click", "Click"),
    ("purchase", "Purchase"),
    ("error", "Error"),
]


def _session_case(user: str = "user_id", ts: str = "ts"):
    return F.concat(F.col(user).cast("string"), F.lit("_"), F.to_date(ts).cast("string"))


def session_log(spark: SparkSession, base: str) -> DataFrame:
    ev = read_table(spark, base, "events")
    spec = SourceSpec(
        name="events",
        case_col=_session_case(),
        event_type="web",
        case_type="session",
        specialty_col=(F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
                       .when(F.col("value") < 50, "low")
                       .when(F.col("value") < 150, "mid")
                       .otherwise("high")),
        resource_col=F.get_json_object("props", "$.k"),
        activity_col="event_type",
        ts_col="ts",
    )
    return to_events(ev, spec)


def order_log(spark: SparkSession, base: str) -> DataFrame:
    orders = read_table(spark, base, "orders")
    lines = read_table(spark, base, "lineitem")
    placed = to_events(orders, SourceSpec(
        name="orders", case_col="o_orderkey", event_type="order", case_type="order",
        specialty_col="o_orderpriority", location_col="o_orderstatus",
        activity_col=F.lit("placed"), ts_col="o_orderdate"))
    shipped = to_events(lines, SourceSpec(
        name="lineitem", case_col="l_orderkey", event_type="shipment", case_type="order",
        specialty_col="l_returnflag", resource_col="l_suppkey", location_col="l_linestatus",
        activity_col=F.lit("shipped"), ts_col="l_shipdate"))
    return union_logs([placed, shipped])


def session_milestones(spark: SparkSession, base: str) -> DataFrame:
    """One wide row per session: first time of each event type, count, value sum."""
    ev = read_table(spark, base, "events")
    firsts = [F.min(F.when(F.col("event_type") == t, F.col("ts"))).alias(f"first_{t}")
              for t, _ in MILESTONES]
    return ev.groupBy(_session_case().alias("case_id"), F.col("user_id")).agg(
        *firsts, F.count(F.lit(1)).alias("n_events"))


def milestone_spec() -> SourceSpec:
    return SourceSpec(
        name="sessions", case_col="case_id", event_type="milestone", case_type="session",
        resource_col=F.col("user_id"),
        events=tuple(EventSpec(f"first_{t}", label) for t, label in MILESTONES))


def milestone_log(spark: SparkSession, base: str) -> DataFrame:
    return to_events(session_milestones(spark, base), milestone_spec())


def mixed_log(spark: SparkSession, base: str) -> DataFrame:
    """Orders log plus unpivoted session milestones: three sources, null timestamps."""
    return union_logs([order_log(spark, base), milestone_log(spark, base)])
