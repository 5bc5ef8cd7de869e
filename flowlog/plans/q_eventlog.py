"""Registered event-log queries (EL1-EL11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlog.config import CANONICAL_COLUMNS
from flowlog.operators import eventlog as el
from flowlog.plans import sample_logs as logs
from flowlog.plans.oracle_sql import EVENT_ORDER, mining, with_logs
from flowlog.plans.registry import CFG, register

_COLS = ", ".join(CANONICAL_COLUMNS)


@register("el_unpivot", with_logs("log_m") + "\nSELECT * FROM log_m")
def el_unpivot(spark, d):
    return logs.milestone_log(spark, d)


@register("el_direct", with_logs("log_a") + "\nSELECT * FROM log_a")
def el_direct(spark, d):
    return logs.session_log(spark, d)


@register("el_union_log", with_logs("log_x") + "\nSELECT * FROM log_x")
def el_union_log(spark, d):
    return logs.mixed_log(spark, d)


@register("el_case_duration", with_logs("log_x") + f""",
dur AS (SELECT case_id,
               CAST(floor((floor(epoch_ms(max(timestamp)) / 1000.0) - floor(epoch_ms(min(timestamp)) / 1000.0)) / 60)
                    AS INTEGER) AS duration_minutes
        FROM log_x GROUP BY case_id)
SELECT {', '.join('l.' + c for c in CANONICAL_COLUMNS)}, d.duration_minutes
FROM log_x l LEFT JOIN dur d ON l.case_id IS NOT DISTINCT FROM d.case_id""")
def el_case_duration(spark, d):
    return el.canonical(el.with_case_duration(logs.mixed_log(spark, d)))


CASE_ATTR_SCHEMA = {"case_id": "string", "case_type": "string", "priority": "string",
                    "status": "string", "segment": "string", "nation": "int", "amount": "double"}


@register("el_case_attributes", """
SELECT CAST(o_orderkey AS VARCHAR) AS case_id, 'order' AS case_type, o_orderpriority AS priority,
       o_orderstatus AS status, CAST(NULL AS VARCHAR) AS segment, CAST(NULL AS INTEGER) AS nation,
       o_totalprice AS amount
FROM orders
UNION ALL
SELECT 'C' || CAST(c_custkey AS VARCHAR), 'customer', NULL, NULL, c_mktsegment, c_nationkey, c_acctbal
FROM customer""")
def el_case_attributes(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("case_id"), F.lit("order").alias("case_type"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"))
    cust = spark.read.parquet(f"{d}/customer.parquet").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("case_id"),
        F.lit("customer").alias("case_type"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("amount"))
    return el.case_attributes([orders, cust], CASE_ATTR_SCHEMA)


@register("el_case_filter", with_logs("log_b") + """,
hits AS MATERIALIZED (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS case_id FROM lineitem WHERE l_returnflag = 'R')
SELECT log_b.* FROM log_b JOIN hits USING (case_id)""")
def el_case_filter(spark, d):
    log = logs.order_log(spark, d)
    return el.filter_cases(log, (F.col("source") == "lineitem") & (F.col("specialty") == "R"))


@register("el_filter_events", with_logs("log_b") + """
SELECT * FROM log_b WHERE specialty IN ('1-URGENT', '2-HIGH', 'R')""")
def el_filter_events(spark, d):
    return el.filter_events(logs.order_log(spark, d), "specialty", ["1-URGENT", "2-HIGH", "R"])


@register("el_mining_view", with_logs("log_x") + f"\nSELECT * FROM {mining('log_x')} l")
def el_mining_view(spark, d):
    return el.mining_view(logs.mixed_log(spark, d))


@register("el_traces", with_logs("log_a") + f"""
SELECT case_id, count(*) AS n_events, string_agg(activity, ',' ORDER BY {EVENT_ORDER}) AS trace,
       min(timestamp) AS first_ts, max(timestamp) AS last_ts
FROM {mining('log_a')} l GROUP BY case_id""")
def el_traces(spark, d):
    t = el.traces(logs.session_log(spark, d), CFG)
    return t.select("case_id", F.size("events").cast("long").alias("n_events"),
                    F.array_join(F.transform("events", lambda e: e["activity"]), ",").alias("trace"),
                    F.col("events")[0]["timestamp"].alias("first_ts"),
                    F.element_at("events", -1)["timestamp"].alias("last_ts"))


@register("el_log_stats", with_logs("log_a") + f""",
seqs AS (SELECT case_id, string_agg(activity, ',' ORDER BY {EVENT_ORDER}) AS s, count(*) AS n
         FROM {mining('log_a')} l GROUP BY case_id)
SELECT CAST(sum(n) AS BIGINT) AS n_events, count(*) AS n_cases, count(DISTINCT s) AS n_variants FROM seqs""")
def el_log_stats(spark, d):
    return el.log_stats(logs.session_log(spark, d), CFG)
