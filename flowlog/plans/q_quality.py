"""Registered quality, dedup, pseudonymisation, parsing and report-shape queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlog.config import ColumnPolicy, Rule
from flowlog.functions import (
    combine_date_time, nullify, ok_flag, parse_date, parse_int, parse_timestamp, regex_repair,
    respace_datetime, violation_flag,
)
from flowlog.operators import cleanse, privacy, quality as dq, reports as rs
from flowlog.operators.sequence import forward_fill
from flowlog.plans import sample_logs as logs
from flowlog.plans.oracle_sql import with_logs
from flowlog.plans.registry import AS_OF, CFG, SALT, register

LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_KEYS = ["l_orderkey", "l_linenumber"]
_REST = [c for c in LINE_COLS if c not in _KEYS and c != "l_shipdate"]


def _dedup_sql(direction: str) -> str:
    order = ", ".join(f"{c} NULLS LAST" for c in _REST)
    return f"""dd AS (SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_shipdate {direction} NULLS LAST, {order}) AS rn
    FROM lineitem) WHERE rn = 1)"""


# ---------------------------------------------------------------- DD1
@register("dd_latest", "WITH " + _dedup_sql("DESC") + "\nSELECT * FROM dd")
def dd_latest(spark, d):
    return cleanse.keep_one(spark.read.parquet(f"{d}/lineitem.parquet"), _KEYS, "l_shipdate",
                            ascending=False)


@register("dd_earliest", "WITH " + _dedup_sql("ASC") + "\nSELECT * FROM dd")
def dd_earliest(spark, d):
    return cleanse.keep_one(spark.read.parquet(f"{d}/lineitem.parquet"), _KEYS, "l_shipdate",
                            ascending=True)


# ---------------------------------------------------------------- DQ1 / DQ2
RULES = [
    Rule("quantity_positive", "l_quantity > 0", "warn"),
    Rule("discount_at_most_8pct", "l_discount <= 0.08", "warn"),
    Rule("tax_below_5pct", "l_tax < 0.05", "warn"),
    Rule("has_shipdate", "l_shipdate IS NOT NULL", "drop"),
    Rule("returned_is_closed", "l_returnflag <> 'R' OR l_linestatus = 'F'", "warn"),
]


@register("dq_expectations", "WITH " + _dedup_sql("DESC") + """
SELECT 'lineitem' AS dataset, r.rule, r.action, (SELECT count(*) FROM dd) AS total, r.failed FROM (
  SELECT 'quantity_positive' AS rule, 'warn' AS action, count(*) FILTER (WHERE NOT coalesce(l_quantity > 0, false)) AS failed FROM dd
  UNION ALL SELECT 'discount_at_most_8pct', 'warn', count(*) FILTER (WHERE NOT coalesce(l_discount <= 0.08, false)) FROM dd
  UNION ALL SELECT 'tax_below_5pct', 'warn', count(*) FILTER (WHERE NOT coalesce(l_tax < 0.05, false)) FROM dd
  UNION ALL SELECT 'has_shipdate', 'drop', count(*) FILTER (WHERE NOT coalesce(l_shipdate IS NOT NULL, false)) FROM dd
  UNION ALL SELECT 'returned_is_closed', 'warn', count(*) FILTER (WHERE NOT coalesce(l_returnflag <> 'R' OR l_linestatus = 'F', false)) FROM dd
) r""")
def dq_expectations(spark, d):
    lines = cleanse.keep_one(spark.read.parquet(f"{d}/lineitem.parquet"), _KEYS, "l_shipdate",
                             ascending=False)
    return dq.expectation_metrics(lines, "lineitem", RULES)


@register("dq_expect_or_drop", """
SELECT * FROM lineitem WHERE coalesce(l_tax < 0.05, false) AND coalesce(l_shipdate IS NOT NULL, false)""")
def dq_expect_or_drop(spark, d):
    rules = [Rule("tax_below_5pct", "l_tax < 0.05", "drop"), Rule("has_shipdate", "l_shipdate IS NOT NULL", "drop"),
             Rule("quantity_positive", "l_quantity > 0", "warn")]
    return dq.apply_expectations(spark.read.parquet(f"{d}/lineitem.parquet"), rules)


# ---------------------------------------------------------------- DQ3 / DQ4
@register("dq_flags_violation", with_logs("ms_wide") + """
SELECT case_id, first_view, first_click, coalesce(first_view > first_click, false) AS view_after_click
FROM ms_wide""")
def dq_flags_violation(spark, d):
    w = logs.session_milestones(spark, d)
    return w.select("case_id", "first_view", "first_click",
                    violation_flag("first_view", "first_click").alias("view_after_click"))


@register("dq_flags_ok", with_logs("ms_wide") + """
SELECT case_id, first_signup, first_purchase, first_signup <= first_purchase AS signup_before_purchase
FROM ms_wide""")
def dq_flags_ok(spark, d):
    w = logs.session_milestones(spark, d)
    return w.select("case_id", "first_signup", "first_purchase",
                    ok_flag("first_signup", "first_purchase").alias("signup_before_purchase"))


@register("dq_order_flags", """
SELECT l.l_orderkey, l.l_linenumber, coalesce(o.o_orderdate > l.l_shipdate, false) AS shipped_before_order,
       o.o_orderdate <= l.l_shipdate AS order_then_ship
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def dq_order_flags(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    orders = spark.read.parquet(f"{d}/orders.parquet")
    j = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "left")
    return j.select("l_orderkey", "l_linenumber",
                    violation_flag("o_orderdate", "l_shipdate").alias("shipped_before_order"),
                    ok_flag("o_orderdate", "l_shipdate").alias("order_then_ship"))


# ---------------------------------------------------------------- DQ5-DQ9
_COV_ACT = """SELECT 'activity' AS level, source, activity, count(*) AS total, count(timestamp) AS with_timestamp,
       count(*) - count(timestamp) AS without_timestamp,
       round(count(timestamp) / count(*) * 100, 2) AS coverage_pct, DATE '{as_of}' AS as_of
FROM {log} GROUP BY source, activity"""
_COV_CASE = """SELECT 'case' AS level, CAST(NULL AS VARCHAR) AS source, CAST(NULL AS VARCHAR) AS activity,
       count(*) AS total, count(*) FILTER (WHERE a = 0) AS with_timestamp,
       count(*) FILTER (WHERE a = 1) AS without_timestamp,
       round(count(*) FILTER (WHERE a = 0) / count(*) * 100, 2) AS coverage_pct, DATE '{as_of}' AS as_of
FROM (SELECT case_id, min(CAST(timestamp IS NULL AS INTEGER)) AS a FROM {log} GROUP BY case_id)"""


@register("dq_activity_coverage", with_logs("log_m") + "\n" + _COV_ACT.format(as_of=AS_OF, log="log_m"))
def dq_activity_coverage(spark, d):
    return dq.activity_coverage(logs.milestone_log(spark, d), AS_OF)


@register("dq_case_coverage", with_logs("log_x") + "\n" + _COV_CASE.format(as_of=AS_OF, log="log_x"))
def dq_case_coverage(spark, d):
    return dq.case_coverage(logs.mixed_log(spark, d), AS_OF)


@register("dq_coverage", with_logs("log_x") + "\n" + _COV_ACT.format(as_of=AS_OF, log="log_x")
          + "\nUNION ALL\n" + _COV_CASE.format(as_of=AS_OF, log="log_x"))
def dq_coverage(spark, d):
    return dq.coverage_table(logs.mixed_log(spark, d), AS_OF)


@register("dq_loss_audit", with_logs("log_x") + """
SELECT source, count(*) AS events, count(*) FILTER (WHERE case_id IS NULL) AS null_case,
       count(*) FILTER (WHERE activity IS NULL) AS null_activity,
       count(*) FILTER (WHERE timestamp IS NULL) AS null_timestamp,
       count(*) FILTER (WHERE case_id IS NOT NULL AND activity IS NOT NULL AND timestamp IS NOT NULL) AS kept
FROM log_x GROUP BY source""")
def dq_loss_audit(spark, d):
    return dq.loss_audit(logs.mixed_log(spark, d))


_PROFILE_COLS = ["case_id", "user_id", "first_signup", "first_view", "first_click", "first_purchase",
                 "first_error", "n_events"]


@register("dq_column_profile", with_logs("ms_wide") + "\n" + "\nUNION ALL\n".join(
    f"SELECT 'sessions' AS dataset, '{c}' AS \"column\", count(*) AS total, count({c}) AS non_null, "
    f"round(count({c}) / count(*), 4) AS share FROM ms_wide" for c in _PROFILE_COLS))
def dq_column_profile(spark, d):
    return dq.column_profile(logs.session_milestones(spark, d), "sessions")


# ---------------------------------------------------------------- AN1-AN5
CUSTOMER_POLICY = ColumnPolicy("customer", hash_columns=("c_custkey", "c_name"),
                               drop_columns=("c_acctbal", "c_phone"))


@register("an_hash", f"""
SELECT sha256('{SALT}.' || CAST(c_custkey AS VARCHAR)) AS c_custkey, sha256('{SALT}.' || c_name) AS c_name,
       c_nationkey, c_mktsegment
FROM customer""")
def an_hash(spark, d):
    cust = spark.read.parquet(f"{d}/customer.parquet")
    return privacy.apply_policy(cust, CUSTOMER_POLICY, SALT, AS_OF)


@register("an_generalise_date", f"""
SELECT o_orderkey, o_orderpriority,
       CAST(round(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') / 365.25) AS INTEGER) AS IDADE_CALCULADA
FROM orders""")
def an_generalise_date(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet").select(
        "o_orderkey", "o_orderpriority",
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("birth_date"))
    policy = ColumnPolicy("orders", generalize_columns=("birth_date",))
    return privacy.apply_policy(orders, policy, SALT, AS_OF, date_format="dd/MM/yyyy")


# ---------------------------------------------------------------- SC2-SC9
@register("sc_parse", """
SELECT o_orderkey,
       try_strptime(strftime(o_orderdate, '%d/%m/%Y %H:%M'), '%d/%m/%Y %H:%M') AS ts_br,
       try_cast(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) AS ts_iso,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS ts_sentinel,
       CAST(o_orderdate AS DATE) AS d_br,
       make_date(2000 + CAST(strftime(o_orderdate, '%y') AS INTEGER), month(o_orderdate), day(o_orderdate)) AS d_short,
       try_cast(CAST(o_custkey AS VARCHAR) AS INTEGER) AS i_key,
       CAST(NULL AS INTEGER) AS i_price,
       CASE WHEN o_orderpriority = '5-LOW' THEN date_trunc('day', o_orderdate) ELSE o_orderdate END AS ts_default,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END AS ts_explicit
FROM orders""")
def sc_parse(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    txt = o.select(
        "o_orderkey",
        F.date_format("o_orderdate", "dd/MM/yyyy HH:mm").alias("t_br"),
        F.col("o_orderdate").cast("string").alias("t_iso"),
        F.when(F.col("o_orderstatus") == "P", F.lit("//"))
         .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss")).alias("t_sentinel"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("t_date"),
        F.date_format("o_orderdate", "dd/MM/yy").alias("t_short"),
        F.col("o_custkey").cast("string").alias("t_key"),
        F.col("o_totalprice").cast("string").alias("t_price"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("t_day"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
         .otherwise(F.date_format("o_orderdate", "HH:mm:ss")).alias("t_time"),
    )
    ntz = lambda c: c.cast("timestamp_ntz")  # noqa: E731  (stable output type across engines)
    return txt.select(
        "o_orderkey",
        ntz(parse_timestamp("t_br", "dd/MM/yyyy HH:mm")).alias("ts_br"),
        ntz(parse_timestamp("t_iso")).alias("ts_iso"),
        ntz(parse_timestamp(nullify("t_sentinel"), "dd/MM/yyyy HH:mm:ss")).alias("ts_sentinel"),
        parse_date("t_date", "dd/MM/yyyy").alias("d_br"),
        parse_date("t_short", "dd/MM/yy").alias("d_short"),
        parse_int("t_key").alias("i_key"),
        parse_int("t_price").alias("i_price"),
        ntz(combine_date_time("t_day", "t_time")).alias("ts_default"),
        ntz(combine_date_time("t_day", "t_time", "yyyy-MM-dd HH:mm:ss")).alias("ts_explicit"),
    )


_NAME_RULES = [(r"#0+", "#"), ("Customer", "Client")]


@register("sc_repair", """
SELECT c_custkey, regexp_replace(regexp_replace(c_name, '#0+', '#', 'g'), 'Customer', 'Client', 'g') AS c_name,
       nullif(c_mktsegment, 'BUILDING') AS c_mktsegment
FROM customer""")
def sc_repair(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet")
    return c.select("c_custkey", regex_repair("c_name", _NAME_RULES).alias("c_name"),
                    nullify("c_mktsegment", "BUILDING").alias("c_mktsegment"))


@register("sc_respace", """
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') || strftime(o_orderdate, '%H:%M') AS glued,
       strftime(o_orderdate, '%d/%m/%Y %H:%M') AS respaced, o_orderdate AS parsed
FROM orders""")
def sc_respace(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").select(
        "o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyyHH:mm").alias("glued"))
    fixed = o.withColumn("respaced", respace_datetime("glued"))
    return fixed.withColumn("parsed", parse_timestamp("respaced", "dd/MM/yyyy HH:mm").cast("timestamp_ntz"))


# ---------------------------------------------------------------- RS1-RS5
def _customer_report(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet")
    return c.select(
        F.col("c_mktsegment").alias("file"), F.col("c_custkey").alias("row_no"),
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("Página "), F.col("c_nationkey").cast("string")))
         .otherwise(F.concat(F.lit(" "), F.col("c_custkey").cast("string"))).alias("c0"),
        F.col("c_name").alias("c1"), F.col("c_nationkey").cast("string").alias("c2"))


@register("rs_numeric_key", """
SELECT c_mktsegment AS file, c_custkey AS row_no, ' ' || CAST(c_custkey AS VARCHAR) AS c0, c_name AS c1,
       CAST(c_nationkey AS VARCHAR) AS c2
FROM customer WHERE NOT (c_acctbal < 0)""")
def rs_numeric_key(spark, d):
    return rs.numeric_key_rows(_customer_report(spark, d), "c0")


@register("rs_forward_fill", """
SELECT event_id, user_id, ts, event_type,
       last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS)
         OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
         AS last_signup_value
FROM events""")
def rs_forward_fill(spark, d):
    ev = spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "ts", "event_type", "value")
    filled = forward_fill(ev, ["user_id"], ["ts", "event_id"],
                          {"last_signup_value": F.when(F.col("event_type") == "signup", F.col("value"))},
                          skew=CFG.skew)
    return filled.drop("value")


def _layout_report(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    t = F.date_format("o_orderdate", "HH:mm:ss")
    p = F.col("o_orderpriority")
    cols = {f"c{i}": F.lit(None).cast("string") for i in range(20)}
    cols["c1"] = F.col("o_orderkey").cast("string")
    cols["c10"] = F.when(p == "1-URGENT", t)
    cols["c11"] = F.when(p == "1-URGENT", F.col("o_orderstatus"))
    cols["c7"] = F.when(p == "2-HIGH", t)
    cols["c8"] = F.when(p == "2-HIGH", F.col("o_orderstatus")).when(p == "3-MEDIUM", t)
    cols["c9"] = F.when(p == "3-MEDIUM", F.col("o_orderstatus"))
    return o.select(F.lit("orders").alias("file"), F.col("o_orderkey").alias("row_no"),
                    *[c.alias(n) for n, c in cols.items()])


_LAYOUTS = [("c10", {"key": "c1", "time": "c10", "status": "c11"}),
            ("c7", {"key": "c1", "time": "c7", "status": "c8"}),
            ("c8", {"key": "c1", "time": "c8", "status": "c9"})]


@register("rs_layout", """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END AS layout,
       CAST(o_orderkey AS VARCHAR) AS key, strftime(o_orderdate, '%H:%M:%S') AS time, o_orderstatus AS status
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""")
def rs_layout(spark, d):
    rows, _ = rs.normalise_layouts(_layout_report(spark, d), _LAYOUTS)
    return rows


@register("rs_layout_counts", """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 END AS layout,
       count(*) AS rows
FROM orders GROUP BY 1""")
def rs_layout_counts(spark, d):
    _, counts = rs.normalise_layouts(_layout_report(spark, d), _LAYOUTS)
    return counts


@register("rs_day_month_swap", """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
            THEN CASE WHEN day(o_orderdate) <= 12
                      THEN make_timestamp(year(o_orderdate), day(o_orderdate), month(o_orderdate),
                                          hour(o_orderdate), minute(o_orderdate), second(o_orderdate)) END
            ELSE o_orderdate END AS repaired
FROM orders""")
def rs_day_month_swap(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    typed = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_orderdate"))
    text = F.when(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
                  F.date_format("o_orderdate", "M/d/yyyy h:mm:ss a"))
    raw = o.select("o_orderkey", typed.alias("typed"), text.alias("text"))
    return raw.select("o_orderkey",
                      rs.repair_timestamp(F.col("typed"), F.col("text")).cast("timestamp_ntz").alias("repaired"))


# ---------------------------------------------------------------- RS2 and the Silver builder
@register("rs_projection", """
SELECT CAST(c_custkey AS VARCHAR) AS ATEND, c_name AS NM_PACIENTE, CAST(c_nationkey AS VARCHAR) AS CD_EXAME
FROM customer WHERE NOT (c_acctbal < 0)""")
def rs_projection(spark, d):
    kept = rs.numeric_key_rows(_customer_report(spark, d), "c0")
    return rs.positional_projection(kept.withColumn("c0", F.trim("c0")), ["c0", "c1", "c2"],
                                    ["ATEND", "NM_PACIENTE", "CD_EXAME"])


def _lineitem_text(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    orders = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_orderdate")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey, "left").drop("o_orderkey")
    return j.select(*[F.col(c).cast("string").alias(c.upper()) for c in j.columns],
                    F.lit(None).cast("string").alias("_rescued_data"),
                    F.lit("lineitem.csv").alias("_source_file"))


def _line_spec():
    from flowlog.plans.hospital import ISO_SECONDS, SilverSpec
    return SilverSpec(
        name="silver_lineitem", bronze="lineitem",
        filters=(("L_LINESTATUS", "F"),),
        repairs=(("L_RETURNFLAG", "N", "none"),),
        timestamps=((ISO_SECONDS, ("L_SHIPDATE", "O_ORDERDATE")),),
        ints=("L_LINENUMBER",),
        violation_flags=(("flag_ship_before_order", "O_ORDERDATE", "L_SHIPDATE"),),
        rules=(Rule("line_present", "L_LINENUMBER IS NOT NULL", "drop"),),
        dedup_keys=("L_ORDERKEY", "L_LINENUMBER"), dedup_order="L_SHIPDATE", dedup_ascending=False,
        drops=("L_TAX", "_rescued_data", "_source_file"))


@register("dd_silver_builder", """
SELECT CAST(l_orderkey AS VARCHAR) AS L_ORDERKEY, l_linenumber AS L_LINENUMBER,
       CAST(l_partkey AS VARCHAR) AS L_PARTKEY, rf AS L_RETURNFLAG, l_shipdate AS L_SHIPDATE,
       o_orderdate AS O_ORDERDATE, coalesce(o_orderdate > l_shipdate, false) AS flag_ship_before_order
FROM (SELECT *, replace(l_returnflag, 'N', 'none') AS rf,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                ORDER BY l_shipdate DESC NULLS LAST, CAST(l_partkey AS VARCHAR),
                                         CAST(l_suppkey AS VARCHAR), CAST(l_quantity AS VARCHAR),
                                         CAST(l_extendedprice AS VARCHAR), CAST(l_discount AS VARCHAR),
                                         CAST(l_tax AS VARCHAR), replace(l_returnflag, 'N', 'none'),
                                         l_linestatus, o_orderdate) AS rn
      FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
      WHERE l_linestatus = 'F') WHERE rn = 1""")
def dd_silver_builder(spark, d):
    """The generic Silver builder (filter, repair, parse, flag, drop rule, dedup, drop) on lineitem text."""
    from flowlog.plans.hospital import build_silver
    s = build_silver(_lineitem_text(spark, d), _line_spec())
    return s.select("L_ORDERKEY", "L_LINENUMBER", "L_PARTKEY", "L_RETURNFLAG",
                    F.col("L_SHIPDATE").cast("timestamp_ntz").alias("L_SHIPDATE"),
                    F.col("O_ORDERDATE").cast("timestamp_ntz").alias("O_ORDERDATE"),
                    "flag_ship_before_order")


_SHAPES = ["M/d/yyyy h:mm:ss a", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "dd-MMM-yyyy HH:mm:ss", "M/d/yyyy H:mm:ss",
           "MMM d, yyyy h:mm:ss a", "yyyyMMdd HH:mm:ss"]


def _mixed_cells(spark, d):
    """Order dates written in one of seven shapes by order key, or as a shape that is no date."""
    o = spark.read.parquet(f"{d}/orders.parquet")
    kind = F.col("o_orderkey") % (len(_SHAPES) + 1)
    cell = F.when(kind == len(_SHAPES), F.concat(F.lit("week "), F.date_format("o_orderdate", "D/yyyy")))
    for i, shape in enumerate(_SHAPES):
        cell = cell.when(kind == i, F.date_format("o_orderdate", shape))
    return o.select("o_orderkey", cell.alias("cell"))


@register("rs_mixed_formats", f"""
SELECT o_orderkey, CASE WHEN o_orderkey % {len(_SHAPES) + 1} < {len(_SHAPES)} THEN date_trunc('second', o_orderdate) END AS parsed FROM orders""")
def rs_mixed_formats(spark, d):
    """Dates of seven shapes in one column, each parsed by its mask (RS5)."""
    return _mixed_cells(spark, d).select("o_orderkey", rs.mixed_timestamp(F.col("cell")).cast("timestamp_ntz").alias("parsed"))


@register("rs_unknown_masks", f"""
SELECT 'AAAA ' || CASE WHEN dayofyear(o_orderdate) < 100 THEN '9' ELSE '999' END || '/9999' AS mask, count(*) AS rows
FROM orders WHERE o_orderkey % {len(_SHAPES) + 1} = {len(_SHAPES)} GROUP BY ALL""")
def rs_unknown_masks(spark, d):
    """Cells of no known shape, counted by shape (RS5)."""
    return rs.unknown_masks(_mixed_cells(spark, d), "cell")


@register("rs_from_file", """
WITH g AS (SELECT c_nationkey, c_custkey, c_name, c_mktsegment, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn,
                  count(*) OVER (PARTITION BY c_nationkey) AS cnt FROM customer)
SELECT c_nationkey AS unit, rn + 1 AS row_in_unit, CAST(c_custkey AS VARCHAR) AS ATEND, c_name AS NM_PACIENTE, 'Unidade ' || c_nationkey AS header FROM g""")
def rs_from_file(spark, d):
    """A landed report, one unit's header line and its rows below it, read back as numbered lines (RS1-RS4)."""
    from flowlog.plans.q_io import _scratch

    path = _scratch(spark, "report")
    cust = spark.read.parquet(f"{d}/customer.parquet")
    rows = cust.select("c_nationkey", F.col("c_custkey").alias("k"), F.concat_ws(";", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment").alias("value"))
    heads = cust.select("c_nationkey").distinct().select("c_nationkey", F.lit(-1).cast("long").alias("k"),
                                                         F.concat(F.lit("Unidade;"), F.col("c_nationkey").cast("string")).alias("value"))
    (rows.unionByName(heads).repartition("c_nationkey").sortWithinPartitions("c_nationkey", "k")
     .select("c_nationkey", "value").write.partitionBy("c_nationkey").text(path))
    lines = rs.split_cells(rs.read_lines(spark, path), 3)
    filled = rs.fill_group_headers(lines, {"header": (F.col("c0") == "Unidade", F.concat_ws(" ", "c0", "c1"))}, skew=CFG.skew)
    kept = rs.numeric_key_rows(filled, "c0")
    table = rs.positional_projection(kept, ["c0", "c1"], ["ATEND", "NM_PACIENTE"], extra=["file", "row_no", "header"])
    return table.select(F.regexp_extract("file", "c_nationkey=([0-9]+)", 1).cast("int").alias("unit"), F.col("row_no").alias("row_in_unit"),
                        "ATEND", "NM_PACIENTE", "header")
