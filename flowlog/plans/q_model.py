"""Registered model-discovery and conformance queries (CF1-CF9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlog.operators import conformance as cf, model as md, prefix_tree as pt
from flowlog.plans import sample_logs as logs
from flowlog.plans.oracle_sql import EVENT_ORDER, mining, with_logs
from flowlog.plans.registry import CFG, NOISE, ORACLE, register


def _edges_sql(log: str) -> str:
    """Steps with START/END, per segment = every source the case touches, plus prefix keys."""
    return with_logs(log) + f""",
ev0 AS (SELECT case_id, activity, source,
               row_number() OVER (PARTITION BY case_id ORDER BY {EVENT_ORDER}) AS pos,
               count(*) OVER (PARTITION BY case_id) AS cnt,
               lag(activity) OVER (PARTITION BY case_id ORDER BY {EVENT_ORDER}) AS prev
        FROM {mining(log)} l),
ev AS (SELECT *,
              list_sort(list(lpad(CAST(pos AS VARCHAR), 9, '0') || ':' || activity)
                   OVER (PARTITION BY case_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS pfx,
              list_sort(list(lpad(CAST(pos AS VARCHAR), 9, '0') || ':' || activity)
                   OVER (PARTITION BY case_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS pfx_all
       FROM ev0),
segs AS (SELECT DISTINCT case_id, source AS segment FROM ev0),
edges0 AS (SELECT case_id, coalesce(prev, '[start]') AS prev_activity, activity, pos AS step,
                  pos - 1 AS plen, coalesce(pfx, []) AS pfx FROM ev
           UNION ALL
           SELECT case_id, activity, '[end]', pos + 1, pos, pfx_all FROM ev WHERE pos = cnt),
edges AS (SELECT s.segment, e.* FROM edges0 e JOIN segs s USING (case_id)),
dfg AS (SELECT segment, prev_activity, activity, count(*) AS n_events, count(DISTINCT case_id) AS n_cases
        FROM edges GROUP BY ALL),
model AS (SELECT segment, prev_activity, activity, n_events FROM (
            SELECT *, max(n_events) OVER (PARTITION BY segment, prev_activity) AS mx FROM dfg)
          WHERE n_events >= {NOISE} * mx),
marked AS (SELECT e.*, m.activity IS NOT NULL AS allowed FROM edges e
           LEFT JOIN model m USING (segment, prev_activity, activity)),
cm AS (SELECT case_id, strftime(min(timestamp), '%Y-%m') AS month FROM {mining(log)} l GROUP BY case_id),
en AS (SELECT segment, prev_activity, list(activity) AS en FROM model GROUP BY ALL)"""


def _precision_sql(by: str) -> str:
    return f"""
pref AS (SELECT {by}, plen, pfx, prev_activity, count(*) AS n, list(DISTINCT activity) AS taken
         FROM edges e JOIN cm USING (case_id) GROUP BY ALL),
sc AS (SELECT p.*, coalesce(len(en.en), 0) AS e, coalesce(len(list_intersect(p.taken, en.en)), 0) AS t
       FROM pref p LEFT JOIN en USING (segment, prev_activity)),
prec AS (SELECT {by}, round(CASE WHEN sum(n * e) > 0 THEN 1.0 - sum(n * (e - t)) / sum(n * e) ELSE 1.0 END, 4)
                AS precision FROM sc GROUP BY ALL)"""


@register("cf_dfg", _edges_sql("log_b") + "\nSELECT * FROM dfg")
def cf_dfg(spark, d):
    return md.dfg(md.edge_steps(logs.order_log(spark, d), CFG, scope="case"))


@register("cf_start_end", _edges_sql("log_b") + """
SELECT segment, 'start' AS kind, activity, n_events, n_cases FROM dfg WHERE prev_activity = '[start]'
UNION ALL
SELECT segment, 'end', prev_activity, n_events, n_cases FROM dfg WHERE activity = '[end]'""")
def cf_start_end(spark, d):
    return md.start_end(md.dfg(md.edge_steps(logs.order_log(spark, d), CFG, scope="case")))


@register("cf_footprint", _edges_sql("log_a") + """,
r AS (SELECT segment, prev_activity AS a, activity AS b FROM dfg
      WHERE prev_activity <> '[start]' AND activity <> '[end]')
SELECT coalesce(x.segment, y.segment) AS segment, coalesce(x.a, y.b) AS a, coalesce(x.b, y.a) AS b,
       CASE WHEN x.a IS NOT NULL AND y.a IS NOT NULL THEN '||' WHEN x.a IS NOT NULL THEN '->' ELSE '<-' END
         AS relation
FROM r x FULL OUTER JOIN r y ON x.segment = y.segment AND x.a = y.b AND x.b = y.a""")
def cf_footprint(spark, d):
    return md.footprint(md.dfg(md.edge_steps(logs.session_log(spark, d), CFG, scope="case")))


@register("cf_eventually_follows", _edges_sql("log_a") + f""",
pos AS (SELECT s.segment, e.case_id, e.activity, min(e.pos) AS first_pos, max(e.pos) AS last_pos
        FROM ev0 e JOIN segs s USING (case_id) GROUP BY ALL)
SELECT x.segment, x.activity AS a, y.activity AS b, count(*) AS n_cases
FROM pos x JOIN pos y ON x.segment = y.segment AND x.case_id = y.case_id AND x.first_pos < y.last_pos
GROUP BY ALL""")
def cf_eventually_follows(spark, d):
    return md.eventually_follows(logs.session_log(spark, d), CFG, scope="case")


@register("cf_model", _edges_sql("log_a") + "\nSELECT * FROM model")
def cf_model(spark, d):
    edges = md.edge_steps(logs.session_log(spark, d), CFG, scope="case")
    return md.filtered_model(md.dfg(edges), NOISE)


@register("cf_fitness", _edges_sql("log_a") + """
SELECT segment, round(1.0 - count(*) FILTER (WHERE NOT allowed) / count(*), 4) AS fitness,
       count(*) AS steps, count(*) FILTER (WHERE NOT allowed) AS disallowed
FROM marked GROUP BY segment""")
def cf_fitness(spark, d):
    edges = md.edge_steps(logs.session_log(spark, d), CFG, scope="case")
    return cf.fitness(edges, md.filtered_model(md.dfg(edges), NOISE))


@register("cf_case_fitness", _edges_sql("log_a") + """
SELECT segment, case_id, round(1.0 - count(*) FILTER (WHERE NOT allowed) / count(*), 4) AS fitness,
       count(*) AS steps, count(*) FILTER (WHERE NOT allowed) AS disallowed
FROM marked GROUP BY segment, case_id""")
def cf_case_fitness(spark, d):
    edges = md.edge_steps(logs.session_log(spark, d), CFG, scope="case")
    return cf.case_fitness(edges, md.filtered_model(md.dfg(edges), NOISE))


@register("cf_precision", _edges_sql("log_a") + "," + _precision_sql("segment") + "\nSELECT * FROM prec")
def cf_precision(spark, d):
    edges = md.edge_steps(logs.session_log(spark, d), CFG, scope="case", with_prefix=True)
    return cf.precision(edges, md.filtered_model(md.dfg(edges), NOISE))


@register("cf_conformance", _edges_sql("log_a") + "," + _precision_sql("segment, month") + """,
fit AS (SELECT segment, month, round(1.0 - count(*) FILTER (WHERE NOT allowed) / count(*), 4) AS fitness,
               count(DISTINCT case_id) AS total_traces
        FROM marked JOIN cm USING (case_id) GROUP BY ALL)
SELECT fit.segment AS source, fitness, precision, total_traces, fit.month
FROM fit JOIN prec USING (segment, month)""")
def cf_conformance(spark, d):
    return cf.conformance(logs.session_log(spark, d), CFG, noise_threshold=NOISE, scope="case")


@register("cf_conformance_b", _edges_sql("log_b") + "," + _precision_sql("segment, month") + """,
fit AS (SELECT segment, month, round(1.0 - count(*) FILTER (WHERE NOT allowed) / count(*), 4) AS fitness,
               count(DISTINCT case_id) AS total_traces
        FROM marked JOIN cm USING (case_id) GROUP BY ALL)
SELECT fit.segment AS source, fitness, precision, total_traces, fit.month
FROM fit JOIN prec USING (segment, month)""")
def cf_conformance_b(spark, d):
    return cf.conformance(logs.order_log(spark, d), CFG, noise_threshold=NOISE, scope="case")


def _edges_sql_source(log: str) -> str:
    """Steps per (case, source) - only the source's own events - with segment = source."""
    return with_logs(log) + f""",
ev AS (SELECT case_id, source AS segment, activity,
              row_number() OVER w AS pos, count(*) OVER (PARTITION BY case_id, source) AS cnt,
              lag(activity) OVER w AS prev
       FROM {mining(log)} l WINDOW w AS (PARTITION BY case_id, source ORDER BY {EVENT_ORDER})),
edges AS (SELECT segment, case_id, coalesce(prev, '[start]') AS prev_activity, activity FROM ev
          UNION ALL SELECT segment, case_id, activity, '[end]' FROM ev WHERE pos = cnt),
dfg AS (SELECT segment, prev_activity, activity, count(*) AS n_events, count(DISTINCT case_id) AS n_cases
        FROM edges GROUP BY ALL),
model AS (SELECT segment, prev_activity, activity FROM (
            SELECT *, max(n_events) OVER (PARTITION BY segment, prev_activity) AS mx FROM dfg)
          WHERE n_events >= {NOISE} * mx)"""


@register("cf_dfg_source", _edges_sql_source("log_b") + "\nSELECT * FROM dfg")
def cf_dfg_source(spark, d):
    return md.dfg(md.edge_steps(logs.order_log(spark, d), CFG, scope="source"))


@register("cf_fitness_source", _edges_sql_source("log_b") + """
SELECT segment, round(1.0 - count(*) FILTER (WHERE m.activity IS NULL) / count(*), 4) AS fitness,
       count(*) AS steps, count(*) FILTER (WHERE m.activity IS NULL) AS disallowed
FROM edges e LEFT JOIN model m USING (segment, prev_activity, activity) GROUP BY segment""")
def cf_fitness_source(spark, d):
    edges = md.edge_steps(logs.order_log(spark, d), CFG, scope="source")
    return cf.fitness(edges, md.filtered_model(md.dfg(edges), NOISE))


_TREE_SQL = """,
walked AS (SELECT segment, month, plen AS depth0, list_concat(pfx, [lpad(CAST(step AS VARCHAR), 9, '0') || ':' || activity]) AS path,
                  pfx, prev_activity, activity FROM edges e JOIN cm USING (case_id)),
nodes AS (SELECT segment, month, depth0 + 1 AS depth, path, pfx, prev_activity, activity, count(*) AS n FROM walked GROUP BY ALL),
family AS (SELECT segment, month, pfx, count(*) AS siblings, CAST(sum(n) AS BIGINT) AS parent_n FROM nodes GROUP BY ALL)
SELECT segment, month, depth, prev_activity, activity, n, siblings, parent_n FROM nodes JOIN family USING (segment, month, pfx)"""


def _tree_rows(tree):
    """A tree's nodes without their ids; siblings and the cases of the parent show that parents are right."""
    family = tree.groupBy("segment", "month", "parent").agg(F.count(F.lit(1)).alias("siblings"), F.sum("n").alias("parent_n"))
    return tree.join(family, ["segment", "month", "parent"]).select(
        "segment", "month", "depth", "prev_activity", "activity", "n", "siblings", "parent_n")


@register("cf_prefix_tree", _edges_sql("log_b") + _TREE_SQL)
def cf_prefix_tree(spark, d):
    """The prefix tree of the order log per source and month, nodes told apart exactly (CF7)."""
    return _tree_rows(pt.prefix_tree(logs.order_log(spark, d), CFG))


@register("cf_tree_conformance", ORACLE["cf_conformance"])
def cf_tree_conformance(spark, d):
    """Fitness and precision of the session log read off its prefix tree (CF6-CF8)."""
    return pt.tree_conformance(pt.prefix_tree(logs.session_log(spark, d), CFG), NOISE)


@register("cf_footprint_full", _edges_sql("log_b") + """,
r AS (SELECT segment, prev_activity AS a, activity AS b FROM dfg WHERE prev_activity <> '[start]' AND activity <> '[end]'),
n AS (SELECT DISTINCT segment, x AS a FROM (SELECT segment, unnest([prev_activity, activity]) AS x FROM dfg) WHERE x NOT IN ('[start]', '[end]'))
SELECT n.segment, n.a, m.a AS b,
       CASE WHEN f.a IS NOT NULL AND g.a IS NOT NULL THEN '||' WHEN f.a IS NOT NULL THEN '->' WHEN g.a IS NOT NULL THEN '<-' ELSE '#' END AS relation
FROM n JOIN n AS m ON m.segment = n.segment LEFT JOIN r AS f ON f.segment = n.segment AND f.a = n.a AND f.b = m.a
LEFT JOIN r AS g ON g.segment = n.segment AND g.a = m.a AND g.b = n.a""")
def cf_footprint_full(spark, d):
    """All four ordering relations, ``#`` included (CF3)."""
    return md.full_footprint(md.dfg(md.edge_steps(logs.order_log(spark, d), CFG, scope="case")))
