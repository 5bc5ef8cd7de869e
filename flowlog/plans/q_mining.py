"""Registered mining queries: variants, transitions, spectrum, networks, KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlog.operators import episodes, kpis, network as sn, transitions as tr, variants as mv
from flowlog.plans import sample_logs as logs
from flowlog.plans.oracle_sql import EVENT_ORDER, mining, with_logs
from flowlog.plans.registry import AS_OF, CFG, register

# ---------------------------------------------------------------- MN3 / MN4
_BOTTLENECK = with_logs("log_a") + f""",
s AS (SELECT source, activity, timestamp,
             lag(activity) OVER w AS prev_activity, lag(timestamp) OVER w AS prev_ts
      FROM {mining('log_a')} l
      WINDOW w AS (PARTITION BY case_id, source ORDER BY {EVENT_ORDER})),
t AS (SELECT source, strftime(timestamp, '%Y-%m') AS month, prev_activity AS from_activity,
             activity AS to_activity,
             date_diff('microsecond', prev_ts, timestamp) / 60000000.0 AS minutes
      FROM s WHERE prev_activity IS NOT NULL),
b AS (SELECT source, month, from_activity, to_activity,
             round(avg(minutes), 4) AS mean_min, round(median(minutes), 4) AS median_min,
             round(stddev_samp(minutes), 4) AS std_min, count(*) AS n,
             round(100.0 * stddev_samp(minutes) / nullif(avg(minutes), 0), 1) AS cv_pct
      FROM t GROUP BY source, month, from_activity, to_activity)"""


@register("mn_bottleneck", _BOTTLENECK + "\nSELECT * FROM b")
def mn_bottleneck(spark, d):
    return tr.bottlenecks(logs.session_log(spark, d), CFG)


@register("mn_bottleneck_report",
          _BOTTLENECK + "\nSELECT *, from_activity || ' → ' || to_activity AS transition FROM b "
          "WHERE n >= 30 AND from_activity <> to_activity")
def mn_bottleneck_report(spark, d):
    return tr.bottleneck_report(tr.bottlenecks(logs.session_log(spark, d), CFG), min_support=30)


# ---------------------------------------------------------------- MN5 / MN6
_WEEKDAY_SQL = ("CASE isodow({ts}) WHEN 1 THEN 'Segunda' WHEN 2 THEN 'Terça' WHEN 3 THEN 'Quarta' "
                "WHEN 4 THEN 'Quinta' WHEN 5 THEN 'Sexta' WHEN 6 THEN 'Sábado' ELSE 'Domingo' END")

_SPECTRUM = with_logs("log_a") + f""",
s AS (SELECT activity, timestamp, lead(activity) OVER w AS next_activity, lead(timestamp) OVER w AS next_ts
      FROM {mining('log_a')} l
      WINDOW w AS (PARTITION BY case_id ORDER BY {EVENT_ORDER})),
t AS (SELECT activity, next_activity, strftime(timestamp, '%Y-%m') AS month,
             {_WEEKDAY_SQL.format(ts='timestamp')} AS weekday,
             date_diff('microsecond', timestamp, next_ts) / 60000000.0 AS minutes
      FROM s WHERE next_activity IS NOT NULL)
SELECT activity, next_activity, month, weekday, count(*) AS n,
       round(quantile_cont(minutes, 0.5), 4) AS median_min,
       round(quantile_cont(minutes, 0.25), 4) AS p25_min,
       round(quantile_cont(minutes, 0.75), 4) AS p75_min
FROM t WHERE minutes >= 0 GROUP BY activity, next_activity, month, weekday"""


@register("mn_spectrum", _SPECTRUM)
def mn_spectrum(spark, d):
    return tr.performance_spectrum(logs.session_log(spark, d), CFG)


@register("mn_time_features", with_logs("log_a") + f"""
SELECT case_id, activity, timestamp, CAST(timestamp AS DATE) AS day,
       {_WEEKDAY_SQL.format(ts='timestamp')} AS weekday, CAST(hour(timestamp) AS INTEGER) AS hour,
       strftime(timestamp, '%Y-%m') AS month
FROM {mining('log_a')} l""")
def mn_time_features(spark, d):
    from flowlog.operators.eventlog import mining_view
    view = mining_view(logs.session_log(spark, d)).select("case_id", "activity", "timestamp")
    return tr.with_time_features(view)


# ---------------------------------------------------------------- MN1 / MN2
_VARIANTS = with_logs("log_a") + f""",
seqs AS (SELECT case_id, string_agg(activity, ' → ' ORDER BY {EVENT_ORDER}) AS sequence,
                count(*) AS n_events
         FROM {mining('log_a')} l GROUP BY case_id),
v AS (SELECT sequence, CAST(n_events AS INTEGER) AS n_events, count(*) AS n_cases
      FROM seqs GROUP BY sequence, n_events),
r AS (SELECT row_number() OVER (ORDER BY n_cases DESC, sequence ASC) AS rank, sequence, n_events,
             n_cases, round(n_cases * 100.0 / (SELECT count(*) FROM seqs), 2) AS coverage_pct,
             DATE '{AS_OF}' AS as_of
      FROM v)"""


@register("mn_variants", _VARIANTS + "\nSELECT * FROM r")
def mn_variants(spark, d):
    return mv.variants(logs.session_log(spark, d), CFG, as_of=AS_OF)


@register("mn_top_variants", _VARIANTS + "\nSELECT * FROM r WHERE rank <= 10")
def mn_top_variants(spark, d):
    return mv.top_variants(mv.variants(logs.session_log(spark, d), CFG, as_of=AS_OF), 10)


@register("mn_pareto", _VARIANTS + """
SELECT rank, sequence, n_cases,
       CAST(sum(n_cases) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_cases,
       round(sum(n_cases) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0
             / sum(n_cases) OVER (), 2) AS cum_pct
FROM r""")
def mn_pareto(spark, d):
    return mv.variant_pareto(mv.variants(logs.session_log(spark, d), CFG, as_of=AS_OF))


# ---------------------------------------------------------------- SN1..SN5, OP3
_CASE_STEPS_B = with_logs("log_b") + f""",
s AS (SELECT *, lag(source) OVER w AS prev_source, lag(specialty) OVER w AS prev_specialty,
             lag(source, 2) OVER w AS prev2_source
      FROM {mining('log_b')} l
      WINDOW w AS (PARTITION BY case_id ORDER BY {EVENT_ORDER}))"""


@register("sn_handover_source", _CASE_STEPS_B + """
SELECT prev_source, source, strftime(timestamp, '%Y-%m') AS month, specialty, count(*) AS n
FROM s WHERE prev_source IS NOT NULL AND prev_source <> source AND specialty IS NOT NULL
GROUP BY ALL""")
def sn_handover_source(spark, d):
    return sn.handover_between_sources(logs.order_log(spark, d), CFG)


@register("sn_subcontract_source_specialty", _CASE_STEPS_B + """
SELECT source, strftime(timestamp, '%Y-%m') AS month, prev_source AS middle_source,
       prev_specialty AS middle_specialty, count(*) AS n
FROM s WHERE prev2_source = source AND prev_source <> source AND prev_specialty IS NOT NULL
GROUP BY ALL""")
def sn_subcontract_source_specialty(spark, d):
    return sn.subcontracting_between_sources(logs.order_log(spark, d), CFG)


def _actor_sql(log: str, actor: str, segment: str | None, kind: str) -> str:
    seg = segment or "'all'"
    base = with_logs(log) + f""",
f AS (SELECT *, CAST({seg} AS VARCHAR) AS segment FROM {mining(log)} l WHERE {actor} IS NOT NULL),
s AS (SELECT segment, {actor} AS cur, lag({actor}) OVER w AS p1, lag({actor}, 2) OVER w AS p2
      FROM f WINDOW w AS (PARTITION BY case_id, segment ORDER BY {EVENT_ORDER}))"""
    if kind == "handover":
        return base + """,
pairs AS (SELECT segment, p1 AS a, cur AS b, count(*) AS n FROM s WHERE p1 IS NOT NULL GROUP BY ALL)
SELECT segment, a, b, n, round(n / sum(n) OVER (PARTITION BY segment), 6) AS weight FROM pairs"""
    return base + """,
tot AS (SELECT segment, count(*) AS t FROM s WHERE p2 IS NOT NULL GROUP BY segment),
pairs AS (SELECT segment, cur AS a, p1 AS b, count(*) AS n FROM s WHERE p2 IS NOT NULL AND p2 = cur GROUP BY ALL)
SELECT pairs.segment, a, b, n, round(n / t, 6) AS weight FROM pairs JOIN tot USING (segment)"""


@register("sn_handover_specialty", _actor_sql("log_b", "specialty", "source", "handover"))
def sn_handover_specialty(spark, d):
    return sn.handover(logs.order_log(spark, d), CFG, actor="specialty", segment="source")


@register("sn_subcontract_specialty", _actor_sql("log_b", "specialty", "source", "subcontracting"))
def sn_subcontract_specialty(spark, d):
    return sn.subcontracting(logs.order_log(spark, d), CFG, actor="specialty", segment="source")


@register("sn_subcontract_source", _actor_sql("log_b", "source", None, "subcontracting"))
def sn_subcontract_source(spark, d):
    return sn.subcontracting(logs.order_log(spark, d), CFG, actor="source", segment=None)


@register("sn_handover_resource", _actor_sql("log_a", "resource", "source", "handover"))
def sn_handover_resource(spark, d):
    return sn.handover(logs.session_log(spark, d), CFG, actor="resource", segment="source")


# ---------------------------------------------------------------- journeys
@register("el_journey_kpis", with_logs("log_b") + f""",
r AS (SELECT case_id, specialty, timestamp,
             row_number() OVER (PARTITION BY case_id ORDER BY {EVENT_ORDER}) AS pos
      FROM {mining('log_b')} l),
c AS (SELECT case_id, min(timestamp) AS st, max(timestamp) AS en, count(*) AS ev,
             max(CASE WHEN pos = 1 THEN specialty END) AS specialty
      FROM r GROUP BY case_id)
SELECT strftime(st, '%Y-%m') AS month, specialty, count(*) AS cases,
       round(avg(date_diff('microsecond', st, en) / 60000000.0), 4) AS mean_duration_min,
       round(quantile_cont(date_diff('microsecond', st, en) / 60000000.0, 0.5), 4) AS median_duration_min,
       round(avg(ev), 4) AS mean_events
FROM c GROUP BY ALL""")
def el_journey_kpis(spark, d):
    return kpis.journey_kpis(logs.order_log(spark, d), CFG)


@register("el_patient_journeys", with_logs("log_b") + f""",
c AS (SELECT case_id, count(*) AS ev, min(timestamp) AS f, max(timestamp) AS la
      FROM {mining('log_b')} l GROUP BY case_id),
p AS (SELECT CAST(o_orderkey AS VARCHAR) AS case_id, o_custkey AS patient_id FROM orders)
SELECT patient_id, count(*) AS cases, CAST(sum(ev) AS BIGINT) AS events, min(f) AS first_event, max(la) AS last_event,
       round(date_diff('microsecond', min(f), max(la)) / 60000000.0 / 1440.0, 4) AS span_days
FROM c JOIN p USING (case_id) GROUP BY patient_id""")
def el_patient_journeys(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    link = orders.select(F.col("o_orderkey").cast("string").alias("case_id"),
                         F.col("o_custkey").alias("patient_id"))
    return kpis.patient_journeys(logs.order_log(spark, d), link)


_STAYS_SQL = """WITH stays AS (
  SELECT user_id AS patient_id, event_id AS stay_id, CASE WHEN event_type = 'error' THEN 'emergency' ELSE 'inpatient' END AS kind, ts AS start,
         CASE WHEN event_id % 7 <> 0 THEN ts + to_microseconds(CAST(floor(value * 60000000) AS BIGINT)) END AS "end"
  FROM events WHERE event_type IN ('error', 'purchase')),
timed AS (SELECT *, greatest(start, coalesce("end", start)) AS until FROM stays)"""


def _stays(spark, d):
    """``events`` as stays: errors are emergency stays, purchases inpatient ones, value minutes long; one in seven is open."""
    ev = spark.read.parquet(f"{d}/events.parquet").where(F.col("event_type").isin("error", "purchase"))
    micros = F.floor(F.col("value") * 60_000_000)
    return ev.select(F.col("user_id").alias("patient_id"), F.col("event_id").alias("stay_id"),
                     F.when(F.col("event_type") == "error", "emergency").otherwise("inpatient").alias("kind"), F.col("ts").alias("start"),
                     F.when(F.col("event_id") % 7 != 0, F.timestamp_add("MICROSECOND", micros, F.col("ts"))).alias("end"))


@register("el_episode_links", _STAYS_SQL + """,
nexts AS (SELECT e.patient_id, e.stay_id, e.start, e."end", e.until, min({'s': i.start, 'id': i.stay_id}) AS nx
          FROM timed e LEFT JOIN timed i ON i.kind = 'inpatient' AND i.patient_id = e.patient_id AND i.start >= e.start
                                         AND i.start <= e.until + INTERVAL 720 MINUTE
          WHERE e.kind = 'emergency' GROUP BY ALL)
SELECT patient_id, stay_id, start, "end", nx.id AS next_stay_id, nx.s AS next_start,
       round(CASE WHEN nx.s IS NOT NULL THEN greatest(date_diff('microsecond', until, nx.s), 0) / 60000000.0 END, 4) AS wait_minutes
FROM nexts""")
def el_episode_links(spark, d):
    """Emergency stays with the inpatient stay that follows within 12 hours (OP4)."""
    return episodes.link_stays(_stays(spark, d), 720, CFG.skew)


@register("el_episodes", _STAYS_SQL + """,
reach AS (SELECT *, max(until) OVER (PARTITION BY patient_id ORDER BY start, until, stay_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM timed),
numbered AS (SELECT *, sum(CASE WHEN r IS NULL OR start > r + INTERVAL 60 MINUTE THEN 1 ELSE 0 END)
                       OVER (PARTITION BY patient_id ORDER BY start, until, stay_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ep FROM reach)
SELECT patient_id, CAST(ep AS BIGINT) AS episode, count(*) AS stays, count(*) FILTER (WHERE kind = 'emergency') AS emergency_stays,
       count(*) FILTER (WHERE kind = 'inpatient') AS inpatient_stays, min(start) AS first_start,
       CASE WHEN count(*) = count("end") THEN max("end") END AS last_end
FROM numbered GROUP BY patient_id, ep""")
def el_episodes(spark, d):
    """Chains of stays no more than an hour apart (OP4)."""
    return episodes.episodes(_stays(spark, d), 60, CFG.skew)


@register("el_attribute_kpis", with_logs("log_b") + f""",
per AS (SELECT case_id, min(timestamp) AS s, count(*) AS n,
               floor((floor(epoch_ms(max(timestamp)) / 1000.0) - floor(epoch_ms(min(timestamp)) / 1000.0)) / 60) AS dur
        FROM {mining('log_b')} l GROUP BY case_id),
attrs AS (SELECT CAST(o_orderkey AS VARCHAR) AS case_id, 'order' AS case_type, o_orderpriority AS specialty, o_orderdate + INTERVAL 30 DAY AS valid_from FROM orders
          UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'line', l_returnflag, l_shipdate FROM lineitem),
held AS (SELECT per.case_id, per.s, per.n, per.dur, min({{'age': date_diff('microsecond', valid_from, s), 't': case_type, 'p': specialty}}) FILTER (WHERE valid_from <= s) AS b,
                min({{'v': valid_from, 't': case_type, 'p': specialty}}) FILTER (WHERE NOT valid_from <= s) AS a
         FROM per LEFT JOIN attrs USING (case_id) GROUP BY ALL),
rows AS (SELECT strftime(s, '%Y-%m') AS month, coalesce(b.t, a.t) AS case_type, coalesce(b.p, a.p) AS specialty, n, dur FROM held)
SELECT month, case_type, specialty, count(*) AS cases, round(avg(dur), 4) AS mean_duration_min, round(quantile_cont(dur, 0.5), 4) AS median_duration_min,
       round(avg(n), 4) AS mean_events
FROM rows GROUP BY ALL""")
def el_attribute_kpis(spark, d):
    """Journey KPIs by the case attributes that held when the case began; a case has an order row and line rows (OP2, EL6)."""
    from flowlog.operators.eventlog import case_attributes

    schema = {"case_id": "string", "case_type": "string", "specialty": "string", "valid_from": "timestamp_ntz"}
    orders = spark.read.parquet(f"{d}/orders.parquet").select(
        F.col("o_orderkey").alias("case_id"), F.lit("order").alias("case_type"), F.col("o_orderpriority").alias("specialty"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("valid_from"))
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select(
        F.col("l_orderkey").alias("case_id"), F.lit("line").alias("case_type"), F.col("l_returnflag").alias("specialty"), F.col("l_shipdate").alias("valid_from"))
    return kpis.journey_kpis_by_attributes(logs.order_log(spark, d), case_attributes([orders, lines], schema), ("case_type", "specialty"), CFG)
