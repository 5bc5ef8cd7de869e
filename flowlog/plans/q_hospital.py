"""The hospital plan end to end on bronze-shaped text tables derived from the driver tables.

``orders`` becomes an inpatient export (admission at the order date,
discharge at the order's last ship date) and ``lineitem`` a bed-movement
export (one movement per line, type from the return flag, unit text with
the mis-encoded ordinal that the Silver repair fixes).  Both run through
the Silver specs and the Gold event mapping unchanged.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlog.operators import eventlog as el
from flowlog.plans import hospital as h
from flowlog.plans.registry import register

_TS = "yyyy-MM-dd HH:mm:ss"


def bronze_inpatient(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    last_ship = spark.read.parquet(f"{d}/lineitem.parquet").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("_alta"))
    j = orders.join(last_ship, orders.o_orderkey == last_ship.l_orderkey, "left")
    return j.select(
        F.col("o_orderkey").cast("string").alias("ATENDIMENTO"),
        F.col("o_custkey").cast("string").alias("COD_PACIENTE"),
        F.date_format("o_orderdate", _TS).alias("DT_HR_ATENDIMENTO"),
        F.date_format("_alta", _TS).alias("DT_HR_ALTA"),
        F.col("o_orderstatus").alias("UNIDADE"), F.col("o_orderpriority").alias("PRESTADOR"),
        F.col("o_orderpriority").alias("ESPECIALID_ATEND"), F.lit("40").alias("IDADE"),
        F.lit("1").alias("CD_ORIGEM"), F.lit("L").alias("CD_LEITO"),
        F.lit(None).cast("string").alias("_rescued_data"), F.lit("orders.csv").alias("_source_file"))


def bronze_moves(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    tipo = (F.when(F.col("l_returnflag") == "R", "TRANSFER. DE")
            .when(F.col("l_returnflag") == "A", "TRANSFER. PARA").otherwise("ALTA"))
    return li.select(
        F.col("l_orderkey").cast("string").alias("ATEND"), F.lit("08:00:00").alias("HORA"),
        tipo.alias("TIPO"), F.concat(F.lit("1Âº "), F.col("l_linestatus")).alias("UNIDADE"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("DATA"),
        F.lit(None).cast("string").alias("_rescued_data"), F.lit("lineitem.csv").alias("_source_file"))


_HOSPITAL_CTES = """alta AS (SELECT l_orderkey, max(l_shipdate) AS a FROM lineitem GROUP BY l_orderkey),
inp AS (SELECT CAST(o_orderkey AS VARCHAR) AS case_id, o_orderdate AS adm, a AS dis, o_orderstatus AS unidade,
               o_orderpriority AS prest FROM orders LEFT JOIN alta ON o_orderkey = l_orderkey),
mv0 AS (SELECT CAST(l_orderkey AS VARCHAR) AS case_id,
               CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + INTERVAL 8 HOUR AS ts,
               CASE l_returnflag WHEN 'R' THEN 'TRANSFER. DE' WHEN 'A' THEN 'TRANSFER. PARA' ELSE 'ALTA' END AS tipo,
               '1º ' || l_linestatus AS unidade FROM lineitem),
mv AS (SELECT case_id, ts, tipo, min(unidade) AS unidade FROM mv0 GROUP BY ALL),
log_h AS (
  SELECT case_id, tipo AS activity, ts AS timestamp, 'complete' AS lifecycle, 'movimentacao' AS event_type,
         'internacao' AS case_type, CAST(NULL AS VARCHAR) AS outcome, CAST(NULL AS VARCHAR) AS resource,
         CAST(NULL AS VARCHAR) AS specialty, unidade AS location, 'silver_movimentacoes' AS source, 0 AS event_seq
  FROM mv
  UNION ALL
  SELECT case_id, 'Internacao', adm, 'complete', 'internacao', 'internacao', NULL, prest, prest, unidade,
         'silver_internacoes', 0 FROM inp
  UNION ALL
  SELECT case_id, 'Alta da Internacao', dis, 'complete', 'internacao', 'internacao', NULL, prest, prest, unidade,
         'silver_internacoes', 1 FROM inp)"""

_SQL = "WITH " + _HOSPITAL_CTES + """,
dur AS (SELECT case_id,
               CAST(floor((floor(epoch_ms(max(timestamp)) / 1000.0) - floor(epoch_ms(min(timestamp)) / 1000.0)) / 60)
                    AS INTEGER) AS duration_minutes FROM log_h GROUP BY case_id)
SELECT log_h.*, dur.duration_minutes FROM log_h LEFT JOIN dur USING (case_id)"""


def hospital_bronze(spark, d):
    return {"silver_internacoes": bronze_inpatient(spark, d), "silver_movimentacoes": bronze_moves(spark, d)}


def hospital_log(spark, d):
    """Silver specs -> Gold event log on the derived bronze tables."""
    log = h.gold_event_log({name: h.build_silver(bronze, h.SILVER[name]) for name, bronze in hospital_bronze(spark, d).items()})
    return log.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def hospital_config(spark, d, cfg):
    """``cfg`` with the hot cases of the hospital log, from a sample of its exports."""
    events = h.sampled_events(hospital_bronze(spark, d), 1.0 if cfg.skew.mode == "all" else cfg.skew.sample_fraction)
    return el.with_hot_cases(events.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")), cfg, sampled=True)


@register("hospital_event_log", _SQL)
def hospital_event_log(spark, d):
    return hospital_log(spark, d)


# ---------------------------------------------------------------- analyses of the hospital log
def _on_hospital(key: str, src_log: str) -> str:
    """The oracle SQL of a registered query, re-pointed from ``src_log`` to the hospital log."""
    from flowlog.plans.oracle_sql import with_logs
    from flowlog.plans.registry import ORACLE

    sql = ORACLE[key]
    prefix = with_logs(src_log)
    assert sql.startswith(prefix), key
    return ("WITH " + _HOSPITAL_CTES + sql[len(prefix):]).replace(src_log, "log_h")


def _register_analyses() -> None:
    from flowlog.operators import conformance as cf, kpis as kp, network as sn, transitions as tr, \
        variants as mv
    from flowlog.plans.registry import AS_OF, CFG, NOISE

    analyses = {
        "hospital_bottleneck": ("mn_bottleneck", "log_a", lambda log, cfg: tr.bottlenecks(log, cfg)),
        "hospital_spectrum": ("mn_spectrum", "log_a", lambda log, cfg: tr.performance_spectrum(log, cfg)),
        "hospital_variants": ("mn_variants", "log_a", lambda log, cfg: mv.variants(log, cfg, as_of=AS_OF)),
        "hospital_handover_source": ("sn_handover_source", "log_b",
                                     lambda log, cfg: sn.handover_between_sources(log, cfg)),
        "hospital_subcontract_source": ("sn_subcontract_source", "log_b",
                                        lambda log, cfg: sn.subcontracting(log, cfg, actor="source", segment=None)),
        "hospital_conformance": ("cf_conformance_b", "log_b",
                                 lambda log, cfg: cf.conformance(log, cfg, noise_threshold=NOISE, scope="case")),
        "hospital_journey_kpis": ("el_journey_kpis", "log_b", lambda log, cfg: kp.journey_kpis(log, cfg)),
    }
    for name, (template, src, build) in analyses.items():
        register(name, _on_hospital(template, src))(
            (lambda b: lambda spark, d: b(hospital_log(spark, d), hospital_config(spark, d, CFG)))(build))


_register_analyses()


def _register_quality() -> None:
    from flowlog.plans.q_quality import _COV_ACT, _COV_CASE
    from flowlog.plans.registry import AS_OF

    sql = ("WITH " + _HOSPITAL_CTES + "\n" + _COV_ACT.format(as_of=AS_OF, log="log_h")
           + "\nUNION ALL\n" + _COV_CASE.format(as_of=AS_OF, log="log_h"))

    @register("hospital_data_quality", sql)
    def hospital_data_quality(spark, d):
        """The Gold data-quality table (coverage per source/activity and per case)."""
        return h.gold_data_quality(hospital_log(spark, d), AS_OF)


_register_quality()


def _register_chart() -> None:
    from flowlog.operators import transitions as tr
    from flowlog.plans.registry import CFG, ORACLE

    base = ORACLE["hospital_bottleneck"]
    assert base.rstrip().endswith("SELECT * FROM b")
    sql = base.rstrip()[:-len("SELECT * FROM b")] + (
        "SELECT *, from_activity || ' → ' || to_activity AS transition FROM b "
        "WHERE n >= 30 AND from_activity <> to_activity AND source = 'silver_movimentacoes'")

    @register("hospital_bottleneck_chart", sql)
    def hospital_bottleneck_chart(spark, d):
        """Chart data of one source: frequent non-self transitions ordered by median (MN4)."""
        table = tr.bottlenecks(hospital_log(spark, d), hospital_config(spark, d, CFG))
        return tr.bottleneck_report(table, min_support=30, source="silver_movimentacoes",
                                    order_by="median_min")


_register_chart()
