"""Hot cases of the hospital log from its exports, lighter deduplication, one pass of conformance, parsing by cast."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowlog.config import MiningConfig, SkewConfig
from flowlog.functions import parse_timestamp
from flowlog.operators import cleanse, conformance as cf, eventlog as el
from flowlog.plans.registry import QUERIES
from flowlog.plans import hospital as h, q_hospital as qh

from tests.conftest import make_log

SMOKE = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().treeString()


def _scans(df) -> int:
    return sum("Relation [l_orderkey" in line for line in _plan(df).splitlines())


def _orders_and_lines(spark, folder, lines):
    """lines: rows of one order's line items (return flag, line status, ship date)."""
    o = [(1, 7, "O", dt.datetime(2026, 3, 1), "HIGH"), (2, 8, "F", dt.datetime(2026, 3, 2), "LOW")]
    spark.createDataFrame(o, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string") \
        .write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(1, *x) for x in lines], "l_orderkey long, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz") \
        .write.parquet(f"{folder}/lineitem.parquet")


def test_hospital_analyses_build_the_log_once_without_hot_cases(spark):
    assert _scans(QUERIES["hospital_handover_source"](spark, SMOKE)) == 2        # the two exports read the line items
    assert _scans(QUERIES["hospital_subcontract_source"](spark, SMOKE)) == 4     # its total is a scalar of its own


def test_hot_case_is_found_in_the_exports(spark, tmp_path):
    days = [dt.datetime(2026, 3, 1) + dt.timedelta(days=i) for i in range(300)]
    _orders_and_lines(spark, str(tmp_path), [(f, "O", d) for d in days for f in "RA"])
    forced = MiningConfig(skew=SkewConfig(hot_rows=200, sample_fraction=1.0, bucket_rows=50))
    hot = qh.hospital_config(spark, str(tmp_path), forced)
    assert [r.case_id for r in hot.hot_cases.collect()] == ["1"]
    cold = qh.hospital_config(spark, str(tmp_path), MiningConfig())
    assert cold.hot_cases is None and cold.skew.mode == "off"
    from flowlog.operators import network as sn, transitions as tr
    log = qh.hospital_log(spark, str(tmp_path))
    for run in (lambda c: tr.bottlenecks(log, c), lambda c: sn.handover_between_sources(log, c),
                lambda c: sn.subcontracting(log, c, actor="source", segment=None), lambda c: cf.conformance(log, c, noise_threshold=0.2)):
        assert sorted(map(str, run(hot).collect())) == sorted(map(str, run(cold).collect()))


def test_no_sample_where_every_export_keeps_one_row_a_case(spark):
    assert h.sampled_events({"silver_internacoes": qh.bronze_inpatient(spark, SMOKE)}, 1.0) is None


def test_model_and_score_read_one_shuffle_of_the_steps(spark):
    rows = [("c1", "a", "2026-03-01 10:00:00", "s", "x"), ("c1", "b", "2026-03-01 11:00:00", "s", "x"), ("c2", "a", "2026-04-01 10:00:00", "t", "y")]
    table = cf.conformance(make_log(spark, rows), MiningConfig(skew=SkewConfig(mode="off")))
    table.collect()
    assert "ReusedExchange" in table._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("ascending", [True, False])
def test_keep_one_orders_by_what_may_differ_only(spark, ascending):
    rows = [("k", 1, "b", "z"), ("k", 1, "a", "y"), ("k", None, "a", "x"), (None, 2, None, "w"), (None, 2, "q", "v"), ("m", 3, None, None)]
    df = spark.createDataFrame(rows, "k string, n int, t string, u string").withColumn("fixed", F.lit("f"))
    got = {(r.k, r.n, r.t, r.u, r.fixed) for r in cleanse.keep_one(df, ["k"], "n", ascending).collect()}
    assert got == {("k", 1, "a", "y", "f"), (None, 2, "q", "v", "f"), ("m", 3, None, None, "f")}
    by_key = cleanse.keep_one(df, ["k", "n"], "n", ascending)
    assert {(r.k, r.n, r.t, r.u) for r in by_key.collect()} == {("k", 1, "a", "y"), ("k", None, "a", "x"), (None, 2, "q", "v"), ("m", 3, None, None)}
    row = next(line for line in _plan(by_key).splitlines() if "min(struct" in line)
    assert "isnull(n" not in row and "isnull(fixed" not in row
    assert cleanse.keep_one(df.select("k", "n"), ["k", "n"], "n", ascending).count() == 4


def test_silver_shuffles_no_column_that_cannot_matter(spark):
    cols = "ATEND string, HORA string, TIPO string, UNIDADE string, DATA string, _rescued_data string, _source_file string"
    rows = [("1", "08:00:00", "A", u, "2026-03-01", r, f) for u, r, f in (("U2", None, "a"), ("U1", "x", "b"), ("U1", None, "c"))]
    silver = h.build_silver(spark.createDataFrame(rows, cols), h.SILVER["silver_movimentacoes"])
    assert [(r.CD_INTERNACAO, r.TIPO, r.UNIDADE) for r in silver.collect()] == [("1", "A", "U1")]
    assert silver.columns == ["CD_INTERNACAO", "TIPO", "UNIDADE", "DT_HR_MOVIMENTACAO"]
    row = next(line for line in _plan(silver).splitlines() if "min(struct" in line)
    assert "_source_file" not in row and "_rescued_data" not in row and "DATA" not in row


def test_flags_follow_the_row_that_stays(spark):
    cols = "ATENDIMENTO string, DT_HR_ATENDIMENTO string, DT_HR_ALTA string, IDADE string, CD_ORIGEM string, CD_LEITO string, _source_file string"
    rows = [("1", "2026-03-02 00:00:00", "2026-03-01 00:00:00", "4", "1", "L", "a"), ("1", "2026-03-01 00:00:00", "2026-03-05 00:00:00", "4", "1", "L", "b"),
            ("2", "2026-03-02 00:00:00", None, "4", "1", "L", "a"), ("3", "2026-03-02 00:00:00", "2026-03-01 00:00:00", "4", "1", "L", "a")]
    silver = h.build_silver(spark.createDataFrame(rows, cols), h.SILVER["silver_internacoes"])
    assert silver.columns[-1] == "flag_atendimento_alta"
    assert {r.CD_INTERNACAO: r.flag_atendimento_alta for r in silver.collect()} == {"1": True, "2": None, "3": False}


def test_cast_layout_reads_what_the_parser_reads(spark):
    texts = ["2026-03-01 10:11:12", "2026-02-30 00:00:00", "2024-02-29 23:59:59", "0000-01-01 00:00:00", "0001-01-01 00:00:00", "2026-3-1 1:2:3",
             "2026-03-01", "2026-03-01T10:11:12", "2026-03-01 24:00:00", "2026-03-01 23:59:60", " 2026-03-01 10:11:12", "2026-03-01 10:11:12\n",
             "2026-03-01 10:11:12.5", "2026-03-01 10:11:12Z", "//", "", None, "12026-03-01 10:11:12", "+12026-03-01 10:11:12", "1582-10-10 00:00:00"]
    fmt = "yyyy-MM-dd HH:mm:ss"
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    got = df.select("i", "x", F.unix_micros(parse_timestamp("x", fmt)).alias("a"), F.unix_micros(F.try_to_timestamp("x", F.lit(fmt))).alias("b")).collect()
    assert [(r.x, r.a) for r in got] == [(r.x, r.b) for r in got]
    assert "cast" in _plan(df.select(parse_timestamp("x", fmt).alias("t"))).lower()
