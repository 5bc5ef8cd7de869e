"""Exports of many parsed columns."""

import datetime as dt

from pyspark.sql import functions as F

from flowlog.functions import parse_timestamp
from flowlog.functions._util import apart
from flowlog.plans import q_exports as qe

SMOKE = "/root/testdata/sf0.001"


def test_wide_projections_stay_out_of_whole_stage_code(spark):
    text = qe.EXPORTS["silver_exames_imagem"].build(spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    parsing = [line for line in text.splitlines() if "gettimestamp" in line and "Project" in line]
    assert parsing and not any(line.lstrip(" :+-").startswith("*") for line in parsing)
    one = spark.range(1).select(apart(parse_timestamp(F.lit("2026-03-01 08:00:00"))).alias("t"),
                                apart(F.lit(None).cast("string")).alias("n")).first()
    assert (one["t"], one["n"]) == (dt.datetime(2026, 3, 1, 8), None)
