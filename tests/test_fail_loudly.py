"""Wrong or missing inputs are errors, and ids, numbers and null positions are kept apart."""

import os
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from flowlog.config import SkewConfig
from flowlog.functions.hashing import id_text
from flowlog.operators.reports import numeric_key_rows
from flowlog.operators.sequence import forward_fill
from flowlog.plans import hospital as h, pipeline
from flowlog.session import checkpoint_dir
from flowlog.streaming.ingest import IngestSource, ingest_to_bronze


def test_distinct_ids_keep_distinct_text(spark):
    ids = ["9007199254740993", "9007199254740992", "0012", "12", "12d", "12f", "1e3", "1000", "-5", "a.0"]
    out = [r.t for r in spark.createDataFrame([(i,) for i in ids], "c string").select(id_text("c").alias("t")).collect()]
    assert out == ids
    same = spark.createDataFrame([("123",), ("123.0",), ("123.00",)], "c string").select(id_text("c").alias("t")).distinct().collect()
    assert [r.t for r in same] == ["123"]
    floats = spark.createDataFrame([(1.0e7,), (123.0,), (12.5,)], "c double").select(id_text("c").alias("t")).collect()
    assert [r.t for r in floats] == ["10000000", "123", "12.5"]


def test_numeric_keys_only(spark):
    rows = ["12", " 12.5 ", "1e3", "-4", ".5", "12d", "12D", "12f", "NaN", "total", "", None]
    df = spark.createDataFrame([(r,) for r in rows], "k string")
    assert [r.k for r in numeric_key_rows(df, "k").collect()] == rows[:5]


@pytest.mark.parametrize("mode", ["off", "detect", "all"])
def test_forward_fill_null_positions(spark, mode):
    df = spark.createDataFrame([(1, 1, None), (1, 3, None), (1, 2, "b"), (1, None, "z"), (1, None, None)], "k int, t int, v string")
    skew = SkewConfig(mode=mode, hot_rows=2, bucket_rows=1, sample_fraction=1.0)
    got = forward_fill(df, ["k"], ["t"], {"f": F.col("v")}, skew=skew)
    assert {r.t: r.f for r in got.where("t is not null").collect()} == {1: None, 2: "b", 3: "b"}


def test_missing_inputs_raise(spark):
    root = os.path.join(checkpoint_dir(spark), "t", uuid.uuid4().hex)
    with pytest.raises(FileNotFoundError):
        h.ingest_hospital(spark, os.path.join(root, "landing"), os.path.join(root, "b"), os.path.join(root, "c"))
    with pytest.raises(pipeline.AbsentInput):
        pipeline.run(spark, {}, as_of="2026-03-31")
    assert pipeline.run(spark, {}, as_of="2026-03-31", skip_absent=True) == {}


def test_reordered_header_fails(spark):
    root = os.path.join(checkpoint_dir(spark), "t", uuid.uuid4().hex)
    land = os.path.join(root, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "a.csv"), "w") as f:
        f.write("B;A\n1;2\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        ingest_to_bronze(spark, IngestSource(folder=land, table="t", columns=("A", "B")), os.path.join(root, "b"), os.path.join(root, "c"))


def test_absent_export_column_is_an_error(spark):
    spec = h.SILVER["silver_internacoes"]
    names = ["ATENDIMENTO", "DT_HR_ATENDIMENTO", "DT_HR_ALTA", "IDADE"]
    short = spark.createDataFrame([("1", "2026-03-01 07:00:00", "2026-03-01 09:00:00", "40")], names)
    with pytest.raises(ValueError, match="CD_ORIGEM"):
        h.build_silver(short, spec)
    row = h.build_silver(short, replace(spec, optional=("CD_ORIGEM",))).collect()[0]
    assert (row.CD_INTERNACAO, row.IDADE, row.flag_atendimento_alta) == ("1", 40, True)
    with pytest.raises(ValueError, match="CD_INTERNACAO"):
        h.build_silver(short.drop("ATENDIMENTO"), spec)
