"""Attributes as of a time, counts reported by writes and streams, replaced months, Bloom filter, numbered lines, mixed date shapes."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from flowlog.config import Rule
from flowlog.operators import eventlog as el, kpis, quality as dq, reports as rs
from flowlog.session import checkpoint_dir
from flowlog.sources.tables import register_table, replace_partitions
from tests.conftest import make_log, ts

RULES = [Rule("positive", "v > 0"), Rule("has_v", "v IS NOT NULL", "drop")]


def _path(spark, kind):
    return os.path.join(checkpoint_dir(spark), "t", kind, uuid.uuid4().hex)


def _local(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_attributes_as_of(spark):
    cases = spark.createDataFrame([("a", ts("2026-01-10 00:00")), ("b", ts("2026-01-10 00:00")), ("c", None), ("d", ts("2026-01-10 00:00")),
                                   ("e", ts("2026-01-10 00:00"))], "case_id string, _start timestamp_ntz")
    rows = [("a", "old", ts("2026-01-01 00:00")), ("a", "held", ts("2026-01-10 00:00")), ("a", "later", ts("2026-01-11 00:00")),
            ("b", "second", ts("2026-02-02 00:00")), ("b", "first", ts("2026-02-01 00:00")), ("b", "none", None),
            ("c", "x", ts("2026-01-01 00:00")), ("d", "y", ts("2026-01-01 00:00")), ("d", "x", ts("2026-01-01 00:00"))]
    attributes = spark.createDataFrame(rows, "case_id string, kind string, valid_from timestamp_ntz")
    got = {r.case_id: r.attrs and r.attrs.kind for r in kpis.attributes_as_of(cases, attributes).collect()}
    assert got == {"a": "held", "b": "first", "c": "x", "d": "x", "e": None}


def test_write_counts_its_expectations_in_one_scan(spark):
    source = _path(spark, "source")
    spark.createDataFrame([(1,), (0,), (None,)], "v int").write.parquet(source)
    df = spark.read.parquet(source)
    out = _path(spark, "out")
    spark.sparkContext.setJobGroup("observed", "observed")
    got = {(r.rule, r.action): (r.total, r.failed) for r in dq.write_observed(df, RULES, out, "t").collect()}
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("observed"))
    spark.sparkContext.setJobGroup("", "")
    assert got == {("positive", "warn"): (3, 2), ("has_v", "drop"): (3, 1), ("written", "audit"): (2, 1)}
    assert jobs <= 2 and spark.read.parquet(out).count() == 2     # the write, and the collected metrics
    wanted = {(r.rule, r.action): (r.total, r.failed) for r in dq.expectation_metrics(df, "t", RULES).collect()}
    assert wanted.items() <= got.items()


def test_streams_report_their_expectations(spark):
    land, out = _path(spark, "land"), _path(spark, "stream")
    for i in range(3):
        spark.createDataFrame([(i,), (-i,), (None,)], "v int").coalesce(1).write.mode("append").parquet(land)
    listener = dq.StreamExpectations()
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("v int").option("maxFilesPerTrigger", 1).parquet(land)
        query = (listener.observed(stream, RULES, "v").writeStream.format("parquet").option("path", out)
                 .option("checkpointLocation", out + "-ck").trigger(availableNow=True).start())
        query.awaitTermination()
        spark._jsc.sc().listenerBus().waitUntilEmpty()
        __import__("time").sleep(2)
        got = {r.rule: (r.total, r.failed) for r in listener.metrics(spark).collect()}
    finally:
        spark.streams.removeListener(listener)
    assert got == {"positive": (9, 7), "has_v": (9, 3)} and spark.read.parquet(out).count() == 6


def test_a_month_is_replaced_alone(spark):
    path = _path(spark, "months")
    rows = spark.createDataFrame([("2026-01", 1), ("2026-01", 2), ("2026-02", 3)], "month string, v int")
    replace_partitions(rows, path, ["month"])
    before = {d: sorted(os.listdir(os.path.join(_local(path), d))) for d in ("month=2026-01", "month=2026-02")}
    replace_partitions(spark.createDataFrame([("2026-02", 7), ("2026-03", 8)], "month string, v int"), path, ["month"])
    after = {d: sorted(os.listdir(os.path.join(_local(path), d))) for d in before}
    assert after["month=2026-01"] == before["month=2026-01"] and after["month=2026-02"] != before["month=2026-02"]
    name = f"months_{uuid.uuid4().hex}"
    assert sorted(tuple(r) for r in register_table(spark, name, path).select("month", "v").collect()) == [
        ("2026-01", 1), ("2026-01", 2), ("2026-02", 7), ("2026-03", 8)]
    replace_partitions(spark.createDataFrame([("2026-04", 9)], "month string, v int"), path, ["month"])
    assert register_table(spark, name, path).count() == 5


def test_case_filter_keeps_whole_cases_behind_its_bloom_filter(spark):
    rows = [(f"c{i}", "A", "2026-01-01 00:00:00", "s1" if i % 9 == 0 and k == 0 else "s2", None) for i in range(200) for k in range(3)]
    log = make_log(spark, rows + [(None, "A", "2026-01-01 00:00:00", "s1", None)])
    kept = el.filter_cases(log, F.col("source") == "s1", bloom_bits=10)
    assert {r.case_id for r in kept.collect()} == {f"c{i}" for i in range(0, 200, 9)} and kept.count() == 3 * 23
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "LeftSemi" in plan
    words = log.withColumn("_w", el.bloom_words(log.where("source = 's1' and case_id is not null").select("case_id").distinct(), "case_id", 10))
    passed = words.where(el.in_bloom(F.col("_w"), F.col("case_id"), 10)).select("case_id").distinct().count()
    assert 23 <= passed < 100
    assert el.filter_cases(log, F.lit(False)).count() == 0


def test_lines_are_numbered_across_splits(spark):
    path = _path(spark, "lines")
    os.makedirs(_local(path))
    for name, n in (("a.txt", 5000), ("b.txt", 3)):
        with open(os.path.join(_local(path), name), "w") as fh:
            fh.write("".join(f"{i};x{i}\n" for i in range(1, n + 1)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = rs.read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 1
        got = [(os.path.basename(r.file), r.row_no, r.value) for r in lines.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 5003 and all(v == f"{n};x{n}" for _, n, v in got) and {f for f, _, _ in got} == {"a.txt", "b.txt"}
    cells = rs.split_cells(spark.createDataFrame([("a;;c",), ("x",)], "value string"), 3).collect()
    assert [tuple(r) for r in cells] == [("a", None, "c"), ("x", None, None)]


def test_mixed_date_shapes(spark):
    at = dt.datetime(2026, 3, 5, 16, 7, 8)
    day = dt.datetime(2026, 3, 5)
    want = {"3/5/2026 4:07:08 PM": at, "03/05/2026 16:07:08": at, "2026-03-05 16:07:08": at, "2026-03-05T16:07:08": at, "2026/3/5 16:07:08": at,
            "20260305 16:07:08": at, "05-Mar-2026 16:07:08": at, "Mar 5, 2026 4:07:08 pm": at, "5 MAR 2026": day, "3/5/26": day, "3.5.2026": day,
            "3-5-2026 4:07 PM": at.replace(second=0), "3/5/2026 4 PM": at.replace(minute=0, second=0), "25/3/2026 00:00": dt.datetime(2026, 3, 25),
            "2026-03-05 16:07:08.25": at.replace(microsecond=250000), " 3/5/2026 ": day, "3/5/2026 4:07PM": at.replace(second=0),
            "13/13/2026": None, "soon": None, "": None, None: None, "2026-02-30": None, "5th of March": None}
    df = spark.createDataFrame([(i, c) for i, c in enumerate(want)], "i int, c string")
    got = {r.i: r.t for r in df.select("i", rs.mixed_timestamp(F.col("c")).cast("timestamp_ntz").alias("t")).collect()}
    assert {c: got[i] for i, c in enumerate(want)} == want
    masks = {r["mask"]: r["rows"] for r in rs.unknown_masks(df, "c").collect()}
    assert masks["AAAA"] == 1 and masks["9/9/9999"] == 1 and sum(masks.values()) == 5
