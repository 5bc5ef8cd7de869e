import pyspark.sql.functions as F

from flowlog.config import Rule
from flowlog.operators import cleanse, quality as dq
from tests.conftest import make_log, ts


def test_keep_one_is_input_order_independent(spark):
    # trap 4: same key, same order value, different payload -> same survivor after shuffling
    rows = [("k", ts("2024-01-01 00:00:00"), p) for p in ("z", "a", "m")]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, p string")
    a = cleanse.keep_one(df, ["k"], "t").first().p
    b = cleanse.keep_one(df.repartition(3).orderBy(F.rand(7)), ["k"], "t").first().p
    assert a == b == "a"


def test_keep_one_nulls_last_both_directions(spark):
    # trap 5
    df = spark.createDataFrame([("k", None, "n"), ("k", ts("2024-01-01 00:00:00"), "x"),
                                ("k", ts("2024-02-01 00:00:00"), "y")], "k string, t timestamp_ntz, p string")
    assert cleanse.keep_one(df, ["k"], "t", ascending=True).first().p == "x"
    assert cleanse.keep_one(df, ["k"], "t", ascending=False).first().p == "y"


def test_keep_one_null_key_is_one_group(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b")], "k string, o int, p string")
    assert cleanse.keep_one(df, ["k"], "o").count() == 1


def test_case_coverage_uses_min_indicator(spark):
    # trap 7: {null, t} is a case with timestamp; {null} is without
    log = make_log(spark, [("c1", "A", None, "s", None), ("c1", "B", "2024-01-01 00:00:00", "s", None),
                           ("c2", "A", None, "s", None)])
    r = dq.case_coverage(log, "2026-03-31").first()
    assert (r.total, r.with_timestamp, r.without_timestamp, r.coverage_pct) == (2, 1, 1, 50.0)


def test_activity_coverage_and_loss_audit(spark):
    log = make_log(spark, [("c1", "A", None, "s", None), ("c1", "A", "2024-01-01 00:00:00", "s", None),
                           (None, "B", "2024-01-01 00:00:00", "s", None)])
    rows = {r.activity: r for r in dq.activity_coverage(log, "2026-03-31").collect()}
    assert rows["A"].coverage_pct == 50.0 and rows["B"].coverage_pct == 100.0
    audit = dq.loss_audit(log).first()
    assert (audit.events, audit.null_case, audit.null_timestamp, audit.kept) == (3, 1, 1, 1)


def test_expectations_warn_and_drop(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 3)], "a int, b int")
    rules = [Rule("a_present", "a IS NOT NULL", "drop"), Rule("b_gt_1", "b > 1", "warn")]
    m = {r.rule: r.failed for r in dq.expectation_metrics(df, "t", rules).collect()}
    assert m == {"a_present": 1, "b_gt_1": 1}  # null predicate counts as failed
    kept, obs = dq.observe_expectations(df, rules)
    assert kept.count() == 2
    assert obs.get["a_present"] == 1 and obs.get["total"] == 3


def test_column_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, `b c` string")
    got = {r.column: r.share for r in dq.column_profile(df, "t").collect()}
    assert got == {"a": 1.0, "b c": 0.5}


def test_cast_columns_skips_absent_and_never_throws(spark):
    df = spark.createDataFrame([("2026-03-01 10:00:00", "05/03/2026", "12", "x"),
                                ("//", "", "12.0", "y")], "t string, d string, i string, other string")
    out = cleanse.cast_columns(df, timestamps=["t", "missing"], dates=["d"], ints=["i"],
                               date_format="dd/MM/yyyy").collect()
    assert out[0].i == 12 and out[1].i is None and out[1].t is None and out[1].d is None
    assert str(out[0].d) == "2026-03-05"


def test_cut_lineage_writes_to_the_checkpoint_folder(spark):
    import uuid

    from flowlog.session import checkpoint_dir, cut_lineage
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    name = f"t_{uuid.uuid4().hex}"
    back = cut_lineage(df, name)
    assert sorted(r.x for r in back.collect()) == [0, 2, 4, 6, 8]
    assert checkpoint_dir(spark) in back.inputFiles()[0].replace("file:", "")
    assert cut_lineage(df).count() == 5
