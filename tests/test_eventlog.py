import pyspark.sql.functions as F

from flowlog.config import EventSpec, SourceSpec
from flowlog.operators import eventlog as el
from tests.conftest import make_log, ts


def _wide(spark):
    return spark.createDataFrame(
        [("c1", ts("2024-01-01 09:00:00"), None, ts("2024-01-01 09:01:59"), "dr", "spec")],
        "id string, t1 timestamp_ntz, t2 timestamp_ntz, t3 timestamp_ntz, who string, sp string")


def test_unpivot_keeps_null_timestamps_and_mining_drops_them(spark):
    # trap 8
    spec = SourceSpec(name="src", case_col="id", event_type="e", case_type="c", specialty_col="sp",
                      events=(EventSpec("t1", "A", "who"), EventSpec("t2", "B"), EventSpec("t3", "C")))
    log = el.to_events(_wide(spark), spec)
    assert log.count() == 3
    assert el.mining_view(log).count() == 2
    rows = {r.activity: r for r in log.collect()}
    assert rows["A"].resource == "dr" and rows["B"].resource is None and rows["C"].event_seq == 2


def test_case_duration_truncates_and_spans_sources(spark):
    # traps 9 and 10
    log = make_log(spark, [("c1", "A", "2024-01-01 09:00:00", "s1", None),
                           ("c1", "B", "2024-01-01 09:01:59", "s2", None),
                           ("c2", "A", None, "s1", None)])
    d = {(r.case_id, r.source): r.duration_minutes for r in el.with_case_duration(log).collect()}
    assert d[("c1", "s1")] == d[("c1", "s2")] == 1
    assert d[("c2", "s1")] is None


def test_case_filter_and_event_filter(spark):
    log = make_log(spark, [("c1", "A", "2024-01-01 00:00:00", "s1", "x"), ("c1", "B", "2024-01-02 00:00:00", "s2", None),
                           ("c2", "A", "2024-01-01 00:00:00", "s2", "y")])
    assert el.filter_cases(log, F.col("source") == "s1").count() == 2
    assert el.filter_events(log, "specialty").count() == 2
    assert el.filter_events(log, "specialty", ["y"]).count() == 1


def test_traces_and_stats(spark):
    log = make_log(spark, [("c1", "B", "2024-01-01 10:00:00", "s", None), ("c1", "A", "2024-01-01 09:00:00", "s", None),
                           ("c2", "A", "2024-01-01 09:00:00", "s", None), ("c2", "B", "2024-01-03 09:00:00", "s", None)])
    t = {r.case_id: [e.activity for e in r.events] for r in el.traces(log).collect()}
    assert t == {"c1": ["A", "B"], "c2": ["A", "B"]}
    s = el.log_stats(log).first()
    assert (s.n_events, s.n_cases, s.n_variants) == (4, 2, 1)


def test_case_attributes_typed_nulls(spark):
    a = spark.createDataFrame([("1", 5)], "case_id string, idade int")
    b = spark.createDataFrame([("2", "F")], "case_id string, sexo string")
    out = el.case_attributes([a, b], {"case_id": "string", "idade": "int", "sexo": "string"})
    assert dict(out.dtypes) == {"case_id": "string", "idade": "int", "sexo": "string"}
    assert out.count() == 2
