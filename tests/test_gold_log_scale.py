"""The Gold log moves Silver rows, not events, and its duration costs nothing where it is not read."""

import datetime as dt

from flowlog.operators import eventlog as el
from flowlog.plans import hospital as h, q_hospital as qh

SMOKE = "/root/testdata/sf0.001"


def _silver(spark):
    t = [dt.datetime(2026, 3, 1, 8, m) for m in range(4)]
    moves = spark.createDataFrame(
        [("1", t[0], "A", "u"), ("1", t[0], "A", "u"), (None, t[1], "B", None), ("", t[3], None, "v"), ("2", None, "A", "u")],
        "CD_INTERNACAO string, DT_HR_MOVIMENTACAO timestamp, TIPO string, UNIDADE string")
    stays = spark.createDataFrame(
        [("1", t[1], t[3], "s", "p", "u"), (None, t[0], None, None, "p", None), (None, t[3], t[3], "s", None, "u"), ("3", None, None, "s", "p", "u")],
        "CD_INTERNACAO string, DT_HR_ATENDIMENTO timestamp, DT_HR_ALTA timestamp, ESPECIALID_ATEND string, PRESTADOR string, UNIDADE string")
    return {"silver_movimentacoes": moves, "silver_internacoes": stays}


def test_gold_log_equals_events_with_their_durations(spark):
    silver = _silver(spark)
    got = h.gold_event_log(silver)
    plain = el.with_case_duration(el.union_logs([el.to_events(silver[n], s) for n, s in h.gold_sources().items() if n in silver]))
    assert got.columns == plain.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    spans = {r["case_id"]: r["duration_minutes"] for r in got.collect()}
    assert spans == {"1": 3, None: 3, "": 0, "2": None, "3": None}       # null ids are one case, apart from ''


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_duration_is_joined_before_events_are_spread(spark):
    plan = _plan(qh.hospital_log(spark, SMOKE))
    assert plan.index("Generate posexplode") < plan.index("Join LeftOuter")


def test_duration_that_nothing_reads_is_not_joined(spark):
    log = h.gold_event_log(_silver(spark))
    assert "Join" in _plan(log)
    assert "Join" not in _plan(log.select("case_id", "activity", "timestamp"))
