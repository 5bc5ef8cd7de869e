"""Disk that the XES export and the Gold log of all sources take."""

import glob
import gzip
import os
import uuid

from flowlog.config import LOG_COLUMNS
from flowlog.operators.eventlog import mining_view, with_case_duration
from flowlog.session import checkpoint_dir
from flowlog.sources import xes
from tests.conftest import make_log


def _root(spark):
    return os.path.join(checkpoint_dir(spark), "t", uuid.uuid4().hex)


def test_xes_parts_are_small_and_whole(spark, monkeypatch):
    # plain parts took thirty times the disk; a gzipped part is read by one task, so it may not grow with the log
    monkeypatch.setattr(xes, "TRACES_A_FILE", 7)
    log = with_case_duration(make_log(spark, [
        (f"c{i}", a, f"2024-0{1 + i % 2}-01 10:0{j}:00", "s\n1", None if i % 3 else "x<y", f"r{i}")
        for i in range(100) for j, a in enumerate("ABCDE")]))
    packed, plain = _root(spark), _root(spark)
    xes.export_xes(log, packed)
    xes.export_xes(log, plain, single_file=True)
    files = glob.glob(f"{packed}/month=*/part-*")
    assert files and all(f.endswith(".xml.gz") for f in files)
    texts = [gzip.open(f, "rt", encoding="utf-8").read() for f in files]
    assert all(t.count("<trace>") <= 7 and "<log " in t and t.rstrip().endswith("</log>") for t in texts)
    assert sum(t.count("<trace>") for t in texts) == 100
    assert sum(map(os.path.getsize, files)) * 3 < sum(len(t.encode()) for t in texts)
    want = sorted(map(str, mining_view(log).select(*LOG_COLUMNS).collect()))
    for path in (packed, plain):
        assert sorted(map(str, xes.read_xes(spark, path).collect())) == want


def test_xes_traces_are_sorted_by_month_before_they_are_blown_up(spark, monkeypatch):
    log = make_log(spark, [(f"c{i}", "A", f"2024-0{1 + i % 2}-01 10:00:00", "s", None) for i in range(9)])
    plans = []
    monkeypatch.setattr(type(log.write), "save", lambda self, path=None, **_: plans.append(self._df))
    xes.export_xes(log, "unused")
    plan = plans[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("lifecycle:transition") < plan.index("Sort [month")      # the later step is printed first
    assert plans[0].schema["month"].nullable is False       # else the writer sorts once more, by the blown-up rows


def _bronze(spark, name):
    """Rows with nulls, copies, ties and times that are minutes, seconds or days apart, for a Silver table of the log."""
    from flowlog.plans import hospital as h

    spec, events = h.SILVER[name], h.EVENT_SOURCES[name]
    raw = {new: old for old, new in spec.renames}
    columns = [c for c in spec.needed() if c not in (spec.dedup_order, *spec.dedup_keys, "NR")]
    columns = list(dict.fromkeys([*spec.dedup_keys, events.case_col, *columns, spec.dedup_order or "NR", "NR",
                                  events.specialty_col or "NR", events.location_col or "NR", events.resource_col or "NR",
                                  *[e.resource_col for e in events.events if e.resource_col], "TIPO_ATENDIMENTO"]))
    made = {out for out, *_ in (*spec.combine, *spec.derive)}
    glued = {c for fmt, names in spec.timestamps if fmt == h.BR_MINUTES for c in names}
    times = {c for _, names in spec.timestamps for c in names} | {s for _, s, _ in spec.derive}
    equal, day, hour = dict(spec.filters), {d for _, d, _, _ in spec.combine}, {t for _, _, t, _ in spec.combine}
    rows = []
    for i in range(60):
        def value(j, c):
            if c in equal:
                return equal[c]
            if c == events.case_col:
                return [None, "", "a", "b", "c"][i % 5]
            if c in spec.dedup_keys and c not in made:
                return str(i % 2)
            k = (i // 5) % 4 if c == spec.dedup_order else i // 2 + j
            if c in times or c in day:
                if k % 7 == 3:
                    return None if k % 2 else "//"
                seconds = k % 3 if i % 3 else 0
                if c in glued:
                    return f"{1 + k % 9:02}/03/20{10 + k % 3 if i % 4 else 26} 10:{k % 60:02}"
                when = f"20{10 + k % 3 if i % 4 else 26}-03-{1 + k % 9:02}"
                return when if c in day else f"{when} 10:{k % 60:02}:{seconds:02}"
            return f"1{k % 6}:00:00" if c in hour else str(k % 5) if c in spec.ints else f"{c}{k % 3}"
        rows.append(tuple(value(j, c) for j, c in enumerate(columns) if c not in made))
    names = [raw.get(c, c) for c in columns if c not in made]
    frame = spark.createDataFrame(rows + rows[::4], ", ".join(f"`{c}` string" for c in names)).repartition(3)
    return frame.selectExpr("*", "cast(null as string) _rescued_data", "'f' _source_file")


def test_gold_log_of_dealt_tables_is_the_same_and_moves_rows_once(spark):
    from flowlog.plans import hospital as h

    bronze = {n: _bronze(spark, n) for n in h.EVENT_SOURCES}
    assert not h.has_hot_cases(bronze)
    cases = {n: s.case_col for n, s in h.EVENT_SOURCES.items()}
    was = h.gold_event_log({n: h.build_silver(b, h.SILVER[n]) for n, b in bronze.items()})
    now = h.gold_event_log({n: h.build_silver(b, h.SILVER[n], cases[n]) for n, b in bronze.items()})
    assert now.columns == was.columns
    rows = sorted(map(str, now.collect()))
    assert rows == sorted(map(str, was.collect())) and now.select("source").distinct().count() == 7
    plan = now._jdf.queryExecution().executedPlan().toString()
    assert all("hashpartitioning(_case" in x for x in plan.split("\n") if "Exchange" in x and "RoundRobin" not in x and "REPARTITION_BY_NUM" not in x)
    # the join finds both sides in place: shuffles are below the unions only
    assert "Exchange" not in plan[:plan.index("Union")]


def test_packed_times_are_the_same_times(spark):
    from flowlog.operators import cleanse

    texts = [("2020-01-01 00:00:00", "2020-01-01 00:07:00", None), (None, None, None), (None, "1900-01-01 00:00:01", "2100-01-01 00:00:00"),
             ("2020-01-01 00:00:00.000001", "0001-01-01 00:00:00", "9999-12-31 23:59:59.999999"), ("2020-01-23 18:07:00", "2020-01-01 00:00:00", "2020-02-15 12:14:00"),
             ("2020-01-01 00:00:00", "2020-01-23 18:08:00", "2019-12-09 05:52:00")]
    df = spark.createDataFrame(texts, "a string, b string, c string").selectExpr(*[f"cast({c} as timestamp) {c}" for c in "abc"], "'k' k")
    back = cleanse.deal(df, "k")
    assert back.dtypes == df.dtypes
    text = [f"cast({c} as string)" for c in "abc"]
    assert sorted(map(str, back.selectExpr(*text).collect())) == sorted(map(str, df.selectExpr(*text).collect()))
    packed, _ = cleanse.pack_stamps(df, ["a", "b", "c"])
    kinds = sorted(r for r, in packed.selectExpr("case when _in60000000 is not null then 'm' when _in1000000 is not null then 's' else 'u' end").collect())
    assert kinds == ["m", "m", "m", "s", "u", "u"]


def test_hot_cases_keep_the_log_in_its_old_plan(spark):
    from flowlog.config import SkewConfig
    from flowlog.plans import hospital as h

    bronze = {"silver_movimentacoes": _bronze(spark, "silver_movimentacoes")}
    assert h.has_hot_cases(bronze, SkewConfig(hot_rows=15, sample_fraction=1.0))
    assert not h.has_hot_cases(bronze, SkewConfig(hot_rows=16, sample_fraction=1.0))
    assert h.has_hot_cases(bronze, SkewConfig(mode="all")) and not h.has_hot_cases(bronze, SkewConfig(mode="off"))
