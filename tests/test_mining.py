from flowlog.operators import network as sn, transitions as tr, variants as mv
from tests.conftest import make_log


def test_variant_length_counts_repeats_and_ties_rank_by_sequence(spark):
    # traps 11 and 12
    log = make_log(spark, [("c1", "A", "2024-01-01 01:00:00", "s", None), ("c1", "B", "2024-01-01 02:00:00", "s", None),
                           ("c1", "A", "2024-01-01 03:00:00", "s", None),
                           ("c2", "B", "2024-01-01 01:00:00", "s", None),
                           ("c3", "A", "2024-01-01 01:00:00", "s", None)])
    v = {r.sequence: r for r in mv.variants(log, as_of="2026-03-31").collect()}
    assert v["A → B → A"].n_events == 3
    assert v["A"].rank == 1 and v["A → B → A"].rank == 2 and v["B"].rank == 3
    assert abs(sum(r.n_cases for r in v.values()) - 3) == 0
    p = {r.rank: r.cum_cases for r in mv.variant_pareto(mv.variants(log, as_of="2026-03-31")).collect()}
    assert p == {1: 1, 2: 2, 3: 3}


def test_bottleneck_stats_nulls(spark):
    # traps 13 and 14
    log = make_log(spark, [("c1", "A", "2024-01-01 01:00:00", "s", None), ("c1", "B", "2024-01-01 01:00:00", "s", None),
                           ("c2", "A", "2024-01-01 01:00:00", "s", None), ("c2", "B", "2024-01-01 01:00:00", "s", None),
                           ("c3", "X", "2024-01-01 01:00:00", "s", None), ("c3", "Y", "2024-01-01 02:00:00", "s", None)])
    b = {(r.from_activity, r.to_activity): r for r in tr.bottlenecks(log).collect()}
    assert b[("A", "B")].mean_min == 0.0 and b[("A", "B")].cv_pct is None
    assert b[("X", "Y")].std_min is None and b[("X", "Y")].cv_pct is None


def test_scopes_and_month_attribution(spark):
    # traps 15 and 16
    log = make_log(spark, [("c1", "A", "2024-01-31 23:50:00", "s1", None),
                           ("c1", "B", "2024-02-01 00:00:00", "s2", None),
                           ("c1", "C", "2024-02-01 00:10:00", "s1", None)])
    b = {(r.source, r.from_activity, r.to_activity): r.month for r in tr.bottlenecks(log).collect()}
    assert b == {("s1", "A", "C"): "2024-02"}
    s = {(r.activity, r.next_activity): r.month for r in tr.performance_spectrum(log).collect()}
    assert s == {("A", "B"): "2024-01", ("B", "C"): "2024-02"}


def test_handover_null_specialty_dropped(spark):
    # trap 17
    log = make_log(spark, [("c1", "A", "2024-01-01 01:00:00", "s1", "x"), ("c1", "B", "2024-01-01 02:00:00", "s2", None),
                           ("c2", "A", "2024-01-01 01:00:00", "s1", "x"), ("c2", "B", "2024-01-01 02:00:00", "s2", "y")])
    assert sn.handover_between_sources(log).count() == 1
    assert sn.handover_between_sources(log, drop_null_keys=False).count() == 2


def test_subcontracting_source_patterns(spark):
    # trap 18: s1,s2,s1 counts in SN3 and SN5; s1,s1,s1 only in SN5
    log = make_log(spark, [("c1", "A", "2024-01-01 01:00:00", "s1", "x"), ("c1", "B", "2024-01-01 02:00:00", "s2", "y"),
                           ("c1", "C", "2024-01-01 03:00:00", "s1", "x"),
                           ("c2", "A", "2024-01-01 01:00:00", "s1", "x"), ("c2", "B", "2024-01-01 02:00:00", "s1", "x"),
                           ("c2", "C", "2024-01-01 03:00:00", "s1", "x")])
    assert sn.subcontracting_between_sources(log).count() == 1
    s5 = {(r.a, r.b): (r.n, r.weight) for r in sn.subcontracting(log, actor="source", segment=None).collect()}
    assert s5 == {("s1", "s2"): (1, 0.5), ("s1", "s1"): (1, 0.5)}


def test_subcontracting_without_pattern_is_empty(spark):
    # trap 19
    log = make_log(spark, [("c1", "A", "2024-01-01 01:00:00", "s1", "x"), ("c1", "B", "2024-01-01 02:00:00", "s1", "y")])
    assert sn.subcontracting(log).count() == 0


def test_handover_weights(spark):
    log = make_log(spark, [("c1", "A", "2024-01-01 01:00:00", "s1", "x"), ("c1", "B", "2024-01-01 02:00:00", "s1", "x"),
                           ("c1", "C", "2024-01-01 03:00:00", "s1", "y")])
    h = {(r.a, r.b): r.weight for r in sn.handover(log).collect()}
    assert h == {("x", "x"): 0.5, ("x", "y"): 0.5}
