from flowlog.operators import conformance as cf, model as md
from flowlog.plans import sample_logs
from tests.conftest import SF001, make_log


def test_fitness_counts_start_and_end_steps(spark):
    # trap 21: a 3-event trace with one disallowed step -> 3/4
    train = make_log(spark, [(f"t{i}", a, f"2024-01-01 0{j}:00:00", "s", None)
                             for i in range(3) for j, a in enumerate("ABC", start=1)])
    model = md.filtered_model(md.dfg(md.edge_steps(train, scope="log")), 0.0)
    test = make_log(spark, [("x", "A", "2024-01-01 01:00:00", "s", None), ("x", "C", "2024-01-01 02:00:00", "s", None),
                            ("x", "B", "2024-01-01 03:00:00", "s", None)])
    r = cf.case_fitness(md.edge_steps(test, scope="log"), model).first()
    # steps: start->A ok, A->C no, C->B no, B->end no  => model trained on A,B,C only allows A->B, B->C
    assert (r.steps, r.disallowed) == (4, 3)
    test2 = make_log(spark, [("y", "A", "2024-01-01 01:00:00", "s", None), ("y", "B", "2024-01-01 02:00:00", "s", None),
                             ("y", "B", "2024-01-01 03:00:00", "s", None)])
    model2 = md.filtered_model(md.dfg(md.edge_steps(train.unionByName(test2.filter("timestamp < '2024-01-01 03:00:00'")), scope="log")), 0.0)
    r2 = cf.case_fitness(md.edge_steps(test2, scope="log"), model2).first()
    assert r2.fitness == 0.75


def test_dfg_sums_and_perfect_fitness(spark):
    log = sample_logs.session_log(spark, SF001)
    edges = md.edge_steps(log, scope="case")
    g = md.dfg(edges)
    total = sum(r.n_events for r in g.collect())
    assert total == log.count() + log.select("case_id").distinct().count()
    fit = cf.fitness(edges, md.filtered_model(g, 0.0)).first()
    assert fit.fitness == 1.0


def test_precision_reference_figures(spark):
    # figures from a prototype run of the same definition on log A at sf0.01
    log = sample_logs.session_log(spark, SF001)
    edges = md.edge_steps(log, scope="case", with_prefix=True)
    g = md.dfg(edges)
    p0 = cf.precision(edges, md.filtered_model(g, 0.0), digits=6).first().precision
    assert abs(p0 - 0.897001) < 1e-6
    m98 = md.filtered_model(g, 0.98)
    assert abs(cf.fitness(edges, m98, digits=5).first().fitness - 0.46116) < 1e-5
    assert abs(cf.precision(edges, m98, digits=6).first().precision - 0.985376) < 1e-6


def test_footprint_relations(spark):
    log = make_log(spark, [("c1", "A", "2024-01-01 01:00:00", "s", None), ("c1", "B", "2024-01-01 02:00:00", "s", None),
                           ("c2", "B", "2024-01-01 01:00:00", "s", None), ("c2", "A", "2024-01-01 02:00:00", "s", None),
                           ("c2", "C", "2024-01-01 03:00:00", "s", None)])
    fp = {(r.a, r.b): r.relation for r in md.footprint(md.dfg(md.edge_steps(log, scope="log"))).collect()}
    assert fp[("A", "B")] == "||" and fp[("A", "C")] == "->" and fp[("C", "A")] == "<-"


def test_eventually_follows(spark):
    log = make_log(spark, [("c1", "A", "2024-01-01 01:00:00", "s", None), ("c1", "B", "2024-01-01 02:00:00", "s", None),
                           ("c1", "A", "2024-01-01 03:00:00", "s", None)])
    ef = {(r.a, r.b): r.n_cases for r in md.eventually_follows(log, scope="log").collect()}
    assert ef == {("A", "B"): 1, ("B", "A"): 1, ("A", "A"): 1}
