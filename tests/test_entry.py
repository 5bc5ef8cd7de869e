import pyspark.sql.functions as F

import __spark_entry__ as entry
from flowlog.operators import conformance as cf, model as md, transitions as tr, variants as mv
from flowlog.plans import sample_logs
from tests.conftest import SF001


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["source", "month", "from_activity", "to_activity", "mean_min", "median_min",
                          "std_min", "n", "cv_pct"]


def test_every_oracle_key_is_a_query():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60


def _shuffled(df):
    return df.repartition(7).orderBy(F.rand(11))


def test_results_do_not_depend_on_input_order(spark):
    log = sample_logs.order_log(spark, SF001)
    shuffled = _shuffled(log)
    for build in (lambda l: tr.bottlenecks(l), lambda l: mv.variants(l, as_of="2026-03-31"),
                  lambda l: md.dfg(md.edge_steps(l)),
                  lambda l: cf.conformance(l, noise_threshold=0.2)):
        a, b = build(log), build(shuffled)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
