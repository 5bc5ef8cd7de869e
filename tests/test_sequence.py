import random

import pandas as pd
import pyspark.sql.functions as F

from flowlog.config import SkewConfig
from flowlog.operators.sequence import assign_buckets, forward_fill, range_rank, running, with_neighbors, with_prefix_xor
from tests.conftest import ts

MODES = [SkewConfig(mode="off"), SkewConfig(mode="all", bucket_rows=2),
         SkewConfig(mode="detect", sample_fraction=1.0, hot_rows=30, bucket_rows=4)]


def _data(spark, n=400, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 20)}"
        rows.append((k, ts(f"2024-01-{rnd.randint(1, 28):02d} {rnd.randint(0, 23):02d}:00:00"), i,
                     rnd.choice("ABCD")))
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, i long, a string"), rows


def _expected(rows):
    pdf = pd.DataFrame(rows, columns=["k", "t", "i", "a"]).sort_values(["k", "t", "i"])
    g = pdf.groupby("k")
    pdf["pos"] = g.cumcount() + 1
    pdf["cnt"] = g["a"].transform("size")
    pdf["lag1"] = g["a"].shift(1)
    pdf["lag2"] = g["a"].shift(2)
    pdf["lead1"] = g["a"].shift(-1)
    return {r.i: (r.pos, r.cnt, r.lag1, r.lag2, r.lead1) for r in pdf.itertuples()}


def test_neighbors_match_brute_force_in_every_skew_mode(spark):
    df, rows = _data(spark)
    exp = _expected(rows)
    for mode in MODES:
        out = with_neighbors(df, ["k"], ["t", "i"], ["a"], lags=(1, 2), leads=(1,), skew=mode)
        got = {r.i: (r._pos, r._cnt, r._lag1 and r._lag1.a, r._lag2 and r._lag2.a, r._lead1 and r._lead1.a)
               for r in out.collect()}
        norm = {i: tuple(None if (isinstance(x, float) and x != x) else x for x in v) for i, v in exp.items()}
        assert got == norm, mode


def test_prefix_xor_is_bucket_independent(spark):
    df, _ = _data(spark, n=200, seed=5)
    results = []
    for mode in MODES:
        s = with_neighbors(df, ["k"], ["t", "i"], ["a"], lags=(), skew=mode)
        s = with_prefix_xor(s, ["k"], ["t", "i"], {"x": F.xxhash64("a", "_pos")})
        results.append(sorted((r.i, r.x) for r in s.select("i", "x").collect()))
    assert results[0] == results[1] == results[2]


def test_forward_fill_across_buckets(spark):
    rows = [("u", ts(f"2024-01-0{d} 0{h}:00:00"), d * 10 + h, (float(d * 10 + h) if (d, h) in {(1, 1), (3, 2)} else None))
            for d in range(1, 6) for h in range(4)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, i long, v double")
    for mode in MODES:
        out = forward_fill(df, ["k"], ["t", "i"], {"f": F.col("v")}, skew=mode)
        got = {r.i: r.f for r in out.collect()}
        assert got[10] is None and got[11] == 11.0 and got[23] == 11.0 and got[31] == 11.0 and got[32] == 32.0 and got[53] == 32.0


def test_range_rank_dense_and_total(spark):
    df = spark.range(0, 5000).select((F.col("id") % 37).alias("g"), F.col("id"))
    ranked = range_rank(df.repartition(7), [("g", True), ("id", False)])
    got = [r.id for r in ranked.orderBy("rank").collect()]
    exp = [r.id for r in df.orderBy(F.col("g").desc(), F.col("id")).collect()]
    assert got == exp
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 5001))


def test_shared_hot_case_table_gives_same_results(spark):
    from flowlog.config import MiningConfig
    from flowlog.operators import eventlog as el, transitions as tr, variants as mv
    from flowlog.plans import sample_logs
    from tests.conftest import SF001

    log = sample_logs.session_log(spark, SF001)
    forced = MiningConfig(skew=SkewConfig(mode="detect", hot_rows=5, sample_fraction=1.0, bucket_rows=2))
    shared = el.with_hot_cases(log, forced)
    assert shared.hot_cases.count() > 0
    for build in (lambda c: tr.bottlenecks(log, c), lambda c: mv.variants(log, c, as_of="2026-03-31")):
        a, b = build(MiningConfig()), build(shared)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _largest_bucket(df, order, skew):
    d = assign_buckets(df, ["k"], order[0], skew, ties=order[1:])
    return d.groupBy("k", "_b").count().agg(F.max("count")).first()[0]


def test_bursty_hot_key_has_no_bucket_above_twice_the_target(spark):
    skew = SkewConfig(mode="detect", sample_fraction=1.0, hot_rows=1000, bucket_rows=500)
    # 99 % of the rows fall into one second, the rest over a year
    df = spark.range(50_000).select(F.lit("hot").alias("k"), F.col("id").alias("i"), F.timestamp_micros(
        F.when(F.col("id") % 100 > 0, F.pmod(F.xxhash64("id"), F.lit(1_000_000)))
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(31_536_000_000_000)))).alias("t"))
    assert _largest_bucket(df, ["t", "i"], skew) <= 1000


def test_one_timestamp_hot_key_is_split_at_any_grain(spark):
    skew = SkewConfig(mode="detect", sample_fraction=1.0, hot_rows=1000, bucket_rows=500)
    days = F.date_add(F.lit("2024-01-01").cast("date"), F.when(F.col("id") % 10 > 0, 3).otherwise((F.col("id") % 70).cast("int")))
    df = spark.range(20_000).select(F.lit("hot").alias("k"), days.alias("t"), F.floor(F.col("id") / 200).alias("i"))
    assert _largest_bucket(df, ["t", "i"], skew) <= 1000


def test_modes_agree_with_null_order_values_and_ties(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice(["h", "h", "x", None]), rnd.choice([None, 1.0, 1.0, 1.0, 2.0, 7.5, float(rnd.randint(0, 50))]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t double, i long")
    got = []
    for mode in [SkewConfig(mode="off"), SkewConfig(mode="all", bucket_rows=1),
                 SkewConfig(mode="detect", sample_fraction=1.0, hot_rows=50, bucket_rows=7)]:
        out = with_neighbors(df, ["k"], ["t", "i"], ["i"], lags=(1,), leads=(1,), skew=mode)
        got.append(sorted((r.i, r._pos, r._cnt, r._lag1 and r._lag1.i, r._lead1 and r._lead1.i) for r in out.collect()))
    assert got[0] == got[1] == got[2]


def test_range_rank_with_nulls_ties_of_one_count_and_few_rows(spark):
    rows = [(1, None), (1, "b"), (1, "a"), (2, "c"), (None, "d")]
    ranked = range_rank(spark.createDataFrame(rows, "n int, s string"), [("n", True), ("s", False)])
    assert [(r.n, r.s) for r in ranked.orderBy("rank").collect()] == [(2, "c"), (1, "a"), (1, "b"), (1, None), (None, "d")]
    assert range_rank(spark.createDataFrame([], "n int, s string"), [("n", True)]).count() == 0


def test_variants_are_built_without_a_job(spark):
    from flowlog.operators.variants import variant_pareto, variants
    from flowlog.plans.sample_logs import session_log

    log = session_log(spark, "/root/testdata/sf0.001")
    spark.sparkContext.setJobGroup("lazy", "lazy")
    variant_pareto(variants(log, as_of="2026-03-31"))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")) == []
    spark.sparkContext.setJobGroup("", "")


def test_running_aggregates_equal_plain_ones_in_every_mode(spark):
    rng = __import__("random").Random(4)
    rows = [(k, rng.randrange(6), i, rng.choice([None, rng.randrange(50)])) for i, k in enumerate("aab" * 40)]
    df = spark.createDataFrame(rows, "k string, t int, i int, v int")
    for mode in MODES:
        out = running(df.repartition(5), ["k"], ["t", "i"], {"m": ("max", F.col("v")), "s": ("sum", F.col("v"))}, skew=mode)
        got = {r.i: (r.m, r.s) for r in out.collect()}
        for k in "ab":
            seen = []
            for _, t, i, v in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])):
                seen += [v] if v is not None else []
                assert got[i] == (max(seen, default=None), sum(seen) if seen else None)
