import random

import pyspark.sql.functions as F

from flowlog.operators.quantiles import grouped_quantiles

QS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p100": 1.0}


def test_quantiles_equal_percentile_aggregate(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([1.0, 2.0, -2.0, 0.0, 3.5, 3.5000001, 1e300, -1e-9, None, float(i), -float(i)])) for i in range(2000)]
    rows.append(("solo", 5.0))
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    exp = sorted(df.groupBy("k").agg(*[F.percentile("v", q).alias(n) for n, q in QS.items()])
                 .filter(F.col("p50").isNotNull()).collect(), key=str)
    assert sorted(grouped_quantiles(df, ["k"], "v", QS).collect(), key=str) == exp
