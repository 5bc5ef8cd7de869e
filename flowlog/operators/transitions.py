"""Transition times: bottlenecks, performance spectrum (MN3-MN6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowlog.config import MiningConfig
from flowlog.functions import minutes_between, month_key, weekday_label
from flowlog.operators.eventlog import case_steps
from flowlog.operators.quantiles import grouped_quantiles, join_on_keys


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def _with_quantiles(t: DataFrame, keys: list[str], value: str, quantiles: dict[str, float],
                    aggs: list[Column], cfg: MiningConfig) -> DataFrame:
    """Plain aggregates plus quantiles per group; exact quantiles stay bounded per task."""
    if cfg.approx:
        return t.groupBy(*keys).agg(*aggs, *[
            F.percentile_approx(value, q, cfg.accuracy).cast("double").alias(n) for n, q in quantiles.items()])
    base = t.groupBy(*keys).agg(*aggs)
    qs = grouped_quantiles(t, keys, value, quantiles)
    return join_on_keys(base, qs, keys, "left")


def bottlenecks(log: DataFrame, cfg: MiningConfig = MiningConfig(), digits: int | None = 4) -> DataFrame:
    """Waiting time between consecutive events of the same case *and source* (MN3).

    Grouped by (source, month of the later event, from, to): mean, median,
    sample std, count, and ``cv_pct = round(100 * std / mean, 1)``; one
    occurrence gives null std and cv, a zero mean gives null cv.
    """
    steps = case_steps(log, cfg, by=("case_id", "source"))
    t = steps.filter(F.col("_lag1").isNotNull()).select(
        "source",
        month_key("timestamp").alias("month"),
        F.col("_lag1.activity").alias("from_activity"),
        F.col("activity").alias("to_activity"),
        minutes_between(F.col("_lag1.timestamp"), F.col("timestamp")).alias("minutes"),
    )
    agg = _with_quantiles(
        t, ["source", "month", "from_activity", "to_activity"], "minutes", {"_median": 0.5},
        [F.avg("minutes").alias("_mean"), F.stddev_samp("minutes").alias("_std"),
         F.count(F.lit(1)).alias("n")], cfg)
    return agg.select(
        "source", "month", "from_activity", "to_activity",
        _round(F.col("_mean"), digits).alias("mean_min"),
        _round(F.col("_median"), digits).alias("median_min"),
        _round(F.col("_std"), digits).alias("std_min"),
        "n",
        F.round(F.try_divide(F.col("_std") * 100.0, F.col("_mean")), 1).alias("cv_pct"),
    )


def bottleneck_report(table: DataFrame, min_support: int = 30, source: str | None = None,
                      order_by: str = "mean_min") -> DataFrame:
    """Frequent, non-self transitions sorted by a time measure, slowest first (MN4),
    with a ``from → to`` label for charts (SC23)."""
    out = table.filter((F.col("n") >= min_support) & (F.col("from_activity") != F.col("to_activity")))
    out = out.withColumn("transition", F.concat_ws(" → ", "from_activity", "to_activity"))
    if source is not None:
        out = out.filter(F.col("source") == source)
    return out.orderBy(F.col(order_by).desc_nulls_last(), "source", "month",
                       "from_activity", "to_activity")


def with_time_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """``day``, ``weekday``, ``hour`` and ``month`` of a timestamp (MN6)."""
    return df.withColumns({
        "day": F.to_date(ts),
        "weekday": weekday_label(ts),
        "hour": F.hour(ts),
        "month": month_key(ts),
    })


def performance_spectrum(log: DataFrame, cfg: MiningConfig = MiningConfig(),
                         digits: int | None = 4) -> DataFrame:
    """Time to the next event of the case, across sources (MN5).

    Grouped by (activity, next activity, month and weekday of the *earlier*
    event): count, median, P25 and P75 (exact, linear interpolation, or
    ``percentile_approx`` with ``cfg.approx``).  Negative gaps are dropped.
    """
    steps = case_steps(log, cfg, leads=(1,), lags=())
    t = steps.filter(F.col("_lead1").isNotNull()).select(
        "activity",
        F.col("_lead1.activity").alias("next_activity"),
        month_key("timestamp").alias("month"),
        weekday_label("timestamp").alias("weekday"),
        minutes_between(F.col("timestamp"), F.col("_lead1.timestamp")).alias("minutes"),
    ).filter(F.col("minutes") >= 0)
    agg = _with_quantiles(
        t, ["activity", "next_activity", "month", "weekday"], "minutes",
        {"_median": 0.5, "_p25": 0.25, "_p75": 0.75}, [F.count(F.lit(1)).alias("n")], cfg)
    return agg.select("activity", "next_activity", "month", "weekday", "n",
                      _round(F.col("_median"), digits).alias("median_min"),
                      _round(F.col("_p25"), digits).alias("p25_min"),
                      _round(F.col("_p75"), digits).alias("p75_min"))
