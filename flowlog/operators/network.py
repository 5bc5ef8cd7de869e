"""Organisational networks: hand-over of work and subcontracting (SN1-SN5).

Weights follow van der Aalst, Reijers & Song (2005): hand-over
``n(a,b) / sum(|trace| - 1)``, subcontracting ``n(a,b) / sum(max(|trace| - 2, 0))``,
per segment; the raw count ``n`` is kept alongside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from flowlog.config import MiningConfig
from flowlog.functions import month_key
from flowlog.operators.eventlog import case_steps, mining_view


def handover_between_sources(log: DataFrame, cfg: MiningConfig = MiningConfig(),
                             attribute: str = "specialty", drop_null_keys: bool = True) -> DataFrame:
    """Source changes between consecutive events of a case (SN1).

    Counted by (previous source, source, month of the receiving event,
    receiving event's ``attribute``).
    """
    steps = case_steps(log, cfg, carry=("source",))
    t = steps.filter(F.col("_lag1").isNotNull() & (F.col("_lag1.source") != F.col("source")))
    if drop_null_keys:
        t = t.filter(F.col(attribute).isNotNull())
    return t.groupBy(F.col("_lag1.source").alias("prev_source"), "source",
                     month_key("timestamp").alias("month"), F.col(attribute).alias(attribute)) \
        .agg(F.count(F.lit(1)).alias("n"))


def subcontracting_between_sources(log: DataFrame, cfg: MiningConfig = MiningConfig(),
                                   attribute: str = "specialty",
                                   drop_null_keys: bool = True) -> DataFrame:
    """A -> B -> A source patterns, keyed by the middle event (SN3).

    Counted by (returning source, its month, middle source, middle ``attribute``).
    """
    steps = case_steps(log, cfg, carry=("source", attribute), lags=(1, 2))
    t = steps.filter((F.col("_lag2.source") == F.col("source"))
                     & (F.col("_lag1.source") != F.col("source")))
    if drop_null_keys:
        t = t.filter(F.col(f"_lag1.{attribute}").isNotNull())
    return t.groupBy("source", month_key("timestamp").alias("month"),
                     F.col("_lag1.source").alias("middle_source"),
                     F.col(f"_lag1.{attribute}").alias(f"middle_{attribute}")) \
        .agg(F.count(F.lit(1)).alias("n"))


def _actor_steps(log: DataFrame, cfg: MiningConfig, actor: str, segment: str | None,
                 lags: tuple[int, ...]) -> DataFrame:
    view = mining_view(log).filter(F.col(actor).isNotNull())
    seg = F.col(segment) if segment else F.lit("all")
    view = view.withColumn("segment", seg.cast("string"))
    return case_steps(view, cfg, by=("case_id", "segment"), carry=(actor,), lags=lags)


def handover(log: DataFrame, cfg: MiningConfig = MiningConfig(), actor: str = "specialty",
             segment: str | None = "source", digits: int = 6) -> DataFrame:
    """Hand-over of work between consecutive actors, A -> A included (SN2, resource level: OP3).

    Events without the actor are dropped first; with ``segment`` the traces
    are cut per segment value (events of that segment only).
    """
    steps = _actor_steps(log, cfg, actor, segment, (1,))
    pairs = steps.filter(F.col("_lag1").isNotNull()).groupBy(
        "segment", F.col(f"_lag1.{actor}").alias("a"), F.col(actor).alias("b")).agg(
        F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("segment"))
    return pairs.withColumn("weight", F.round(F.col("n") / total, digits))


def subcontracting(log: DataFrame, cfg: MiningConfig = MiningConfig(), actor: str = "specialty",
                   segment: str | None = "source", digits: int = 6) -> DataFrame:
    """A -> B -> A actor patterns, pair (A, B), A -> A -> A included (SN4, SN5).

    A segment without any pattern simply yields no rows.
    """
    steps = _actor_steps(log, cfg, actor, segment, (1, 2))
    triples = steps.filter(F.col("_lag2").isNotNull())
    pairs = triples.filter(F.col(f"_lag2.{actor}") == F.col(actor)).groupBy(
        "segment", F.col(actor).alias("a"), F.col(f"_lag1.{actor}").alias("b")).agg(
        F.count(F.lit(1)).alias("n"))
    if segment is None:
        # one segment: the total is a scalar subquery (a join on a literal would be a cross join)
        pairs = pairs.withColumn("_triples", triples.agg(F.count(F.lit(1))).scalar())
    else:
        totals = triples.groupBy("segment").agg(F.count(F.lit(1)).alias("_triples"))
        pairs = pairs.join(totals, "segment")
    return pairs.select(
        "segment", "a", "b", "n", F.round(F.col("n") / F.col("_triples"), digits).alias("weight"))
