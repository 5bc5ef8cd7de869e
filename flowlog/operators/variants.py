"""Variant analysis (MN1, MN2) and variant Pareto curve."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window, functions as F

from flowlog.config import MiningConfig
from flowlog.operators.eventlog import event_order, mining_view
from flowlog.operators.sequence import assign_buckets, range_rank

ARROW = " → "


def case_sequences(log: DataFrame, cfg: MiningConfig = MiningConfig()) -> DataFrame:
    """Per case: ``sequence`` (activities in order) and ``n_events``, in one pass over the log.

    Each (case, bucket) piece is a sorted ``collect_list`` (bounded by the
    hot-key threshold or the bucket size); pieces are joined in bucket order.
    """
    view = mining_view(log)
    order = event_order(view)
    pieces = (assign_buckets(view, ["case_id"], "timestamp", cfg.skew, hot=cfg.hot_cases,
                             ties=order[1:4])
              .groupBy("case_id", "_b")
              .agg(F.count(F.lit(1)).alias("_n"), F.array_join(F.transform(
                  F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in order], F.col("activity").alias("_a")))),
                  lambda x: x["_a"]), ARROW).alias("_piece")))
    return pieces.groupBy("case_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_b", "_piece"))),
                                 lambda x: x["_piece"]), ARROW).alias("sequence"),
        F.sum("_n").cast("int").alias("n_events"))


def variants(log: DataFrame, cfg: MiningConfig = MiningConfig(),
             as_of: _dt.date | str | None = None) -> DataFrame:
    """One row per distinct activity sequence (MN1).

    ``rank`` by case count descending then sequence ascending; ``n_events`` is
    the sequence length (repeats counted); ``coverage_pct`` = round(100 n / N, 2);
    ``as_of`` stamps the reference date (today when omitted).

    The log is passed once: sequences are built per case and counted, and equal
    ones combine map-side before the counting shuffle.
    """
    table = case_sequences(log, cfg).groupBy("sequence", "n_events").agg(F.count(F.lit(1)).alias("n_cases"))
    ranked = range_rank(table, [("n_cases", True), ("sequence", False)])
    ranked = ranked.withColumn("_total", table.agg(F.sum("n_cases")).scalar())  # of the counted table, not of the log
    stamp = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return ranked.select(
        "rank", "sequence", "n_events", "n_cases",
        F.round(F.col("n_cases") * 100.0 / F.col("_total"), 2).alias("coverage_pct"),
        stamp.alias("as_of"))


def top_variants(table: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent variants (MN2); a top-k report, so the limit is the feature."""
    return table.orderBy("rank").limit(k)


def variant_pareto(table: DataFrame) -> DataFrame:
    """Cumulative case coverage along the variant ranking.

    With variants sorted by (n desc, sequence), the cumulative count at rank r
    is ``S(n) + n * (r - C(n))`` where C(n), S(n) count variants and cases of
    strictly larger n.  Those come from the table of distinct n values (at
    most sqrt(2 N) rows for N cases), broadcast back.
    """
    per_n = table.groupBy("n_cases").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.orderBy(F.col("n_cases").desc()).rowsBetween(Window.unboundedPreceding, -1)
    per_n = per_n.select(
        "n_cases",
        F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_cgt"),
        F.coalesce(F.sum(F.col("_c") * F.col("n_cases")).over(w), F.lit(0)).alias("_sgt"))
    out = table.join(F.broadcast(per_n), "n_cases") \
        .withColumn("_total", table.agg(F.sum("n_cases")).scalar())  # scalar subquery
    cum = F.col("_sgt") + F.col("n_cases") * (F.col("rank") - F.col("_cgt"))
    return out.select(
        "rank", "sequence", "n_cases",
        cum.cast("long").alias("cum_cases"),
        F.round(cum * 100.0 / F.col("_total"), 2).alias("cum_pct"))
