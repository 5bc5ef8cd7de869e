"""Conformance of a log against a directly-follows model (CF6-CF9).

Fitness: share of steps (START and END included) that the model allows.
Precision: escaping edges over log prefixes - for each distinct prefix,
the model successors of its last activity that the log never takes after
that prefix, weighted by how often the prefix occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowlog.config import MiningConfig
from flowlog.functions import month_key
from flowlog.operators.eventlog import mining_view
from flowlog.operators.model import edge_steps, edge_weights, filtered_model, step_counts


def _allowed(edges: DataFrame, model: DataFrame) -> DataFrame:
    """Mark each step allowed / not; AQE broadcasts the model when it is small."""
    m = model.select("segment", "prev_activity", "activity", F.lit(True).alias("_ok"))
    return edges.join(m, ["segment", "prev_activity", "activity"], "left") \
        .withColumn("allowed", F.coalesce(F.col("_ok"), F.lit(False))).drop("_ok")


def _case_month(log: DataFrame) -> DataFrame:
    return mining_view(log).groupBy("case_id").agg(month_key(F.min("timestamp")).alias("month"))


def fitness(edges: DataFrame, model: DataFrame, by: tuple[str, ...] = ("segment",),
            digits: int = 4) -> DataFrame:
    """``1 - disallowed steps / all steps`` per ``by`` (CF6); steps may be pre-counted (``n``)."""
    marked = _allowed(edges, model)
    w = F.col("n") if "n" in edges.columns else F.lit(1)
    bad = F.sum(F.when(~F.col("allowed"), w).otherwise(F.lit(0)))
    total = F.sum(w)
    return marked.groupBy(*by).agg(
        F.round(1.0 - bad / total, digits).alias("fitness"),
        total.cast("long").alias("steps"),
        bad.cast("long").alias("disallowed"))


def case_fitness(edges: DataFrame, model: DataFrame, digits: int = 4) -> DataFrame:
    """Fitness of every case against its segment's model (CF9)."""
    return fitness(edges, model, by=("segment", "case_id"), digits=digits)


def precision(edges: DataFrame, model: DataFrame, by: tuple[str, ...] = ("segment",),
              digits: int = 4) -> DataFrame:
    """Escaping-edges precision per ``by`` (CF7); needs ``edge_steps(with_prefix=True)``.

    Prefix groups are keyed by (length, two 64-bit fingerprints); their
    successor sets are bounded by the activity vocabulary.
    """
    w = F.col("n") if "n" in edges.columns else F.lit(1)
    prefixes = edges.groupBy(*by, "plen", "px1", "px2", "prev_activity").agg(
        F.sum(w).alias("_n"), F.collect_set("activity").alias("_taken"))
    enabled = model.groupBy("segment", "prev_activity").agg(F.collect_set("activity").alias("_en"))
    j = prefixes.join(enabled, ["segment", "prev_activity"], "left")
    e = F.coalesce(F.size("_en"), F.lit(0))
    t = F.coalesce(F.size(F.array_intersect("_taken", "_en")), F.lit(0))
    agg = j.groupBy(*by).agg(F.sum(F.col("_n") * (e - t)).alias("_esc"),
                             F.sum(F.col("_n") * e).alias("_den"))
    value = F.when(F.col("_den") > 0, 1.0 - F.col("_esc") / F.col("_den")).otherwise(F.lit(1.0))
    return agg.select(*by, F.round(value, digits).alias("precision"))


def conformance(log: DataFrame, cfg: MiningConfig = MiningConfig(), noise_threshold: float = 0.0,
                scope: str = "case", digits: int = 4) -> DataFrame:
    """Per (segment, month of the case's first event): fitness, precision, traces (CF8).

    One model per segment (all months); the month only splits the scoring.
    The ordered pass runs once and yields the case month itself; steps are
    counted per (segment, month, prefix, edge), the model is read off those
    counts, and one prefix-level table - each prefix with its successors and
    their counts, bounded by the activity vocabulary - joined once with the
    model's enabled sets gives both fitness and precision.
    """
    if scope == "source":   # partitions are (case, source): the case month needs the whole case
        edges = edge_steps(log, cfg, scope=scope, with_prefix=True).join(_case_month(log), "case_id")
    else:
        edges = edge_steps(log, cfg, scope=scope, with_prefix=True, with_month=True)
    by = ["segment", "month"]
    # never null; said here as the model's join says it, so that model and score read one shuffle of the counts
    edges = edges.filter(F.col("prev_activity").isNotNull())
    counts = step_counts(edges, tuple(by), prefix=True)
    model = filtered_model(edge_weights(counts), noise_threshold)
    enabled = model.groupBy("segment", "prev_activity").agg(F.collect_set("activity").alias("_en"))
    prefixes = counts.groupBy(*by, "plen", "px1", "px2", "prev_activity").agg(
        F.sum("n").alias("_n"), F.collect_list(F.struct("activity", "n")).alias("_succ"))
    j = prefixes.join(enabled, ["segment", "prev_activity"], "left") \
        .withColumn("_en", F.coalesce(F.col("_en"), F.array().cast("array<string>")))
    e = F.size("_en")
    t = F.size(F.array_intersect(F.transform("_succ", lambda x: x["activity"]), F.col("_en")))
    ok = F.aggregate(F.filter("_succ", lambda x: F.array_contains(F.col("_en"), x["activity"])),
                     F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    scored = j.groupBy(*by).agg(
        F.sum("_n").alias("_steps"), F.sum(ok).alias("_ok"),
        # each trace takes one step from the empty prefix
        F.sum(F.when(F.col("plen") == 0, F.col("_n")).otherwise(0)).alias("total_traces"),
        F.sum(F.col("_n") * (e - t)).alias("_esc"), F.sum(F.col("_n") * e).alias("_den"))
    fit = F.round(1.0 - (F.col("_steps") - F.col("_ok")) / F.col("_steps"), digits)
    prec = F.round(F.when(F.col("_den") > 0, 1.0 - F.col("_esc") / F.col("_den")).otherwise(F.lit(1.0)),
                   digits)
    return scored.select(
        F.col("segment").alias("source"), fit.alias("fitness"), prec.alias("precision"),
        "total_traces", "month")
