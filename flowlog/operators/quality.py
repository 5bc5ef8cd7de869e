"""Data-quality operators: expectations, coverage, loss audit, profiles (DQ1-DQ9)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from flowlog.config import Rule


def _passes(rule: Rule):
    """A row passes when the predicate is true; false *or null* fails."""
    return F.coalesce(F.expr(rule.predicate), F.lit(False))


def expectation_metrics(df: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
    """One pass over ``df``: (dataset, rule, action, total, failed) per rule (DQ2)."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count_if(~_passes(r)).alias(f"_f{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    items = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                               F.col(f"_f{i}").alias("failed")) for i, r in enumerate(rules)])
    return wide.select(F.lit(dataset).alias("dataset"), F.col("_total").alias("total"),
                       F.explode(items).alias("_r")) \
        .select("dataset", "_r.rule", "_r.action", "total", "_r.failed")


def apply_expectations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Drop rows failing any ``drop`` rule (DQ1); ``warn`` rules keep rows."""
    out = df
    for r in rules:
        if r.action == "drop":
            out = out.filter(_passes(r))
    return out


def observe_expectations(df: DataFrame, rules: Sequence[Rule],
                         name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Attach the failure counts as an ``Observation`` of the job that consumes ``df``.

    Counts are taken on the input rows (before ``drop`` rules apply), in the
    same pass as the write - no extra scan.
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("total")]
    metrics += [F.count_if(~_passes(r)).alias(r.name) for r in rules]
    observed = df.observe(obs, *metrics)
    return apply_expectations(observed, rules), obs


def _stamp(as_of):
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def activity_coverage(log: DataFrame, as_of: _dt.date | str | None = None) -> DataFrame:
    """Timestamp coverage per (source, activity), level ``activity`` (DQ5)."""
    g = log.groupBy("source", "activity").agg(
        F.count(F.lit(1)).alias("total"), F.count("timestamp").alias("with_timestamp"))
    return g.select(
        F.lit("activity").alias("level"), "source", "activity", "total", "with_timestamp",
        (F.col("total") - F.col("with_timestamp")).alias("without_timestamp"),
        F.round(F.col("with_timestamp") / F.col("total") * 100, 2).alias("coverage_pct"),
        _stamp(as_of).alias("as_of"))


def case_coverage(log: DataFrame, as_of: _dt.date | str | None = None) -> DataFrame:
    """Cases whose events *all* lack a timestamp vs. the rest, level ``case`` (DQ6).

    The reference takes ``min`` of the per-event null indicator, so a case is
    "without timestamp" only when no event has one.
    """
    per_case = log.groupBy("case_id").agg(
        F.min(F.col("timestamp").isNull().cast("int")).alias("_all_null"))
    g = per_case.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("_all_null") == 0).alias("with_timestamp"),
        F.count_if(F.col("_all_null") == 1).alias("without_timestamp"))
    return g.select(
        F.lit("case").alias("level"), F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("string").alias("activity"), "total", "with_timestamp",
        "without_timestamp",
        F.round(F.col("with_timestamp") / F.col("total") * 100, 2).alias("coverage_pct"),
        _stamp(as_of).alias("as_of"))


def coverage_table(log: DataFrame, as_of=None) -> DataFrame:
    """Both grains in one table (DQ7)."""
    return activity_coverage(log, as_of).unionByName(case_coverage(log, as_of))


def loss_audit(log: DataFrame) -> DataFrame:
    """Per source: all events, and how many lack case / activity / timestamp (DQ8)."""
    kept = F.col("case_id").isNotNull() & F.col("activity").isNotNull() & F.col("timestamp").isNotNull()
    return log.groupBy("source").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("case_id").isNull()).alias("null_case"),
        F.count_if(F.col("activity").isNull()).alias("null_activity"),
        F.count_if(F.col("timestamp").isNull()).alias("null_timestamp"),
        F.count_if(kept).alias("kept"))


def column_profile(df: DataFrame, dataset: str, digits: int = 4) -> DataFrame:
    """Share of non-null values per column, unpivoted (DQ9), in one scan."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_total"),
                  *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(cols)])
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_c{i}").alias("non_null"))
                      for i, c in enumerate(cols)])
    out = wide.select(F.col("_total").alias("total"), F.explode(items).alias("_p"))
    return out.select(F.lit(dataset).alias("dataset"), "_p.column", "total", "_p.non_null",
                      F.round(F.col("_p.non_null") / F.col("total"), digits).alias("share"))


def write_observed(df: DataFrame, rules: Sequence[Rule], path: str, dataset: str, fmt: str = "parquet",
                   partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` under its ``drop`` rules and return what the writing job counted (DQ1, DQ2, IO12).

    Rows (dataset, rule, action, total, failed) as from :func:`expectation_metrics`, and one with
    rule ``written`` (total: rows that reached the table, failed: rows dropped). The input is
    scanned once: the counts are ``Observation``s of the write, before and after the drops.
    """
    kept, before = observe_expectations(df, rules, name=f"{dataset}-input")
    after = Observation(f"{dataset}-written")
    writer = kept.observe(after, F.count(F.lit(1)).alias("total")).write.format(fmt).mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    counts, written = before.get, after.get["total"]
    rows = [(dataset, r.name, r.action, counts["total"], counts[r.name]) for r in rules]
    rows.append((dataset, "written", "audit", written, counts["total"] - written))
    return df.sparkSession.createDataFrame(rows, "dataset string, rule string, action string, total long, failed long")


class StreamExpectations(StreamingQueryListener):
    """Expectation counts of streaming queries, summed over their micro-batches.

    Attach with ``spark.streams.addListener`` and mark a stream with :meth:`observed`; the
    counts arrive with each batch's progress, from the job that writes it.
    """

    def __init__(self) -> None:
        self.rules: dict[str, Sequence[Rule]] = {}
        self.counts: dict[str, dict[str, int]] = {}

    def observed(self, stream: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
        """``stream`` counted against its rules and without the rows that fail a ``drop`` rule."""
        self.rules[dataset] = list(rules)
        metrics = [F.count(F.lit(1)).alias("total"), *[F.count_if(~_passes(r)).alias(r.name) for r in rules]]
        return apply_expectations(stream.observe(dataset, *metrics), rules)

    def metrics(self, spark) -> DataFrame:
        rows = [(d, r.name, r.action, self.counts.get(d, {}).get("total", 0), self.counts.get(d, {}).get(r.name, 0))
                for d, rules in self.rules.items() for r in rules]
        return spark.createDataFrame(rows, "dataset string, rule string, action string, total long, failed long")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for dataset, row in event.progress.observedMetrics.items():
            if dataset in self.rules:
                held = self.counts.setdefault(dataset, {})
                for name, value in row.asDict().items():
                    held[name] = held.get(name, 0) + value

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
