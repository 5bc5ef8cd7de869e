"""Journey KPIs and patient-level journeys (documented extensions of the reference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowlog.config import MiningConfig
from flowlog.functions import minutes_between, month_key
from flowlog.operators.eventlog import event_order, mining_view
from flowlog.operators.quantiles import grouped_quantiles, join_on_keys
from flowlog.operators.sequence import with_neighbors


def journey_kpis(log: DataFrame, cfg: MiningConfig = MiningConfig(), digits: int = 4) -> DataFrame:
    """Per (month of case start, specialty of the case's first event): cases,
    mean / median case duration in minutes and mean events per case."""
    view = mining_view(log)
    steps = with_neighbors(view, ["case_id"], event_order(view), ["activity"], lags=(),
                           skew=cfg.skew, hot=cfg.hot_cases)
    per_case = steps.groupBy("case_id").agg(
        F.min("timestamp").alias("_start"), F.max("timestamp").alias("_end"),
        F.count(F.lit(1)).alias("_events"),
        F.min_by("specialty", "_pos").alias("specialty"))
    per_case = per_case.withColumns({"_dur": minutes_between("_start", "_end"),
                                     "month": month_key("_start")})
    keys = ["month", "specialty"]
    g = per_case.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cases"),
        F.round(F.avg("_dur"), digits).alias("mean_duration_min"),
        F.round(F.avg("_events"), digits).alias("mean_events"))
    med = grouped_quantiles(per_case, keys, "_dur", {"_med": 0.5})
    out = join_on_keys(g, med, keys, "left")
    return out.select(*keys, "cases", "mean_duration_min",
                      F.round(F.col("_med"), digits).alias("median_duration_min"), "mean_events")


def attributes_as_of(cases: DataFrame, attributes: DataFrame, at: str = "_start", valid_from: str = "valid_from") -> DataFrame:
    """``cases`` with ``attrs``, the attribute row of the case that held at its time ``at``.

    A case may have several attribute rows (an inpatient and an emergency one, or later
    corrections): the latest ``valid_from`` not after ``at`` counts, else the earliest one; of rows of
    the same time the smallest. Rows without a time come last; a case without rows has null.
    Both choices are aggregates, so many rows of one case are reduced in the tasks.
    """
    names = [c for c in attributes.columns if c not in ("case_id", valid_from)]
    rows = attributes.select("case_id", F.col(valid_from).alias("_valid"), F.struct(*names).alias("_attrs"))
    both = cases.select("case_id", at).join(rows, "case_id")
    held = F.col("_valid") <= F.col(at)
    since = F.timestamp_diff("MICROSECOND", F.col("_valid"), F.col(at))
    chosen = both.groupBy("case_id").agg(
        F.min(F.when(held, F.struct(since.alias("age"), F.col("_attrs").alias("a")))).alias("before"),
        F.min(F.when(~F.coalesce(held, F.lit(False)), F.struct(F.col("_valid").isNull().alias("none"), F.col("_valid").alias("v"),
                                                              F.col("_attrs").alias("a")))).alias("after"))
    return cases.join(chosen.select("case_id", F.coalesce("before.a", "after.a").alias("attrs")), "case_id", "left")


def journey_kpis_by_attributes(log: DataFrame, attributes: DataFrame, by: tuple[str, ...], cfg: MiningConfig = MiningConfig(),
                               valid_from: str = "valid_from", digits: int = 4) -> DataFrame:
    """Per (month of case start, the case attributes ``by``): cases, mean and median duration in minutes, mean events (OP2).

    ``attributes`` is the case-attribute table (EL6) with a time; the row that held at the case's start counts.
    """
    per_case = mining_view(log).groupBy("case_id").agg(
        F.min("timestamp").alias("_start"), F.max("timestamp").alias("_end"), F.count(F.lit(1)).alias("_events"))
    joined = attributes_as_of(per_case, attributes, "_start", valid_from)
    rows = joined.select(month_key("_start").alias("month"), *[F.col(f"attrs.{c}").alias(c) for c in by],
                         minutes_between("_start", "_end").alias("_dur"), "_events")
    keys = ["month", *by]
    g = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("cases"), F.round(F.avg("_dur"), digits).alias("mean_duration_min"),
                                F.round(F.avg("_events"), digits).alias("mean_events"))
    med = grouped_quantiles(rows, keys, "_dur", {"_med": 0.5})
    return join_on_keys(g, med, keys, "left").select(*keys, "cases", "mean_duration_min",
                                                     F.round(F.col("_med"), digits).alias("median_duration_min"), "mean_events")


def patient_journeys(log: DataFrame, case_patient: DataFrame, digits: int = 4) -> DataFrame:
    """Link cases of one patient (``case_patient``: case_id, patient_id) and
    summarise per patient: cases, events, first and last event, span in days."""
    view = mining_view(log)
    per_case = view.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("_events"), F.min("timestamp").alias("_first"),
        F.max("timestamp").alias("_last"))
    j = per_case.join(case_patient, "case_id")
    g = j.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("cases"), F.sum("_events").alias("events"),
        F.min("_first").alias("first_event"), F.max("_last").alias("last_event"))
    return g.withColumn("span_days", F.round(
        minutes_between("first_event", "last_event") / 1440.0, digits))
