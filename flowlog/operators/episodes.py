"""Episodes of care: emergency stays linked to the inpatient stay that follows, and chains of stays (OP4).

Stays: ``patient_id``, ``stay_id``, ``kind`` ('emergency' or 'inpatient'), ``start`` and
``end`` (null: open; for gaps an open stay counts as ending where it starts, so a
missing discharge does not swallow all that follows).

Both operators work along the time of each patient with the library's split of hot
keys, so a patient with very many stays is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowlog.config import SkewConfig
from flowlog.operators.sequence import forward_fill, running

EMERGENCY, INPATIENT = "emergency", "inpatient"


def _micros(c):
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def _with_times(stays: DataFrame) -> DataFrame:
    start = F.col("start").cast("timestamp_ntz")
    until = F.greatest(start, F.coalesce(F.col("end").cast("timestamp_ntz"), start))
    return stays.where("patient_id is not null and start is not null").withColumns({"_from": _micros(start), "_until": _micros(until)})


def link_stays(stays: DataFrame, gap_minutes: int, skew: SkewConfig = SkewConfig()) -> DataFrame:
    """Each emergency stay with the patient's next inpatient stay.

    The next one is the first that starts at or after the emergency stay's start, and no later
    than ``gap_minutes`` after its end; of several at one instant the smallest ``stay_id``. Columns:
    patient_id, stay_id, start, end, ``next_stay_id``, ``next_start``, ``wait_minutes`` (from
    the end of the emergency stay, 0 where the stays overlap); the last three null without link.
    """
    timed = _with_times(stays)
    first = (timed.where(F.col("kind") == INPATIENT).groupBy("patient_id", "_from")
             .agg(F.min(F.struct("stay_id", "start")).alias("_next")).withColumn("_rank", F.lit(0)))
    waiting = timed.where(F.col("kind") == EMERGENCY).withColumn("_rank", F.lit(1))
    both = first.unionByName(waiting, allowMissingColumns=True)
    # backwards in time, the last inpatient stay seen is the next one; at one instant it comes before the emergency stays
    both = both.withColumn("_back", -F.col("_from"))
    seen = F.when(F.col("_rank") == 0, F.struct(F.col("_next.stay_id").alias("id"), F.col("_next.start").alias("at"), F.col("_from").alias("t")))
    filled = forward_fill(both, ["patient_id"], ["_back", "_rank", "stay_id"], {"_found": seen}, skew=skew).where(F.col("_rank") == 1)
    linked = F.col("_found.t") <= F.col("_until") + F.lit(gap_minutes * 60_000_000).cast("long")
    wait = F.greatest(F.col("_found.t") - F.col("_until"), F.lit(0)) / 60e6
    return filled.select("patient_id", "stay_id", "start", "end", F.when(linked, F.col("_found.id")).alias("next_stay_id"),
                         F.when(linked, F.col("_found.at")).alias("next_start"), F.when(linked, F.round(wait, 4)).alias("wait_minutes"))


def number_episodes(stays: DataFrame, gap_minutes: int, skew: SkewConfig = SkewConfig()) -> DataFrame:
    """``stays`` with ``episode``, numbered 1, 2, ... per patient: a stay that starts more than ``gap_minutes``
    after the latest end of all earlier stays opens a new one."""
    order = ["_from", "_until", "stay_id"]
    timed = running(_with_times(stays), ["patient_id"], order, {"_reach": ("max", F.col("_until"))}, skew, inclusive=False)
    opens = F.col("_reach").isNull() | (F.col("_from") > F.col("_reach") + F.lit(gap_minutes * 60_000_000).cast("long"))
    return running(timed, ["patient_id"], order, {"episode": ("sum", opens.cast("long"))}, skew).drop("_from", "_until", "_reach")


def episodes(stays: DataFrame, gap_minutes: int, skew: SkewConfig = SkewConfig()) -> DataFrame:
    """One row per episode: stays by kind, first start, last end (null while a stay is open)."""
    numbered = number_episodes(stays, gap_minutes, skew)
    return numbered.groupBy("patient_id", "episode").agg(
        F.count(F.lit(1)).alias("stays"), F.count_if(F.col("kind") == EMERGENCY).alias("emergency_stays"),
        F.count_if(F.col("kind") == INPATIENT).alias("inpatient_stays"), F.min("start").alias("first_start"),
        F.when(F.count_if(F.col("end").isNull()) == 0, F.max("end")).alias("last_end"))
