"""Exact grouped quantiles that stay bounded per task, one plan at every size.

Spark's ``percentile`` keeps a map of every distinct value of a group and merges
it in one task, which a group holding a large share of all rows outgrows. Here

1. equal values of a group are counted (combined map-side);
2. values fall into bands, ``BANDS`` per doubling of the value, and the counts are
   summed per band; running sums over a group's bands (at most a few ten
   thousand, whatever its rows) give the first rank of each band;
3. only the bands that hold a wanted rank are kept, two per quantile at most, and
   the values of these bands alone are numbered, each band by itself.

Interpolation is linear between the ranks floor((n-1)q) and ceil((n-1)q),
the same rule as ``percentile`` and DuckDB's ``quantile_cont``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BANDS = 1024


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on group keys where null keys match each other (a null group is a group)."""
    r = right
    for i, k in enumerate(keys):
        r = r.withColumnRenamed(k, f"_rk{i}")
    cond = [left[k].eqNullSafe(r[f"_rk{i}"]) for i, k in enumerate(keys)]
    return left.join(r, cond, how).drop(*[f"_rk{i}" for i in range(len(keys))])


def _band(v: Column) -> Column:
    """A whole number that never falls as ``v`` grows; NaN is above all."""
    size = F.least(F.log2(1.0 + F.abs(v) * float(1 << 26)), F.lit(4096.0))
    band = F.signum(v) * F.floor(size * BANDS)
    return F.when(F.isnan(v), F.lit(1 << 30)).otherwise(band.cast("int"))


def grouped_quantiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """(keys..., one column per ``quantiles`` entry); nulls are ignored; groups
    without values are absent."""
    keys = list(keys)
    v = F.col("_v")
    counts = (df.select(*keys, F.col(value).cast("double").alias("_v")).filter(v.isNotNull())
              .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn("_band", _band(v)))
    group = Window.partitionBy(*keys)
    bands = (counts.groupBy(*keys, "_band").agg(F.sum("_c").alias("_bc"))
             .withColumns({"_n": F.sum("_bc").over(group),
                           "_before": F.coalesce(F.sum("_bc").over(
                               group.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))}))
    # 0-based ranks wanted per quantile: floor and ceil of (n - 1) q
    pos = {name: (F.col("_n") - 1) * F.lit(q) for name, q in quantiles.items()}
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in pos.values()])))
    bands = bands.withColumn("_ranks", F.filter(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_bc")))) \
        .filter(F.size("_ranks") > 0).drop("_bc")
    inside = join_on_keys(counts, bands, [*keys, "_band"])
    up_to = F.sum("_c").over(Window.partitionBy(*keys, "_band").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    inside = inside.withColumn("_end", F.col("_before") + up_to)
    hit = (inside.withColumn("_r", F.explode("_ranks"))
           .filter((F.col("_r") < F.col("_end")) & (F.col("_r") >= F.col("_end") - F.col("_c"))))
    found = hit.groupBy(*keys).agg(F.max("_n").alias("_n"), F.map_from_entries(F.collect_set(F.struct("_r", "_v"))).alias("_at"))
    out = []
    for name, p in pos.items():
        low, high = F.floor(p), F.ceil(p)
        at_low, at_high = F.col("_at")[low], F.col("_at")[high]
        out.append(F.when(low == high, at_low).otherwise((high - p) * at_low + (p - low) * at_high).alias(name))
    return found.select(*keys, *out)
