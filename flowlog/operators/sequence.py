"""Order-dependent operators that stay balanced when one key is huge.

A plain ``Window.partitionBy(case)`` sends every row of a case to one task;
if one case (or user, or report file) holds a third of all rows, that task
does a third of the job.  Here:

1. A sample estimates rows per key; keys above a threshold ("hot") get
   quantiles of the first sort column (the time axis) as bucket bounds. The
   hot-key table holds at most ``HOT_SHARE * BOUNDS`` bounds and is broadcast.
2. Every row of a hot key gets a bucket of about equal frequency.  The window
   runs per (key, bucket), so a hot key is spread over many tasks while
   ordinary keys see one plain window.
3. Only hot keys need values that cross a bucket border (neighbours,
   running offsets, carried values).  Their buckets contribute their first
   and last few rows (bounded) to a small bucket table, ordered per key by
   bucket, which is joined back; ordinary rows find no match and keep their
   in-bucket values, which are already final.

Results do not depend on the bucketing - only the work distribution does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from flowlog.config import SkewConfig


BOUNDS = 255        # bounds of a hot key at most; a power of two less one
HOT_SHARE = 4096    # hot keys at most, the largest ones; any other key has less than this part of all rows
RANK_BOUNDS = 1023  # bounds that split a table to be ranked; a power of two less one


def sort_keys(order_by: Sequence) -> list[Column]:
    """Names sort ascending with nulls last (as DuckDB and the oracle do)."""
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]


def _empty_like(arr: Column) -> Column:
    """A typed empty array with the element type of ``arr``."""
    return F.filter(arr, lambda x: F.lit(False))


def _axis(df: DataFrame, name: str) -> Column:
    """A numeric position along column ``name`` (micros, days or the value)."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c) \
            .cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, T.NumericType):
        return c.cast("double")
    raise TypeError(f"cannot bucket along a {dtype} column")


def _left_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
               broadcast: bool = False) -> DataFrame:
    """Plain equi left join on column names, so the join keys line up with the
    window's hash partitioning and the large side is not shuffled again.
    Null keys never match; they are never hot either (see :func:`hot_keys`)."""
    return left.join(F.broadcast(right) if broadcast else right, list(keys), "left")


def hot_keys(df: DataFrame, keys: Sequence[str], axis_col: str, skew: SkewConfig, sampled: bool = False) -> DataFrame | None:
    """(keys, ``_hb`` sampled quantiles of the axis, ``_hm`` parts per stretch) for keys estimated to be hot.

    One pass over the sample gives each key's count and quantile summary; both are merged
    from the tasks' partial results. A key is hot if it has ``hot_rows`` rows or more and is among
    the ``HOT_SHARE`` largest: any other has less than 1 / ``HOT_SHARE`` of all rows, no more than
    an even share of the work. So there are at most ``HOT_SHARE * BOUNDS`` bounds at every size.

    A key of about n buckets gets min(n, ``BOUNDS`` + 1) stretches of equal
    frequency, so a burst of events is cut as finely as its rows require; beyond
    that number each stretch is cut further into ``_hm`` parts of equal width.
    ``sampled``: ``df`` is such a sample already.
    """
    if skew.mode == "off":
        return None
    frac = 1.0 if skew.mode == "all" else skew.sample_fraction
    # filters on the columns themselves, as the mining view has them: both read the same shuffles
    for c in (axis_col, *keys):
        df = df.filter(F.col(c).isNotNull())
    src = df.select(*keys, _axis(df, axis_col).alias("_ax"))
    if frac < 1.0 and not sampled:
        src = src.sample(fraction=frac, seed=17)
    marks = [i / (BOUNDS + 1) for i in range(1, BOUNDS + 1)]
    sizes = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("_hc"), F.percentile_approx("_ax", marks, 10 * BOUNDS).alias("_q"))
    g = sizes if skew.mode == "all" else (sizes.filter(F.col("_hc") / F.lit(frac) >= F.lit(skew.hot_rows))
                                          .orderBy(F.col("_hc").desc(), *keys).limit(HOT_SHARE))
    n = F.ceil(F.col("_hc") / F.lit(frac) / F.lit(float(max(1, skew.bucket_rows))))
    stretches = F.least(F.greatest(n, F.lit(2)), F.lit(BOUNDS + 1))
    # every (BOUNDS + 1) / stretches-th of the marks
    bounds = F.transform(F.sequence(F.lit(1).cast("long"), stretches.cast("long") - 1),
                         lambda i: F.get("_q", (F.floor(i * F.lit(BOUNDS + 1) / stretches) - 1).cast("int")))
    return g.select(*keys, bounds.alias("_hb"),
                    F.ceil(n / F.lit(float(BOUNDS + 1))).cast("long").alias("_hm"))


def _bucket_of(x: Column, bounds: Column, parts: Column) -> tuple[Column, Column, Column]:
    """(stretch, part, whether rows of this value are split by the next sort columns).

    The stretch is the number of bounds up to ``x``, by binary search. Part 0 of a
    stretch holds the rows equal to its lower bound; every value that may fill a
    stretch is such a bound, so these rows are split along the next sort columns.
    """
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(BOUNDS.bit_length()))])
    stretch = F.aggregate(steps, F.lit(0), lambda at, s: at + F.when(
        F.get(bounds, at + s - 1) <= x, s).otherwise(F.lit(0)))
    low, high = F.get(bounds, stretch - 1), F.get(bounds, stretch)
    part = F.floor(F.coalesce((x - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0)) * parts)
    tied = F.coalesce(x == low, F.lit(False))
    return stretch, F.when(tied, F.lit(0).cast("long")).otherwise(part + 1), tied


def assign_buckets(df: DataFrame, keys: Sequence[str], axis_col: str, skew: SkewConfig,
                   bucket_col: str = "_b", hot: DataFrame | None = None,
                   ties: Sequence[str] = ()) -> DataFrame:
    """Add ``bucket_col`` and ``_hot`` (key is split).

    The bucket is a struct that grows along the order: the stretch and part of
    the axis and, for rows on a bound (where values that fill whole stretches
    lie, as a day in a date-only export), the ``ties`` columns (the next sort columns) as (is-null,
    value) pairs. Rows without a position are last. Ordinary keys get one bucket.

    ``hot`` is an optional precomputed table from :func:`hot_keys`, keyed by a
    subset of ``keys`` (e.g. hot cases reused for (case, source) keys: any
    monotone bucketing is correct, so case-level bounds serve).
    """
    if hot is None:
        hot = hot_keys(df, keys, axis_col, skew)
        on = list(keys)
    else:
        on = [k for k in hot.columns if k not in ("_hb", "_hm")]
        if not set(on) <= set(keys):
            raise ValueError(f"hot-key table keyed by {on}, not a subset of {list(keys)}")

    def struct_of(t, part, split):
        parts = [t.alias("t"), part.alias("p")]
        for i, c in enumerate(ties):
            dt = df.schema[c].dataType
            parts.append(F.when(split, F.col(c).isNull()).otherwise(F.lit(None).cast("boolean")).alias(f"n{i}"))
            parts.append(F.when(split, F.col(c)).otherwise(F.lit(None).cast(dt)).alias(f"v{i}"))
        return F.struct(*parts)

    if hot is None:
        return df.withColumns({bucket_col: struct_of(F.lit(0), F.lit(0).cast("long"), F.lit(False)),
                               "_hot": F.lit(False)})
    # at most HOT_SHARE * BOUNDS numbers (8 MB), hence the hint
    d = _left_join(df, hot, on, broadcast=(skew.mode != "all"))
    d = d.withColumns({"_hot": F.col("_hb").isNotNull(), "_x": _axis(d, axis_col)})
    stretch, part, tied = _bucket_of(F.col("_x"), F.col("_hb"), F.col("_hm"))
    placed = F.col("_hot") & F.col("_x").isNotNull()
    d = d.withColumns({
        "_t": F.when(placed, stretch).when(F.col("_hot"), F.lit(BOUNDS + 1)).otherwise(F.lit(0)),
        "_p": F.when(placed, part).otherwise(F.lit(0).cast("long")),
        "_s": F.when(placed, tied).otherwise(F.lit(False))})
    return d.withColumn(bucket_col, struct_of(F.col("_t"), F.col("_p"), F.col("_s"))) \
        .drop("_hb", "_hm", "_x", "_t", "_p", "_s")


def with_neighbors(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                   carry: Sequence[str], lags: Sequence[int] = (1,), leads: Sequence[int] = (),
                   skew: SkewConfig = SkewConfig(), bucket_col: str = "_b",
                   hot: DataFrame | None = None, key_sets: Sequence[str] = (),
                   key_mins: Sequence[str] = ()) -> DataFrame:
    """Add ``_pos`` (1-based rank in the key), ``_cnt`` (rows of the key) and
    ``_lag{k}`` / ``_lead{k}`` structs of the ``carry`` columns; for each
    column in ``key_sets`` (low-cardinality, e.g. the source) ``_set_{col}``,
    the distinct values of the whole key, and for each column in
    ``key_mins`` ``_min_{col}``, its minimum over the whole key - both
    computed in the same pass (no join back to a per-key aggregate).

    ``order_by`` (column names, ascending, nulls last) must be total within a
    key for deterministic results; its first column is the bucketing axis.
    The output keeps ``bucket_col`` and ``_hot`` for follow-up passes.
    """
    keys = list(partition_by)
    kl = max(lags, default=0)
    kd = max(leads, default=0)
    d = assign_buckets(df, keys, order_by[0], skew, bucket_col, hot, ties=list(order_by[1:4]))
    w_in = Window.partitionBy(*keys, bucket_col, "_hot").orderBy(*sort_keys(order_by))
    w_all = Window.partitionBy(*keys, bucket_col, "_hot")
    d = d.withColumn("_pl", F.struct(*[F.col(c) for c in carry]))
    cols = {"_rn": F.row_number().over(w_in), "_n": F.count(F.lit(1)).over(w_all)}
    for c in key_sets:
        cols[f"_sin_{c}"] = F.collect_set(c).over(w_all)
    for c in key_mins:
        cols[f"_mnin_{c}"] = F.min(c).over(w_all)
    for k in lags:
        cols[f"_lag{k}_in"] = F.lag("_pl", k).over(w_in)
    for k in leads:
        cols[f"_lead{k}_in"] = F.lead("_pl", k).over(w_in)
    d = d.withColumns(cols)

    # bucket table: hot keys only, first/last rows of each bucket
    edge = F.col("_hot") & ((F.col("_rn") <= max(kd, 1)) | (F.col("_rn") > F.col("_n") - kl))
    per_bucket = (
        d.filter(edge)
        .groupBy(*keys, bucket_col, "_hot")
        .agg(F.max("_n").alias("_bn"),
             F.array_sort(F.collect_list(F.struct(F.col("_rn").alias("rn"),
                                                  F.col("_pl").alias("pl")))).alias("_edge"),
             *[F.first(f"_sin_{c}").alias(f"_bset_{c}") for c in key_sets],
             *[F.min(f"_mnin_{c}").alias(f"_bmin_{c}") for c in key_mins])
    )
    w_b = Window.partitionBy(*keys).orderBy(bucket_col)
    bcols = {
        "_off": F.coalesce(F.sum("_bn").over(w_b.rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0).cast("long")),
        "_kcnt": F.sum("_bn").over(Window.partitionBy(*keys)),
    }
    for c in key_sets:
        bcols[f"_kset_{c}"] = F.array_distinct(F.flatten(
            F.collect_list(f"_bset_{c}").over(Window.partitionBy(*keys))))
    for c in key_mins:
        bcols[f"_kmin_{c}"] = F.min(f"_bmin_{c}").over(Window.partitionBy(*keys))
    if kl:
        tail = F.transform(F.filter("_edge", lambda x: x["rn"] > F.col("_bn") - kl), lambda x: x["pl"])
        per_bucket = per_bucket.withColumn("_tail", tail)
        bcols["_ptail"] = F.concat(*[
            F.coalesce(F.lag("_tail", j).over(w_b), _empty_like(F.col("_tail")))
            for j in range(kl, 0, -1)])
    if kd:
        head = F.transform(F.filter("_edge", lambda x: x["rn"] <= kd), lambda x: x["pl"])
        per_bucket = per_bucket.withColumn("_head", head)
        bcols["_nhead"] = F.concat(*[
            F.coalesce(F.lead("_head", j).over(w_b), _empty_like(F.col("_head")))
            for j in range(1, kd + 1)])
    per_bucket = per_bucket.withColumns(bcols).select(*keys, bucket_col, "_hot", *bcols.keys())

    out = _left_join(d, per_bucket, [*keys, bucket_col, "_hot"])
    final = {"_pos": F.coalesce(F.col("_off"), F.lit(0).cast("long")) + F.col("_rn"),
             "_cnt": F.coalesce(F.col("_kcnt"), F.col("_n"))}
    for c in key_sets:
        final[f"_set_{c}"] = F.coalesce(F.col(f"_kset_{c}"), F.col(f"_sin_{c}"))
    for c in key_mins:
        final[f"_min_{c}"] = F.coalesce(F.col(f"_kmin_{c}"), F.col(f"_mnin_{c}"))
    for k in lags:
        final[f"_lag{k}"] = F.when(F.col("_rn") > k, F.col(f"_lag{k}_in")).otherwise(
            F.try_element_at(F.col("_ptail"), (F.col("_rn") - k - 1).cast("int")))
    for k in leads:
        final[f"_lead{k}"] = F.when(F.col("_rn") + k <= F.col("_n"), F.col(f"_lead{k}_in")).otherwise(
            F.try_element_at(F.col("_nhead"), (F.col("_rn") + k - F.col("_n")).cast("int")))
    out = out.withColumns(final)
    drop = ["_pl", "_rn", "_n", "_off", "_kcnt", "_ptail", "_nhead"]
    drop += [p + c for c in key_sets for p in ("_sin_", "_kset_")]
    drop += [p + c for c in key_mins for p in ("_mnin_", "_kmin_")]
    drop += [f"_lag{k}_in" for k in lags] + [f"_lead{k}_in" for k in leads]
    return out.drop(*[c for c in drop if c in out.columns])


def with_prefix_xor(df: DataFrame, partition_by: Sequence[str], order_by: Sequence,
                    values: dict[str, Column], bucket_col: str = "_b",
                    inclusive: bool = False) -> DataFrame:
    """Running ``bit_xor`` of each value along the order (exclusive by default).

    Needs ``bucket_col`` and ``_hot`` left by :func:`with_neighbors`.  XOR is
    associative and commutative, so bucket totals combine exactly.
    """
    keys = list(partition_by)
    w_in = Window.partitionBy(*keys, bucket_col, "_hot").orderBy(*sort_keys(order_by))
    frame = w_in.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    d = df.withColumns({f"_xv_{n}": v for n, v in values.items()})
    d = d.withColumns({f"_xin_{n}": F.coalesce(F.bit_xor(f"_xv_{n}").over(frame), F.lit(0).cast("long"))
                       for n in values})
    per_bucket = d.filter(F.col("_hot")).groupBy(*keys, bucket_col, "_hot").agg(
        *[F.bit_xor(f"_xv_{n}").alias(f"_bx_{n}") for n in values])
    w_b = Window.partitionBy(*keys).orderBy(bucket_col).rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.select(*keys, bucket_col, "_hot", *[
        F.bit_xor(f"_bx_{n}").over(w_b).alias(f"_xoff_{n}") for n in values])
    out = _left_join(d, per_bucket, [*keys, bucket_col, "_hot"])
    out = out.withColumns({n: F.col(f"_xin_{n}").bitwiseXOR(F.coalesce(F.col(f"_xoff_{n}"), F.lit(0).cast("long")))
                           for n in values})
    return out.drop(*[f"{p}{n}" for n in values for p in ("_xv_", "_xin_", "_xoff_")])


def forward_fill(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str],
                 values: dict[str, Column], skew: SkewConfig = SkewConfig(),
                 bucket_col: str = "_b") -> DataFrame:
    """Carry the last non-null of each ``values`` expression forward (RS3).

    Inside a bucket ``last(ignorenulls)`` over a running frame; across the
    buckets of a hot key, the last non-null value of earlier buckets.
    """
    keys = list(partition_by)
    d = assign_buckets(df, keys, order_by[0], skew, bucket_col, ties=list(order_by[1:4]))
    w_in = Window.partitionBy(*keys, bucket_col, "_hot").orderBy(*sort_keys(order_by)) \
        .rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({f"_ff_{name}": expr for name, expr in values.items()})
    d = d.withColumns({f"_in_{name}": F.last(f"_ff_{name}", ignorenulls=True).over(w_in)
                       for name in values})
    order_struct = F.struct(*[x for n, c in enumerate(order_by)
                              for x in (F.col(c).isNull().alias(f"n{n}"), F.col(c).alias(f"v{n}"))])
    per_bucket = d.filter(F.col("_hot")).groupBy(*keys, bucket_col, "_hot").agg(*[
        F.max_by(F.col(f"_ff_{name}"), F.when(F.col(f"_ff_{name}").isNotNull(), order_struct))
        .alias(f"_bl_{name}") for name in values])
    w_b = Window.partitionBy(*keys).orderBy(bucket_col).rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_bucket.select(*keys, bucket_col, "_hot", *[
        F.last(f"_bl_{name}", ignorenulls=True).over(w_b).alias(f"_carry_{name}") for name in values])
    out = _left_join(d, per_bucket, [*keys, bucket_col, "_hot"])
    out = out.withColumns({name: F.coalesce(F.col(f"_in_{name}"), F.col(f"_carry_{name}"))
                           for name in values})
    drop = [p + name for name in values for p in ("_ff_", "_in_", "_carry_")]
    return out.drop(*drop, bucket_col, "_hot")


def running(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], values: dict[str, tuple[str, Column]],
            skew: SkewConfig = SkewConfig(), inclusive: bool = True, bucket_col: str = "_b") -> DataFrame:
    """Running ``max``, ``min`` or ``sum`` of expressions along the order: ``values`` maps a new column to (kind, expression).

    All three combine from the buckets of a hot key: each bucket runs by itself, and the
    totals of the buckets before it are added in. Null where no value has come yet.
    """
    kinds = {"max": (F.max, F.greatest), "min": (F.min, F.least),
             "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b))}
    keys = list(partition_by)
    d = assign_buckets(df, keys, order_by[0], skew, bucket_col, ties=list(order_by[1:4]))
    d = d.withColumns({f"_rv_{n}": v for n, (_, v) in values.items()})
    w_in = Window.partitionBy(*keys, bucket_col, "_hot").orderBy(*sort_keys(order_by)) \
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    d = d.withColumns({f"_rin_{n}": kinds[k][0](f"_rv_{n}").over(w_in) for n, (k, _) in values.items()})
    w_b = Window.partitionBy(*keys).orderBy(bucket_col).rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = (d.filter(F.col("_hot")).groupBy(*keys, bucket_col, "_hot")
                  .agg(*[kinds[k][0](f"_rv_{n}").alias(f"_rt_{n}") for n, (k, _) in values.items()])
                  .select(*keys, bucket_col, "_hot", *[kinds[k][0](f"_rt_{n}").over(w_b).alias(f"_ro_{n}") for n, (k, _) in values.items()]))
    out = _left_join(d, per_bucket, [*keys, bucket_col, "_hot"])
    out = out.withColumns({n: kinds[k][1](F.col(f"_rin_{n}"), F.col(f"_ro_{n}")) for n, (k, _) in values.items()})
    return out.drop(*[f"{p}{n}" for n in values for p in ("_rv_", "_rin_", "_ro_")], bucket_col, "_hot")


def range_rank(df: DataFrame, order_by: Sequence[tuple[str, bool]], out_col: str = "rank") -> DataFrame:
    """1..N along a total order, lazily and without a one-partition window.

    ``order_by``: (column, descending), descending ones numeric. The rows whose keys have
    the smallest hashes are an even sample of the order; their keys, ``RANK_BOUNDS`` at most,
    split the table into ranges. Ranges are counted, rows are numbered inside their range and
    start behind the ranges before. The sample depends on the rows alone, so every
    evaluation of the plan splits alike.
    """
    key = F.struct(*[x for i, (c, down) in enumerate(order_by)
                     for x in (F.col(c).isNull().alias(f"n{i}"), (-F.col(c) if down else F.col(c)).alias(f"v{i}"))])
    d = df.withColumn("_key", key)
    sample = d.select("_key").orderBy(F.xxhash64("_key"), "_key").limit(RANK_BOUNDS)
    bounds = sample.agg(F.array_sort(F.collect_list("_key"))).scalar()
    d = d.withColumn("_bounds", bounds)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(RANK_BOUNDS.bit_length()))])
    place = F.aggregate(steps, F.lit(0), lambda at, s: at + F.when(
        F.get("_bounds", at + s - 1) <= F.col("_key"), s).otherwise(F.lit(0)))
    d = d.withColumn("_range", place).drop("_bounds")
    # one row a range, hence the hint
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (d.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
               .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0).cast("long")).alias("_start")))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("_key"))
    return (d.withColumn("_in", inside).join(F.broadcast(offsets), "_range")
            .withColumn(out_col, (F.col("_start") + F.col("_in")).cast("long")).drop("_key", "_range", "_in", "_start"))
