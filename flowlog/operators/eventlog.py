"""Canonical event log construction and log-level operators (EL1-EL11)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from flowlog.config import CANONICAL_COLUMNS, TIE_BREAK, MiningConfig, SourceSpec
from flowlog.functions import span_minutes
from flowlog.operators.sequence import assign_buckets, hot_keys, with_neighbors


def _col(v, default_type: str = "string") -> Column:
    if v is None:
        return F.lit(None).cast(default_type)
    return F.col(v) if isinstance(v, str) else v


def _lit_or_col(v) -> Column:
    """Literal text for ``str``, expression for ``Column``."""
    if v is None:
        return F.lit(None).cast("string")
    return F.lit(v) if isinstance(v, str) else v


def to_events(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Source rows -> canonical events, plus ``event_seq`` (EL1, EL2, EL3).

    A wide source (``spec.events``) is unpivoted with one
    ``explode(array(struct ...))``: one scan, however many timestamp columns.
    Events whose timestamp is null are kept, as the reference keeps them;
    :func:`mining_view` drops them later.
    """
    common = {
        "case_id": _col(spec.case_col).cast("string"),
        "lifecycle": F.lit(spec.lifecycle),
        "event_type": F.lit(spec.event_type),
        "case_type": _lit_or_col(spec.case_type).cast("string"),
        "outcome": F.lit(None).cast("string"),
        "specialty": _col(spec.specialty_col).cast("string"),
        "location": _col(spec.location_col).cast("string"),
        "source": F.lit(spec.name),
    }
    if spec.events:
        base_resource = _col(spec.resource_col).cast("string")
        items = [
            F.struct(
                F.lit(i).alias("event_seq"),
                F.lit(e.activity).alias("activity"),
                _col(e.ts_col).alias("timestamp"),
                (_col(e.resource_col).cast("string") if e.resource_col is not None
                 else base_resource).alias("resource"),
            )
            for i, e in enumerate(spec.events)
        ]
        wide = df.select(*[c.alias(n) for n, c in common.items()],
                         F.explode(F.array(*items)).alias("_e"))
        out = wide.select("*", "_e.*").drop("_e")
    else:
        out = df.select(*[c.alias(n) for n, c in common.items()],
                        _col(spec.activity_col).cast("string").alias("activity"),
                        _col(spec.ts_col).alias("timestamp"),
                        _col(spec.resource_col).cast("string").alias("resource"),
                        F.lit(0).alias("event_seq"))
    return out.select(*CANONICAL_COLUMNS, "event_seq")


def union_logs(logs: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name (EL4)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)


CASE = "_case"      # case ids as text that is never null; a table with this column is dealt to tasks by it


def case_key(case: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), case.cast("string")), F.lit(""))


def case_of_key(key: Column) -> Column:
    return F.when(key != "", F.substring(key, 2, 2**31 - 1))


def gather_events(parts: Sequence[tuple[DataFrame, SourceSpec]]) -> DataFrame:
    """One row per source row with all its events still in it: the input of :func:`spread_events`.

    What a source's rows have in common (activity names, source, event type, lifecycle)
    is left out; ``_src`` is the source's place in ``parts``. So a pass over the whole log - a
    join by case - moves each source row once and not once per event. Tables that are all dealt
    by ``CASE`` keep that column.
    """
    dealt = all(CASE in df.columns for df, _ in parts)

    def one(i, df, spec):
        base = _col(spec.resource_col).cast("string")
        stamps = [_col(e.ts_col) for e in spec.events] or [_col(spec.ts_col)]
        people = [base if e.resource_col is None else _col(e.resource_col).cast("string") for e in spec.events] or [base]
        return df.select(
            F.lit(i).alias("_src"), _col(spec.case_col).cast("string").alias("case_id"),
            (F.lit(None) if spec.events else _col(spec.activity_col)).cast("string").alias("_activity"),
            _lit_or_col(spec.case_type).cast("string").alias("case_type"),
            _col(spec.specialty_col).cast("string").alias("specialty"),
            _col(spec.location_col).cast("string").alias("location"),
            F.array(*stamps).alias("_stamps"), F.array(*people).alias("_people"), *([CASE] if dealt else []))

    return union_logs([one(i, df, spec) for i, (df, spec) in enumerate(parts)])


def spread_events(rows: DataFrame, specs: Sequence[SourceSpec]) -> DataFrame:
    """Canonical events, plus ``event_seq``, of the rows of :func:`gather_events`; further columns follow."""
    def fixed(values):
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("_src"))

    names = F.get(F.array(*[F.array(*[F.lit(e.activity) for e in s.events] or [F.lit(None).cast("string")])
                            for s in specs]), F.col("_src"))
    made = {
        "activity": F.when(fixed([bool(s.events) for s in specs]), F.get(names, F.col("event_seq"))).otherwise(F.col("_activity")),
        "timestamp": F.col("timestamp"),
        "lifecycle": fixed([s.lifecycle for s in specs]),
        "event_type": fixed([s.event_type for s in specs]),
        "outcome": F.lit(None).cast("string"),
        "resource": F.get("_people", F.col("event_seq")),
        "source": fixed([s.name for s in specs]),
    }
    own = ("_src", "case_id", "_activity", "case_type", "specialty", "location", "_stamps", "_people")
    # never empty; a plain explode would have the optimizer test so where the rows are read, over expressions of all their times
    wide = rows.select("*", F.posexplode_outer("_stamps").alias("event_seq", "timestamp"))
    return wide.select(*[made[c].alias(c) if c in made else F.col(c) for c in CANONICAL_COLUMNS], "event_seq",
                       *[c for c in rows.columns if c not in own])


def canonical(log: DataFrame) -> DataFrame:
    cols = CANONICAL_COLUMNS + (["duration_minutes"] if "duration_minutes" in log.columns else [])
    return log.select(*cols)


def with_case_duration(log: DataFrame) -> DataFrame:
    """``duration_minutes`` = whole minutes between first and last event of the case (EL5).

    Written as a per-case aggregate joined back rather than an unordered
    window: the aggregate combines map-side, and AQE splits the join
    partition of a hot case, where a window would put the case in one task.
    Null case ids form one group, as in a window.

    Also takes the rows of :func:`gather_events`. The join is on one key that is never
    null, so the aggregate is not shuffled again, and the optimizer drops the join
    where the duration is not read. Rows that are dealt by ``CASE`` (which is dropped) already are not
    moved: each task joins its own cases, looked up and not sorted.
    """
    if "_stamps" in log.columns:
        first, last = F.array_min("_stamps"), F.array_max("_stamps")
    else:
        first = last = F.col("timestamp")
    dealt = CASE in log.columns
    if not dealt:
        log = log.withColumn(CASE, case_key(F.col("case_id")))
    spans = log.groupBy(CASE).agg(span_minutes(F.min(first), F.max(last)).alias("duration_minutes"))
    return log.join(spans.hint("shuffle_hash") if dealt else spans, CASE, "left").drop(CASE)


def case_attributes(parts: Sequence[DataFrame], schema: dict[str, str]) -> DataFrame:
    """Align projections to one schema with typed nulls and union them (EL6)."""
    aligned = []
    for p in parts:
        aligned.append(p.select(*[
            (F.col(n) if n in p.columns else F.lit(None)).cast(t).alias(n)
            for n, t in schema.items()]))
    return union_logs(aligned)


BLOOM_BITS = 22     # bits of the case filter as a power of two (512 KB)


def mining_view(log: DataFrame) -> DataFrame:
    """Events usable for mining: case, activity and timestamp all present (EL7)."""
    return log.filter(F.col("case_id").isNotNull() & F.col("activity").isNotNull() & F.col("timestamp").isNotNull())


def event_order(log: DataFrame) -> list[str]:
    """Total order of events inside a case: timestamp, then tie-breakers."""
    return ["timestamp"] + [c for c in TIE_BREAK if c in log.columns]


def case_steps(log: DataFrame, cfg: MiningConfig = MiningConfig(), by: Sequence[str] = ("case_id",),
               carry: Sequence[str] = ("activity", "timestamp"), lags: Sequence[int] = (1,),
               leads: Sequence[int] = ()) -> DataFrame:
    """The shared "steps" base: neighbours and position of each event inside ``by``."""
    view = mining_view(log)
    return with_neighbors(view, list(by), event_order(view), list(carry), lags=lags,
                          leads=leads, skew=cfg.skew, hot=cfg.hot_cases)


def with_hot_cases(log: DataFrame, cfg: MiningConfig = MiningConfig(), sampled: bool = False) -> MiningConfig:
    """A config carrying the log's hot-case table, sampled once and shared by
    every ordered operator run on this log (instead of one sample per call).

    A log without hot cases needs no buckets, so the operators run on it with skew handling off and
    build the log once, not once more for the buckets. ``sampled``: ``log`` is a sample of
    ``skew.sample_fraction`` already.
    """
    from dataclasses import replace

    from flowlog.session import checkpoint_dir

    if cfg.skew.mode == "off":
        return cfg
    checkpoint_dir(log.sparkSession)
    hot = hot_keys(mining_view(log), ["case_id"], "timestamp", cfg.skew, sampled)
    # bounded (at most rows / hot_rows keys): materialised once in the shared
    # checkpoint folder so every analysis reuses it instead of re-sampling
    hot = hot.checkpoint(eager=True)
    if hot.isEmpty():
        return replace(cfg, skew=replace(cfg.skew, mode="off"))
    return replace(cfg, hot_cases=hot)


def traces(log: DataFrame, cfg: MiningConfig = MiningConfig(),
           fields: Sequence[str] = ("activity", "timestamp")) -> DataFrame:
    """One row per case with its ordered events as ``array<struct>`` (EL8).

    Events are first gathered per (case, bucket) - a hot case is split into
    bounded pieces - and the pieces are concatenated in bucket order, so no
    single sort holds a whole hot case; the output row itself is the whole
    trace by definition.
    """
    view = mining_view(log)
    order = event_order(view)
    pieces = (assign_buckets(view, ["case_id"], "timestamp", cfg.skew, hot=cfg.hot_cases, ties=order[1:4])
              .groupBy("case_id", "_b")
              .agg(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in order],
                                                        *[F.col(f).alias(f"_f_{f}") for f in fields])))
                   .alias("_evs")))
    pieces = pieces.withColumn("_evs", F.transform("_evs", lambda x: F.struct(
        *[x[f"_f_{f}"].alias(f) for f in fields])))
    return (pieces.groupBy("case_id")
            .agg(F.array_sort(F.collect_list(F.struct("_b", "_evs"))).alias("_p"))
            .select("case_id", F.flatten(F.transform("_p", lambda p: p["_evs"])).alias("events")))


def filter_events(log: DataFrame, column: str, values: Sequence | None = None) -> DataFrame:
    """Keep events whose attribute is in ``values`` (or non-null); emptied cases vanish (EL9)."""
    if values is None:
        return log.filter(F.col(column).isNotNull())
    return log.filter(F.col(column).isin(list(values)))


def bloom_words(keys: DataFrame, key: str, bits: int = BLOOM_BITS) -> Column:
    """A Bloom filter of the keys (two hashes), as a scalar subquery: an array of ``2^bits / 64`` longs, whatever their number."""
    words = 1 << (bits - 6)
    places = keys.select(F.explode(F.array(*_bloom_places(F.col(key), bits))).alias("p"))
    held = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b"))
    dense = keys.sparkSession.range(words).withColumnRenamed("id", "w").join(held, "w", "left")
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("long")).alias("b")))),
                                 lambda x: x["b"])).scalar()


def _bloom_places(key: Column, bits: int) -> list[Column]:
    return [F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 64 - bits) for seed in (1, 2)]


def in_bloom(words: Column, key: Column, bits: int = BLOOM_BITS) -> Column:
    """False only if the key is not among those of :func:`bloom_words`."""
    hit = None
    for p in _bloom_places(key, bits):
        word = F.get(words, F.shiftright(p, 6).cast("int"))
        one = F.call_function("shiftright", word, p.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
        hit = one if hit is None else hit & one
    return hit


def filter_cases(log: DataFrame, predicate: Column, bloom_bits: int = BLOOM_BITS) -> DataFrame:
    """Whole cases having at least one event that satisfies ``predicate`` (EL10).

    Events of cases that a Bloom filter of the hit cases rules out are dropped where they are
    read, before the semi join that decides. The filter has a fixed size (``2^bloom_bits`` bits);
    with very many hits it only lets more through.
    """
    hits = log.filter(predicate).select("case_id").where("case_id is not null").distinct()
    words = bloom_words(hits, "case_id", bloom_bits)
    near = log.withColumn("_bloom", words).filter(in_bloom(F.col("_bloom"), F.col("case_id"), bloom_bits)).drop("_bloom")
    return near.join(hits, "case_id", "left_semi")


def variant_fingerprints(log: DataFrame, cfg: MiningConfig = MiningConfig()) -> DataFrame:
    """Per case: trace length and two 64-bit order-sensitive fingerprints.

    Each event contributes ``xxhash64(seed, activity, position)`` and a case
    fingerprint is the XOR of its events' values (Zobrist hashing), so it is
    a plain aggregate that combines map-side.  Two independent seeds give a
    128-bit fingerprint plus the length.
    """
    steps = case_steps(log, cfg, carry=("activity",), lags=())
    s1, s2 = cfg.seeds
    return steps.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("trace_len"),
        F.bit_xor(F.xxhash64(F.lit(s1), "activity", "_pos")).alias("fp1"),
        F.bit_xor(F.xxhash64(F.lit(s2), "activity", "_pos")).alias("fp2"),
    )


def log_stats(log: DataFrame, cfg: MiningConfig = MiningConfig()) -> DataFrame:
    """Events, cases and distinct variants of the mining view (EL11)."""
    view = mining_view(log)
    fps = variant_fingerprints(view, cfg)
    n_events = view.agg(F.count(F.lit(1))).scalar()   # scalar subquery, evaluated once
    return fps.agg(F.count(F.lit(1)).alias("n_cases"),
                   F.count_distinct("trace_len", "fp1", "fp2").alias("n_variants")) \
        .select(n_events.alias("n_events"), "n_cases", "n_variants")
