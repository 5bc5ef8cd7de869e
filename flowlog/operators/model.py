"""Directly-follows model discovery (CF1-CF5).

The reference discovers a process tree with a single-machine solver; here
the model is a table of allowed transitions with virtual START and END,
computed by grouping, so it scales with the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlog.config import MiningConfig
from flowlog.functions import month_key
from flowlog.operators.eventlog import event_order, mining_view
from flowlog.operators.sequence import with_neighbors, with_prefix_xor

# Names of the virtual start and end activities.
START = "[start]"
END = "[end]"


def edge_steps(log: DataFrame, cfg: MiningConfig = MiningConfig(), scope: str = "case",
               with_prefix: bool = False, with_month: bool = False) -> DataFrame:
    """One row per directly-follows step, START and END included.

    Columns: segment, case_id, prev_activity, activity, step (1..len+1) and,
    with ``with_prefix``, ``plen`` and ``px1``/``px2``: fingerprint of the
    activity prefix before the step (exclusive running XOR of
    ``xxhash64(seed, activity, position)``).

    ``scope``: ``'case'`` - per source, the whole cases that touch it (the
    reference's behaviour); ``'source'`` - only that source's events;
    ``'log'`` - one segment for the whole log.  ``with_month`` adds ``month``,
    the month of the case's first event, from the same ordered pass.
    """
    view = mining_view(log)
    by = ["case_id", "source"] if scope == "source" else ["case_id"]
    order = event_order(view)
    steps = with_neighbors(view, by, order, ["activity"], lags=(1,), leads=(1,), skew=cfg.skew,
                           hot=cfg.hot_cases, key_sets=["source"] if scope == "case" else [],
                           key_mins=["timestamp"] if with_month and scope != "source" else [])
    if with_prefix:
        s1, s2 = cfg.seeds
        steps = steps.withColumns({
            "_h1": F.xxhash64(F.lit(s1), "activity", "_pos"),
            "_h2": F.xxhash64(F.lit(s2), "activity", "_pos")})
        steps = with_prefix_xor(steps, by, order, {"_x1": F.col("_h1"), "_x2": F.col("_h2")})
    # scope 'case': every source the case touches, from the same pass (no join)
    seg: Column = {"source": F.col("source"), "log": F.lit("all")}.get(scope, F.col("_seg"))
    if scope == "case":
        steps = steps.withColumn("_seg", F.explode("_set_source"))
    first = {"prev_activity": F.coalesce(F.col("_lag1.activity"), F.lit(START)),
             "activity": F.col("activity"), "step": F.col("_pos")}
    last = {"prev_activity": F.col("activity"), "activity": F.lit(END), "step": F.col("_pos") + 1}
    if with_prefix:
        first.update({"plen": F.col("_pos") - 1, "px1": F.col("_x1"), "px2": F.col("_x2")})
        last.update({"plen": F.col("_pos"),
                     "px1": F.col("_x1").bitwiseXOR(F.col("_h1")),
                     "px2": F.col("_x2").bitwiseXOR(F.col("_h2"))})
    mk = lambda d: F.struct(*[v.alias(k) for k, v in d.items()])
    items = F.when(F.col("_lead1").isNull(), F.array(mk(first), mk(last))).otherwise(F.array(mk(first)))
    extra = [month_key("_min_timestamp").alias("month")] if with_month and scope != "source" else []
    out = steps.select("case_id", seg.cast("string").alias("segment"), *extra, F.explode(items).alias("_s"))
    return out.select("segment", "case_id", *(["month"] if extra else []), "_s.*")


def dfg(edges: DataFrame) -> DataFrame:
    """Directly-follows graph per segment: step and case counts per edge (CF1).

    Accepts raw steps or pre-counted steps (a weight column ``n``).
    """
    weight = F.col("n") if "n" in edges.columns else F.lit(1)
    per_case = edges.groupBy("segment", "prev_activity", "activity", "case_id").agg(
        F.sum(weight).alias("_n"))
    return per_case.groupBy("segment", "prev_activity", "activity").agg(
        F.sum("_n").alias("n_events"), F.count(F.lit(1)).alias("n_cases"))


def step_counts(edges: DataFrame, by: tuple[str, ...] = ("segment",), prefix: bool = False) -> DataFrame:
    """Steps counted per (``by``, [prefix], prev, activity): one shared aggregate that
    model discovery, fitness and precision all read (weight column ``n``)."""
    keys = [*by, *(["plen", "px1", "px2"] if prefix else []), "prev_activity", "activity"]
    return edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def edge_weights(counts: DataFrame) -> DataFrame:
    """Edge weights per segment from :func:`step_counts` (no case counts)."""
    return counts.groupBy("segment", "prev_activity", "activity").agg(F.sum("n").alias("n_events"))


def start_end(graph: DataFrame) -> DataFrame:
    """Start and end activities with their counts (CF2)."""
    starts = graph.filter(F.col("prev_activity") == START).select(
        "segment", F.lit("start").alias("kind"), "activity", "n_events", "n_cases")
    ends = graph.filter(F.col("activity") == END).select(
        "segment", F.lit("end").alias("kind"), F.col("prev_activity").alias("activity"),
        "n_events", "n_cases")
    return starts.unionByName(ends)


def footprint(graph: DataFrame) -> DataFrame:
    """Ordering relation of every pair that is directly-follows in some direction (CF3).

    ``->`` a is followed by b only, ``<-`` only b by a, ``||`` both; pairs not
    listed are in the ``#`` (never adjacent) relation - listing them would be
    all pairs of activities, which is left implicit.
    """
    real = graph.filter((F.col("prev_activity") != START) & (F.col("activity") != END)) \
        .select("segment", F.col("prev_activity").alias("a"), F.col("activity").alias("b"))
    fwd = real.withColumn("_f", F.lit(True))
    bwd = real.select("segment", F.col("b").alias("a"), F.col("a").alias("b")).withColumn("_r", F.lit(True))
    both = fwd.join(bwd, ["segment", "a", "b"], "full_outer")
    rel = (F.when(F.col("_f") & F.col("_r"), "||").when(F.col("_f"), "->").otherwise("<-"))
    return both.select("segment", "a", "b", rel.alias("relation"))


def full_footprint(graph: DataFrame) -> DataFrame:
    """Ordering relation of every pair of a segment's activities, ``#`` for those never adjacent (CF3).

    One row per pair: the square of the activities of a segment, which the vocabulary bounds.
    """
    names = (graph.select("segment", F.explode(F.array("prev_activity", "activity")).alias("a"))
             .where(~F.col("a").isin(START, END)).distinct())
    pairs = names.join(names.select("segment", F.col("a").alias("b")), "segment")
    return (pairs.join(footprint(graph), ["segment", "a", "b"], "left")
            .withColumn("relation", F.coalesce("relation", F.lit("#"))).select("segment", "a", "b", "relation"))


def eventually_follows(log: DataFrame, cfg: MiningConfig = MiningConfig(),
                       scope: str = "case") -> DataFrame:
    """Cases in which some ``a`` occurs before some ``b`` (CF4).

    Per (case, activity) the first and last position are aggregated; the
    case-level self join then works on distinct activities of a case (bounded
    by the activity vocabulary), never on pairs of events.
    """
    view = mining_view(log)
    by = ["case_id", "source"] if scope == "source" else ["case_id"]
    steps = with_neighbors(view, by, event_order(view), ["activity"], lags=(), skew=cfg.skew,
                           hot=cfg.hot_cases, key_sets=["source"] if scope == "case" else [])
    if scope == "case":
        steps = steps.withColumn("_seg", F.explode("_set_source"))
    seg = {"source": F.col("source"), "log": F.lit("all")}.get(scope, F.col("_seg"))
    pos = steps.groupBy("case_id", seg.cast("string").alias("segment"), "activity").agg(
        F.min("_pos").alias("first_pos"), F.max("_pos").alias("last_pos"))
    a = pos.select("segment", "case_id", F.col("activity").alias("a"), "first_pos")
    b = pos.select("segment", "case_id", F.col("activity").alias("b"), "last_pos")
    pairs = a.join(b, ["segment", "case_id"]).filter(F.col("first_pos") < F.col("last_pos"))
    return pairs.groupBy("segment", "a", "b").agg(F.count(F.lit(1)).alias("n_cases"))


def filtered_model(graph: DataFrame, noise_threshold: float = 0.0) -> DataFrame:
    """Edges with ``n_events >= threshold * max outgoing n_events of prev`` (CF5)."""
    w = Window.partitionBy("segment", "prev_activity")
    return (graph.withColumn("_mx", F.max("n_events").over(w))
            .filter(F.col("n_events") >= F.lit(noise_threshold) * F.col("_mx"))
            .select("segment", "prev_activity", "activity", "n_events"))
