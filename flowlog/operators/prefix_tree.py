"""The prefix tree of a log's cases, and conformance read off it (CF7, CF8).

A node is one distinct sequence of activities from the start of a case: its id, parent,
depth, last activity, and how many cases pass through it. Nodes are told apart by their
parent and the activities themselves, not by fingerprints, so identity is exact.

One ordered pass numbers the events of each case; cases travel on as pieces of at most
``PIECE`` activities. Round r counts the distinct (node, piece) pairs of the r-th pieces,
spreads each distinct pair (not each case) over its prefixes, and every distinct prefix
is a node. A case that goes on alone needs no comparison any more: the rest of its pieces
is a chain of nodes under its own. So there are as many rounds as pieces that two cases
share from the start, no row ever holds a whole long case, and a node's cases are
counted in the tasks before they are shuffled.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, functions as F

from flowlog.config import MiningConfig
from flowlog.functions import month_key
from flowlog.operators.eventlog import event_order, mining_view
from flowlog.operators.model import END, START, filtered_model
from flowlog.operators.sequence import with_neighbors
from flowlog.session import checkpoint_dir

PIECE = 32      # activities of a piece
ROOT = ""       # id of the start of every tree
TREE_COLUMNS = ["segment", "month", "node", "parent", "depth", "prev_activity", "activity", "n"]


def _written(df: DataFrame, folder: str, name: str) -> DataFrame:
    path = os.path.join(folder, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def case_pieces(log: DataFrame, cfg: MiningConfig = MiningConfig(), piece: int = PIECE) -> DataFrame:
    """Rows (case_id, piece, acts, before, ended, sources, month): a case's activities cut into pieces, in one ordered pass.

    ``before`` is the activity before the piece; the last piece of a case ends with END.
    """
    view = mining_view(log)
    steps = with_neighbors(view, ["case_id"], event_order(view), ["activity"], lags=(1,), skew=cfg.skew, hot=cfg.hot_cases,
                           key_sets=["source"], key_mins=["timestamp"])
    number = F.floor((F.col("_pos") - 1) / piece).cast("int")
    pieces = (steps.groupBy("case_id", number.alias("piece"))
              .agg(F.array_sort(F.collect_list(F.struct("_pos", "activity"))).alias("acts"), F.min_by("_lag1.activity", "_pos").alias("before"),
                   F.max("_cnt").alias("cnt"), F.max("_set_source").alias("sources"), F.min("_min_timestamp").alias("first")))
    ended = F.col("piece") == F.floor((F.col("cnt") - 1) / piece)
    acts = F.transform("acts", lambda x: x["activity"])
    return pieces.select("case_id", "piece", F.when(ended, F.concat(acts, F.array(F.lit(END)))).otherwise(acts).alias("acts"),
                         F.coalesce("before", F.lit(START)).alias("before"), ended.alias("ended"), "sources", month_key("first").alias("month"))


def prefix_tree(log: DataFrame, cfg: MiningConfig = MiningConfig(), by_month: bool = True, piece: int = PIECE) -> DataFrame:
    """One tree per segment (every source a case touches) and month of the case's first event (null with ``by_month=False``).

    Columns ``TREE_COLUMNS``; the end of a case is a node with activity END. Rounds run when
    the tree is built; their tables lie in the shared checkpoint folder.
    """
    folder = os.path.join(checkpoint_dir(log.sparkSession), "prefix-tree", uuid.uuid4().hex)
    pieces = _written(case_pieces(log, cfg, piece), folder, "pieces")
    month = F.col("month") if by_month else F.lit(None).cast("string")
    going = (pieces.where("piece = 0").select("case_id", F.explode("sources").alias("segment"), month.alias("month"),
                                              F.lit(ROOT).alias("start"), "acts", "before", "ended"))
    place = ["segment", F.coalesce("month", F.lit("")).alias("m"), "start"]
    out, at = [], 0
    while True:
        counted = going.groupBy("segment", "month", "start", "before", "acts").agg(F.count(F.lit(1)).alias("n"))
        spread = counted.select("segment", "month", "start", "before", "n",
                                F.explode(F.expr("transform(sequence(1, size(acts)), i -> slice(acts, 1, i))")).alias("path"))
        nodes = (spread.groupBy("segment", "month", "start", "before", "path").agg(F.sum("n").alias("n"))
                 .withColumn("node", F.concat(F.lit(f"{at}."), F.monotonically_increasing_id().cast("string"))))
        nodes = _written(nodes, folder, f"nodes-{at}")
        up = nodes.select(*place, F.col("path").alias("up"), F.col("node").alias("above"))
        size = F.size("path")
        out.append(nodes.withColumn("up", F.slice("path", F.lit(1), size - 1)).withColumn("m", F.coalesce("month", F.lit("")))
                   .join(up, ["segment", "m", "start", "up"], "left")
                   .select("segment", "month", "node", F.coalesce("above", "start").alias("parent"), (size + at * piece).cast("long").alias("depth"),
                           F.coalesce(F.get("path", size - 2), F.col("before")).alias("prev_activity"), F.element_at("path", -1).alias("activity"), "n"))
        reached = nodes.select(*place, F.col("path").alias("acts"), "node", F.col("n").alias("cases"))
        on = (going.where("not ended").withColumn("m", F.coalesce("month", F.lit(""))).join(reached, ["segment", "m", "start", "acts"])
              .select("case_id", "segment", "month", F.col("node").alias("start"), "cases"))
        on = _written(on, folder, f"going-{at}")
        if on.isEmpty():
            break
        # the rest of a case that is alone: one node for each activity
        rest = (on.where("cases = 1").join(pieces.where(F.col("piece") > at).select("case_id", "piece", "acts", "before"), "case_id")
                .select("segment", "month", "start", "piece", "before", "acts", F.posexplode("acts").alias("i", "activity")))
        depth = F.col("piece").cast("long") * piece + F.col("i") + 1
        first = (F.col("piece") == at + 1) & (F.col("i") == 0)
        out.append(rest.select("segment", "month", F.concat_ws(":", "start", depth.cast("string")).alias("node"),
                               F.when(first, F.col("start")).otherwise(F.concat_ws(":", "start", (depth - 1).cast("string"))).alias("parent"),
                               depth.alias("depth"), F.coalesce(F.get("acts", F.col("i") - 1), F.col("before")).alias("prev_activity"),
                               "activity", F.lit(1).cast("long").alias("n")))
        at += 1
        going = (on.where("cases > 1").join(pieces.where(F.col("piece") == at).select("case_id", "acts", "before", "ended"), "case_id")
                 .select("case_id", "segment", "month", "start", "acts", "before", "ended"))
    tree = out[0]
    for part in out[1:]:
        tree = tree.unionByName(part)
    return tree


def tree_conformance(tree: DataFrame, noise_threshold: float = 0.0, digits: int = 4) -> DataFrame:
    """Per (segment, month): fitness, precision and traces, read off the tree (CF6-CF8).

    The model is the tree's edges by activity, filtered by ``noise_threshold``. A node's children
    are what the log takes after its prefix: those that the model allows count for fitness, the
    model's successors among which none is a child escape.
    """
    edges = tree.groupBy("segment", "prev_activity", "activity").agg(F.sum("n").alias("n_events"))
    model = filtered_model(edges, noise_threshold)
    enabled = model.groupBy("segment", "prev_activity").agg(F.collect_set("activity").alias("_en"))
    nodes = tree.groupBy("segment", "month", "parent", "prev_activity").agg(
        F.sum("n").alias("_n"), F.collect_list(F.struct("activity", "n")).alias("_next"))
    j = (nodes.join(enabled, ["segment", "prev_activity"], "left")
         .withColumn("_en", F.coalesce("_en", F.array().cast("array<string>"))))
    taken = F.size(F.array_intersect(F.transform("_next", lambda x: x["activity"]), "_en"))
    ok = F.aggregate(F.filter("_next", lambda x: F.array_contains("_en", x["activity"])), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    scored = j.groupBy("segment", "month").agg(
        F.sum("_n").alias("steps"), F.sum(ok).alias("ok"), F.sum(F.when(F.col("parent") == ROOT, F.col("_n")).otherwise(0)).alias("total_traces"),
        F.sum(F.col("_n") * (F.size("_en") - taken)).alias("escaped"), F.sum(F.col("_n") * F.size("_en")).alias("open"))
    fitness = F.round(1.0 - (F.col("steps") - F.col("ok")) / F.col("steps"), digits)
    precision = F.round(F.when(F.col("open") > 0, 1.0 - F.col("escaped") / F.col("open")).otherwise(F.lit(1.0)), digits)
    return scored.select(F.col("segment").alias("source"), fitness.alias("fitness"), precision.alias("precision"), "total_traces", "month")
