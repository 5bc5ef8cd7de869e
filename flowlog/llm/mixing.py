"""Mix sources to target weights by systematic sampling.

A source's documents all have the same expected number of copies, its target
over its size. They are put in a fixed order, expected copies are summed along
it, one offset (drawn from the source's name and a seed) is added, and a
document is taken once per integer boundary that its stretch of the running sum
crosses. The order is by size, so short and long documents are taken in
proportion and the words taken stay within about one long document of the
target.

The running sum needs no source in one task: documents are counted per (source,
size class, slot), a slot being a hash of the id, the counts are summed along
each source's few thousand cells, and positions are numbered within a cell.

Cases: a null text has size 0; a null source is a source, last in order; sources
of size 0 have target 0 and their documents are taken 0 times; equal rows are
taken independently; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlog.llm.common import WORD, materialise

SLOTS = 256
MAX_REPEAT = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=(1, 2, 3), max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source with ``source_size`` and ``target``.

    Filling by weight under the bound ``max_repeat * source_size``: with sources
    sorted by bound over weight, those before some place are at their bound and
    the rest share what is left by weight; that place is the first where the
    share of the next source is within its bound.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(order) - 1
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                                                (n % len(weights) + 1).cast("int")).cast("long"))
    per = per.withColumn("bound", F.col("source_size") * max_repeat)
    by_ratio = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    per = (per
           .withColumn("left_size", F.sum("source_size").over(whole) - F.coalesce(F.sum("bound").over(before), F.lit(0)))
           .withColumn("left_weight", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
           .withColumn("level", F.col("left_size") / F.col("left_weight"))
           .withColumn("free", F.col("level") * F.col("weight") <= F.col("bound")))
    level = F.min(F.when(F.col("free"), F.struct(F.col("bound") / F.col("weight"), F.col("level")))).over(whole)
    return (per.withColumn("fill", level.getField("level"))
            .withColumn("target", F.least(F.col("bound").cast("double"), F.col("fill") * F.col("weight")))
            .select("source", "source_size", "target"))


def _draw(*parts: Column) -> Column:
    """Uniform in [0, 1) from the parts' text; the same wherever it is computed."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("double") / float(1 << 32)


def systematic_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   weights=(1, 2, 3), max_repeat: int = MAX_REPEAT, seed: str = "mix") -> DataFrame:
    """``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies`` (columns of these names are replaced)."""
    docs = docs.drop("mix_size", "mix_source_size", "mix_target", "mix_copies", "mix_cell", "mix_pos")
    size = F.col("mix_size")
    sized = docs.withColumn("mix_size", F.coalesce(word_count(F.col(text_col)), F.lit(0).cast("long")))
    size_class = F.when(size > 0, F.floor(F.log2(size.cast("double")) * 2) + 1).otherwise(0).cast("int")
    slot = F.floor(_draw(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))) * SLOTS).cast("int")
    name = F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("null"))
    sized = sized.withColumn("mix_cell", F.concat(F.lpad(size_class.cast("string"), 4, "0"), F.lit(":"),
                                                  F.lpad(slot.cast("string"), 4, "0"), F.lit(":"), name))
    cells = (sized.groupBy(F.col(source_col).alias("source"), "mix_cell")
             .agg(F.sum("mix_size").alias("size"), F.count("*").alias("rows")))
    cells = materialise(cells, "mix-cells")        # a few thousand rows a source, read by both tables below
    targets = source_targets(cells, weights, max_repeat)
    along = Window.partitionBy("source").orderBy("mix_cell").rowsBetween(Window.unboundedPreceding, -1)
    plan = (cells.withColumn("mix_start", F.coalesce(F.sum("rows").over(along), F.lit(0))).select("source", "mix_cell", "mix_start").alias("c")
            .join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source")))
            .select("mix_cell", "mix_start", F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
                    _draw(F.lit(seed + "-offset"), F.coalesce(F.col("c.source"), F.lit(""))).alias("mix_offset")))
    # positions inside a cell: one source, one size class, 1/256 of the ids
    inside = Window.partitionBy("mix_cell").orderBy("mix_size", F.col(id_col).asc_nulls_first(), F.xxhash64(F.col(text_col)))
    share = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(0.0)
    last = F.col("mix_start") + F.col("mix_pos")
    crossed = F.floor(last * share + F.col("mix_offset")) - F.floor((last - 1) * share + F.col("mix_offset"))
    return (sized.withColumn("mix_pos", F.row_number().over(inside)).join(plan, "mix_cell")
            .withColumn("mix_copies", F.when(size > 0, crossed).otherwise(0).cast("long"))
            .drop("mix_cell", "mix_pos", "mix_start", "mix_offset"))
