"""Quality rules whose thresholds follow each language and source.

Per text: words, their code points, symbols, repeated lines, words in repeated windows
of three words, words in capitals. A text that is too short or mostly repetition fails
outright. The other rules compare ratios (in thousandths) with fences, read off quantiles
of the texts of the same language and source:

    high fence = upper quartile + reach * max(upper quartile - lower quartile, slack)

and for the length of words a low fence likewise. The quantiles come from sketches that
can be merged: counts in buckets whose width is at most 1/64 of their values, so a
sketch of many texts is the sum of the sketches of their parts, in any order and whatever
the partitioning, and reruns agree. A source with fewer than ``MIN_DOCS`` texts in a
language borrows the merged sketch of the language, and a language with fewer that of all.

Texts cost one pass; after it only counts travel. The sketches are summed in the tasks
before they are shuffled, and hold a few hundred buckets a group, whatever its size.

Cases: null and empty texts have no word and fail; a null language or source is a group
of its own; very long texts are whole in one row; repeated rows count each and each come
back; an empty table gives an empty result; columns of the table other than the four
named are not read, so no names clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlog.llm.common import SPACE, WORD, materialise, text_of

MIN_WORDS = 50
MAX_REPEAT = 50             # per cent of the words in repeated windows
MIN_DOCS = 50
REACH = 3
QUARTILES = (25, 75)
#: rule -> (numerator, denominator, thousandths of slack, sides)
RULES = {
    "word_length": ("word_chars", "n_words", 500, "both"),
    "symbols": ("n_symbols", "n_words", 30, "high"),
    "dup_lines": ("n_dup_lines", "n_lines", 150, "high"),
    "repeat_words": ("n_repeat_words", "n_words", 110, "high"),
    "capitals": ("n_capitals", "n_words", 30, "high"),
}
SYMBOLS = r"[#*$%&|<>]"
CAPITALS = r"[A-Z]{2,}"


def text_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with the counts of its texts in place of the texts."""
    plain = lambda c: "'" + c.replace("\\", "\\\\") + "'"
    worded = docs.withColumn("words", F.filter(F.split(F.col(text_col), SPACE), lambda w: w != ""))
    worded = worded.withColumn("n_words", F.size("words").cast("long"))
    lined = worded.withColumn("lines", F.filter(F.split(F.col(text_col), "\n"), lambda x: x.rlike(WORD)))
    # windows of three words with their place; sorted only where a window comes twice
    windows = F.expr("""CASE WHEN n_words > 3 THEN transform(
        arrays_zip(slice(words, 1, size(words) - 2), slice(words, 2, size(words) - 2), slice(words, 3, size(words) - 2)),
        w -> concat_ws(' ', w.`0`, w.`1`, w.`2`)) ELSE array() END""")
    ranked = (lined.withColumn("windows", windows)
              .withColumn("ranked", F.expr("""CASE WHEN size(array_distinct(windows)) < size(windows)
                  THEN sort_array(transform(windows, (w, i) -> struct(w AS w, i AS i))) ELSE array() END"""))
              .withColumn("again", F.expr("filter(ranked, (x, i) -> get(ranked, i - 1).w = x.w OR get(ranked, i + 1).w = x.w)")))
    return ranked.select(
        *[c for c in docs.columns if c != text_col], "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.expr(f"regexp_count({text_col}, {plain(SYMBOLS)})").cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("size(array_distinct(flatten(transform(again, x -> array(x.i, x.i + 1, x.i + 2)))))").cast("long").alias("n_repeat_words"),
        F.expr(f"regexp_count({text_col}, {plain(CAPITALS)})").cast("long").alias("n_capitals"))


def ratio(rule: str) -> Column:
    """A rule's ratio in thousandths, rounded down; 0 where there is nothing to divide by."""
    numerator, denominator, _, _ = RULES[rule]
    return F.when(F.col(denominator) > 0, F.expr(f"(1000 * {numerator}) div {denominator}")).otherwise(F.lit(0).cast("long"))


def bucket_of(value: Column) -> Column:
    """Sketch bucket of a value >= 0: the value itself up to 127, then 64 buckets for each doubling."""
    shift = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return F.when(value < 128, value).otherwise(shift * 64 + F.floor(value / F.pow(F.lit(2.0), shift)))


def value_of(bucket: Column) -> Column:
    """Smallest value of a bucket."""
    shift = F.greatest(F.floor(bucket / 64) - 1, F.lit(0))
    return ((bucket - shift * 64) * F.pow(F.lit(2.0), shift)).cast("long")


def sketches(counted: DataFrame, by: list[str]) -> DataFrame:
    """Sketch of every rule's ratios per group of ``by``: rows (by, rule, bucket, n)."""
    return (counted.select(*by, F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), bucket_of(ratio(r)).alias("bucket")) for r in RULES])).alias("x"))
            .select(*by, "x.rule", "x.bucket").groupBy(*by, "rule", "bucket").agg(F.count("*").alias("n")))


def merge(sketch: DataFrame, by: list[str]) -> DataFrame:
    """The sketch of larger groups: counts of equal buckets add up."""
    return sketch.groupBy(*by, "rule", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Rows (by, rule, docs, low, high): the values of the buckets in which the quartiles lie."""
    along = Window.partitionBy(*by, "rule").orderBy("bucket")
    whole = Window.partitionBy(*by, "rule")
    ranked = sketch.withColumn("upto", F.sum("n").over(along)).withColumn("docs", F.sum("n").over(whole))

    def at(percent):
        return value_of(F.min(F.when(100 * F.col("upto") >= percent * F.col("docs"), F.col("bucket"))))

    return ranked.groupBy(*by, "rule").agg(F.max("docs").alias("docs"), at(QUARTILES[0]).alias("low"), at(QUARTILES[1]).alias("high"))


def fences(sketch: DataFrame) -> DataFrame:
    """Per language and source, one column ``<rule>_low`` and ``<rule>_high`` for each rule."""
    per_lang, overall = merge(sketch, ["lang_key"]), merge(sketch, [])
    own = quartiles(sketch, ["lang_key", "source_key"])
    lang = quartiles(per_lang, ["lang_key"]).toDF("lang_key", "rule", "lang_docs", "lang_low", "lang_high")
    whole = quartiles(overall, []).toDF("rule", "all_docs", "all_low", "all_high")
    rows = own.join(lang, ["lang_key", "rule"]).join(whole, "rule")

    def chosen(side):
        return (F.when(F.col("docs") >= MIN_DOCS, F.col(side)).when(F.col("lang_docs") >= MIN_DOCS, F.col(f"lang_{side}"))
                .otherwise(F.col(f"all_{side}")))

    slack = F.create_map(*[F.lit(x) for r, (_, _, s, _) in RULES.items() for x in (r, s)])[F.col("rule")]
    rows = (rows.withColumn("q1", chosen("low")).withColumn("q3", chosen("high"))
            .withColumn("wide", REACH * F.greatest(F.col("q3") - F.col("q1"), slack)))
    out = []
    for rule, (_, _, _, sides) in RULES.items():
        here = F.col("rule") == rule
        out.append(F.max(F.when(here, F.col("q3") + F.col("wide"))).alias(f"{rule}_high"))
        if sides == "both":
            out.append(F.max(F.when(here, F.col("q1") - F.col("wide"))).alias(f"{rule}_low"))
    return rows.groupBy("lang_key", "source_key").agg(*out)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Per row: id, the counts, ``base_failed``, ``failed_rules`` (names of the fences passed) and ``kept``."""
    def key(name):
        return F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit("null"))

    named = docs.select(F.col(id_col).alias("row_id"), key(lang_col).alias("lang_key"), key(source_col).alias("source_key"), text_of(text_col).alias("body"))
    counted = text_counts(named, "body")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    counted = materialise(counted.withColumn("base_failed", failed), "quality-counts")
    sketch = materialise(sketches(counted.where("not base_failed"), ["lang_key", "source_key"]), "quality-sketches")
    joined = counted.join(fences(sketch), ["lang_key", "source_key"], "left")
    beyond = []
    for rule, (_, _, _, sides) in RULES.items():
        out = ratio(rule) > F.col(f"{rule}_high")
        if sides == "both":
            out = out | (ratio(rule) < F.col(f"{rule}_low"))
        beyond.append(F.when(out, F.lit(rule)))
    rules = F.array_compact(F.array(*beyond))
    return (joined.withColumn("failed_rules", F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(rules))
            .select(F.col("row_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals",
                    "base_failed", "failed_rules", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept")))
