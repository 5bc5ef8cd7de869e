"""Report-shaped inputs to tables (RS1-RS5).

Input contract: positional string columns ``c0 .. cN`` plus ``file`` and
``row_no`` (the line number inside the file).  Decoding spreadsheet binaries
is outside the library; any reader that yields this shape works.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from flowlog.config import SkewConfig
from flowlog.operators.sequence import forward_fill

# A number as written in a report cell; not 12d, 12f or NaN.
NUMBER_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
# Fixed value: a time of day written HH:mm:ss.
TIME_PATTERN = r"^\d{2}:\d{2}:\d{2}$"


def numeric_key_rows(df: DataFrame, key: str) -> DataFrame:
    """Keep rows whose key column parses as a number; drops headers and footers (RS1)."""
    return df.filter(F.col(key).cast("string").rlike(NUMBER_PATTERN))


def positional_projection(df: DataFrame, keep: Sequence[str], names: Sequence[str],
                          extra: Sequence[str] = ()) -> DataFrame:
    """Select positional columns in order and name them (RS2)."""
    if len(keep) != len(names):
        raise ValueError("keep and names differ in length")
    return df.select(*[F.col(k).alias(n) for k, n in zip(keep, names)], *extra)


def fill_group_headers(df: DataFrame, rules: dict[str, tuple[Column, Column]],
                       order: str = "row_no", by: Sequence[str] = ("file",),
                       skew: SkewConfig = SkewConfig()) -> DataFrame:
    """Carry group-header values down to the rows that follow (RS3).

    ``rules`` maps an output column to (is-header predicate, value).  A value
    persists until the next header of the same kind (it is not reset by other
    headers).  A huge file is split into row-number buckets so it is not
    one task.
    """
    values = {name: F.when(pred, val) for name, (pred, val) in rules.items()}
    return forward_fill(df, list(by), [order], values, skew=skew)


def normalise_layouts(df: DataFrame, probes: Sequence[tuple[str, dict[str, str]]],
                      pattern: str = TIME_PATTERN, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Pick the first layout whose probe column matches ``pattern`` (RS4).

    ``probes`` is an ordered list of (probe column, {output: source column});
    rows matching no layout are dropped, and returned counted per layout
    (``layout`` null = dropped) as a second DataFrame.
    """
    outputs = list(probes[0][1].keys())
    choice = None
    for i, (probe, mapping) in enumerate(probes):
        hit = F.trim(F.col(probe)).rlike(pattern)
        s = F.struct(F.lit(i).alias("layout"), *[F.col(mapping[o]).alias(o) for o in outputs])
        choice = F.when(hit, s) if choice is None else choice.when(hit, s)
    tagged = df.withColumn("_lay", choice)
    counts = tagged.groupBy(F.col("_lay.layout").alias("layout")).agg(F.count(F.lit(1)).alias("rows"))
    rows = tagged.filter(F.col("_lay").isNotNull()).select(*keep, "_lay.*")
    return rows, counts


def swap_day_month(ts: Column) -> Column:
    """Exchange day and month of a timestamp read day-first as month-first (RS5).

    Only possible when the day is at most 12; otherwise null.
    """
    return F.try_make_timestamp(F.year(ts), F.dayofmonth(ts), F.month(ts), F.hour(ts),
                                F.minute(ts), F.second(ts))


# Month-first text layouts tried in order (12- and 24-hour clocks).
MONTH_FIRST_FORMATS = ["M/d/yyyy h:mm:ss a", "M/d/yyyy h:mm a", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm",
                       "yyyy-MM-dd HH:mm:ss"]


def repair_timestamp(typed: Column, text: Column,
                     formats: Sequence[str] = tuple(MONTH_FIRST_FORMATS)) -> Column:
    """Typed values get day and month exchanged; text is parsed month-first (RS5)."""
    parsed = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])
    return F.when(typed.isNotNull(), swap_day_month(typed)).otherwise(parsed)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files as (file, row_no, value), lines numbered from 1 in file order (the input of RS1-RS4).

    Large files are read in splits. A split's lines come in order, so a line's number is its
    place in its block plus the lines of the file's earlier blocks: one row per block is counted and
    summed, and joined back. Nothing is sorted, and no file is read by one task.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid"), "value")
    blocks = lines.groupBy("file", "_block").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_lines").over(before), F.lit(0).cast("long")))
    return lines.join(blocks, ["file", "_block"]).select(
        "file", (F.col("_before") + F.col("_mid") - F.col("_first") + 1).alias("row_no"), "value")


def split_cells(lines: DataFrame, columns: int, sep: str = ";", value: str = "value") -> DataFrame:
    """Lines cut into ``columns`` positional text columns c0, c1, ...; short lines are padded with null."""
    cells = F.split(F.col(value), "\\Q" + sep + "\\E", -1)
    return lines.select(*[c for c in lines.columns if c != value],
                        *[F.nullif(F.get(cells, F.lit(i)), F.lit("")).alias(f"c{i}") for i in range(columns)])


def _mask_formats() -> dict[str, tuple[str, ...]]:
    """Mask -> formats, the first that fits counts: month before day where both fit, as in the exports."""
    dates = {"9999-9-9": ("yyyy-M-d",), "9999/9/9": ("yyyy/M/d",), "9999.9.9": ("yyyy.M.d",), "99999999": ("yyyyMMdd",)}
    for mark in "/-.":
        dates[f"9{mark}9{mark}9999"] = (f"M{mark}d{mark}yyyy", f"d{mark}M{mark}yyyy")
        dates[f"9{mark}9{mark}9"] = (f"M{mark}d{mark}yy", f"d{mark}M{mark}yy")
    dates |= {"AAA 9, 9999": ("MMM d, yyyy",), "AAA 9 9999": ("MMM d yyyy",), "9 AAA 9999": ("d MMM yyyy",), "9-AAA-9999": ("d-MMM-yyyy",),
              "9/AAA/9999": ("d/MMM/yyyy",)}
    times = {"": "", " 9:9": " H:m", " 9:9:9": " H:m:s", " 9:9 AA": " h:m a", " 9:9:9 AA": " h:m:s a", " 9:9AA": " h:ma", " 9:9:9AA": " h:m:sa",
             " 9 AA": " h a", "A9:9": "'T'H:m", "A9:9:9": "'T'H:m:s"}
    return {d + t: tuple(f + tf for f in fs) for d, fs in dates.items() for t, tf in times.items()}


MASK_FORMATS = _mask_formats()


def text_mask(text: Column) -> Column:
    """The shape of a cell: numbers of one or two digits as 9, longer ones digit by digit, letters as A; fractions of a second cut."""
    plain = F.regexp_replace(F.trim(text), r"(:[0-9]{1,2})[.,][0-9]{1,9}", "$1")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, r"[0-9]", "9"), r"(?<!9)99(?!9)", "9"), r"\p{L}", "A")


def mixed_timestamp(text: Column) -> Column:
    """A cell in any of the known shapes as a timestamp; null for unknown shapes and impossible values (RS5).

    The mask picks the format, so each cell is parsed once or twice, whatever the number of formats.
    """
    cell = F.trim(text)
    plain = F.regexp_replace(cell, r"(:[0-9]{1,2})[.,][0-9]{1,9}", "$1")
    part = F.rpad(F.regexp_extract(cell, r":[0-9]{1,2}[.,]([0-9]{1,9})", 1), 6, "0")
    known = F.create_map(*[x for shape, formats in MASK_FORMATS.items() for x in (F.lit(shape), F.lit("|".join(formats)))])
    formats = F.split(F.try_element_at(known, text_mask(text)), r"\|")
    whole = F.coalesce(F.try_to_timestamp(plain, F.get(formats, F.lit(0))), F.try_to_timestamp(plain, F.get(formats, F.lit(1))))
    micros = F.unix_micros(whole) + F.substring(part, 1, 6).try_cast("long")
    return F.timestamp_micros(micros)


def repair_mixed(typed: Column, text: Column) -> Column:
    """Typed cells get day and month exchanged; text cells are parsed by their shape (RS5)."""
    return F.when(typed.isNotNull(), swap_day_month(typed)).otherwise(mixed_timestamp(text))


def unknown_masks(df: DataFrame, column: str) -> DataFrame:
    """Cells that :func:`mixed_timestamp` cannot read, counted by shape."""
    cell = F.col(column)
    return (df.where(cell.isNotNull() & mixed_timestamp(cell).isNull())
            .groupBy(text_mask(cell).alias("mask")).agg(F.count(F.lit(1)).alias("rows")))
