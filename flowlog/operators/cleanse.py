"""Typing and deduplication of raw tables (SC*, DD1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from flowlog.functions import parse_date, parse_int, parse_timestamp


def cast_columns(df: DataFrame, timestamps: Sequence[str] = (), ints: Sequence[str] = (),
                 dates: Sequence[str] = (), ts_format: str | None = None,
                 date_format: str | None = None) -> DataFrame:
    """Parse lists of text columns in one projection; absent names are ignored."""
    present = set(df.columns)
    cols: dict[str, Column] = {}
    for c in timestamps:
        if c in present:
            cols[c] = parse_timestamp(F.col(f"`{c}`"), ts_format)
    for c in dates:
        if c in present:
            cols[c] = parse_date(F.col(f"`{c}`"), date_format)
    for c in ints:
        if c in present:
            cols[c] = parse_int(F.col(f"`{c}`"))
    return df.withColumns(cols) if cols else df


def _descending(c: Column, dtype: T.DataType) -> Column:
    """A key that sorts ``c`` descending when sorted ascending."""
    if isinstance(dtype, T.TimestampNTZType):
        return -F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    if isinstance(dtype, T.TimestampType):
        return -F.unix_micros(c)
    if isinstance(dtype, T.DateType):
        return -F.unix_date(c)
    if isinstance(dtype, T.BooleanType):
        return ~c
    if isinstance(dtype, (T.NumericType,)):
        return -c
    raise TypeError(f"descending dedup order needs a numeric or time column, got {dtype}")


#: microseconds of a unit, and the type and largest distance of the arrays that hold so many of it
_UNITS = ((60_000_000, "smallint", 2**15 - 1), (1_000_000, "int", 2**31 - 1), (1, "bigint", 2**63 - 1))


def pack_stamps(df: DataFrame, names: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with its timestamps ``names`` told by their distance from the first one of the row, and how to read them.

    The distances are minutes in two bytes, seconds in four or else microseconds in eight, whatever all of the row
    fit in, so no value changes; a shuffled row takes a third of the bytes if its times are close together.
    """
    micros = [F.unix_micros(F.col(f"`{c}`")) for c in names]
    df = df.withColumn("_base", F.coalesce(*micros)) \
        .withColumn("_apart", F.array(*[m - F.col("_base") for m in micros])).drop(*names)
    left = F.lit(True)
    for unit, kind, most in _UNITS:
        # lambdas are called here and now, with the unit at hand
        fits = F.forall("_apart", lambda x: x.isNull() | ((x % unit == 0) & x.between(-most * unit, most * unit))) if unit > 1 else F.lit(True)
        told = F.transform("_apart", lambda x: F.call_function("div", x, F.lit(unit).cast("long")).cast(kind))
        df = df.withColumn(f"_in{unit}", F.when(left & fits, told))
        left = left & F.col(f"_in{unit}").isNull()

    def read(i: int) -> Column:
        return F.timestamp_micros(F.col("_base") + F.coalesce(*[F.get(F.col(f"_in{u}"), F.lit(i)).cast("long") * F.lit(u) for u, _, _ in _UNITS]))

    return df.drop("_apart"), {c: read(i) for i, c in enumerate(names)}


def _stamps(df: DataFrame, but: Sequence[str] = ()) -> list[str]:
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType) and f.name not in but]
    return names if len(names) > 1 else []


def deal(df: DataFrame, by: str) -> DataFrame:
    """``df`` dealt to tasks by column ``by``, its timestamps packed on the way."""
    packed, read = pack_stamps(df, names) if (names := _stamps(df)) else (df, {})
    packed = packed.repartition(by)
    return packed.select(*[read[c].alias(c) if c in read else F.col(f"`{c}`") for c in df.columns])


def keep_one(df: DataFrame, keys: Sequence[str], order_col: str, ascending: bool = True,
             tie_break: Sequence[str] | None = None, by: str | None = None) -> DataFrame:
    """One row per key: first by ``order_col`` (nulls last), ties broken by the
    remaining columns ascending (nulls last) so the survivor never depends on
    input order (DD1).

    Written as ``min`` over the row in its order - an aggregate that combines map-side,
    so a key holding a large share of the rows is reduced in every map task
    before the shuffle, unlike a ``row_number`` window - and the columns are read
    back from the winner, so each value travels once.  Null keys form one
    group, as in a window.

    ``by`` names a column that follows from the keys: rows are dealt to tasks by it, their timestamps packed, and
    stay there, so that later passes by that column move nothing. They are not combined before, so this is
    for tables in which no value of ``by`` has more rows than one task should hold.
    """
    cols = df.columns
    keys = [by, *keys] if by else list(keys)
    schema, read = df.schema, {}
    if by:
        names = _stamps(df, keys)
        df, read = pack_stamps(df, names) if names else (df, {})
        df = df.repartition(by)
    rest = [c for c in (tie_break if tie_break is not None else cols)
            if c not in keys and c != order_col]
    others = [c for c in cols if c not in keys and c != order_col and c not in rest]
    ordering, at = [], {}

    def value(c: str) -> Column:
        return read.get(c, F.col(f"`{c}`"))

    def place(c: str, key: Column | None = None) -> None:
        """Sort by column ``c`` next, or by ``key`` where ``c`` is null last too."""
        if schema[c].nullable:
            ordering.append(value(c).isNull())
        if key is None:
            at[c] = f"f{len(ordering)}"
        ordering.append(value(c) if key is None else key)

    if order_col not in keys or not rest:       # a key is the same in all rows of its group
        place(order_col, None if ascending else _descending(value(order_col), schema[order_col].dataType))
    for c in rest:
        place(c)
    if order_col not in at and order_col not in keys:
        at[order_col] = f"f{len(ordering)}"
        ordering.append(value(order_col))
    ordering = F.struct(*[x.alias(f"f{i}") for i, x in enumerate(ordering)])
    aggs = [F.min(ordering).alias("_row")]
    if others:
        aggs.append(F.min_by(F.struct(*[value(c).alias(c) for c in others]), ordering).alias("_others"))
    picked = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(*aggs)
    if by:
        # true of all rows: whatever is read of them later, the rows that are dealt are the same, and dealt once
        picked = picked.where(F.col("_row").isNotNull())
    return picked.select(*[
        F.col(f"`{c}`").alias(c) if c in keys else F.col("_others").getField(c).alias(c) if c in others
        else F.col("_row").getField(at[c]).alias(c) for c in cols])
