"""Delimited-file readers and writers (IO9, IO10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_delimited(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8",
                   schema: StructType | None = None, rescue_col: str | None = None) -> DataFrame:
    """Header CSV; every column text unless ``schema`` says otherwise.

    ``encoding="ISO-8859-1"`` reads the latin-1 exports (IO9).  With
    ``rescue_col`` malformed lines (too short / too long) are kept and their
    raw text lands in that column (PERMISSIVE mode).
    """
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    if rescue_col:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", rescue_col)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = ";", encoding: str = "UTF-8") -> None:
    """Header CSV sink, one directory of part files (IO10)."""
    df.write.mode("overwrite").option("header", True).option("sep", sep) \
        .option("encoding", encoding).csv(path)
