"""Table scans, overwrite sinks and post-write audits (IO7, IO8, IO12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan one Parquet table ``{base}/{name}.parquet`` (or a catalog table if ``base`` is empty)."""
    if not base:
        return spark.read.table(name)
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def write_table(df: DataFrame, path_or_name: str, fmt: str = "parquet",
                partition_by: Sequence[str] = (), as_table: bool = False) -> None:
    """Overwrite sink; ``partition_by`` (e.g. the month) enables partition pruning."""
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if as_table:
        writer.saveAsTable(path_or_name)
    else:
        writer.save(path_or_name)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace the partitions (e.g. months) that ``df`` holds rows of; the files of all others stay as they are (IO8).

    Rerunning a month replaces just that month; a first run creates the table.
    """
    df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Make a partitioned table's folder a catalog table (or look its partitions up again) and read it by name (IO7)."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=fmt)
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return read_table(spark, "", name)


def audit_counts(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per written table, as one small DataFrame (IO12)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    del spark
    return out
