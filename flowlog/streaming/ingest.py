"""Incremental CSV file stream -> bronze Parquet tables (IO1-IO6).

Each landing folder is a file stream with ``trigger(availableNow=True)``:
every run picks up only files not yet recorded in the checkpoint, so a
re-run over the same files appends nothing (exactly-once via the file
sink's commit log).  Every row gets ``_source_file`` (from the hidden
``_metadata`` column) and ``_ingestion_timestamp``; malformed lines are
kept with their raw text in ``_rescued_data``.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

RESCUE_COL = "_rescued_data"


@dataclass(frozen=True)
class IngestSource:
    """One landing folder and the bronze table it feeds (IO2)."""

    folder: str
    table: str
    columns: tuple[str, ...] = ()
    sep: str = ";"
    encoding: str = "UTF-8"


def folder_exists(spark: SparkSession, folder: str) -> bool:
    """Whether a folder exists in whatever file system its path names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def header_schema(spark: SparkSession, folder: str, sep: str = ";", encoding: str = "UTF-8",
                  columns: Sequence[str] = ()) -> T.StructType:
    """All-text schema from the given names or the header of the folder's files."""
    if not columns:
        columns = spark.read.option("header", True).option("sep", sep) \
            .option("encoding", encoding).csv(folder).columns
    return T.StructType([T.StructField(c, T.StringType()) for c in columns]
                        + [T.StructField(RESCUE_COL, T.StringType())])


def ingest_to_bronze(spark: SparkSession, src: IngestSource, bronze_root: str,
                     checkpoint_root: str, await_termination: bool = True):
    """Start (and by default await) the availableNow stream of one folder (IO1, IO3, IO4, IO6)."""
    schema = header_schema(spark, src.folder, src.sep, src.encoding, src.columns)
    stream = (spark.readStream.format("csv")
              .option("header", True).option("sep", src.sep).option("encoding", src.encoding)
              .option("enforceSchema", False)     # a header in another order fails instead of swapping columns
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUE_COL)
              .schema(schema).load(src.folder))
    stream = stream.select("*", F.col("_metadata.file_path").alias("_source_file"),
                           F.current_timestamp().alias("_ingestion_timestamp"))
    query = (stream.writeStream.format("parquet")
             .option("checkpointLocation", os.path.join(checkpoint_root, src.table))
             .option("path", os.path.join(bronze_root, src.table))
             .outputMode("append")
             .trigger(availableNow=True)
             .queryName(f"bronze_{src.table}")
             .start())
    if await_termination:
        query.awaitTermination()
    return query


def ingest_all(spark: SparkSession, sources: Sequence[IngestSource], bronze_root: str,
               checkpoint_root: str) -> list:
    """Start every folder's stream, then wait for all of them (they run concurrently)."""
    queries = [ingest_to_bronze(spark, s, bronze_root, checkpoint_root, await_termination=False)
               for s in sources]
    for q in queries:
        q.awaitTermination()
    return queries


def read_bronze(spark: SparkSession, bronze_root: str, table: str) -> DataFrame:
    """Scan a bronze table; ``mergeSchema`` unifies files written under evolving headers (IO5).

    Schema evolution: when an export gains columns, restart the table's
    stream (same checkpoint) with the wider ``IngestSource.columns``; files
    already ingested are not re-read, new files land with the new columns,
    and rows of a file that does not fit the declared header are kept in
    ``_rescued_data``.  One stream and one checkpoint per table: two streams
    writing to one sink path would collide on the sink's batch log.
    """
    return spark.read.option("mergeSchema", "true").parquet(os.path.join(bronze_root, table))
