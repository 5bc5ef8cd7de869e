"""CSV landing folders whose header changes over time (IO1, IO3-IO6).

The stream only discovers files: ``maxFilesPerTrigger`` bounds a micro-batch,
and the checkpoint remembers what was taken. Each batch groups its files by
their header line, reads every group by name with Spark's CSV reader, and lands
all groups in one table, so columns may be added, dropped or reordered from file
to file without being declared.

A schema log beside the checkpoint holds the table's columns: a batch that meets
new names appends them, in the order seen, as one entry under its batch id. Names
that differ in case only are one column, under the first spelling. Readers take
the schema from the log, not from file footers.

A batch lands in its own folder, ``_batch=<id>``, and writes its schema entry, by
overwriting: a batch that is replayed after a failure replaces itself, and no
reader sees rows twice.

Cases: files without any line are skipped; a file with a header only widens the
schema; repeated or empty names get their position as a suffix; a byte-order mark is
not part of a name; lines shorter or longer than their file's header are kept, with
the raw line in ``_rescued_data``.
"""

from __future__ import annotations

import csv
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from flowlog.streaming.ingest import RESCUE_COL, IngestSource, folder_exists

BATCH_COL = "_batch"
SOURCE_COL, TIME_COL = "_source_file", "_ingestion_timestamp"
FILES_PER_BATCH = 256
_FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                       T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def first_line(spark: SparkSession, path: str, encoding: str) -> str | None:
    """First line of a file on any Hadoop file system, plain or compressed; None if the file is empty."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(conf).open(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec is not None else stream, encoding))
    try:
        return reader.readLine()
    finally:
        reader.close()


def header_names(line: str, sep: str) -> tuple[str, ...]:
    """Column names of a header line, told apart without regard to case."""
    names, seen = [], set()
    for i, raw in enumerate(next(csv.reader([line.lstrip("﻿")], delimiter=sep))):
        name = raw.strip() or f"_c{i}"
        if name.lower() in seen:
            name = f"{name}{i}"
        seen.add(name.lower())
        names.append(name)
    return tuple(names)


class SchemaLog:
    """The table's columns in the order first seen: one JSON entry per batch that met new ones."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def columns(self, before_batch: int | None = None) -> list[str]:
        if not folder_exists(self.spark, self.path):
            return []
        rows = self.spark.read.schema("columns array<string>, batch long").json(self.path)
        if before_batch is not None:
            rows = rows.where(F.col("batch") < before_batch)
        return [c for r in sorted(rows.collect(), key=lambda r: r["batch"]) for c in r["columns"]]

    def widen(self, batch: int, names: Iterable[str]) -> list[str]:
        """Append the names that the log lacks, as the entry of ``batch``; all columns after it."""
        known = self.columns(before_batch=batch)
        have = {c.lower() for c in known}
        new = []
        for name in names:
            if name.lower() not in have:
                have.add(name.lower())
                new.append(name)
        if new:
            entry = self.spark.createDataFrame([(new,)], "columns array<string>")
            entry.coalesce(1).write.mode("overwrite").json(os.path.join(self.path, f"batch={batch}"))
        return known + new


def schema_log(spark: SparkSession, checkpoint_root: str, table: str) -> SchemaLog:
    return SchemaLog(spark, os.path.join(checkpoint_root, table, "schema_log"))


def read_by_header(spark: SparkSession, files: list[str], src: IngestSource) -> dict[tuple[str, ...], list[str]]:
    """Files by the column names of their header; files without a line are left out."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in sorted(files):
        line = first_line(spark, path, src.encoding)
        if line is not None:
            groups.setdefault(header_names(line, src.sep), []).append(path)
    return groups


def _read_group(spark: SparkSession, names: tuple[str, ...], files: list[str], columns: list[str], src: IngestSource) -> DataFrame:
    """One header's files, read by position under their own names and laid out as the table's columns."""
    spelled = {c.lower(): c for c in columns}
    own = [spelled[n.lower()] for n in names]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*own, RESCUE_COL]])
    rows = (spark.read.option("header", True).option("sep", src.sep).option("encoding", src.encoding)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUE_COL).schema(schema).csv(files))
    missing = [c for c in columns if c not in own]
    return rows.select(*[F.col(f"`{c}`") if c not in missing else F.lit(None).cast("string").alias(c) for c in columns],
                       RESCUE_COL, F.col("_metadata.file_path").alias(SOURCE_COL))


def land_batch(spark: SparkSession, files: list[str], batch: int, src: IngestSource, bronze_root: str, checkpoint_root: str) -> None:
    """Land one batch of files: widen the schema log, read each header's files by name, write the batch's folder."""
    groups = read_by_header(spark, files, src)
    if not groups:
        return
    columns = schema_log(spark, checkpoint_root, src.table).widen(batch, [n for names in groups for n in names])
    rows = None
    for names, paths in groups.items():
        part = _read_group(spark, names, paths, columns, src)
        rows = part if rows is None else rows.unionByName(part)
    (rows.withColumn(TIME_COL, F.current_timestamp()).write.mode("overwrite")
     .parquet(os.path.join(bronze_root, src.table, f"{BATCH_COL}={batch}")))


def ingest_evolving(spark: SparkSession, src: IngestSource, bronze_root: str, checkpoint_root: str,
                    files_per_batch: int = FILES_PER_BATCH, await_termination: bool = True):
    """Start (and by default await) the availableNow stream of one landing folder; headers may differ per file."""
    def land(files, batch):
        # at most ``files_per_batch`` names
        names = [r["path"] for r in files.select("path").collect()]
        land_batch(files.sparkSession, names, batch, src, bronze_root, checkpoint_root)

    query = (spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", files_per_batch)
             .option("pathGlobFilter", "[!._]*").load(src.folder).select("path")
             .writeStream.foreachBatch(land)
             .option("checkpointLocation", os.path.join(checkpoint_root, src.table, "stream"))
             .trigger(availableNow=True).queryName(f"bronze_{src.table}").start())
    if await_termination:
        query.awaitTermination()
    return query


def read_evolving(spark: SparkSession, bronze_root: str, checkpoint_root: str, table: str) -> DataFrame:
    """The table under the schema log's columns; rows of files without a column hold null there."""
    columns = schema_log(spark, checkpoint_root, table).columns()
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, RESCUE_COL, SOURCE_COL]]
                          + [T.StructField(TIME_COL, T.TimestampType()), T.StructField(BATCH_COL, T.LongType())])
    path = os.path.join(bronze_root, table)
    if not folder_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
